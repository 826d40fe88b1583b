"""JSON, text and array transforms over whole tables."""

from pyspark.sql import functions as F

from turnpress.catalog import inputs, sqltext
from turnpress.catalog.registry import query
from turnpress.functions import chat, spans, text, tools
from turnpress.operators.clean import normalize_multi_turn, normalize_single_turn
from turnpress.operators.dedup import dedup_key
from turnpress.operators.tokenize import nested_from_json, nested_to_json
from turnpress.session import sealed, spread, stored


def spec_text(t):
    """A tool as ``name|description|parameters``."""
    fn = t["function"]
    return F.concat_ws("|", fn["name"], fn["description"], fn["parameters"])


def call_signature(c):
    return F.concat(c["function"]["name"], F.lit("("), c["function"]["arguments"], F.lit(")"))


def message_line(m):
    """A message as ``role:content:call|call``."""
    calls = F.coalesce(F.array_join(F.transform(m["tool_calls"], call_signature), "|"), F.lit(""))
    return F.concat(m["role"], F.lit(":"), m["content"], F.lit(":"), calls)


def flat_examples(examples, *more):
    """Examples as texts: tools joined by ``;``, messages by line ends; ``more`` columns follow."""
    return examples.select(
        "ord", "source",
        F.array_join(F.transform("tools", spec_text), ";").alias("tools"),
        F.array_join(F.transform("messages", message_line), "\n").alias("messages"), *more,
    )


@query("parse_permissive_object", f"""
WITH calls AS (
  SELECT event_id, CASE
    WHEN event_id % 3 = 0 THEN '{{"name": "' || event_type || '", "arguments": ' || chr(39) || props || chr(39) || '}}'
    WHEN event_id % 3 = 1 THEN '[' || props || ']'
    ELSE props END AS txt, event_type, props FROM events)
SELECT event_id, txt, event_id % 3 <> 1 AS is_object,
  CASE WHEN event_id % 3 = 0 THEN event_type END AS name,
  CASE WHEN event_id % 3 = 0 THEN props END AS arguments
FROM calls
""")
def parse_permissive_object(spark, sf_dir):
    """Three spellings of every event: single-quoted arguments, a list, a plain object."""
    form = F.col("event_id") % 3
    written = (
        F.when(form == 0, F.concat(F.lit('{"name": "'), "event_type", F.lit("\", \"arguments\": '"), "props", F.lit("'}")))
        .when(form == 1, F.concat(F.lit("["), "props", F.lit("]")))
        .otherwise(F.col("props"))
    )
    forms = inputs.table(spark, sf_dir, "events").select("event_id", written.alias("txt"))
    parsed = spans.with_objects(forms.withColumn("obj", F.array("txt")), "obj", "obj").withColumn(
        "obj", F.get("obj", F.lit(0))
    )
    fields = F.from_json("obj", "name string, arguments string", text.LENIENT)
    return parsed.withColumn("f", fields).select(
        "event_id", "txt", F.col("obj").isNotNull().alias("is_object"),
        F.col("f.name").alias("name"), F.col("f.arguments").alias("arguments"),
    )


@query("normalize_tool_spec", f"""
WITH {sqltext.SINGLE}
SELECT ord, i AS position, sig AS spec FROM (
  SELECT ord, unnest(sigs) AS sig, CAST(generate_subscripts(sigs, 1) AS BIGINT) AS i FROM named1) t
""")
def normalize_tool_spec(spark, sf_dir):
    listed = inputs.raw_single_turn(spark, sf_dir).select("ord", text.json_list(F.col("tools")).alias("texts"))
    specs = listed.withColumn("specs", tools.tool_specs(F.col("texts")))
    return specs.select("ord", F.posexplode("specs").alias("n", "spec")).select(
        "ord", (F.col("n") + 1).cast("bigint").alias("position"),
        F.when(F.col("spec").isNotNull(), spec_text(F.col("spec"))).alias("spec"),
    )


@query("normalize_tool_call", f"""
WITH {sqltext.SINGLE}
SELECT ord, i AS position, sig AS call FROM (
  SELECT ord, unnest(calls) AS sig, CAST(generate_subscripts(calls, 1) AS BIGINT) AS i FROM named1) t
""")
def normalize_tool_call(spark, sf_dir):
    listed = inputs.raw_single_turn(spark, sf_dir).select("ord", text.json_list(F.col("answers")).alias("texts"))
    calls = listed.withColumn("calls", tools.tool_calls(F.col("texts")))
    return calls.select("ord", F.posexplode("calls").alias("n", "call")).select(
        "ord", (F.col("n") + 1).cast("bigint").alias("position"),
        F.when(F.col("call").isNotNull(), call_signature(F.col("call"))).alias("call"),
    )


@query("extract_json_objects", f"""
WITH texts AS (
  SELECT page_id AS id, html AS txt FROM pages
  UNION ALL SELECT 1000000000 + doc_id, text FROM documents
  UNION ALL SELECT 2000000000 + ord, coalesce(system, '') FROM ({sqltext.multi_turn_sql("check")}) r),
{sqltext.spans("found", "texts")},
plain AS (SELECT *, replace(replace(replace(span, '''', '"'), 'True', 'true'), 'None', 'null') AS js FROM found)
SELECT id, CAST(i AS BIGINT) AS position, CAST(start - 1 AS BIGINT) AS start, span FROM plain
WHERE json_valid(span) OR json_valid(js)
""")
def extract_json_objects(spark, sf_dir):
    """Objects in all pages, documents and prompts, with their offsets; spans that do not parse are skipped."""
    pages = inputs.table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("txt"))
    docs = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id") + 1000000000, "text")
    prompts = inputs.raw_multi_turn(spark, sf_dir).select(F.col("ord") + 2000000000, F.coalesce("system", F.lit("")))
    texts = spread(pages.union(docs)).union(prompts).where(F.instr("txt", "{") > 0)
    cut = sealed(texts.select("id", spans.brace_objects(F.col("txt")).alias("at")))
    found = spans.with_objects(cut.withColumn("span", F.col("at.span")), "span", "object")
    each = found.select("id", F.posexplode(F.arrays_zip("at", "span", "object")).alias("n", "s"))
    return each.where("s.object IS NOT NULL").select(
        "id", (F.col("n") + 1).cast("bigint").alias("position"),
        (F.col("s.at.start") - 1).cast("bigint").alias("start"), F.col("s.span").alias("span"),
    )


@query("extract_tools", f"""
WITH {sqltext.MULTI_TOOLS}
SELECT ord, row_number() OVER (PARTITION BY ord ORDER BY i) AS position, sig AS spec FROM decl2
""")
def extract_tools(spark, sf_dir):
    found = tools.with_declared_tools(inputs.raw_multi_turn(spark, sf_dir).select("ord", "system"))
    return found.select("ord", F.posexplode("tools").alias("n", "t")).select(
        "ord", (F.col("n") + 1).cast("bigint").alias("position"), spec_text(F.col("t")).alias("spec")
    )


@query("strip_end_marker", f"""
WITH raw2 AS ({sqltext.multi_turn_sql("check")})
SELECT ord, {sqltext.strip("replace(chat, '<|endoftext|>', '')")} AS chat FROM raw2
""")
def strip_end_marker(spark, sf_dir):
    return inputs.raw_multi_turn(spark, sf_dir).select("ord", chat.without_end_marker(F.col("chat")).alias("chat"))


def _turn_table(spark, sf_dir):
    turns = chat.with_turns(inputs.raw_multi_turn(spark, sf_dir))
    return turns.select("ord", F.posexplode("turns").alias("n", "t")).select(
        "ord", (F.col("n") + 1).cast("bigint").alias("position"), "t.role", "t.content"
    )


@query("split_role_turns", f"WITH {sqltext.MULTI_TURNS} SELECT ord, i AS position, role, content FROM turns2")
def split_role_turns(spark, sf_dir):
    return _turn_table(spark, sf_dir)


@query("map_roles", f"""
WITH {sqltext.MULTI_TURNS}
SELECT CASE role WHEN 'USER' THEN 'user' WHEN 'ASSISTANT' THEN 'assistant' ELSE 'tool' END AS role,
  count(*) AS n_turns, count(DISTINCT ord) AS n_chats FROM turns2 GROUP BY 1
""")
def map_roles(spark, sf_dir):
    turns = _turn_table(spark, sf_dir).select("ord", chat.message_role(F.col("role")).alias("role"))
    return turns.groupBy("role").agg(F.count("*").alias("n_turns"), F.countDistinct("ord").alias("n_chats"))


@query("find_function_call", f"""
WITH {sqltext.MULTI}
SELECT ord, i AS position, strpos(raw_content, '<functioncall>') - 1 AS marker_start,
  strpos(raw_content, '<functioncall>') + 13 + strpos(substr(raw_content, strpos(raw_content, '<functioncall>') + 14), '{{') - 1 + length(span) AS call_end,
  name, args AS arguments
FROM msg2 WHERE marked AND span IS NOT NULL
""")
def find_function_call(spark, sf_dir):
    turns = _turn_table(spark, sf_dir).where((F.col("role") == "ASSISTANT") & chat.has_call_marker(F.col("content")))
    found = turns.select(
        "ord", "position", chat.call_start(F.col("content")).cast("bigint").alias("marker_start"),
        chat.call_end(F.col("content")).cast("bigint").alias("call_end"),
        F.array(chat.call_text(F.col("content"))).alias("objects"),
    )
    parsed = spans.with_objects(found, "objects", "objects").withColumns({
        "object": F.get("objects", F.lit(0)), "call": F.get(tools.tool_calls(F.col("objects")), F.lit(0)),
    })
    return sealed(parsed).where(F.col("object").isNotNull()).select(
        "ord", "position", "marker_start", "call_end",
        F.coalesce(F.col("call.function.name"), F.get_json_object("object", "$.name")).alias("name"),
        F.coalesce(F.col("call.function.arguments"), F.get_json_object("object", "$.arguments")).alias("arguments"),
    )


@query("assistant_turn", f"""
WITH {sqltext.MULTI}
SELECT ord, i AS position, bad AS rejected, CASE WHEN NOT bad THEN content END AS content,
  CASE WHEN NOT bad AND name IS NOT NULL THEN name || '(' || args || ')' END AS call
FROM msg2 WHERE raw_role = 'ASSISTANT'
""")
def assistant_turn(spark, sf_dir):
    """Every assistant turn as its message, or marked as rejected."""
    parsed = chat.with_calls(chat.with_turns(inputs.raw_multi_turn(spark, sf_dir)))
    rows = parsed.select("ord", F.posexplode(F.arrays_zip("turns", "calls")).alias("n", "z"))
    content = F.col("z.turns.content")
    marked = chat.has_call_marker(content)
    bad = marked & F.col("z.calls").isNull()
    return rows.where(F.col("z.turns.role") == "ASSISTANT").select(
        "ord", (F.col("n") + 1).cast("bigint").alias("position"), bad.alias("rejected"),
        F.when(~bad, F.when(marked, chat.text_before_call(content)).otherwise(content)).alias("content"),
        F.when(~bad & marked, call_signature(F.col("z.calls"))).alias("call"),
    )


@query("parse_chat", f"""
WITH {sqltext.MULTI}
SELECT c.ord, CASE WHEN NOT c.bad THEN string_agg(m.role || ':' || m.content || ':' || coalesce(m.name || '(' || m.args || ')', ''), chr(10) ORDER BY m.i) END AS messages
FROM conv2 c LEFT JOIN msg2 m USING (ord) GROUP BY c.ord, c.bad
""")
def parse_chat(spark, sf_dir):
    parsed = chat.with_messages(inputs.raw_multi_turn(spark, sf_dir))
    return parsed.select("ord", F.array_join(F.transform("messages", message_line), "\n").alias("messages"))


@query("normalize_single_turn", f"""
WITH {sqltext.SINGLE}
SELECT ord, 'single_turn' AS source, array_to_string(sigs, ';') AS tools,
  'user:' || query || ':' || chr(10) || 'assistant::' || array_to_string(calls, '|') AS messages
FROM flag1 WHERE reason IS NULL
""")
def normalize_single_turn_query(spark, sf_dir):
    return flat_examples(normalize_single_turn(inputs.raw_single_turn(spark, sf_dir)))


@query("normalize_multi_turn", f"""
WITH {sqltext.MULTI}
SELECT f.ord, 'multi_turn' AS source, f.sigs AS tools,
  string_agg(m.role || ':' || m.content || ':' || coalesce(m.name || '(' || m.args || ')', ''), chr(10) ORDER BY m.i) AS messages
FROM flag2 f JOIN msg2 m USING (ord) WHERE f.reason IS NULL GROUP BY f.ord, f.sigs
""")
def normalize_multi_turn_query(spark, sf_dir):
    return flat_examples(normalize_multi_turn(inputs.raw_multi_turn(spark, sf_dir)))


@query("nested_to_json", f"""
WITH {sqltext.SINGLE}
SELECT ord, array_to_string(sigs, ';') AS tools,
  'user:' || query || ':' || chr(10) || 'assistant::' || array_to_string(calls, '|') AS messages,
  true AS same_key
FROM flag1 WHERE reason IS NULL
""")
def nested_to_json_query(spark, sf_dir):
    """Nested columns to JSON texts and back; the key must not change on the way."""
    examples = normalize_single_turn(inputs.raw_single_turn(spark, sf_dir))
    keyed = examples.withColumn("_before", dedup_key(F.col("messages"), F.col("tools")))
    back = sealed(nested_from_json(nested_to_json(keyed)))
    same = (dedup_key(F.col("messages"), F.col("tools")) == F.col("_before")).alias("same_key")
    # Stored: both sides of the join read one parse.
    both = stored(flat_examples(back, same).drop("source"), "nested")
    return both.drop("same_key").join(both.select("ord", "same_key"), "ord")
