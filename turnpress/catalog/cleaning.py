"""Predicates, union and duplicate removal over whole tables."""

from pyspark.sql import functions as F

from turnpress.catalog import inputs, sqltext
from turnpress.catalog.parsing import call_signature
from turnpress.catalog.registry import query
from turnpress.functions.chat import with_messages
from turnpress.functions.text import json_list
from turnpress.functions.tokens import trainable
from turnpress.functions.tools import called_names, tool_calls, tool_names, tool_specs, with_declared_tools
from turnpress.operators import clean
from turnpress.operators.dedup import dedup_first, union_sources, with_dedup_key
from turnpress.operators.tokenize import fits, rendered_ok, token_lengths, tokenize
from turnpress.schemas import MULTI_TURN, SINGLE_TURN


@query("filter_user_chars", """
SELECT doc_id, length(text) AS n_chars FROM documents WHERE length(text) BETWEEN 5 AND 8000
""")
def filter_user_chars(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir).where(clean.user_chars_ok(F.col("messages")))
    return docs.select(
        F.col("ord").alias("doc_id"), F.length(F.get("messages", F.lit(0))["content"]).cast("bigint").alias("n_chars")
    )


@query("filter_tool_count", f"""
WITH {sqltext.SINGLE}
SELECT ord, CAST(len(tl) AS BIGINT) AS n_tools FROM lists1 WHERE len(tl) BETWEEN 1 AND 32
""")
def filter_tool_count(spark, sf_dir):
    listed = inputs.raw_single_turn(spark, sf_dir).select("ord", json_list(F.col("tools")).alias("t"))
    return listed.where(clean.tool_count_ok(F.col("t"))).select("ord", F.size("t").cast("bigint").alias("n_tools"))


@query("filter_message_count", f"""
WITH {sqltext.MULTI}
SELECT ord, n_messages FROM conv2 WHERE NOT bad AND n_messages <= 40
""")
def filter_message_count(spark, sf_dir):
    parsed = _parsed_chats(spark, sf_dir)
    return parsed.where(clean.message_count_ok(F.col("messages"))).select(
        "ord", F.size("messages").cast("bigint").alias("n_messages")
    )


def _parsed_chats(spark, sf_dir):
    return with_messages(inputs.raw_multi_turn(spark, sf_dir))


@query("filter_valid_json_lists", f"""
WITH {sqltext.SINGLE}
SELECT ord, CAST(len(tl) AS BIGINT) AS n_tools, CAST(len(al) AS BIGINT) AS n_answers FROM lists1 WHERE tl IS NOT NULL AND len(al) > 0
""")
def filter_valid_json_lists(spark, sf_dir):
    listed = inputs.raw_single_turn(spark, sf_dir).select(
        "ord", json_list(F.col("tools")).alias("t"), json_list(F.col("answers")).alias("a")
    )
    return listed.where(clean.valid_json_lists(F.col("t"), F.col("a"))).select(
        "ord", F.size("t").cast("bigint").alias("n_tools"), F.size("a").cast("bigint").alias("n_answers")
    )


@query("filter_all_normalized", f"""
WITH {sqltext.SINGLE}
SELECT ord, array_to_string(names, ',') AS tools, array_to_string(calls, ',') AS calls FROM named1
WHERE tl IS NOT NULL AND al IS NOT NULL
  AND NOT coalesce(list_bool_or(list_transform(sigs, lambda s: s IS NULL)), false)
  AND NOT coalesce(list_bool_or(list_transform(calls, lambda c: c IS NULL)), false)
""")
def filter_all_normalized(spark, sf_dir):
    listed = inputs.raw_single_turn(spark, sf_dir).select(
        "ord", tool_specs(json_list(F.col("tools"))).alias("t"), tool_calls(json_list(F.col("answers"))).alias("c")
    )
    return listed.where(clean.all_present(F.col("t")) & clean.all_present(F.col("c"))).select(
        "ord", F.array_join(tool_names(F.col("t")), ",").alias("tools"),
        F.array_join(F.transform("c", call_signature), ",").alias("calls"),
    )


@query("filter_role_presence", f"""
SELECT conv_id AS ord, count(*) AS n_messages FROM conversations GROUP BY conv_id
HAVING bool_or(role = 'user') AND bool_or(role = 'assistant')
""")
def filter_role_presence(spark, sf_dir):
    kept = inputs.conversations(spark, sf_dir).where(clean.role_presence_ok(F.col("messages")))
    return kept.select("ord", F.size("messages").cast("bigint").alias("n_messages"))


@query("filter_declared_tools", f"""
WITH {sqltext.MULTI}
SELECT c.ord, coalesce(string_agg(m.name, ',' ORDER BY m.i), '') AS called
FROM conv2 c LEFT JOIN (SELECT * FROM msg2 WHERE name IS NOT NULL) m USING (ord) WHERE NOT c.bad AND NOT c.undeclared GROUP BY c.ord
""")
def filter_declared_tools(spark, sf_dir):
    parsed = with_declared_tools(_parsed_chats(spark, sf_dir))
    return parsed.where(F.col("messages").isNotNull() & clean.declared_ok(F.col("messages"), F.col("tools"))).select(
        "ord", F.array_join(called_names(F.col("messages")), ",").alias("called")
    )


@query("filter_render_failures", f"""
WITH {sqltext.RENDERED_CONV} SELECT ord, n_tokens FROM toks WHERE trained
""")
def filter_render_failures(spark, sf_dir):
    coded = tokenize(inputs.conversations(spark, sf_dir))
    return coded.where(rendered_ok(F.col("input_ids"))).select("ord", F.size("input_ids").cast("bigint").alias("n_tokens"))


@query("filter_overlength", f"""
WITH {sqltext.RENDERED_DOC} SELECT ord, n_tokens FROM toks WHERE trained AND n_tokens <= 2048
""")
def filter_overlength(spark, sf_dir):
    lengths = token_lengths(inputs.documents(spark, sf_dir))
    return lengths.where(fits(F.col("n_tokens"), 2048)).select("ord", F.col("n_tokens").cast("bigint"))


@query("filter_trainable", f"""
SELECT conv_id AS ord, count(*) AS n_assistant FROM conversations WHERE role = 'assistant' GROUP BY conv_id
""")
def filter_trainable(spark, sf_dir):
    coded = tokenize(inputs.conversations(spark, sf_dir)).where(trainable(F.col("labels")))
    turns = inputs.conversations(spark, sf_dir).select(
        "ord", F.size(F.filter("messages", lambda m: m["role"] == "assistant")).cast("bigint").alias("n_assistant")
    )
    return turns.join(coded.select("ord"), "ord", "left_semi")


@query("union_sources", f"""
SELECT 'single_turn' AS source, 0 AS source_rank, count(DISTINCT conv_id) AS n_examples, count(*) AS n_messages FROM conversations
UNION ALL SELECT 'multi_turn', 1, count(*), 2 * count(*) FROM documents
""")
def union_sources_query(spark, sf_dir):
    both = union_sources(
        inputs.conversations(spark, sf_dir).withColumn("source", F.lit(SINGLE_TURN)),
        inputs.documents(spark, sf_dir, MULTI_TURN),
    )
    return both.groupBy("source", "source_rank").agg(
        F.count("*").alias("n_examples"), F.sum(F.size("messages")).alias("n_messages")
    )


_KEY = f"""
sha1(string_agg(role || '::' || lower({sqltext.strip('content')}) || '::', chr(10) ORDER BY i) || '##')"""


@query("dedup_key", f"""
WITH m AS (
  SELECT 'c' || conv_id AS id, turn AS i, role, text AS content FROM conversations
  UNION ALL SELECT 'd' || doc_id, 0, 'user', text FROM documents
  UNION ALL SELECT 'd' || doc_id, 1, 'assistant', lang FROM documents)
SELECT id, {_KEY} AS key FROM m GROUP BY id
""")
def dedup_key_query(spark, sf_dir):
    talks = with_dedup_key(inputs.conversations(spark, sf_dir)).select(F.concat(F.lit("c"), "ord").alias("id"), "key")
    docs = with_dedup_key(inputs.documents(spark, sf_dir)).select(F.concat(F.lit("d"), "ord").alias("id"), "key")
    return talks.union(docs)


@query("dedup_key_calls", f"""
WITH {sqltext.SINGLE}
SELECT ord, sha1('user::' || lower({sqltext.strip('query')}) || '::' || chr(10) || 'assistant::::' || array_to_string(calls, '|') || '##'
  || array_to_string(list_sort(names), ',')) AS key
FROM flag1 WHERE reason IS NULL
""")
def dedup_key_calls(spark, sf_dir):
    """Keys of examples with tools and calls."""
    return with_dedup_key(clean.normalize_single_turn(inputs.raw_single_turn(spark, sf_dir))).select("ord", "key")


_FOLDED = f"""
WITH m AS (
  SELECT 0 AS source_rank, conv_id AS ord, turn AS i, role, text AS content FROM conversations
  UNION ALL SELECT 1, conv_id, turn, role, ' ' || chr(9) || translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || chr(10) || ' ' FROM conversations
  UNION ALL SELECT 2, doc_id, 0, 'user', text FROM documents
  UNION ALL SELECT 2, doc_id, 1, 'assistant', lang FROM documents),
keyed AS (SELECT source_rank, ord, {_KEY} AS key FROM m GROUP BY source_rank, ord)"""


def folded_sources(spark, sf_dir):
    """Conversations, the same in capitals, and all documents, in this precedence."""
    plain, loud = inputs.repeated_conversations(spark, sf_dir)
    return union_sources(plain, loud, inputs.documents(spark, sf_dir))


@query("dedup_first", f"""
{_FOLDED}
SELECT source_rank, ord, key FROM keyed
QUALIFY row_number() OVER (PARTITION BY key ORDER BY source_rank, ord) = 1
""")
def dedup_first_query(spark, sf_dir):
    return dedup_first(folded_sources(spark, sf_dir)).select("source_rank", "ord", "key")
