"""Rendering, tokenisation, masks, packing and records over whole tables."""

from pyspark.sql import functions as F

from turnpress.catalog import inputs, sqltext
from turnpress.catalog.registry import query
from turnpress.catalog.reports import CONV_ITEMS, EVAL_SIZE, PACK_LEN, SEED, SEQ_LEN, first_fit, packed_conversations
from turnpress.functions.tokens import TOOLS_FOOT, TOOLS_HEAD, ByteTokenizer, ChatTemplate, resolve_pad
from turnpress.functions.vocabulary import VocabularyTokenizer
from turnpress.operators import packing
from turnpress.operators.clean import normalize_single_turn
from turnpress.operators.order import holdout_split, with_shuffle_key
from turnpress.operators.tokenize import fits, tokenize, with_segments
from turnpress.session import new_path, sealed
from turnpress.sources.io import stored_in_buckets

PAD = resolve_pad(ByteTokenizer())


def joined(c):
    """An integer array as text."""
    return F.array_join(F.col(c).cast("array<string>"), ",").alias(c)


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _rendered_single(arguments: str) -> str:
    """Segments of the single-turn examples; ``arguments`` is the text of a call's arguments in the template."""
    text = "c[length(string_split(c, '(')[1]) + 2:length(c) - 1]"
    return f"""
WITH {sqltext.SINGLE},
good AS (SELECT * FROM flag1 WHERE reason IS NULL),
t AS (SELECT ord, unnest(fl) AS f, generate_subscripts(fl, 1) AS i FROM good),
tl2 AS (
  SELECT ord, string_agg(chr(10) || '{{"type": "function", "function": {{"name": ' || json_extract(f, '$.name')
    || ', "description": ' || CASE WHEN json_type(f, '$.description') = 'VARCHAR' THEN CAST(json_extract(f, '$.description') AS VARCHAR) ELSE '""' END
    || ', "parameters": ' || coalesce({sqltext.spaced("json_extract(f, '$.parameters')")}, '{{}}') || '}}}}', '' ORDER BY i) AS block
  FROM t GROUP BY ord),
a AS (
  SELECT ord, string_agg(chr(10) || '<tool_call>' || chr(10) || '{{"name": "' || string_split(c, '(')[1] || '", "arguments": '
    || {arguments.format(text)} || '}}' || chr(10) || '</tool_call>', '' ORDER BY i) AS body
  FROM (SELECT ord, unnest(calls) AS c, generate_subscripts(calls, 1) AS i FROM good) u GROUP BY ord)
SELECT ord, 0 AS position, 'system' AS role, '<|im_start|>system' || chr(10) || 'You are a helpful assistant.' || {_sql_text(TOOLS_HEAD)}
  || block || {_sql_text(TOOLS_FOOT)} || '<|im_end|>' || chr(10) AS txt FROM tl2
UNION ALL SELECT ord, 1, 'user', '<|im_start|>user' || chr(10) || query || '<|im_end|>' || chr(10) FROM good
UNION ALL SELECT ord, 2, 'assistant', '<|im_start|>assistant' || body || '<|im_end|>' || chr(10) FROM a
"""


def _segments_of_single(spark, sf_dir, template):
    rendered = with_segments(normalize_single_turn(inputs.raw_single_turn(spark, sf_dir)), template)
    return rendered.select("ord", F.posexplode("segments").alias("position", "s")).select(
        "ord", "position", "s.role", F.col("s.text").alias("txt")
    )


@query("render_chat", _rendered_single("{}"))
def render_chat(spark, sf_dir):
    """Segments of every valid single-turn example, with tool block and calls."""
    return _segments_of_single(spark, sf_dir, ChatTemplate())


@query("render_chat_quoted", _rendered_single("CAST(to_json({}) AS VARCHAR)"))
def render_chat_quoted(spark, sf_dir):
    """The same with the arguments as a JSON string, as the template's own encoder writes them."""
    return _segments_of_single(spark, sf_dir, ChatTemplate(quoted_arguments=True))


def _with_ids(name: str, rendered: str) -> str:
    """CTE ``name(ord, i, role, ids)``: byte ids of every segment."""
    return f"""{rendered},
{name} AS (
  SELECT ord, i, role, list_concat(list_concat([257], list_transform(regexp_extract_all(h, '..'), lambda p: CAST('0x' || p AS INTEGER))), [258, 10]) AS ids
  FROM (SELECT ord, i, role, hex(encode(replace(replace(txt, '<|im_start|>', ''), '<|im_end|>' || chr(10), ''))) AS h FROM seg) x)"""


_CONV_IDS = _with_ids("coded", sqltext.RENDERED_CONV) + """,
rows2 AS (
  SELECT ord, flatten(list(ids ORDER BY i)) AS input_ids,
    flatten(list(CASE WHEN role = 'assistant' THEN ids ELSE list_transform(ids, lambda x: -100) END ORDER BY i)) AS labels
  FROM coded GROUP BY ord HAVING bool_or(role = 'assistant'))"""


@query("tokenize", f"""
WITH {_with_ids("coded", sqltext.RENDERED_DOC)},
flat AS (SELECT ord, flatten(list(ids ORDER BY i)) AS ids FROM coded GROUP BY ord)
SELECT ord, CAST(len(ids) AS BIGINT) AS n_tokens, CAST(list_sum(ids) AS BIGINT) AS id_sum,
  CAST(list_sum(list_transform(ids, lambda x, i: CAST(x AS BIGINT) * i)) AS BIGINT) AS id_moment
FROM flat
""")
def tokenize_query(spark, sf_dir):
    """Ids of all documents; the moment weighs each id with its place."""
    coded = tokenize(inputs.documents(spark, sf_dir))
    return coded.select(
        "ord", F.size("input_ids").cast("bigint").alias("n_tokens"),
        F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("id_sum"),
        F.aggregate(
            F.transform("input_ids", lambda x, i: x.cast("bigint") * (i + 1)), F.lit(0).cast("bigint"), lambda s, x: s + x
        ).alias("id_moment"),
    )


@query("tokenize_vocabulary")
def tokenize_vocabulary(spark, sf_dir):
    """Ids of every whole document text by a public vocabulary; the moment weighs each id with its place."""
    import public_tokenizers

    tokenizer = VocabularyTokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.array(F.struct("text")).alias("segments"))
    ids = F.flatten(tokenizer.segment_ids(F.col("segments")))
    return sealed(docs.select("ord", ids.alias("ids"))).select(
        "ord", F.size("ids").cast("bigint").alias("n_tokens"),
        F.aggregate("ids", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("id_sum"),
        F.aggregate(
            F.transform("ids", lambda x, i: x.cast("bigint") * (i + 1)), F.lit(0).cast("bigint"), lambda s, x: s + x
        ).alias("id_moment"),
    )


@query("mask_labels", f"""
WITH {_CONV_IDS}
SELECT ord, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels FROM rows2
""")
def mask_labels(spark, sf_dir):
    coded = tokenize(inputs.conversations(spark, sf_dir)).where(F.col("labels").isNotNull())
    return coded.select("ord", joined("input_ids"), joined("labels"))


@query("pack_ffd", f"""
WITH RECURSIVE {CONV_ITEMS}, {first_fit('items', PACK_LEN)}
SELECT b.ord, b.len AS n_tokens, b.bin, row_number() OVER (PARTITION BY b.bin ORDER BY t.i) - 1 AS slot
FROM bins b JOIN items t USING (ord)
""")
def pack_ffd(spark, sf_dir):
    placed = packed_conversations(spark, sf_dir)
    return placed.select("ord", F.col("n_tokens").cast("bigint"), "bin", packing.slot_number().cast("bigint").alias("slot"))


def packed_records(spark, sf_dir):
    """Packed records of all conversations; tokens are stored, bins found on lengths."""
    keyed = with_shuffle_key(inputs.conversations(spark, sf_dir), SEED, "ord")
    tokens = stored_in_buckets(
        spark, new_path(spark, "tokens"), "shuffle_key", lambda n: tokenize(keyed.repartition(n, "shuffle_key"))
    ).where(fits(F.col("n_tokens"), PACK_LEN))
    _, placed = packing.place(tokens, PACK_LEN)
    return packing.build_packed(placed, PACK_LEN, PAD)


_PACKED = f"""
WITH RECURSIVE {_CONV_IDS},
items AS (
  SELECT row_number() OVER (ORDER BY n_tokens DESC, {sqltext.key("'42'", "ord")}) AS i, ord, n_tokens AS len
  FROM toks WHERE trained AND n_tokens <= {PACK_LEN}), {first_fit('items', PACK_LEN)},
docs AS (SELECT b.bin, t.i, t.len, r.input_ids, r.labels FROM bins b JOIN items t USING (ord) JOIN rows2 r USING (ord)),
packs AS (
  SELECT bin, CAST({PACK_LEN} - sum(len) AS BIGINT) AS pad, flatten(list(input_ids ORDER BY i)) AS ids, flatten(list(labels ORDER BY i)) AS labels,
    flatten(list(range(len) ORDER BY i)) AS positions, list(len ORDER BY i) AS lens
  FROM docs GROUP BY bin),
packed AS (
  SELECT bin, list_concat(ids, list_transform(range(pad), lambda x: {PAD})) AS input_ids,
    list_concat(labels, list_transform(range(pad), lambda x: -100)) AS labels,
    list_concat(positions, list_transform(range(pad), lambda x: 0)) AS position_ids,
    CASE WHEN pad > 0 THEN list_append(lens, pad) ELSE lens END AS seq_lens, lens
  FROM packs)"""


@query("build_packed", f"""
{_PACKED}
SELECT bin, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels,
  array_to_string(position_ids, ',') AS position_ids, array_to_string(seq_lens, ',') AS seq_lens FROM packed
""")
def build_packed(spark, sf_dir):
    return packed_records(spark, sf_dir).select(
        "bin", joined("input_ids"), joined("labels"), joined("position_ids"), joined("seq_lens")
    )


def eval_sql(seq_len: int) -> str:
    """CTEs ending in ``evals``: padded records of the held-out documents."""
    return f"""
WITH {_with_ids("coded", sqltext.RENDERED_DOC)},
ranked AS (SELECT doc_id AS ord, row_number() OVER (ORDER BY {sqltext.key("'42'", "doc_id")}) AS r FROM documents),
rows2 AS (
  SELECT ord, flatten(list(ids ORDER BY i)) AS input_ids,
    flatten(list(CASE WHEN role = 'assistant' THEN ids ELSE list_transform(ids, lambda x: -100) END ORDER BY i)) AS labels
  FROM coded JOIN ranked USING (ord) WHERE r <= {EVAL_SIZE} GROUP BY ord),
evals AS (
  SELECT ord, list_concat(input_ids, list_transform(range({seq_len} - len(input_ids)), lambda x: {PAD})) AS input_ids,
    list_concat(labels, list_transform(range({seq_len} - len(labels)), lambda x: -100)) AS labels,
    list_concat(list_transform(input_ids, lambda x: 1), list_transform(range({seq_len} - len(input_ids)), lambda x: 0)) AS attention_mask
  FROM rows2 WHERE len(input_ids) <= {seq_len})"""


_EVAL = eval_sql(SEQ_LEN)


def eval_records(spark, sf_dir, seq_len: int = SEQ_LEN, pad: int = PAD):
    """Held-out documents, one padded record each."""
    docs = holdout_split(with_shuffle_key(inputs.documents(spark, sf_dir), SEED, "ord"), EVAL_SIZE)
    coded = tokenize(docs.where(F.col("split") == "eval")).where(fits(F.col("n_tokens"), seq_len))
    return packing.build_eval(coded.select("ord", "input_ids", "labels"), seq_len, pad)


@query("build_eval", f"""
{_EVAL}
SELECT ord, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels,
  array_to_string(attention_mask, ',') AS attention_mask FROM evals
""")
def build_eval(spark, sf_dir):
    return eval_records(spark, sf_dir).select("ord", joined("input_ids"), joined("labels"), joined("attention_mask"))


@query("resolve_pad", f"""
{_EVAL}, pads AS (SELECT * FROM (VALUES ('pad id', 7), ('no pad id', 256)) v(setting, pad_id))
SELECT setting, ord, CAST(pad_id AS BIGINT) AS pad_id,
  CAST(len(list_filter(attention_mask, lambda x: x = 0)) AS BIGINT) AS n_pad FROM evals, pads
""")
def resolve_pad_query(spark, sf_dir):
    """Padding written into every evaluation record, with a padding id of its own and without."""
    settings = {"pad id": ByteTokenizer(pad_id=7), "no pad id": ByteTokenizer()}
    rows = [
        eval_records(spark, sf_dir, pad=resolve_pad(tokenizer)).select(
            F.lit(name).alias("setting"), "ord",
            F.element_at("input_ids", -1).cast("bigint").alias("last"),
            F.size(F.filter(F.arrays_zip("input_ids", "attention_mask"), lambda x: (x["attention_mask"] == 0) & (x["input_ids"] == resolve_pad(tokenizer)))).cast("bigint").alias("n_pad"),
        )
        for name, tokenizer in settings.items()
    ]
    whole = rows[0].unionByName(rows[1])
    fallback = F.when(F.col("setting") == "pad id", resolve_pad(settings["pad id"])).otherwise(resolve_pad(settings["no pad id"]))
    return whole.select("setting", "ord", F.when(F.col("n_pad") > 0, F.col("last")).otherwise(fallback).cast("bigint").alias("pad_id"), "n_pad")


@query("project_batch_columns", f"""
{_PACKED}
SELECT array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels,
  array_to_string(position_ids, ',') AS position_ids FROM packed
""")
def project_batch_columns(spark, sf_dir):
    train = packing.project_train(packed_records(spark, sf_dir))
    return train.select(*[joined(c) for c in train.columns])


@query("project_eval_columns", f"""
{_EVAL}
SELECT array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels,
  array_to_string(attention_mask, ',') AS attention_mask FROM evals
""")
def project_eval_columns(spark, sf_dir):
    held = packing.project_eval(eval_records(spark, sf_dir))
    return held.select(*[joined(c) for c in held.columns])


@query("doc_boundaries", f"""
{_PACKED}
SELECT bin, array_to_string(list_transform(lens, lambda x, i: coalesce(list_sum(lens[1:i - 1]), 0)), ',') AS starts,
  array_to_string(lens, ',') AS lengths, true AS consistent FROM packed
""")
def doc_boundaries(spark, sf_dir):
    found = packing.doc_boundaries(packed_records(spark, sf_dir), PAD)
    return found.select("bin", joined("starts"), joined("lengths"), "consistent")
