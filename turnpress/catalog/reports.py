"""Counts, rates, profiles and losses over whole tables."""

from pyspark.sql import functions as F

from turnpress.catalog import inputs, sqltext
from turnpress.catalog.cleaning import _FOLDED, folded_sources
from turnpress.catalog.registry import query
from turnpress.operators import report
from turnpress.operators.dedup import dedup_first, with_dedup_key
from turnpress.operators.order import holdout_split, with_shuffle_key
from turnpress.operators.packing import pack_ffd, supervised_tokens
from turnpress.operators.tokenize import fits, token_lengths, tokenize
from turnpress.session import stored

SEQ_LEN = 2048
PACK_LEN = 8192
EVAL_SIZE = 200
SEED = 42


def flagged(spark, sf_dir):
    return inputs.flagged_single_turn(spark, sf_dir).unionByName(inputs.flagged_multi_turn(spark, sf_dir))


_COUNTS = f"""
WITH {sqltext.SINGLE}, {sqltext.MULTI},
flags AS (SELECT 'single_turn' AS source, reason FROM flag1 UNION ALL SELECT 'multi_turn', reason FROM flag2),
counts AS (SELECT source, count(*) AS total, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason IS NOT NULL) AS dropped
  FROM flags GROUP BY source)"""


@query("source_counts", f"{_COUNTS} SELECT * FROM counts")
def source_counts(spark, sf_dir):
    return report.source_counts(flagged(spark, sf_dir))


@query("reject_counts", f"{_COUNTS} SELECT source, reason AS reject_reason, count(*) AS n FROM flags WHERE reason IS NOT NULL GROUP BY ALL")
def reject_counts(spark, sf_dir):
    return report.reject_counts(flagged(spark, sf_dir))


@query("keep_rate", f"{_COUNTS} SELECT source, total, kept, dropped, round(100.0 * kept / greatest(total, 1), 6) AS keep_pct FROM counts")
def keep_rate(spark, sf_dir):
    rates = report.keep_rate(report.source_counts(flagged(spark, sf_dir)))
    return rates.withColumn("keep_pct", F.round("keep_pct", 6))


@query("dedup_report", f"""
{_FOLDED}
SELECT count(*) AS input_rows, count(*) - count(DISTINCT key) AS removed, count(DISTINCT key) AS final_rows FROM keyed
""")
def dedup_report(spark, sf_dir):
    return report.dedup_report(with_dedup_key(folded_sources(spark, sf_dir)))


@query("final_by_source", f"""
{_FOLDED},
kept AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY key ORDER BY source_rank, ord) = 1)
SELECT count(*) AS final_examples, count(*) FILTER (source_rank <> 1) AS by_source_single_turn,
  count(*) FILTER (source_rank = 1) AS by_source_multi_turn FROM kept
""")
def final_by_source(spark, sf_dir):
    return report.final_by_source(dedup_first(folded_sources(spark, sf_dir)))


_SPLIT_LENGTHS = f"""
WITH {sqltext.RENDERED_DOC},
ranked AS (SELECT *, row_number() OVER (ORDER BY {sqltext.key("'42'", "ord")}) AS r FROM toks),
lens AS (SELECT *, CASE WHEN r <= {EVAL_SIZE} THEN 'eval' ELSE 'train' END AS split FROM ranked)"""


def split_lengths(spark, sf_dir):
    docs = with_shuffle_key(inputs.documents(spark, sf_dir), SEED, "ord")
    return token_lengths(holdout_split(docs, EVAL_SIZE))


@query("drop_reasons", f"""
{_SPLIT_LENGTHS}
SELECT split, count(*) AS n_rows, count(*) FILTER (NOT trained) AS render_failures,
  count(*) FILTER (trained AND n_tokens > {SEQ_LEN}) AS over_length FROM lens GROUP BY split
""")
def drop_reasons(spark, sf_dir):
    return report.drop_reasons(split_lengths(spark, sf_dir), SEQ_LEN)


@query("token_length_profile", f"""
WITH {sqltext.RENDERED_DOC}
SELECT CAST(sum(n_tokens) AS BIGINT) AS n_tokens, CAST(floor(quantile_cont(n_tokens, 0.5)) AS BIGINT) AS p50,
  CAST(floor(quantile_cont(n_tokens, 0.95)) AS BIGINT) AS p95, max(n_tokens) AS max FROM toks WHERE trained AND n_tokens <= {SEQ_LEN}
""")
def token_length_profile(spark, sf_dir):
    lengths = token_lengths(inputs.documents(spark, sf_dir))
    return report.token_length_profile(lengths.where(fits(F.col("n_tokens"), SEQ_LEN)))


def first_fit(items: str, capacity: int) -> str:
    """CTEs ending in ``bins(ord, len, bin)``: first fit, item by item, over ``items(i, ord, len)``."""
    return f"""
ffd AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST(-1 AS BIGINT) AS bin, CAST([] AS BIGINT[]) AS room
  UNION ALL
  SELECT i, pos - 1, CASE WHEN pos <= len(room) THEN list_concat(list_concat(room[1:pos - 1], [room[pos] - n]), room[pos + 1:])
    ELSE list_append(room, {capacity} - n) END
  FROM (
    SELECT t.i, t.len AS n, f.room,
      coalesce(nullif(list_position(list_transform(f.room, lambda r: r >= t.len), true), 0), len(f.room) + 1) AS pos
    FROM ffd f JOIN {items} t ON t.i = f.i + 1) step),
bins AS (SELECT t.ord, t.len, f.bin FROM ffd f JOIN {items} t USING (i))"""


CONV_ITEMS = f"""
{sqltext.RENDERED_CONV},
items AS (
  SELECT row_number() OVER (ORDER BY n_tokens DESC, {sqltext.key("'42'", "ord")}) AS i, ord, n_tokens AS len
  FROM toks WHERE trained AND n_tokens <= {PACK_LEN})"""


def packed_conversations(spark, sf_dir):
    """Bins of all conversations by length, without token arrays."""
    keyed = with_shuffle_key(inputs.conversations(spark, sf_dir), SEED, "ord")
    lengths = stored(token_lengths(keyed).select("ord", "shuffle_key", "n_tokens"), "lengths")
    return pack_ffd(lengths.where(fits(F.col("n_tokens"), PACK_LEN)), PACK_LEN)


@query("packing_density", f"""
WITH RECURSIVE {CONV_ITEMS}, {first_fit('items', PACK_LEN)}
SELECT count(DISTINCT bin) AS n_bins, count(*) AS n_docs, CAST(sum(len) AS BIGINT) AS used_tokens,
  count(DISTINCT bin) * {PACK_LEN} AS total_slots,
  round(100.0 * sum(len) / (count(DISTINCT bin) * {PACK_LEN}), 6) AS density_pct,
  round(count(*) / count(DISTINCT bin), 6) AS docs_per_bin
FROM bins
""")
def packing_density(spark, sf_dir):
    out = report.packing_density(packed_conversations(spark, sf_dir), PACK_LEN)
    return out.withColumns({c: F.round(c, 6) for c in ("density_pct", "docs_per_bin")})


@query("supervised_tokens", f"""
WITH {sqltext.RENDERED_CONV}
SELECT ord, CAST(sum(CASE WHEN role = 'assistant' THEN strlen(txt) - 20 ELSE 0 END) AS BIGINT) AS n_supervised
FROM seg GROUP BY ord HAVING bool_or(role = 'assistant')
""")
def supervised_tokens_query(spark, sf_dir):
    coded = tokenize(inputs.conversations(spark, sf_dir)).where(F.col("labels").isNotNull())
    return supervised_tokens(coded).select("ord", F.col("n_supervised").cast("bigint"))


_LOSSES = """
WITH losses AS (
  SELECT event_id // 8 + 1 AS step, value AS loss, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n_tokens FROM events)"""


@query("weighted_loss", f"""
{_LOSSES} SELECT CAST(sum(n_tokens) AS BIGINT) AS n_tokens, round(sum(loss * n_tokens) / greatest(sum(n_tokens), 1), 6) AS loss FROM losses
""")
def weighted_loss(spark, sf_dir):
    return report.weighted_loss(inputs.losses(spark, sf_dir)).withColumn("loss", F.round("loss", 6))


@query("loss_by_window", f"""
{_LOSSES}, ends AS (SELECT *, CAST(ceil(step / 5) * 5 AS BIGINT) AS fin FROM losses)
SELECT fin AS step, CAST(sum(n_tokens) AS BIGINT) AS n_tokens, round(sum(loss * n_tokens) / greatest(sum(n_tokens), 1), 6) AS loss
FROM ends GROUP BY fin HAVING max(step) = fin
""")
def loss_by_window(spark, sf_dir):
    return report.loss_by_window(inputs.losses(spark, sf_dir), 5).withColumn("loss", F.round("loss", 6))
