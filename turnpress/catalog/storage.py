"""Sources, sinks and user functions over whole tables."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from turnpress.catalog import inputs, sqltext
from turnpress.catalog.cleaning import _FOLDED, folded_sources
from turnpress.catalog.parsing import flat_examples
from turnpress.catalog.registry import query
from turnpress.catalog.reports import _COUNTS, _LOSSES, PACK_LEN, flagged
from turnpress.catalog.tokens import _PACKED, eval_records, eval_sql, joined, packed_records
from turnpress.operators import report
from turnpress.operators.clean import normalize_single_turn
from turnpress.operators.dedup import dedup_first, select_sources, union_sources, with_dedup_key
from turnpress.operators.mapping import apply_row_processor, batched_map
from turnpress.schemas import MULTI_TURN, SINGLE_TURN
from turnpress.session import new_path
from turnpress.sources import io


@query("scan_single_turn", f"WITH raw1 AS ({inputs.SINGLE_TURN_SQL}) SELECT * FROM raw1")
def scan_single_turn(spark, sf_dir):
    """The raw corpus written as JSON lines and scanned again."""
    path = new_path(spark, "single")
    inputs.raw_single_turn(spark, sf_dir).write.json(path)
    return io.scan_single_turn(spark, path, "json")


@query("scan_multi_turn", f"""
WITH raw2 AS ({sqltext.multi_turn_sql("check")})
SELECT ord, coalesce(system, '') AS system, coalesce(chat, '') AS chat FROM raw2
""")
def scan_multi_turn(spark, sf_dir):
    path = new_path(spark, "multi")
    inputs.raw_multi_turn(spark, sf_dir).write.parquet(path)
    return io.scan_multi_turn(spark, path)


@query("cap_rows", f"WITH raw1 AS ({inputs.SINGLE_TURN_SQL}) SELECT * FROM raw1 ORDER BY ord LIMIT 500")
def cap_rows(spark, sf_dir):
    """Trial run on the first rows of the source: the cap is the operator."""
    return io.cap_rows(inputs.raw_single_turn(spark, sf_dir), 500)


@query("select_sources", f"""
SELECT 'both' AS run, 'single_turn' AS source, count(*) AS n FROM documents
UNION ALL SELECT 'both', 'multi_turn', count(DISTINCT conv_id) FROM conversations
UNION ALL SELECT 'single_only', 'single_turn', count(*) FROM documents
UNION ALL SELECT 'multi_only', 'multi_turn', count(DISTINCT conv_id) FROM conversations
""")
def select_sources_query(spark, sf_dir):
    sources = {SINGLE_TURN: inputs.documents(spark, sf_dir), MULTI_TURN: inputs.conversations(spark, sf_dir)}
    runs = {"both": {}, "single_only": {"single_only": True}, "multi_only": {"multi_only": True}}
    parts = [
        union_sources(*select_sources(sources, **flags).values()).groupBy("source").agg(F.count("*").alias("n"))
        .select(F.lit(run).alias("run"), "source", "n")
        for run, flags in runs.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("write_jsonl", """
SELECT 'd' || doc_id AS id, 2 AS n_messages, CAST(strlen(text) AS BIGINT) AS n_bytes, false AS has_calls FROM documents
""")
def write_jsonl(spark, sf_dir):
    """Every document as one line of JSON, read back as plain lines."""
    path = new_path(spark, "lines")
    io.write_jsonl(inputs.documents(spark, sf_dir), path)
    lines = spark.read.text(path)
    return lines.select(
        F.concat(F.lit("d"), F.get_json_object("value", "$.ord")).alias("id"),
        F.json_array_length(F.get_json_object("value", "$.messages")).alias("n_messages"),
        F.octet_length(F.get_json_object("value", "$.messages[0].content")).cast("bigint").alias("n_bytes"),
        F.contains("value", F.lit('"tool_calls"')).alias("has_calls"),
    )


@query("read_jsonl", f"""
WITH {sqltext.SINGLE}
SELECT ord, 'single_turn' AS source, array_to_string(sigs, ';') AS tools,
  'user:' || query || ':' || chr(10) || 'assistant::' || array_to_string(calls, '|') AS messages
FROM flag1 WHERE reason IS NULL
""")
def read_jsonl(spark, sf_dir):
    path = new_path(spark, "examples")
    io.write_jsonl(normalize_single_turn(inputs.raw_single_turn(spark, sf_dir)), path)
    return flat_examples(io.read_jsonl(spark, path))


@query("write_stats", f"""
{_COUNTS},
{_FOLDED.strip().removeprefix("WITH")},
kept AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY key ORDER BY source_rank, ord) = 1)
SELECT source || '_total' AS metric, total AS value FROM counts UNION ALL SELECT source || '_kept', kept FROM counts
UNION ALL SELECT source || '_dropped', dropped FROM counts
UNION ALL SELECT 'duplicates_dropped', count(*) - count(DISTINCT key) FROM keyed
UNION ALL SELECT 'final_examples', count(*) FROM kept
UNION ALL SELECT 'by_source_single_turn', count(*) FROM kept WHERE source_rank <> 1
UNION ALL SELECT 'by_source_multi_turn', count(*) FROM kept WHERE source_rank = 1
""")
def write_stats(spark, sf_dir):
    examples = folded_sources(spark, sf_dir)
    stats = report.stats_table(
        report.source_counts(flagged(spark, sf_dir)),
        report.dedup_report(with_dedup_key(examples)),
        report.final_by_source(dedup_first(examples)),
    )
    path = new_path(spark, "stats")
    io.write_stats(stats, path)
    return io.read_stats(spark, path)


def _written_packed(spark, sf_dir) -> str:
    path = new_path(spark, "packed")
    records = eval_records(spark, sf_dir, PACK_LEN).drop("ord")
    io.write_packed(packed_records(spark, sf_dir), records, path, PACK_LEN)
    return path


def _moments(third: str) -> str:
    """Sums of the three columns of a packed set, each value times its place."""
    return ", ".join(
        f"CAST(sum(list_sum(list_transform({c}, lambda x, i: CAST(x AS BIGINT) * i))) AS BIGINT) AS {name}_moment"
        for c, name in (("input_ids", "id"), ("labels", "label"), (third, "third"))
    )


@query("write_packed", f"""
WITH train AS ({_PACKED} SELECT count(*) AS n_rows, {_moments("position_ids")} FROM packed),
held AS ({eval_sql(PACK_LEN)} SELECT count(*) AS n_rows, {_moments("attention_mask")} FROM evals)
SELECT 'train' AS split, * FROM train UNION ALL SELECT 'eval', * FROM held
""")
def write_packed(spark, sf_dir):
    """Ids, labels and positions (training) or masks (evaluation) as read back, values and places."""
    train, held = io.read_packed(spark, _written_packed(spark, sf_dir))

    def moment(column):
        return F.sum(F.aggregate(F.transform(column, lambda x, i: x.cast("bigint") * (i + 1)), F.lit(0).cast("bigint"), lambda s, x: s + x))

    parts = [
        df.agg(F.count("*").alias("n_rows"), moment("input_ids").alias("id_moment"), moment("labels").alias("label_moment"), moment(third).alias("third_moment"))
        .withColumn("split", F.lit(name))
        for name, df, third in (("train", train, "position_ids"), ("eval", held, "attention_mask"))
    ]
    return parts[0].unionByName(parts[1])


@query("read_packed", f"""
{_PACKED}
SELECT bin, array_to_string(input_ids, ',') AS input_ids, array_to_string(seq_lens, ',') AS seq_lens FROM packed
""")
def read_packed(spark, sf_dir):
    train, _ = io.read_packed(spark, _written_packed(spark, sf_dir))
    return train.select("bin", joined("input_ids"), joined("seq_lens"))


@query("materialize_once", "SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY lang, source")
def materialize_once(spark, sf_dir):
    """Built on the first call; the second one only reads."""
    path = new_path(spark, "once")
    docs = inputs.table(spark, sf_dir, "documents")
    io.materialize_once(spark, path, lambda: docs.select("lang", "source", "n_chars"))
    again = io.materialize_once(spark, path, lambda: docs.select(F.raise_error(F.lit("built twice"))))
    return again.groupBy("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))


@query("metrics_log", f"""
{_LOSSES}, ends AS (SELECT *, CAST(ceil(step / 5) * 5 AS BIGINT) AS fin FROM losses),
windows AS (SELECT fin AS step, round(sum(loss * n_tokens) / greatest(sum(n_tokens), 1), 6) AS loss FROM ends GROUP BY fin HAVING max(step) = fin)
SELECT 'train' AS kind, step, loss, CAST(step * 0.5 AS DOUBLE) AS elapsed_s, CAST(NULL AS DOUBLE) AS eval_loss FROM windows
UNION ALL SELECT 'eval', max(step), NULL, NULL, round(sum(loss * n_tokens) / greatest(sum(n_tokens), 1), 6) FROM losses
""")
def metrics_log(spark, sf_dir):
    """Training rows per window and one final evaluation row, appended to one log."""
    losses = inputs.losses(spark, sf_dir)
    train = report.loss_by_window(losses, 5).select(
        "step", F.round("loss", 6).alias("loss"), (F.col("step") * 0.5).cast("double").alias("elapsed_s")
    )
    final = losses.agg(
        F.max("step").alias("step"), F.round(report.weighted(F.col("loss"), F.col("n_tokens")), 6).alias("eval_loss")
    )
    path = new_path(spark, "metrics")
    io.append_metrics(train, path)
    io.append_metrics(final, path)
    return io.read_metrics(spark, path).select("kind", "step", "loss", "elapsed_s", "eval_loss")


@query("apply_row_processor", """
SELECT source, count(*) AS kept, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents WHERE length(text) BETWEEN 5 AND 8000 GROUP BY source
""")
def apply_row_processor_query(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    processor = F.when(F.length("text").between(5, 8000), F.struct("source", F.length("text").alias("n_chars")))
    kept, _ = apply_row_processor(docs, processor)
    return kept.groupBy("example.source").agg(
        F.count("*").alias("kept"), F.sum("example.n_chars").alias("n_chars")
    )


@query("row_processor_counts", """
SELECT count(*) AS total, count(*) FILTER (length(text) BETWEEN 5 AND 8000) AS kept,
  count(*) FILTER (length(text) NOT BETWEEN 5 AND 8000) AS dropped FROM documents
""")
def row_processor_counts(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return apply_row_processor(docs, F.when(F.length("text").between(5, 8000), F.struct("source")))[1]


@query("batched_map", "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents")
def batched_map_query(spark, sf_dir):
    """A batch function over Arrow data: byte lengths of all documents."""

    def sizes(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = pc.cast(pc.binary_length(batch.column("text")), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), n], ["doc_id", "n_bytes"])

    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "text")
    return batched_map(docs, sizes, "doc_id bigint, n_bytes bigint")
