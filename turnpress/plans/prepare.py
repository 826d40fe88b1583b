"""Raw corpora to one cleaned, deduplicated set of examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnpress.operators.clean import flag_multi_turn, flag_single_turn
from turnpress.operators.dedup import dedup_first, select_sources, with_dedup_key, with_row_id
from turnpress.operators.report import (
    dedup_report, final_by_source, keep_rate, source_counts, stats_table,
)
from turnpress.schemas import EXAMPLE, MULTI_TURN, SINGLE_TURN, SOURCE_ORDER
from turnpress.sources.io import cap_rows, discard, inputs_of, is_complete, materialize_once, publish, write_jsonl, write_stats

FLAGGERS = {SINGLE_TURN: flag_single_turn, MULTI_TURN: flag_multi_turn}


def prepare(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    output: str,
    caps: dict[str, int | None] | None = None,
    single_only: bool = False,
    multi_only: bool = False,
) -> dict[str, DataFrame]:
    """Clean, merge and deduplicate.

    Publishes ``table/`` (Parquet, what ``pack`` reads), ``examples/`` (the same rows as JSON
    lines), ``rates/`` and ``stats/``. The corpora are parsed once into a stage table with
    reasons, keys and row numbers, so duplicates are found on narrow rows. Every output is put in place by a rename when it is whole, so a run
    that died goes on from the last output; the stage table goes when all are there.
    """
    caps = caps or {}
    enabled = select_sources(sources, single_only, multi_only)
    outputs = [f"{output}/{name}" for name in ("table", "examples", "rates", "stats")]
    names = [name for name in SOURCE_ORDER if name in enabled]
    made_from = {"sources": names, "caps": [caps.get(n) for n in names], "inputs": inputs_of(*(enabled[n] for n in names))}
    for path in outputs:  # before any work: a folder of another run is an error
        if is_complete(spark, path):
            publish(spark, path, lambda at: None, made_from)
    if not all(is_complete(spark, path) for path in outputs):
        flagged = lambda: reduce(lambda a, b: a.unionByName(b), [
            FLAGGERS[name](cap_rows(enabled[name], caps.get(name))).withColumn("source_rank", F.lit(rank))
            for rank, name in enumerate(SOURCE_ORDER) if name in enabled
        ])
        stage = f"{output}/_flagged"
        flags = materialize_once(spark, stage, lambda: with_row_id(with_dedup_key(flagged())), made_from)
        valid = flags.where(F.col("reject_reason").isNull()).drop("reject_reason")
        columns = EXAMPLE.fieldNames()
        kept = materialize_once(spark, outputs[0], lambda: dedup_first(valid).select(*columns), made_from)
        counts = source_counts(flags)
        publish(spark, outputs[1], lambda at: write_jsonl(kept, at), made_from)
        publish(spark, outputs[2], lambda at: keep_rate(counts).write.parquet(at), made_from)
        publish(spark, outputs[3], lambda at: write_stats(stats_table(counts, dedup_report(valid), final_by_source(kept)), at), made_from)
        discard(spark, stage)
    return {"examples": spark.read.parquet(outputs[0]), "rates": spark.read.parquet(outputs[2])}
