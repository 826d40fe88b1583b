"""Counts, rates, profiles and losses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.schemas import SOURCE_ORDER


def source_counts(flagged: DataFrame) -> DataFrame:
    """Total, kept and dropped rows per source of a flagged table."""
    bad = F.col("reject_reason").isNotNull()
    return flagged.groupBy("source").agg(
        F.count("*").alias("total"), F.count_if(~bad).alias("kept"), F.count_if(bad).alias("dropped")
    )


def reject_counts(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("reject_reason").isNotNull()).groupBy("source", "reject_reason").agg(
        F.count("*").alias("n")
    )


def keep_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("keep_pct", 100 * F.col("kept") / F.greatest("total", F.lit(1)))


def dedup_report(keyed: DataFrame) -> DataFrame:
    """Input rows, rows removed and rows left, from a keyed table."""
    per_key = keyed.groupBy("key").agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
        F.count("*").alias("final_rows"),
    )


def final_by_source(deduped: DataFrame) -> DataFrame:
    """One row with the surviving rows of each source."""
    return deduped.agg(
        F.count("*").alias("final_examples"),
        *[F.count_if(F.col("source") == s).alias(f"by_source_{s}") for s in SOURCE_ORDER],
    )


def stats_table(counts: DataFrame, report: DataFrame, final: DataFrame) -> DataFrame:
    """All counters as ``(metric, value)`` rows; counters that stayed zero are rows too."""
    melted = counts.select(F.explode(F.array(*[
        F.struct(F.concat(F.col("source"), F.lit("_" + c)).alias("metric"), F.col(c).cast("bigint").alias("value"))
        for c in ("total", "kept", "dropped")
    ])).alias("s")).select("s.*")
    parts = [melted, report.select(F.lit("duplicates_dropped").alias("metric"),
                                   F.col("removed").cast("bigint").alias("value"))]
    parts += [final.select(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in final.columns]
    return reduce(lambda a, b: a.unionByName(b), parts)


def drop_reasons(lengths: DataFrame, seq_len: int) -> DataFrame:
    """Render failures and over-length rows per split."""
    return lengths.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("n_tokens").isNull()).alias("render_failures"),
        F.count_if(F.col("n_tokens") > seq_len).alias("over_length"),
    )


def token_length_profile(lengths: DataFrame) -> DataFrame:
    """Token sum, median, 95th percentile (interpolated, cut to whole numbers) and maximum.

    The percentiles are exact: they count per distinct length, so the state is bounded
    by the number of lengths and not by the rows.
    """
    return lengths.agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.percentile("n_tokens", F.lit(0.5)).cast("bigint").alias("p50"),
        F.percentile("n_tokens", F.lit(0.95)).cast("bigint").alias("p95"),
        F.max("n_tokens").cast("bigint").alias("max"),
    )


def packing_density(placed: DataFrame, seq_len: int) -> DataFrame:
    """Bins, slots, used share and documents per bin; needs no token arrays."""
    bins = placed.groupBy("bin").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("used"))
    totals = bins.agg(
        F.count("*").alias("n_bins"),
        F.coalesce(F.sum("docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum("used"), F.lit(0)).alias("used_tokens"),
    )
    return totals.withColumns({
        "total_slots": F.col("n_bins") * seq_len,
        "density_pct": 100 * F.col("used_tokens") / F.greatest(F.col("n_bins") * seq_len, F.lit(1)),
        "docs_per_bin": F.col("n_docs") / F.greatest("n_bins", F.lit(1)),
    })


def weighted(loss: Column, n: Column) -> Column:
    """Token-weighted mean; zero when there are no tokens at all."""
    return F.sum(loss * n) / F.greatest(F.sum(n), F.lit(1))


def weighted_loss(losses: DataFrame, *by: str) -> DataFrame:
    return losses.groupBy(*by).agg(
        F.sum("n_tokens").alias("n_tokens"), weighted(F.col("loss"), F.col("n_tokens")).alias("loss")
    )


def loss_by_window(losses: DataFrame, log_every: int) -> DataFrame:
    """Weighted loss per ``log_every`` steps; only windows that were completed are logged."""
    end = (F.ceil(F.col("step") / log_every) * log_every).cast("bigint")
    windows = losses.withColumn("_end", end).groupBy("_end").agg(
        F.max("step").alias("step"),
        F.sum("n_tokens").alias("n_tokens"),
        weighted(F.col("loss"), F.col("n_tokens")).alias("loss"),
    )
    return windows.where(F.col("step") == F.col("_end")).drop("_end")
