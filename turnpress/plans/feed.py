"""Packed records to the order in which ranks read them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnpress.operators.order import batch_plan, epoch_shard_plan, schedule


def training_plan(packed: DataFrame, epochs: int, world: int, global_batch: int, micro_batch: int = 1,
                  seed: int = 42) -> DataFrame:
    """``(bin, epoch, rank, step, slot)`` of every packed record in every epoch; bins are 0..n-1."""
    shards = epoch_shard_plan(packed.select("bin"), "bin", epochs, world, seed, is_dense=True)
    return batch_plan(shards, global_batch, micro_batch, world).select(
        "bin", "epoch", "rank", "index", "step", "slot"
    )


def training_schedule(packed: DataFrame, epochs: int, world: int, global_batch: int, micro_batch: int = 1,
                      warmup_ratio: float = 0.03) -> DataFrame:
    counted = packed.agg(F.count("*").alias("n_rows"))
    return schedule(counted, global_batch, micro_batch, world, epochs, warmup_ratio)


def write_plan(plan: DataFrame, path: str) -> None:
    """One folder per epoch and rank, rows in reading order inside each file."""
    plan.repartitionByRange("epoch", "rank", "index").sortWithinPartitions("epoch", "rank", "index").write.mode(
        "errorifexists"
    ).partitionBy("epoch", "rank").parquet(path)
