"""User code over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.session import stored


def apply_row_processor(df: DataFrame, processor: Column) -> tuple[DataFrame, DataFrame]:
    """A processor column (NULL = drop) over a table.

    Returns the kept rows with their ``example`` and a one-row table of counters. The
    processor's results are written once, so it runs once for both.
    """
    processed = stored(df.withColumn("example", processor), "processed")
    kept = F.col("example").isNotNull()
    counts = processed.agg(
        F.count("*").alias("total"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped")
    )
    return processed.where(kept), counts


def batched_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
                batch_size: int = 64) -> DataFrame:
    """``fn`` over Arrow batches of at most ``batch_size`` rows; input columns are replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                yield fn(batch.slice(start, batch_size))

    return df.mapInArrow(run, schema)
