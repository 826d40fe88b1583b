"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.session import new_path, stored

WORD = r"[^\x20\x09-\x0D]+"
"""A word of the contracts; ``bytes.split()`` finds the same ones in UTF-8."""


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def fold(key: Column, modulus: int) -> Column:
    """crc32 of a key as text, modulo ``modulus``; a NULL key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def map_batches(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with a function ``fn(batch) -> dict of columns``, one call per Arrow batch.

    Columns of ``schema`` that ``fn`` does not return are taken over from the input.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = fields.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(batch)
            columns = [made[n] if n in made else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return df.mapInArrow(run, fields)


def with_batch_column(df: DataFrame, name: str, type_: T.DataType, fn: Callable) -> DataFrame:
    """All columns of ``df`` and one computed per Arrow batch; it runs once, whatever is filtered above."""
    return map_batches(df, lambda batch: {name: fn(batch)}, T.StructType([*df.schema.fields, T.StructField(name, type_)]))


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """Texts of a batch as UTF-8, one at a time; NULL is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    for value in column:
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys`` (integers, no NULL).

    A table holds as many whole groups as a batch completes, so tiny groups cost no call
    each; only a group that crosses batches waits for its end.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
            if held:
                last = held[-1].column(held[-1].schema.get_field_index(k))[-1].as_py()
                change[0] |= bool(v[0] != last)
        starts = np.flatnonzero(change)
        if not len(starts):
            held.append(batch)
            continue
        cut = int(starts[-1])
        done = [*held, *([batch.slice(0, cut)] if cut else [])]
        if done:
            yield pa.Table.from_batches(done)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def bounds(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys."""
    n = len(columns[0])
    change = np.ones(n, bool)
    if n:
        change[1:] = False
        for v in columns:
            change[1:] |= v[1:] != v[:-1]
    starts = np.flatnonzero(change)
    return starts, np.append(starts[1:], n)


def blocks(rows: DataFrame, key: str, member: str, cap: int) -> DataFrame:
    """Rows dealt into pairs of chunks of about ``cap`` rows inside each key with a partner.

    A key with up to ``cap`` rows is one block. A larger one is cut into c chunks by a hash
    of ``member`` and each row goes to the c blocks (lo, hi) its chunk is part of, so every
    two rows of the key meet in a block and no task holds more than two chunks. Keys with
    one row are left out. Adds ``_lo``, ``_hi`` and ``_second`` (the row is of chunk hi).
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(
        key, F.ceil(F.col("_n") / F.lit(cap)).cast("int").alias("_c")
    )
    own = F.pmod(F.xxhash64(F.col(member), F.lit(7)), F.col("_c")).cast("int")
    return (
        rows.join(sizes, key)
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)))
        .withColumn("_lo", F.least("_own", "_other"))
        .withColumn("_hi", F.greatest("_own", "_other"))
        .withColumn("_second", F.col("_own") > F.col("_lo"))
        .drop("_own", "_other", "_c")
    )


class Labels:
    """Components among the positions of one block: ``label[i]`` is the smallest position joined to i."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join i[k] with j[k] for all k; pairs that are together already cost one comparison."""
        x, y = self.label[i], self.label[j]
        apart = x != y
        if not apart.any():
            return
        n = len(self.label)
        up: dict[int, int] = {}

        def root(v: int) -> int:
            while (w := up.get(v, v)) != v:
                up[v] = v = up.get(w, w)
            return v

        for pair in np.unique(x[apart] * n + y[apart]).tolist():
            v, w = root(pair // n), root(pair % n)
            if v != w:
                up[max(v, w)] = min(v, w)
        moved = np.arange(n)
        for v in list(up):
            moved[v] = root(v)
        self.label = moved[self.label]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions that are not their own label, and their labels."""
        moved = np.flatnonzero(self.label != np.arange(len(self.label)))
        return moved, self.label[moved]


def drop(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id): the smallest id reachable, for every id in ``edges`` (a, b) that is not its own.

    Rounds of large and small stars: every larger neighbour of a node points to the smallest
    one, then every smaller neighbour does. The minimum per node is summed up before it is
    shuffled and comes back by a join, which Spark may split, so a node with very many
    neighbours is no single task. A round is one written table in the shared folder with a
    mark on every edge it moved; the rounds end when none moved. Only that flag is collected.
    """
    spark = edges.sparkSession
    a, b = F.col("a"), F.col("b")
    schema = "a bigint, b bigint, moved boolean"

    def written(df: DataFrame) -> tuple[str, DataFrame, bool]:
        path = new_path(spark, "stars")
        df.write.parquet(path)
        out = spark.read.schema(schema).parquet(path)
        return path, out, bool(out.agg(F.max("moved")).first()[0])

    path, now, more = written(
        edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.lit(True).alias("moved"))
    )
    by_node = Window.partitionBy("a").orderBy("b", F.col("moved").desc())
    while more:
        both = now.select("a", "b").union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b"), (F.col("m") != a).alias("moved"))
        ranked = large.select("a", "b", "moved", F.first("b").over(by_node).alias("m"), F.lag("b").over(by_node).alias("last"))
        small = ranked.where("last IS NULL OR last != b").select(
            F.when(b == F.col("m"), a).otherwise(b).alias("a"), F.col("m").alias("b"), (F.col("moved") | (b != F.col("m"))).alias("moved")
        )
        old = path
        path, now, more = written(small)
        drop(spark, old)
    return now.select(a.alias("id"), b.alias("component_id")).distinct()


__all__ = [
    "WORD", "read", "fold", "map_batches", "with_batch_column", "texts", "runs", "bounds", "blocks", "Labels",
    "components", "stored", "drop",
]
