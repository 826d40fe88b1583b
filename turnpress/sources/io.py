"""Scans and sinks."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.functions.text import spaced_json
from turnpress.functions.tokens import tool_json
from turnpress.operators.order import order_cutoff, with_first
from turnpress.operators.permutation import unused
from turnpress.schemas import EVAL, EXAMPLE, INTS, METRICS, PACKED, RAW_MULTI_TURN, RAW_SINGLE_TURN, STATS, TOOLS


def _scan(spark: SparkSession, path: str, schema: T.StructType, fmt: str, has_ord: bool) -> DataFrame:
    """Typed rows; a line or file that does not fit the schema ends the job."""
    reader = spark.read.format(fmt).option("mode", "FAILFAST")
    if has_ord:
        return reader.schema(schema).load(path)
    body = T.StructType([f for f in schema if f.name != "ord"])
    rows = reader.schema(body).load(path)
    ordered = with_file_order(rows) if fmt == "parquet" else with_line_order(rows)
    return ordered.select(*schema.fieldNames())


def with_file_order(parquet: DataFrame) -> DataFrame:
    """``ord`` for Parquet files without one: files by path, rows as stored.

    The number depends on the files alone, so a task that is run again gives the same
    order. Only the list of file paths is numbered in one task.
    """
    rows = parquet.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = parquet.select(F.col("_metadata.file_path").alias("_file")).distinct()
    numbered = files.withColumn("_n", F.row_number().over(Window.orderBy("_file")).cast("bigint"))
    return rows.join(numbered, "_file").withColumn("ord", F.col("_n") * (1 << 40) + F.col("_row")).drop(
        "_file", "_row", "_n"
    )


def with_line_order(lines: DataFrame) -> DataFrame:
    """``ord`` for text or JSON lines without one: files by path, lines as stored, counted from zero.

    A file is read in splits. Rows are numbered inside their split and the counts of the
    splits before it are added; the number does not depend on how files were split. Only
    the list of splits, one row each, is summed in one task.
    """
    place = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"), "_id": F.monotonically_increasing_id()}
    rows = lines.select("*", *(c.alias(n) for n, c in place.items()))
    splits = rows.groupBy("_file", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("_file", "_start", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    numbered = rows.join(offsets, ["_file", "_start"]).withColumn("ord", F.col("_id") + F.col("_shift"))
    return numbered.drop("_file", "_start", "_id", "_shift")


def scan_single_turn(spark: SparkSession, path: str, fmt: str = "parquet", has_ord: bool = True) -> DataFrame:
    return _scan(spark, path, RAW_SINGLE_TURN, fmt, has_ord)


def scan_multi_turn(spark: SparkSession, path: str, fmt: str = "parquet", has_ord: bool = True) -> DataFrame:
    """Multi-turn corpus; missing texts read as empty."""
    return without_nulls(_scan(spark, path, RAW_MULTI_TURN, fmt, has_ord))


def without_nulls(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("system", "chat")})


def cap_rows(df: DataFrame, max_rows: int | None, order: str = "ord") -> DataFrame:
    """The first rows in source order, for trial runs; None keeps all.

    The cut-off number is found by counting, so the cap itself is a filter and no sort. Of rows
    with that number, as many stay as are missing.
    """
    if max_rows is None:
        return df
    if max_rows <= 0:
        return df.limit(0)
    (first,) = unused(df, "first")
    return with_first(df, max_rows, order, order_cutoff(df, max_rows, order), first).where(first).drop(first)


def example_line(tools: Column) -> Column:
    """An example as one JSON object: tool parameters nested, absent ``tool_calls`` left out."""
    specs = F.array_join(F.transform(tools, tool_json), ", ")
    head = F.substring_index(F.to_json(F.struct("ord", "source")), "}", 1)
    return F.concat(head, F.lit(',"tools":['), specs, F.lit('],"messages":'), F.to_json("messages"), F.lit("}"))


def write_jsonl(examples: DataFrame, path: str) -> None:
    """One object per line; text is not escaped beyond what JSON asks for."""
    examples.select(example_line(F.col("tools")).alias("value")).write.mode("errorifexists").text(path)


def read_jsonl(spark: SparkSession, path: str, has_ord: bool = True) -> DataFrame:
    """Prepared examples; nested tool parameters come back as JSON text.

    Lines without ``ord`` are numbered in file order; a line that is no example ends the job.
    """
    rows = _scan(spark, path, EXAMPLE, "json", has_ord)

    def respaced(tool):
        fn = tool["function"]
        nested = F.when(F.startswith(fn["parameters"], F.lit("{")), spaced_json(fn["parameters"]))
        return F.struct(
            tool["type"].alias("type"),
            F.struct(
                fn["name"].alias("name"), fn["description"].alias("description"),
                F.coalesce(nested, fn["parameters"]).alias("parameters"),
            ).alias("function"),
        )

    return rows.withColumn("tools", F.transform("tools", respaced).cast(TOOLS))


def write_stats(stats: DataFrame, path: str) -> None:
    """Counters in metric order, one small file."""
    stats.coalesce(1).sortWithinPartitions("metric").write.mode("errorifexists").json(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATS).json(path)


def _checked(df: DataFrame, columns: tuple[str, ...], seq_len: int) -> DataFrame:
    """Fails the write when an array is not exactly ``seq_len`` long."""
    checks = {
        c: F.when(F.size(c) == seq_len, F.col(c)).otherwise(
            F.raise_error(F.concat(F.lit(f"{c} is not {seq_len} long: "), F.size(c))).cast(INTS)
        )
        for c in columns
    }
    return df.withColumns(checks)


GROUP_TOKENS = 1 << 20
"""Tokens per column of a row group. Readers decode a whole batch of rows, which ends with its row group, into memory."""
GROUP_ROWS = 256
"""Rows of a row group where their lengths vary."""


def _grouped(write: DataFrameWriter, rows: int) -> DataFrameWriter:
    """Parquet in row groups of at most ``rows`` rows, so that no reader meets thousands of arrays at once."""
    return write.option("parquet.block.row.count.limit", max(1, rows))


def write_packed(packed: DataFrame, records: DataFrame, path: str, seq_len: int, made_from: dict | None = None) -> None:
    """``train/`` (packed) and ``eval/`` (one conversation per row) as Parquet; what is complete stays.

    What is there from other parameters or inputs is an error. Row groups hold about
    ``GROUP_TOKENS`` tokens a column, however many rows a task writes.
    """
    rows = GROUP_TOKENS // seq_len
    train = _checked(packed, ("input_ids", "labels", "position_ids"), seq_len)
    held = _checked(records, ("input_ids", "labels", "attention_mask"), seq_len)
    spark = packed.sparkSession
    publish(spark, f"{path}/train", lambda at: _grouped(train.write, rows).parquet(at), made_from)
    publish(spark, f"{path}/eval", lambda at: _grouped(held.write, rows).parquet(at), made_from)


def read_packed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (
        spark.read.schema(PACKED).parquet(f"{path}/train"),
        spark.read.schema(EVAL).parquet(f"{path}/eval"),
    )


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a stage has committed its output to ``path``."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


MADE_FROM = "_made_from"


def inputs_of(*inputs: DataFrame) -> dict[str, list]:
    """What tells inputs apart: schema and files, with sizes and times as the file system has them.

    One listing per folder. Rows that come from no file are known by their schema alone.
    """
    found = {}
    for i, df in enumerate(inputs):
        hadoop = df.sparkSession._jvm.org.apache.hadoop.fs
        conf = df.sparkSession._jsc.hadoopConfiguration()
        names = {hadoop.Path(f).toString() for f in df.inputFiles()}
        files = []
        for folder in {hadoop.Path(f).getParent().toString() for f in names}:
            path = hadoop.Path(folder)
            for status in path.getFileSystem(conf).listStatus(path):
                if (name := status.getPath().toString()) in names or name.replace("file:/", "file:///") in names:
                    files.append([name, status.getLen(), status.getModificationTime()])
        found[str(i)] = [df.schema.json(), sorted(files)]
    return found


def _said(value) -> str:
    """A value as text that is the same in every session; an object without one of its own is its fields."""
    if type(value).__repr__ is not object.__repr__:
        return repr(value)
    return f"{type(value).__name__}({', '.join(f'{k}={_said(v)}' for k, v in sorted(vars(value).items()))})"


def fingerprint(made_from: dict) -> str:
    """One line: the parameters as text, and a digest of everything, inputs too."""
    plain = {k: _said(v) for k, v in sorted(made_from.items()) if k != "inputs"}
    whole = json.dumps([plain, made_from.get("inputs")], sort_keys=True)
    return json.dumps({**plain, "digest": hashlib.sha256(whole.encode()).hexdigest()}, sort_keys=True)


def _marker(spark: SparkSession, path: str):
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, MADE_FROM)
    return marker, marker.getFileSystem(spark._jsc.hadoopConfiguration())


def _same_origin(spark: SparkSession, path: str, wanted: str) -> None:
    """An error unless ``path`` was made from the same parameters and inputs; one that says nothing is taken as it is."""
    marker, fs = _marker(spark, path)
    if not fs.exists(marker):
        return
    there = _read(fs, marker)
    if there != wanted:
        raise ValueError(f"{path} was made from other parameters or inputs ({there}, now {wanted}): choose another folder or remove it")


def publish(spark: SparkSession, path: str, write: Callable[[str], None], made_from: dict | None = None) -> None:
    """``write`` to a fresh folder beside ``path`` and rename it; nothing if ``path`` is complete.

    A run that dies leaves at most a folder of its own name, never a part of ``path``, so
    the next run writes the whole again. An incomplete ``path`` of someone else is an error.
    ``made_from``, parameters and ``inputs_of`` the inputs, is kept beside the data; a complete
    ``path`` that was made from anything else is an error, not a result.
    """
    said = None if made_from is None else fingerprint(made_from)
    if is_complete(spark, path):
        if said is not None:
            _same_origin(spark, path, said)
        return
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, building = hadoop.Path(path), hadoop.Path(f"{path}.building-{uuid.uuid4().hex}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(f"{path} exists and no run has completed it")
    write(building.toString())
    if not is_complete(spark, building.toString()):
        raise RuntimeError(f"no output for {path}")
    if said is not None:
        _written(spark, hadoop.Path(building, MADE_FROM), said)
    if not fs.rename(building, target):
        raise RuntimeError(f"{path} could not be put in place")


def _read(fs, path) -> str:
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _written(spark: SparkSession, path, text: str) -> None:
    """Writes a small new file; an existing one is an error."""
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def discard(spark: SparkSession, path: str) -> None:
    """Removes the data of a stage whose results are published."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize_once(spark: SparkSession, path: str, build: Callable[[], DataFrame], made_from: dict | None = None) -> DataFrame:
    """The table at ``path``; built and written first if no complete output is there."""
    publish(spark, path, lambda at: build().write.parquet(at), made_from)
    return spark.read.parquet(path)


BUCKETS = "_buckets"


def stored_in_buckets(
    spark: SparkSession, path: str, key: str, build: Callable[[int], DataFrame], made_from: dict | None = None
) -> DataFrame:
    """The table at ``path`` in buckets of ``key``, so that joins and groups by the key move none of its rows.

    ``build`` is given the number of buckets (the session's shuffle partitions at the first run,
    kept beside the data) and returns rows that it dealt out by ``key`` into as many partitions
    before its wide columns were computed. Every task then writes the one file of its bucket, in
    row groups of ``GROUP_ROWS`` rows. The
    session's catalog knows the table for a moment only; what is returned reads the files.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()

    def whole(at: str) -> str:
        return hadoop.Path(at).getFileSystem(conf).makeQualified(hadoop.Path(at)).toString()

    def write(at: str) -> None:
        n = min(int(spark.conf.get(f"spark.sql.{k}")) for k in ("shuffle.partitions", "sources.bucketing.maxBuckets"))
        name = f"turnpress_{uuid.uuid4().hex}"
        _grouped(build(n).write, GROUP_ROWS).format("parquet").bucketBy(n, key).option("path", whole(at)).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # its files have a path of their own and stay
        _written(spark, hadoop.Path(at, BUCKETS), str(n))

    publish(spark, path, write, made_from)
    note = hadoop.Path(path, BUCKETS)
    if not note.getFileSystem(conf).exists(note):
        raise ValueError(f"{path} was not written in buckets: choose another folder or remove it")
    n = int(_read(note.getFileSystem(conf), note))
    columns = spark.read.parquet(path).schema.toDDL()
    name, place = f"turnpress_{uuid.uuid4().hex}", whole(path).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {n} BUCKETS LOCATION '{place}'")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def append_metrics(rows: DataFrame, path: str, attempt: str | None = None) -> None:
    """Appends metric rows; columns a row does not have are left out of its line.

    Rows go to a folder of their own, and the log's manifest then names it under ``attempt``. The
    entry is created once and for all, so a job that runs again with its attempt adds nothing,
    and rows of a job that died are in no manifest and never read. Without an attempt every call
    adds its rows.
    """
    spark = rows.sparkSession
    folder = uuid.uuid4().hex
    entry = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest", quote(attempt, safe="") if attempt else folder)
    fs = entry.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(entry):
        return
    rows.write.mode("errorifexists").json(f"{path}/rows/{folder}")
    try:
        _written(spark, entry, folder)
    except Exception:
        if not fs.exists(entry):
            raise
        discard(spark, f"{path}/rows/{folder}")  # the same attempt was quicker


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Folders that the manifest of a log names: one small file per append."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = spark.read.text(folder.toString()).collect()
    return sorted(f"{path}/rows/{r['value']}" for r in names)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Training and evaluation rows of one log, told apart by ``kind``."""
    kind = F.when(F.col("eval_loss").isNotNull(), "eval").otherwise("train")
    listed = _listed(spark, path)
    rows = spark.read.schema(METRICS).json(listed) if listed else spark.createDataFrame([], METRICS)
    return rows.withColumn("kind", kind)
