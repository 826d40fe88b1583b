"""Seeded order, exact holdout, global positions, epoch and batch plans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.operators.permutation import Permutation, unused
from turnpress.session import stored

# Leading hex digits of a shuffle key: 65,536 equal buckets at four digits.
PREFIX = 4


def shuffle_key(seed: int | Column, *keys: Column) -> Column:
    """Hex key whose order is a fixed permutation of the rows for each seed.

    Every part goes in with its length, so no two lists of parts give one text. A NULL
    part would make rows alike that are not, and ends the job.
    """
    seed = seed if isinstance(seed, Column) else F.lit(seed)

    def part(key: Column) -> Column:
        text = F.coalesce(key.cast("string"), F.raise_error(F.lit("NULL in a key part: give the rows an order first")).cast("string"))
        return F.concat(F.length(text).cast("string"), F.lit(":"), text)

    return F.sha1(F.concat_ws("|", seed.cast("string"), *[part(k) for k in keys]).cast("binary"))


def with_shuffle_key(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    return df.withColumn("shuffle_key", shuffle_key(seed, *[F.col(k) for k in keys]))


def with_position(df: DataFrame, key: str, within: tuple[str, ...] = (), prefix: int = PREFIX) -> DataFrame:
    """Zero-based ``position`` by a hash-like hex ``key`` inside each group, and the group's ``total``.

    Rows are numbered per (group, key prefix); the counts of the smaller prefixes are
    added. No task sees more than one prefix of one group, so neither a global order
    nor a group with a third of all rows ends in a single task.
    """
    group = [*within, "_prefix"]
    cut = df.withColumn("_prefix", F.substring(key, 1, prefix))
    whole = Window.partitionBy(*within)
    before = whole.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(*group).agg(F.count("*").alias("_n")).select(
        *group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("total"),
    )
    numbered = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(key)))
    return (
        numbered.join(offsets, group)
        .withColumn("position", F.col("_before") + F.col("_rn") - 1)
        .drop("_prefix", "_rn", "_before")
    )


def seeded_shuffle(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    """Rows with their place in the seeded permutation."""
    return with_position(with_shuffle_key(df, seed, *keys), "shuffle_key")


def holdout_cutoff(df: DataFrame, n: int, key: str = "shuffle_key", prefix: int = PREFIX) -> tuple[str, int, int] | None:
    """The n-th smallest text key as an order statistic with ties; None when there are fewer than n rows.

    ``(key, taken, count)``: of the ``count`` rows with that key, ``taken`` are among the n
    smallest. Counts per key prefix find the one prefix that holds it; only the distinct keys of
    that prefix are ordered. One row reaches the driver.
    """
    bucket = _reached(df.groupBy(F.substring(key, 1, prefix).alias("_at")).agg(F.count("*").alias("_n")), n)
    if bucket is None:
        return None
    inside = df.where(F.substring(key, 1, prefix) == bucket["_at"]).groupBy(F.col(key).alias("_at")).agg(F.count("*").alias("_n"))
    rest = n - (bucket["_upto"] - bucket["_n"])
    hit = _reached(inside, rest)
    return hit["_at"], rest - (hit["_upto"] - hit["_n"]), hit["_n"]


def _reached(counts: DataFrame, n: int):
    """The first row of ``(_at, _n)`` by ``_at`` where the running sum reaches n."""
    upto = F.sum("_n").over(Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    return counts.where("_at IS NOT NULL").withColumn("_upto", upto).where(F.col("_upto") >= n).orderBy("_at").first()


def order_cutoff(df: DataFrame, n: int, order: str | Column = "ord") -> tuple[int, int, int] | None:
    """The n-th smallest whole number, as ``holdout_cutoff`` has it for texts.

    Counts over 4,096 equal ranges locate the range that holds it, which is then cut the
    same way. Only one column is read and only one range reaches the driver per round.
    """
    numbers = df.select((F.col(order) if isinstance(order, str) else order).cast("bigint").alias("_v"))
    low, high, total = numbers.agg(F.min("_v"), F.max("_v"), F.count("_v")).first()
    if total < n:
        return None
    count = total
    if high - low >= 1 << 62:  # one half first, so that differences fit 64 bits
        below = numbers.where("_v < 0").count()
        low, high, n, count = (low, -1, n, below) if n <= below else (0, high, n - below, total - below)
    while low < high:
        width = max(1, -(-(high - low + 1) // 4096))
        cell = F.call_function("div", F.col("_v") - low, F.lit(width).cast("bigint"))
        counts = numbers.where(F.col("_v").between(low, high)).groupBy(cell.cast("int").alias("_at")).agg(F.count("*").alias("_n"))
        hit = _reached(counts, n)
        count = hit["_n"]
        n -= hit["_upto"] - count
        low, high = low + hit["_at"] * width, min(high, low + (hit["_at"] + 1) * width - 1)
    return low, n, count


def _has_map(type_: T.DataType) -> bool:
    if isinstance(type_, T.ArrayType):
        return _has_map(type_.elementType)
    if isinstance(type_, T.StructType):
        return any(_has_map(f.dataType) for f in type_)
    return isinstance(type_, T.MapType)


def content_tie(df: DataFrame) -> Column:
    """A number from all columns: it orders rows that a key leaves tied, and equal rows get equal ones.

    61 bits, so that differences stay within 64.
    """
    columns = [(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]
    return F.shiftright(F.xxhash64(*[F.to_json(F.struct(c)) if _has_map(t) else c for c, t in columns]), 3)


def with_first(df: DataFrame, n: int, order: str, cutoff: tuple | None, out: str) -> DataFrame:
    """Adds boolean ``out``: the row is one of the ``n`` smallest by ``order``, exactly, ties and all.

    ``cutoff`` is the order statistic of ``order``. Where it splits rows with equal keys, the next one,
    of a hash over all columns, decides; where that splits rows too, they are equal rows, and any of
    them will do: these alone are written down and numbered. All else is a comparison.
    """
    if cutoff is None:
        return df.withColumn(out, F.lit(True))
    value, taken, count = cutoff
    key = F.col(order)
    if taken == count:
        return df.withColumn(out, F.coalesce(key <= F.lit(value), F.lit(False)))
    tie = content_tie(df)
    last, among, equal = order_cutoff(df.where(key == F.lit(value)), taken, tie)
    inside = F.coalesce((key < F.lit(value)) | ((key == F.lit(value)) & (tie <= last)), F.lit(False))
    if among == equal:
        return df.withColumn(out, inside)
    same = F.coalesce((key == F.lit(value)) & (tie == last), F.lit(False))
    (place,) = unused(df, "place")
    rows, _ = dense(stored(df.where(same).withColumn(place, F.monotonically_increasing_id()), "ties"), place, place)
    chosen = rows.withColumn(out, F.col(place) < among).drop(place)
    return df.where(~same).withColumn(out, inside).unionByName(chosen.select(*df.columns, out))


def holdout_split(df: DataFrame, eval_size: int, key: str = "shuffle_key") -> DataFrame:
    """Adds ``split``: the ``eval_size`` smallest keys are ``eval``, the rest ``train``.

    The split is a comparison with one cut-off key, so neither side is shuffled; of rows that
    share that key, as many are ``eval`` as are missing.
    """
    if eval_size <= 0:
        return df.withColumn("split", F.lit("train"))
    (held,) = unused(df, "held")
    marked = with_first(df, eval_size, key, holdout_cutoff(df, eval_size, key), held)
    return marked.withColumn("split", F.when(F.col(held), "eval").otherwise("train")).drop(held)


def sort_length_desc(df: DataFrame, length: str = "n_tokens", tie: str = "ord") -> DataFrame:
    return df.orderBy(F.col(length).desc(), F.col(tie))


def dense(rows: DataFrame, place: str, out: str) -> tuple[DataFrame, int]:
    """Replaces ``place``, the ``monotonically_increasing_id`` of a stored table, by 0..n-1; also n.

    The high bits of ``place`` name the task that wrote the row. Counts per task, one row each,
    are summed up on the driver and sent back, so the broadcast is bounded by the number of tasks.
    """
    task = F.shiftright(F.col(place), 33)
    counts = sorted(rows.groupBy(task.alias("t")).agg(F.count("*").alias("n")).collect())
    offsets, n = [], 0
    for r in counts:
        offsets.append((r["t"], n - (r["t"] << 33)))
        n += r["n"]
    at, shift = unused(rows, "task", "shift")
    table = rows.sparkSession.createDataFrame(offsets, f"{at} bigint, {shift} bigint")
    joined = rows.withColumn(at, task).join(F.broadcast(table), at)
    return joined.withColumn(out, F.col(place) + F.col(shift)).drop(*({at, shift, place} - {out})), n


def numbered(ids: DataFrame, key: str, out: str = "number") -> tuple[DataFrame, int]:
    """``(key, out)`` with the numbers 0..n-1 in key order, and n: one sort over ranges, written once."""
    given = F.coalesce(F.col(key), F.raise_error(F.lit("NULL id in a plan")).cast(ids.schema[key].dataType))
    rows = ids.select(given.alias(key)).repartitionByRange(key).sortWithinPartitions(key)
    return dense(stored(rows.withColumn(out, F.monotonically_increasing_id()), "numbers"), out, out)


def epoch_shard_plan(ids: DataFrame, key: str, epochs: int, world: int, seed: int, is_dense: bool = False) -> DataFrame:
    """``(epoch, position, rank, index)`` of every id in every training epoch.

    Ids are numbered once (with ``is_dense`` they are 0..n-1 already, as bins are); a place in any
    epoch is arithmetic on that number, so epochs cost no further scan or shuffle. Each epoch
    has its own permutation; the tail that would leave ranks uneven drops out. ``total`` counts
    the rows before that.
    """
    (number,) = unused(ids, "number")
    if is_dense:
        n = ids.count()
        checked = F.when(F.col(key).between(0, n - 1), F.col(key)).otherwise(F.raise_error(F.lit("ids are not 0..n-1")).cast("bigint"))
        rows = ids.select(key, checked.cast("bigint").alias(number))
    else:
        rows, n = numbered(ids, key, number)
    each = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    placed = Permutation(n, seed, epochs).with_place(each, number, "epoch").drop(number)
    placed = placed.withColumn("total", F.lit(n).cast("bigint"))
    return _on_ranks(placed.where(F.col("position") < n - n % world), world)


def rank_plan(
    spark: SparkSession, permutation: Permutation, rank: int, world: int, global_batch: int, micro_batch: int,
    first_step: int, last_step: int,
) -> DataFrame:
    """``(number, epoch, position, rank, index, step, slot)`` of one rank from its steps alone.

    The rows of ``batch_plan`` for that rank and these steps (counted over the epochs, from 1),
    without any table: places follow from the steps, and numbers from places by the inverse
    permutation. ``ids_of`` finds the ids where numbers are not the ids themselves.
    """
    slots = accumulation(global_batch, micro_batch, world)
    per_epoch, own = permutation.n // global_batch, global_batch // world
    last_step = min(last_step, per_epoch * permutation.epochs)
    steps = spark.range(max(0, last_step - first_step + 1) * own)
    div = lambda c, by: F.call_function("div", c, F.lit(max(by, 1)).cast("bigint"))
    step = div(F.col("id"), own) + (first_step - 1)
    rows = steps.select(
        (step + 1).alias("step"), div(step, per_epoch).cast("int").alias("epoch"),
        (step % max(per_epoch, 1) * own + F.col("id") % own).alias("index"),
    )
    placed = rows.withColumns({
        "rank": F.lit(rank), "position": F.col("index") * world + rank,
        "slot": (div(F.col("index"), micro_batch) % slots).cast("int"),
    })
    return permutation.with_number(placed, "position", "epoch")


CHUNK = 1_000_000
"""Numbers in a folder of a stored numbering."""
ASKED = 100_000
"""Most numbers that are worked out on the driver to choose folders, and sent to executors."""


def write_numbering(ids: DataFrame, key: str, path: str, chunk: int = CHUNK) -> int:
    """The numbering as Parquet in folders of ``chunk`` consecutive numbers; returns n."""
    rows, n = numbered(ids, key)
    folder = F.call_function("div", F.col("number"), F.lit(chunk).cast("bigint"))
    rows.withColumn("chunk", folder).write.mode("errorifexists").partitionBy("chunk").parquet(path)
    return n


def ids_of(numbering: DataFrame, plan: DataFrame, asked: Iterable[int] | None = None, chunk: int = CHUNK) -> DataFrame:
    """``plan`` with the ids of its numbers, from a stored numbering.

    ``asked``, the plan's numbers where they are few (``Permutation.number`` gives them without a
    job), limits the read to their folders and lets the plan be broadcast; both only up to
    ``ASKED`` numbers, else it is a shuffled join.
    """
    asked = None if asked is None else set(asked)
    if asked is None or len(asked) > ASKED:
        return plan.join(numbering.drop("chunk"), "number")
    folders = sorted({n // chunk for n in asked})
    return numbering.where(F.col("chunk").isin(folders)).drop("chunk").join(F.broadcast(plan), "number")


def asked_numbers(
    permutation: Permutation, rank: int, world: int, global_batch: int, first_step: int, last_step: int
) -> list[int] | None:
    """The numbers that ``rank_plan`` gives, or None when they are more than ``ASKED``."""
    per_epoch, own = permutation.n // global_batch, global_batch // world
    last_step = min(last_step, per_epoch * permutation.epochs)
    if (last_step - first_step + 1) * own > ASKED:
        return None
    found = []
    for step in range(first_step - 1, last_step):
        epoch, inside = divmod(step, per_epoch)
        found += [permutation.number((inside * own + i) * world + rank, epoch) for i in range(own)]
    return found


def eval_shard_plan(ids: DataFrame, key: str, world: int, order: str = "shuffle_key") -> DataFrame:
    """Evaluation rows on ranks in their stored order: no reshuffle, no drop, no repeats."""
    placed = with_position(ids.select(key, order), order).drop(order).withColumn("epoch", F.lit(0))
    return _on_ranks(placed, world)


def _on_ranks(placed: DataFrame, world: int) -> DataFrame:
    return placed.withColumns({
        "rank": (F.col("position") % world).cast("int"),
        "index": F.floor(F.col("position") / world).cast("bigint"),
    })


def accumulation(global_batch: int, micro_batch: int, world: int) -> int:
    """Micro-batches per step; the global batch must divide evenly."""
    steps, rest = divmod(global_batch, micro_batch * world)
    if rest or not steps:
        raise ValueError("global batch must be a multiple of micro batch x world")
    return steps


def batch_plan(shards: DataFrame, global_batch: int, micro_batch: int, world: int) -> DataFrame:
    """Optimiser step and accumulation slot of every sharded sequence.

    Steps count on over the epochs; sequences of an incomplete global batch drop out.
    """
    slots = accumulation(global_batch, micro_batch, world)
    per_epoch = F.floor(F.col("total") / global_batch)
    micro = F.floor(F.col("index") / micro_batch)
    step = F.floor(micro / slots)
    return shards.where(step < per_epoch).withColumns({
        "step": (F.col("epoch") * per_epoch + step + 1).cast("bigint"),
        "slot": (micro % slots).cast("int"),
    })


def schedule(counted: DataFrame, global_batch: int, micro_batch: int, world: int, epochs: int,
             warmup_ratio: float = 0.03) -> DataFrame:
    """Steps per epoch, total steps and warm-up steps for a one-row table with ``n_rows``."""
    per_epoch = F.floor(F.col("n_rows") / global_batch)
    total = per_epoch * epochs
    return counted.select(
        per_epoch.cast("bigint").alias("steps_per_epoch"),
        total.cast("bigint").alias("total_steps"),
        F.greatest(F.lit(1), F.floor(total * warmup_ratio)).cast("bigint").alias("warmup_steps"),
        F.lit(accumulation(global_batch, micro_batch, world)).cast("bigint").alias("accumulation"),
    )
