"""Exact first-fit-decreasing packing as one histogram, one join and one shuffle."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnpress.functions.tokens import n_supervised
from turnpress.operators.order import with_position
from turnpress.schemas import IGNORE_INDEX
from turnpress.session import stored

PLAN_SCHEMA = "n_tokens int, rank_from bigint, rank_to bigint, first_bin bigint, per_bin int"
# Largest plan sent to every executor (about 40 bytes a row); beyond it rows are shuffled.
BROADCAST_ROWS = 250_000
# Ranks per join bucket: a row meets only the plan rows near its own rank.
RANKS_PER_BUCKET = 1_000_000


class _Rooms:
    """Runs of equal bins by room; the leftmost run with enough room is found in log time.

    Runs of one room wait in a heap by first bin. A tree over rooms keeps the smallest
    first bin of every range of rooms.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.none = float("inf")
        self.least = [self.none] * (2 * self.size)
        self.heaps: dict[int, list[tuple[int, int]]] = {}

    def _renew(self, room: int) -> None:
        heap, at = self.heaps[room], room + self.size
        self.least[at] = heap[0][0] if heap else self.none
        at >>= 1
        while at:
            self.least[at] = min(self.least[2 * at], self.least[2 * at + 1])
            at >>= 1

    def add(self, first: int, bins: int, room: int) -> None:
        heapq.heappush(self.heaps.setdefault(room, []), (first, bins))
        self._renew(room)

    def take(self, room: int) -> tuple[int, int, int] | None:
        """``(first, bins, room)`` of the leftmost run with at least ``room``, taken out."""
        at = found = room + self.size
        while at > 1:
            if at % 2 == 0 and self.least[at + 1] < self.least[found]:
                found = at + 1  # all rooms to the right of this branch
            at //= 2
        if self.least[found] == self.none:
            return None
        while found < self.size:
            found = 2 * found + (self.least[2 * found] > self.least[2 * found + 1])
        first, bins = heapq.heappop(self.heaps[found - self.size])
        self._renew(found - self.size)
        return first, bins, found - self.size


def length_runs(histogram, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """First-fit-decreasing over a length histogram, on runs of equal bins.

    ``histogram`` is ``(length, count)``, so its size is bounded by the capacity and
    not by the data. Neighbouring bins with the same room form one run; a length cuts
    the leftmost run that has room for it in at most three. Returns ``(length,
    rank_from, rank_to, first_bin, per_bin)``: the items of that length with those ranks
    go ``per_bin`` at a time into consecutive bins.
    """
    histogram = sorted(((int(n), int(c)) for n, c in histogram), reverse=True)
    if any(not 0 < length <= capacity for length, _ in histogram):
        raise ValueError(f"every length must be between 1 and {capacity}")
    plan, rooms, next_bin = [], _Rooms(capacity), 0
    for length, count in histogram:
        left = count
        while left:
            run = rooms.take(length)
            if run is None:
                opened = -(-left // (capacity // length))
                run = (next_bin, opened, capacity)
                next_bin += opened
            first, bins, room = run
            each = room // length
            full = min(bins, left // each)
            rest = left - full * each if full < bins else 0
            for n, items in ((full, each), (min(rest, 1), rest), (bins - full - min(rest, 1), 0)):
                if not n:
                    continue
                if items:
                    rank = count - left
                    plan.append((length, rank, rank + n * items, first, items))
                    left -= n * items
                if room - items * length >= histogram[-1][0]:
                    rooms.add(first, n, room - items * length)
                first += n
    return plan


def _bucket(rank: Column) -> Column:
    return F.floor(rank / RANKS_PER_BUCKET)


def packing_plan(lengths: DataFrame, capacity: int) -> DataFrame:
    """Plan rows per rank bucket for a table of ``n_tokens``.

    Only the length histogram leaves Spark. The plan is broadcast when its row count,
    known here, is small enough; otherwise the join on length and bucket is a shuffle
    that a single length cannot crowd.
    """
    counts = lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()
    plan = length_runs([(r["n_tokens"], r["n"]) for r in counts], capacity)
    rows = sum((hi - 1) // RANKS_PER_BUCKET - lo // RANKS_PER_BUCKET + 1 for _, lo, hi, _, _ in plan)
    frame = lengths.sparkSession.createDataFrame(plan, PLAN_SCHEMA).withColumn(
        "bucket", F.explode(F.sequence(_bucket(F.col("rank_from")), _bucket(F.col("rank_to") - 1)))
    )
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def pack_ffd(lengths: DataFrame, capacity: int, key: str = "shuffle_key") -> DataFrame:
    """Adds ``bin`` and ``slot``: first-fit-decreasing, equal lengths in ``key`` order.

    Items of one length are interchangeable up to their rank, so bins follow from the
    plan by a join on length and rank. ``slot`` sorts a bin in placement order.
    """
    sized = lengths.withColumn("n_tokens", F.col("n_tokens").cast("int"))
    plan = packing_plan(sized.select("n_tokens"), capacity).alias("p")
    ranked = with_position(sized, key, within=("n_tokens",), prefix=3).drop("total")
    r = ranked.withColumn("bucket", _bucket(F.col("position"))).alias("r")
    match = (
        (F.col("r.n_tokens") == F.col("p.n_tokens"))
        & (F.col("r.bucket") == F.col("p.bucket"))
        & (F.col("r.position") >= F.col("p.rank_from"))
        & (F.col("r.position") < F.col("p.rank_to"))
    )
    step = F.floor((F.col("position") - F.col("rank_from")) / F.col("per_bin"))
    return r.join(plan, match).select(
        "r.*",
        (F.col("first_bin") + step).cast("bigint").alias("bin"),
        F.struct((-F.col("r.n_tokens")).alias("by_length"), F.col("position").alias("by_rank")).alias("slot"),
    ).drop("position", "bucket")


def place(tokens: DataFrame, seq_len: int, key: str = "shuffle_key") -> tuple[DataFrame, DataFrame]:
    """Bins of a stored token table, found on keys and lengths alone, and the placed tokens.

    With tokens in buckets of ``key`` (``stored_in_buckets``) neither the test for repeated keys
    nor the join moves a token: bins come to the buckets, and ``build_packed`` has the only
    shuffle of token arrays.
    """
    if tokens.groupBy(key).count().where("count > 1").limit(1).collect():
        raise ValueError(f"{key} is not unique")
    bins = stored(pack_ffd(tokens.select(key, "n_tokens"), seq_len, key), "bins")
    placed = tokens.select(key, "input_ids", "labels").join(bins.select(key, "bin", "slot"), key)
    return bins, placed


def _padded(values: Column, fill: Column | int, seq_len: int) -> Column:
    fill = fill if isinstance(fill, Column) else F.lit(fill)
    return F.concat(values, F.array_repeat(fill, F.lit(seq_len) - F.size(values)))


def _positions(sizes: Column) -> Column:
    return F.flatten(F.transform(sizes, lambda n: F.sequence(F.lit(0), n - 1)))


def build_packed(placed: DataFrame, seq_len: int, pad_id: int) -> DataFrame:
    """One record per bin: documents in placement order, padded to ``seq_len``.

    A bin holds at most ``seq_len`` tokens, which bounds every group of this shuffle.
    """
    docs = F.array_sort(F.collect_list(F.struct("slot", "input_ids", "labels")))
    bins = placed.groupBy("bin").agg(docs.alias("docs")).select(
        "bin",
        F.flatten(F.transform("docs", lambda d: d["input_ids"])).alias("ids"),
        F.flatten(F.transform("docs", lambda d: d["labels"])).alias("labels"),
        F.transform("docs", lambda d: F.size(d["input_ids"])).alias("sizes"),
    )
    pad = F.lit(seq_len) - F.size("ids")
    return bins.select(
        "bin",
        _padded(F.col("ids"), pad_id, seq_len).alias("input_ids"),
        _padded(F.col("labels"), IGNORE_INDEX, seq_len).alias("labels"),
        _padded(_positions(F.col("sizes")), 0, seq_len).alias("position_ids"),
        F.when(pad > 0, F.concat("sizes", F.array(pad))).otherwise(F.col("sizes")).alias("seq_lens"),
    )


def build_eval(tokens: DataFrame, seq_len: int, pad_id: int) -> DataFrame:
    """One padded record per conversation with its attention mask."""
    keep = [c for c in tokens.columns if c not in ("input_ids", "labels")]
    ones = F.array_repeat(F.lit(1), F.size("input_ids"))
    return tokens.select(
        *keep,
        _padded(F.col("input_ids"), pad_id, seq_len).alias("input_ids"),
        _padded(F.col("labels"), IGNORE_INDEX, seq_len).alias("labels"),
        _padded(ones, 0, seq_len).alias("attention_mask"),
    )


def project_train(packed: DataFrame) -> DataFrame:
    """The columns a training step reads; document lengths follow from the positions."""
    return packed.select("input_ids", "labels", "position_ids")


def project_eval(records: DataFrame) -> DataFrame:
    return records.select("input_ids", "labels", "attention_mask")


def doc_boundaries(packed: DataFrame, pad_id: int) -> DataFrame:
    """Documents of every record read back from position resets.

    Adds ``starts`` (offset of every document), ``lengths`` and ``consistent``: whether
    the lengths, with the padding, are the stored ``seq_lens``.
    """
    last = F.element_at("seq_lens", -1)
    n = F.size("position_ids")
    tail_resets = F.element_at("position_ids", -1) == 0
    has_pad = tail_resets & ((last > 1) | (F.element_at("input_ids", -1) == pad_id))
    used = F.when(has_pad, n - last).otherwise(n)
    starts = F.filter(
        F.transform("position_ids", lambda p, i: F.when((p == 0) & (i < used), i)), lambda i: i.isNotNull()
    )
    with_starts = packed.withColumns({"_used": used, "_pad": has_pad, "starts": starts})
    ends = F.concat(F.slice(F.col("starts"), F.lit(2), F.size("starts")), F.array("_used"))
    lengths = F.zip_with("starts", ends, lambda a, b: b - a)
    padded = F.when(F.col("_pad"), F.concat("lengths", F.array(n - F.col("_used")))).otherwise(F.col("lengths"))
    return (
        with_starts.withColumn("lengths", lengths)
        .withColumn("consistent", padded == F.col("seq_lens"))
        .drop("_used", "_pad")
    )


def supervised_tokens(records: DataFrame) -> DataFrame:
    return records.withColumn("n_supervised", n_supervised(F.col("labels")))


def slot_number() -> Column:
    """Place of a document inside its bin, from zero."""
    return F.row_number().over(Window.partitionBy("bin").orderBy("slot")) - 1
