"""Quality rules with thresholds that adapt to language and source.

Statistics of every whole text go, per language and source, into quantile sketches: counts
per logarithmic bucket, so any quantile is known within one percent and sketches of parts
add up to the sketch of the whole. They are plain grouped counts: a group with a third of
all rows is counted where its rows are. Rows that fail the base rule are left out of them.

Thresholds are tail quantiles of the sketches: a high fence lies REACH times the way from the
median to the 90th percentile beyond that percentile, a low one the same below the tenth. The
sketch of a group is merged with that of its language, scaled down to WEIGHT rows, and this
one with that of all rows, so small groups lean on wider ones. There is no least width but the
bounds of the buckets that the quantiles fall into. Rates have a high fence only, and a document is held against it by its
count: as many events as the fence allows for its length, and three standard errors of that
count. Rows are judged by a join with the fences of their group.

Contract. NULL and empty texts have no words and fail the base rule. NULL languages and
sources are groups of their own. Repeated rows count as often as they occur and get equal
verdicts; a table of equal rows rejects none of them beyond the base rule. Empty tables give
empty results.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.llm.common import map_batches, stored, texts

GAMMA, LEAST = math.log(1.01), 1e-4
"""Logarithm of the ratio of two bucket bounds; values up to LEAST share one bucket."""

TAIL, REACH, WEIGHT, PARTS = 10, 2.0, 50, 1024
"""Percent in a tail, how far beyond it a fence lies, the rows a wider sketch counts for, and the
parts that a row is counted in when sketches are scaled: counts stay integers, so sums are exact."""

ERRORS, EVENT = 3.0, 6
"""Standard errors a count may be over its fence, and words in the smallest repeat of three words."""

CONTINUED = bytes(range(0x80, 0xC0))
BLANK = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"


def counts(text: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    repeated = 0
    if len(times) < len(windows):
        upto = 0  # words before this place are counted
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return (
        len(words), len(text.translate(None, CONTINUED + BLANK)), len(text) - len(text.translate(None, SYMBOLS)),
        len(lines), len(lines) - len(set(lines)), repeated,
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(key, groups, counts) of every whole text."""

    def run(batch: pa.RecordBatch) -> dict:
        rows = list(zip(*(counts(t) for t in texts(batch, text)), strict=True)) or [[]] * len(NAMES)
        return {n: pa.array(v, pa.int64()) for n, v in zip(NAMES, rows, strict=True)}

    kept = docs.select(key, *groups, text)
    fields = [kept.schema[n] for n in (key, *groups)] + [T.StructField(n, T.LongType()) for n in NAMES]
    return map_batches(kept, run, T.StructType(fields))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


LEVEL = "word_length"
"""The measure with two fences; all others are rates of events."""


def measures() -> dict[str, tuple[Column, Column]]:
    """Per measure its value and, for rates, the units that the events are counted in."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        LEVEL: (F.col("word_chars") / words, words),
        "symbol_rate": (F.col("n_symbols") / words, words),
        "dup_line_rate": (F.col("n_dup_lines") / lines, lines),
        "repeat_rate": (F.col("n_repeat_words") / words, words / EVENT),
    }


def bucket(value: Column) -> Column:
    return F.when(value <= LEAST, F.lit(-(1 << 20))).otherwise(F.ceil(F.log(value) / GAMMA).cast("int"))


def edge(bucket_: Column, high: bool = True) -> Column:
    """The bound of a bucket, a hundredth of a bucket outside it so that rounding does not matter."""
    out = F.exp((bucket_ + 0.01) * GAMMA) if high else F.exp((bucket_ - 1.01) * GAMMA)
    return F.when(bucket_ == -(1 << 20), F.lit(LEAST if high else 0.0)).otherwise(out)


def sketches(stats: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, measure, bucket, n): sketches add up by summing n."""
    named = F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), bucket(v).alias("bucket")) for n, (v, _) in measures().items())))
    return stats.where(~base_failed()).select(*groups, named.alias("m")).groupBy(*groups, "m.measure", "m.bucket").agg(F.count("*").alias("n"))


QUANTILES = {"bottom": (TAIL, False), "below": (50, True), "above": (50, False), "top": (100 - TAIL, True)}
"""Percents, and which bound of the bucket is taken: the one that makes a tail wider."""


def leaned(sketch: DataFrame, groups: list[str], weight: int = WEIGHT) -> DataFrame:
    """(groups, measure, bucket, n): each group's sketch merged with WEIGHT rows of the next wider one, in PARTS of a row."""
    known = sketch.groupBy("measure", "bucket").agg((PARTS * F.sum("n")).alias("n"))
    for depth in range(1, len(groups) + 1):
        names, wider = groups[:depth], groups[: depth - 1]
        share = F.col("n") / F.sum("n").over(Window.partitionBy(*wider, "measure"))
        scaled = known.select(*wider, "measure", "bucket", F.floor(float(weight * PARTS) * share).alias("n"))
        lent = sketch.select(*names, "measure").distinct().join(scaled, [*wider, "measure"])
        own = sketch.select(*names, "measure", "bucket", (PARTS * F.col("n")).alias("n"))
        known = own.unionByName(lent.select(own.columns)).groupBy(*names, "measure", "bucket").agg(F.sum("n").alias("n"))
    return known


def fences(sketch: DataFrame, groups: list[str], reach: float = REACH, weight: int = WEIGHT) -> DataFrame:
    """One row per group with ``low_<measure>`` and ``high_<measure>``."""
    own = Window.partitionBy(*groups, "measure")
    ranked = leaned(sketch, groups, weight).withColumn("_upto", F.sum("n").over(own.orderBy("bucket"))).withColumn("_all", F.sum("n").over(own))
    at = lambda percent: F.min(F.when(100 * F.col("_upto") >= percent * F.col("_all"), F.col("bucket")))
    known = ranked.groupBy(*groups, "measure").agg(*(edge(at(q), high).alias(n) for n, (q, high) in QUANTILES.items()))
    low = F.col("bottom") - reach * (F.col("below") - F.col("bottom"))
    high = F.col("top") + reach * (F.col("top") - F.col("above"))
    pick = lambda name, c: F.max(F.when(F.col("measure") == name, c))
    return known.groupBy(*groups).agg(
        *(pick(m, low).alias(f"low_{m}") for m in measures()), *(pick(m, high).alias(f"high_{m}") for m in measures())
    )


def beyond(measure: str) -> Column:
    """Is a row with its group's fences outside those of one measure?"""
    value, units = measures()[measure]
    low, high = F.col(f"low_{measure}"), F.col(f"high_{measure}")
    if measure == LEVEL:
        return ~value.between(low, high)
    return value * units > high * units + ERRORS * F.sqrt(high * units + 1)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(key, groups (one or more), counts, base_failed, outside array of measures beyond a fence, kept).

    A group all of whose rows fail the base rule has no fences, and needs none.
    """
    stats = stored(statistics(docs, key, text, groups), "counts")
    names = [f"_{i}" for i in range(len(groups))]
    for n, g in zip(names, groups, strict=True):  # keys that are never NULL
        stats = stats.withColumn(n, F.coalesce(F.concat(F.lit("s"), F.col(g).cast("string")), F.lit("n")))
    bounds = stored(fences(stored(sketches(stats, names), "sketches"), names), "fences")
    judged = stats.join(bounds, names, "left")
    outside = F.array_compact(F.array(*(F.when(beyond(m), F.lit(m)) for m in measures())))
    failed = base_failed()
    return judged.select(
        key, *groups, *NAMES, failed.alias("base_failed"), outside.alias("outside"), (~failed & (F.size(outside) == 0)).alias("kept")
    )
