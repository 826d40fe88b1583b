"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source whose target is e whole times its size and a rest first gives e complete epochs.
The rest is drawn without replacement with chances by quality weight: document i gets the
exponential key -ln(u_i) / w_i, with u_i from a hash of the document, and documents enter
by rising key until their sizes reach the rest. The place where a source is cut is found by
radix selection: sizes are summed per source and leading bits of the key, the bucket in
which the running sum passes the rest is opened further, and after all bits each source
has one cut-off key. Nothing is sorted but one source's buckets.

Contract. NULL and empty texts have size 0 and are never taken; sources are ordered by
code point, a NULL source is a source of its own and the last. Documents with one key are
repeated rows; those at the cut-off are numbered, and as many enter as bring the sum nearest
to the rest. Documents are never cut, so a source is off its target by at most half the size
of one document. The same rows give the same mix under any partitioning. Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnpress.llm.common import WORD, stored
from turnpress.operators.permutation import unused

STEPS, BITS = 4, 12
"""Rounds of the radix selection and bits of the key that each one opens."""


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.25 and 1: the share of letters and white space in the text."""
    odd = F.length(F.regexp_replace(text, r"[\p{L}\s]+", ""))
    return F.lit(0.25) + 0.75 * (1 - F.coalesce(odd / F.greatest(F.length(text), F.lit(1)), F.lit(0.0)))


def exponential_key(identity: Column, weight: Column) -> Column:
    """Rank of -ln(u) / w as an integer of STEPS * BITS bits, the same on every run."""
    u = (F.shiftrightunsigned(F.xxhash64(identity, F.lit("mix")), 11).cast("double") + 0.5) / float(1 << 53)
    key = -F.log(u) / weight
    top = (1 << (STEPS * BITS)) - 1
    return F.least(F.floor((1 - F.exp(-key)) * float(top)), F.lit(top)).cast("long")


def targets(sizes: DataFrame, cycle: int = 3, most: int = 3) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Weights 1..cycle repeat over the sources in order. A target stops at ``most`` times its
    source's size and the excess goes to the others by weight, until none is above: with c =
    most * size / weight, sources are full from the smallest c up. In that order the level
    at which the rest shares evenly is (total - caps of the full) / (weight of the rest).
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    by_level = Window.orderBy("_c", "_place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    share = (
        sizes.withColumn("_place", F.row_number().over(order))
        .withColumn("_w", ((F.col("_place") - 1) % cycle + 1).cast("double"))
        .withColumn("_cap", most * F.col("source_size").cast("double"))
        .withColumn("_c", F.col("_cap") / F.col("_w"))
        .withColumn("_total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_weights", F.sum("_w").over(everything))
        .withColumn("_full", F.coalesce(F.sum("_cap").over(by_level), F.lit(0.0)))
        .withColumn("_gone", F.coalesce(F.sum("_w").over(by_level), F.lit(0.0)))
        .withColumn("_level", (F.col("_total") - F.col("_full")) / (F.col("_weights") - F.col("_gone")))
        .withColumn("_open", F.col("_level") < F.col("_c"))
        .withColumn("_first", F.min(F.when(F.col("_open"), F.struct("_c", "_place", "_level"))).over(everything))
    )
    level = F.col("_first")["_level"]
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("_w")))
    return share.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: key, source, size, source_size, target, times (how often it enters), taken."""
    content = F.col(text)
    rows = stored(
        docs.select(
            F.col(key), F.col(source).alias("source"), word_count(content).alias("size"), document_key(key, text).alias("_key")
        ),
        "sizes",
    )
    times = entries()
    return placed(rows, plan(rows)).select(
        key, "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken")
    )


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents themselves, each as often as it enters the mix, with all columns, whatever their names."""
    rows = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"), document_key(key, text).alias("_key"))
    chosen = plan(stored(rows, "sizes"))
    (whole,) = unused(docs, "document")
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole)).select(
        whole, F.col(f"{whole}.`{source}`").alias("source"), word_count(F.col(f"{whole}.`{text}`")).alias("size"),
        document_key(f"{whole}.`{key}`", f"{whole}.`{text}`").alias("_key"),
    )
    out = placed(sized, chosen.select("source", "_epochs", "_cut", "_copies", "_take"))
    return out.select(whole, F.explode(F.array_repeat(F.lit(1), entries().cast("int")))).select(f"{whole}.*")


def document_key(key: str, text: str) -> Column:
    identity = F.concat_ws("/", F.col(key).cast("string"), F.xxhash64(text).cast("string"))
    return exponential_key(identity, quality_weight(F.col(text)))


def entries() -> Column:
    """How often a document enters, from its size, key and place and its source's epochs and cut-off."""
    size = F.col("size")
    below = (F.col("_key") < F.col("_cut")) | ((F.col("_key") == F.col("_cut")) & (F.col("_place") < F.col("_take")))
    return F.when(size == 0, 0).otherwise(F.col("_epochs") + F.coalesce(below, F.lit(False)).cast("int")).cast("long")


def plan(rows: DataFrame) -> DataFrame:
    """Per source of the stored ``rows`` (source, size, _key): sizes, target, epochs, cut-off key, its rows and how many enter."""
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0)
    aims = aims.withColumn("_epochs", whole)
    aims = stored(aims.withColumn("_left", F.greatest(F.col("target") - F.col("_epochs") * F.col("source_size"), F.lit(0.0))), "targets")
    none = F.lit(0).cast("long")
    cut = aims.select("source", none.alias("_prefix"), F.col("_left").alias("_need"), none.alias("_size"), none.alias("_copies"))
    rising = Window.partitionBy("source").orderBy("_bucket")
    for step in range(1, STEPS + 1):
        shift = BITS * (STEPS - step)
        sums = (
            _joined(rows.where("size > 0"), cut.drop("_size", "_copies"))
            .where(F.shiftright("_key", shift + BITS) == F.col("_prefix"))
            .groupBy("source", F.shiftright("_key", shift).alias("_bucket"))
            .agg(F.sum("size").alias("_size"), F.max("_need").alias("_need"), F.count("*").alias("_copies"))
        )
        passed = (
            sums.withColumn("_upto", F.sum("_size").over(rising.rowsBetween(Window.unboundedPreceding, 0)))
            .where(F.col("_upto") > F.col("_need"))
            .groupBy("source")
            .agg(F.min(F.struct("_bucket", "_upto", "_size", "_need", "_copies")).alias("_b"))
        )
        need = F.col("_b._need") - (F.col("_b._upto") - F.col("_b._size"))
        cut = stored(
            passed.select(
                "source", F.col("_b._bucket").alias("_prefix"), need.alias("_need"), F.col("_b._size").alias("_size"),
                F.col("_b._copies").alias("_copies"),
            ),
            "cuts",
        )
    # _need is now what the keys below the cut-off leave open, _size what the rows of the cut-off key bring together
    take = F.least(F.ceil(F.col("_need") * F.col("_copies") / F.col("_size") - 0.5), "_copies")
    ends = cut.select(F.col("source").alias("_s"), F.col("_prefix").alias("_cut"), "_copies", take.alias("_take"))
    return aims.join(ends, aims["source"].eqNullSafe(ends["_s"]), "left").drop("_s")


def placed(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows with their source's values and ``_place``, a number from 0 for those of a key that only some rows enter by.

    Only these rows are numbered, from a table of them: within each of its parts, plus the rows
    of earlier parts, so that no task holds all copies of a document.
    """
    joined = _joined(rows, chosen, keep=True)
    some = "_copies > 1 AND _take > 0 AND _take < _copies"
    if not chosen.where(some).head(1):
        return joined.withColumn("_place", F.lit(0).cast("long")).drop("_name")
    edge = F.coalesce(F.expr(f"_key = _cut AND size > 0 AND {some}"), F.lit(False))
    shared = stored(joined.where(edge).withColumn("_row", F.monotonically_increasing_id()), "edge")
    shared = shared.withColumn("_part", F.shiftright("_row", 33))
    parts = Window.partitionBy("_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = shared.groupBy("_name", "_part").agg(F.count("*").alias("_n")).select(
        "_name", "_part", F.coalesce(F.sum("_n").over(parts), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_name", "_part").orderBy("_row")) - 1
    numbered = shared.withColumn("_inside", inside).join(before, ["_name", "_part"])
    numbered = numbered.withColumn("_place", F.col("_before") + F.col("_inside")).select(*joined.columns, "_place")
    return joined.where(~edge).withColumn("_place", F.lit(0).cast("long")).unionByName(numbered).drop("_name")


def _joined(rows: DataFrame, per_source: DataFrame, keep: bool = False) -> DataFrame:
    """Rows with their source's values; a join on one column that is never NULL, so that Spark may split a hot source."""
    named = lambda df: df.withColumn("_name", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    joined = named(rows).join(named(per_source).drop("source"), "_name")
    return joined if keep else joined.drop("_name")
