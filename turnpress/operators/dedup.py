"""Union of sources and removal of repeated conversations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.functions.text import strip
from turnpress.functions.tools import tool_names
from turnpress.operators.order import content_tie
from turnpress.operators.permutation import unused
from turnpress.schemas import CALLS, SOURCE_ORDER
from turnpress.session import stored


def select_sources(sources: dict[str, DataFrame], single_only: bool = False, multi_only: bool = False) -> dict:
    """The enabled sources; asking for both restrictions at once is an error."""
    if single_only and multi_only:
        raise ValueError("single_only and multi_only exclude each other")
    only = SOURCE_ORDER[0] if single_only else SOURCE_ORDER[1] if multi_only else None
    return {name: df for name, df in sources.items() if only in (None, name)}


def union_sources(*examples: DataFrame) -> DataFrame:
    """Bag union; ``source_rank`` keeps the precedence of the arguments."""
    ranked = [df.withColumn("source_rank", F.lit(i)) for i, df in enumerate(examples)]
    return reduce(lambda a, b: a.unionByName(b), ranked)


def dedup_key(messages: Column, tools: Column) -> Column:
    """SHA-1 of roles, folded contents and calls of all messages, and sorted tool names."""
    no_calls = F.array().cast(CALLS)

    def signature(c):
        fn = c["function"]
        return F.concat(F.coalesce(fn["name"], F.lit("None")), F.lit("("), fn["arguments"], F.lit(")"))

    def line(m):
        calls = F.array_join(F.transform(F.coalesce(m["tool_calls"], no_calls), signature), "|")
        content = F.lower(strip(F.coalesce(m["content"], F.lit(""))))
        return F.concat(m["role"], F.lit("::"), content, F.lit("::"), calls)

    names = F.array_join(F.array_sort(tool_names(tools)), ",")
    return F.sha1(F.concat(F.array_join(F.transform(messages, line), "\n"), F.lit("##"), names).cast("binary"))


def with_dedup_key(examples: DataFrame) -> DataFrame:
    return examples.withColumn("key", dedup_key(F.col("messages"), F.col("tools")))


ROW, TIE = "row_id", "row_tie"
BROADCAST_ROWS = 1_000_000
"""Most row numbers sent to every executor: some 30 MB as a hash table."""


def with_row_id(rows: DataFrame, row: str = ROW, tie: str = TIE) -> DataFrame:
    """Adds a number per row and a hash of its content, for a table that is written next.

    The number is fixed once the table is written.
    """
    return rows.withColumns({tie: content_tie(rows), row: F.monotonically_increasing_id()})


def first_rows(keys: DataFrame, row: str = ROW, tie: str = TIE) -> DataFrame:
    """``row`` of the first row per key by ``(source_rank, ord)``, then content; one row per key."""
    least = F.min(F.struct("source_rank", "ord", tie, row)).alias("first")
    return keys.select("key", "source_rank", "ord", tie, row).groupBy("key").agg(least).select(F.col(f"first.{row}").alias(row))


def dedup_first(examples: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """First row per key in ``(source_rank, ord)`` order; of rows that tie, one stays.

    Two phases. Keys and row numbers alone are shuffled, and summed up before that, so a key
    with a third of all rows sends one row per input split. Whole rows are then chosen by number:
    by the numbers that stay or, if these are more than ``limit``, those that go, as a broadcast;
    where both are more, by a shuffle of evenly spread numbers, never by key. Rows that have no
    number yet (``with_row_id``) are written to the shared folder first.
    """
    keyed = examples if "key" in examples.columns else with_dedup_key(examples)
    row, tie, own = ROW, TIE, {ROW, TIE} <= set(keyed.columns)
    if not own:
        row, tie = unused(keyed, ROW, TIE)
        keyed = stored(with_row_id(keyed, row, tie), "keyed")
    first = stored(first_rows(keyed, row, tie), "first")
    n_first = first.count()
    if n_first <= limit:
        kept = keyed.join(F.broadcast(first), row, "left_semi")
    elif keyed.count() - n_first <= limit:
        gone = keyed.select(row).join(first, row, "left_anti")
        kept = keyed.join(F.broadcast(gone), row, "left_anti")
    else:
        kept = keyed.join(first, row, "left_semi")
    return kept.select(*[c for c in keyed.columns if own or c not in (row, tie)])
