"""Examples to token rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.functions.tokens import ByteTokenizer, ChatTemplate, mask_labels, render_chat, trainable
from turnpress.schemas import MESSAGES, TOOLS
from turnpress.session import sealed


def nested_to_json(df: DataFrame) -> DataFrame:
    """Nested columns as opaque JSON texts; no tools become ``[]``."""
    no_tools = F.array().cast(TOOLS)
    return df.withColumns({
        "_messages_json": F.to_json("messages"),
        "_tools_json": F.to_json(F.coalesce(F.col("tools"), no_tools)),
    }).drop("messages", "tools")


def nested_from_json(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "messages": F.from_json("_messages_json", MESSAGES),
        "tools": F.from_json("_tools_json", TOOLS),
    }).drop("_messages_json", "_tools_json")


def with_segments(examples: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    return examples.withColumn("segments", render_chat(F.col("messages"), F.col("tools"), template))


def tokenize(examples: DataFrame, tokenizer=None, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Adds ``input_ids``, ``labels`` and ``n_tokens``.

    All three are NULL for a conversation that cannot be rendered or has nothing to
    train on.
    """
    tokenizer = tokenizer or ByteTokenizer()
    coded = sealed(with_segments(examples, template).withColumn("_ids", tokenizer.segment_ids(F.col("segments"))))
    good = F.exists("segments", lambda s: s["trained"] & (F.length(s["text"]) > 0))
    return coded.select(
        *[c for c in examples.columns if c not in ("messages", "tools")],
        F.when(good, F.flatten("_ids")).alias("input_ids"),
        F.when(good, mask_labels(F.col("segments"), F.col("_ids"))).alias("labels"),
        F.when(good, F.aggregate("_ids", F.lit(0), lambda n, ids: n + F.size(ids))).alias("n_tokens"),
    )


def token_lengths(examples: DataFrame, tokenizer=None, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """``n_tokens`` alone, for plans and reports: no id array is built in byte mode."""
    tokenizer = tokenizer or ByteTokenizer()
    coded = with_segments(examples, template)
    good = F.exists("segments", lambda s: s["trained"])
    counted = coded.withColumn("n_tokens", F.when(good, tokenizer.n_tokens(F.col("segments"))))
    return sealed(counted.drop("segments", "messages", "tools"))


def rendered_ok(ids: Column) -> Column:
    return ids.isNotNull()


def fits(n_tokens: Column, seq_len: int) -> Column:
    """Inclusive length bound."""
    return F.coalesce(n_tokens <= seq_len, F.lit(False))


__all__ = [
    "fits", "nested_from_json", "nested_to_json", "rendered_ok", "token_lengths", "tokenize",
    "trainable", "with_segments",
]
