"""Row cleaning: raw corpora to examples, with a reason for every rejected row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.functions.chat import user_text_ok, with_messages
from turnpress.functions.text import json_list, list_of_objects
from turnpress.functions.tools import called_names, tool_calls, tool_names, tool_specs, with_declared_tools
from turnpress.schemas import (
    CALLS, EXAMPLE, MAX_MESSAGES, MAX_TOOLS, MESSAGES, MIN_TOOLS, MULTI_TURN, SINGLE_TURN, TOOLS,
)
from turnpress.session import sealed


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# ---- predicates ---------------------------------------------------------------

def user_chars_ok(messages: Column) -> Column:
    """Every user text is within the length bounds."""
    return F.forall(messages, lambda m: (m["role"] != "user") | user_text_ok(m["content"]))


def tool_count_ok(tools: Column) -> Column:
    return _true(F.size(tools).between(MIN_TOOLS, MAX_TOOLS))


def message_count_ok(messages: Column) -> Column:
    return _true(F.size(messages) <= MAX_MESSAGES)


def role_presence_ok(messages: Column) -> Column:
    roles = F.transform(messages, lambda m: m["role"])
    return _true(F.array_contains(roles, "user") & F.array_contains(roles, "assistant"))


def declared_ok(messages: Column, tools: Column) -> Column:
    """Every called name is declared."""
    return _true(F.size(F.array_except(called_names(messages), tool_names(tools))) == 0)


def all_present(items: Column) -> Column:
    return _true(~F.exists(items, lambda i: i.isNull()))


def valid_json_lists(tools: Column, answers: Column) -> Column:
    """Both are JSON lists and there is at least one answer."""
    return _true(tools.isNotNull() & (F.size(answers) > 0))


# ---- sources ------------------------------------------------------------------

def flag_single_turn(df: DataFrame) -> DataFrame:
    """Raw ``(ord, query, tools, answers)`` rows to examples with ``reject_reason``.

    Length is tested before any JSON is parsed, and tools and calls are normalised only
    where both lists hold.
    """
    cheap = user_text_ok(F.col("query"))
    lists = df.withColumn("_t", F.when(cheap, json_list(F.col("tools")))).withColumn(
        "_a", F.when(F.col("_t").isNotNull(), json_list(F.col("answers")))
    )
    early = sealed(lists).withColumn(
        "_early",
        F.when(~cheap, "user_chars")
        .when(~valid_json_lists(F.col("_t"), F.col("_a")), "json_lists")
        .when(~tool_count_ok(F.col("_t")), "tool_count"),
    )
    ok = F.col("_early").isNull()
    normalized = sealed(early.withColumns({
        "_specs": F.when(ok & list_of_objects(F.col("tools")), tool_specs(F.col("_t"))),
        "_calls": F.when(ok & list_of_objects(F.col("answers")), tool_calls(F.col("_a"))),
    }))
    messages = F.array(
        F.struct(F.lit("user").alias("role"), F.col("query").alias("content"),
                 F.lit(None).cast(CALLS).alias("tool_calls")),
        F.struct(F.lit("assistant").alias("role"), F.lit("").alias("content"),
                 F.col("_calls").alias("tool_calls")),
    ).cast(MESSAGES)
    whole = all_present(F.col("_specs")) & all_present(F.col("_calls"))
    flagged = normalized.withColumn(
        "reject_reason", F.when(~ok, F.col("_early")).when(~whole, "not_normalized")
    )
    good = F.col("reject_reason").isNull()
    return sealed(flagged.select(
        "ord", F.lit(SINGLE_TURN).alias("source"),
        F.when(good, F.col("_specs")).alias("tools"), F.when(good, messages).alias("messages"),
        "reject_reason",
    ))


def flag_multi_turn(df: DataFrame) -> DataFrame:
    """Raw ``(ord, system, chat)`` rows to examples with ``reject_reason``.

    The chat is parsed only where the prompt declares an acceptable number of tools.
    """
    tools = with_declared_tools(df).withColumn(
        "chat", F.when(tool_count_ok(F.col("tools")), F.coalesce(F.col("chat"), F.lit("")))
    )
    m = F.col("messages")
    flagged = with_messages(tools).withColumn(
        "reject_reason",
        F.when(~tool_count_ok(F.col("tools")), "tool_count")
        .when(m.isNull(), "chat")
        .when(~message_count_ok(m), "message_count")
        .when(~role_presence_ok(m), "role_presence")
        .when(~declared_ok(m, F.col("tools")), "undeclared_tool"),
    )
    return sealed(flagged.select("ord", F.lit(MULTI_TURN).alias("source"), "tools", "messages", "reject_reason"))


def valid_examples(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("reject_reason").isNull()).select(*EXAMPLE.fieldNames())


def normalize_single_turn(df: DataFrame) -> DataFrame:
    return valid_examples(flag_single_turn(df))


def normalize_multi_turn(df: DataFrame) -> DataFrame:
    return valid_examples(flag_multi_turn(df))


def conversation_examples(turns: DataFrame, source: str = MULTI_TURN) -> DataFrame:
    """Turn table ``(conv_id, turn, role, text)`` to one example per conversation, all turns in order.

    A conversation is one row of the result, so its turns meet in one task; its length is
    judged by ``message_count_ok`` and by no one else.
    """
    message = lambda i: F.struct(
        i["role"].alias("role"), i["text"].alias("content"), F.lit(None).cast(CALLS).alias("tool_calls")
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("items"))
    return grouped.select(
        F.col("conv_id").alias("ord"), F.lit(source).alias("source"),
        F.array().cast(TOOLS).alias("tools"),
        F.transform("items", message).cast(MESSAGES).alias("messages"),
    )
