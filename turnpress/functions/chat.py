"""Role-tagged chat texts to message arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.functions.spans import brace_spans, with_objects
from turnpress.functions.text import SPACE_CLASS, bind, strip
from turnpress.functions.tools import tool_calls
from turnpress.schemas import (
    CALL_MARKER, CALLS, CHAT_ROLES, END_MARKER, MAX_USER_CHARS, MESSAGE, MIN_USER_CHARS, TURNS,
)
from turnpress.session import sealed

_ROLE_WORDS = "|".join(CHAT_ROLES)
# A role word with a colon at the start of a line, with the white space around it.
ROLE_HEAD = rf"(?dmU)(?:^|\n){SPACE_CLASS}*({_ROLE_WORDS}):{SPACE_CLASS}*"


def without_end_marker(chat: Column) -> Column:
    return strip(F.replace(chat, F.lit(END_MARKER), F.lit("")))


def role_turns(chat: Column) -> Column:
    """``array<struct<role, content>>`` with raw role words; empty turns dropped.

    Text before the first role is dropped. If that text itself opens with a role
    word, roles and contents pair up one place off, as the corpus rules have it.
    """
    text = without_end_marker(chat)
    cut = F.struct(
        F.split(text, ROLE_HEAD, -1).alias("parts"),
        F.regexp_extract_all(text, F.lit(ROLE_HEAD), F.lit(1)).alias("heads"),
    )

    def pairs(c):
        n = F.size(c["heads"])
        shifted = F.regexp_like(strip(F.get(c["parts"], F.lit(0))), F.lit(f"^(?:{_ROLE_WORDS})"))
        roles = F.when(shifted, F.slice(c["parts"], F.lit(1), n)).otherwise(c["heads"])
        contents = F.when(shifted, c["heads"]).otherwise(F.slice(c["parts"], F.lit(2), n))
        return F.zip_with(
            roles, contents, lambda r, t: F.struct(strip(r).alias("role"), strip(t).alias("content"))
        )

    return F.filter(bind(cut, pairs), lambda t: (t["role"] != "") & (t["content"] != "")).cast(TURNS)


def message_role(role: Column) -> Column:
    out = F.lit(None).cast("string")
    for word, name in CHAT_ROLES.items():
        out = F.when(role == word, F.lit(name)).otherwise(out)
    return out


def has_call_marker(content: Column) -> Column:
    return F.instr(content, CALL_MARKER) > 0


def text_before_call(content: Column) -> Column:
    return strip(F.substring_index(content, CALL_MARKER, 1))


def call_text(content: Column) -> Column:
    """First balanced ``{...}`` after the first call marker, or NULL."""
    after = F.substring(content, F.instr(content, CALL_MARKER) + len(CALL_MARKER), F.length(content))
    body = F.substring(after, F.instr(after, "{"), F.length(after))
    return F.when(
        has_call_marker(content) & (F.instr(after, "{") > 0), F.get(brace_spans(body), F.lit(0))
    )


def call_start(content: Column) -> Column:
    """Zero-based offset of the call marker."""
    return F.instr(content, CALL_MARKER) - 1


def call_end(content: Column) -> Column:
    """Zero-based offset just behind the call object."""
    behind = F.instr(content, CALL_MARKER) + len(CALL_MARKER)
    after = F.substring(content, behind, F.length(content))
    return behind + F.instr(after, "{") - 2 + F.length(call_text(content))


def user_text_ok(text: Column) -> Column:
    return F.coalesce(F.length(text).between(MIN_USER_CHARS, MAX_USER_CHARS), F.lit(False))


def _message(turn: Column, call: Column) -> Column:
    """Message of one turn; NULL marks a turn that spoils its conversation."""
    plain = F.struct(
        message_role(turn["role"]).alias("role"), turn["content"].alias("content"),
        F.lit(None).cast(CALLS).alias("tool_calls"),
    ).cast(MESSAGE)
    calling = F.struct(
        F.lit("assistant").alias("role"), text_before_call(turn["content"]).alias("content"),
        F.array(call).alias("tool_calls"),
    ).cast(MESSAGE)
    with_marker = (turn["role"] == "ASSISTANT") & has_call_marker(turn["content"])
    return (
        F.when((turn["role"] == "USER") & ~user_text_ok(turn["content"]), F.lit(None).cast(MESSAGE))
        .when(with_marker & call.isNull(), F.lit(None).cast(MESSAGE))
        .when(with_marker, calling)
        .otherwise(plain)
    )


def with_turns(df: DataFrame, chat: str = "chat") -> DataFrame:
    return sealed(df.withColumn("turns", role_turns(F.col(chat))))


def with_calls(df: DataFrame) -> DataFrame:
    """Adds ``calls``: one entry per turn, NULL where there is no usable call."""
    texts = F.transform(
        F.col("turns"), lambda t: F.when(t["role"] == "ASSISTANT", call_text(t["content"]))
    )
    parsed = with_objects(df.withColumn("_texts", texts), "_texts", "_texts")
    return sealed(parsed.withColumn("calls", tool_calls(F.col("_texts"))).drop("_texts"))


def with_messages(df: DataFrame, chat: str = "chat") -> DataFrame:
    """Adds ``messages`` parsed from ``chat``; NULL when any turn is bad or none is left."""
    known = F.filter(
        F.arrays_zip(F.col("turns").alias("turn"), F.col("calls").alias("call")),
        lambda z: z["turn"]["role"].isin(*CHAT_ROLES),
    )
    parsed = with_calls(with_turns(df, chat)).withColumn(
        "messages", F.transform(known, lambda z: _message(z["turn"], z["call"]))
    )
    good = (F.size("messages") > 0) & ~F.exists("messages", lambda m: m.isNull())
    return sealed(parsed.withColumn("messages", F.when(good, F.col("messages"))).drop("turns", "calls"))
