"""Chat formatting: canonical turns from heterogeneous layouts, and a reversible template.

A record holds a conversation in one of several layouts: prompt and response, instruction
with or without input, a list of messages, a list of exchanges, and so on, all as nullable
columns of one table. The paths of the fields that a row has, hashed, are the fingerprint of
its layout; it selects a declarative mapping that yields canonical (role, text) turns.

The template marks where turns and their texts begin and end. Inside roles and texts every
control string is replaced by a tilde and a digit, and tildes by ``~0``, so markers occur
only where the template put them and all texts come back. The loss mask is one run per
turn: characters before the text, text under the loss, characters behind.

Contract. NULL roles and texts are empty. A layout without mapping gives NULL turns and a
NULL layout name, and no error. Turns are ordered by number, rows of one number by role and
text; repeated rows are repeated turns. Columns besides those of a layout are passed over.
Empty tables give empty results. Everything is a column expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEGIN, MIDDLE, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROLS = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
"""Strings that may not stand in a text of the output as they are."""

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """How the layout with exactly these fields becomes turns."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[], Column]

    def fingerprint(self) -> Column:
        return F.xxhash64(F.lit(",".join(sorted(self.paths))))


def said(role: str, field: str) -> Column:
    return F.struct(F.lit(role).alias("role"), F.coalesce(F.col(field), F.lit("")).alias("text"))


def listed(field: str, role: str, text: str, names: dict[str, str]) -> Column:
    """Turns of a list of structs; ``names`` are the roles that have another name there."""

    def turn(x: Column) -> Column:
        named = F.coalesce(x[role], F.lit(""))
        for theirs, ours in names.items():
            named = F.when(x[role] == theirs, F.lit(ours)).otherwise(named)
        return F.struct(named.alias("role"), F.coalesce(x[text], F.lit("")).alias("text"))

    return F.transform(field, turn)


MAPPINGS = (
    Mapping("pair", ("prompt", "response"), lambda: F.array(said("user", "prompt"), said("assistant", "response"))),
    Mapping("instruction", ("instruction", "output"), lambda: F.array(said("user", "instruction"), said("assistant", "output"))),
    Mapping(
        "instruction_input", ("instruction", "input", "output"),
        lambda: F.array(said("system", "instruction"), said("user", "input"), said("assistant", "output")),
    ),
    Mapping("messages", ("messages[].role", "messages[].content"), lambda: listed("messages", "role", "content", {})),
    Mapping(
        "exchanges", ("conversations[].from", "conversations[].value"),
        lambda: listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    ),
)


def field_paths(type_: T.DataType, value: Column, path: str) -> list[tuple[str, Column]]:
    """Leaf paths below a column, each with the condition that a row has it."""
    if isinstance(type_, T.StructType):
        return [p for f in type_.fields for p in field_paths(f.dataType, value[f.name], f"{path}.{f.name}" if path else f.name)]
    if isinstance(type_, T.ArrayType):
        inner = [type_.elementType]
        leaves = [""]
        if isinstance(inner[0], T.StructType):
            leaves = [f".{f.name}" for f in inner[0].fields]
        return [(f"{path}[]{leaf}", value.isNotNull()) for leaf in leaves]
    return [(path, value.isNotNull())]


def fingerprint(records: DataFrame, fields: list[str]) -> Column:
    """Hash of the sorted paths that a row has among ``fields``."""
    paths = [p for name in fields for p in field_paths(records.schema[name].dataType, F.col(name), name)]
    present = F.array(*(F.when(has, F.lit(path)) for path, has in paths))
    return F.xxhash64(F.array_join(F.array_sort(F.array_compact(present)), ","))


def canonical(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` with ``layout`` (name of the mapping) and ``turns``."""
    known = {p.split("[]")[0].split(".")[0] for m in mappings for p in m.paths}
    fields = [f for f in records.columns if f in known]
    usable = [m for m in mappings if {p.split("[]")[0].split(".")[0] for p in m.paths} <= set(fields)]
    marked = records.withColumn("_layout", fingerprint(records, fields))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in usable:
        layout = F.when(F.col("_layout") == m.fingerprint(), F.lit(m.name)).otherwise(layout)
        turns = F.when(F.col("_layout") == m.fingerprint(), m.turns().cast(TURNS)).otherwise(turns)
    return marked.withColumns({"layout": layout, "turns": turns}).drop("_layout")


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("~"), F.lit("~0"))
    for i, control in enumerate(CONTROLS, 1):
        text = F.replace(text, F.lit(control), F.lit(f"~{i}"))
    return text


def unescaped(text: Column) -> Column:
    for i in range(len(CONTROLS), 0, -1):
        text = F.replace(text, F.lit(f"~{i}"), F.lit(CONTROLS[i - 1]))
    return F.replace(text, F.lit("~0"), F.lit("~"))


def formatted(df: DataFrame, turns: str = "turns", trained: str = "assistant") -> DataFrame:
    """``df`` with ``formatted`` and ``mask`` array<struct<skip, take, tail>>, one run per turn."""
    parts = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(BEGIN), escaped(t["role"]), F.lit(MIDDLE)).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == trained).alias("loss"),
        ),
    )
    made = df.withColumn("_parts", parts)
    mask = F.transform(
        "_parts",
        lambda p: F.struct(
            F.when(p["loss"], F.length(p["head"])).otherwise(F.length(p["head"]) + F.length(p["body"])).alias("skip"),
            F.when(p["loss"], F.length(p["body"])).otherwise(0).alias("take"),
            F.lit(len(END)).alias("tail"),
        ),
    )
    text = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return made.withColumns({"formatted": text, "mask": mask}).drop("_parts")


def read_back(df: DataFrame) -> DataFrame:
    """``df`` with ``turns`` and ``loss_texts`` (unescaped) read from ``formatted`` and ``mask`` alone."""
    quoted = lambda s: rf"\Q{s}\E"
    pieces = F.split("formatted", quoted(END), -1)
    made = df.withColumn("_pieces", F.slice(pieces, 1, F.size(pieces) - 1))

    def turn(piece: Column) -> Column:
        head_body = F.split(piece.substr(F.lit(len(BEGIN) + 1), F.length(piece)), quoted(MIDDLE), 2)
        return F.struct(unescaped(head_body[0]).alias("role"), unescaped(head_body[1]).alias("text"))

    def loss(piece: Column, run: Column) -> Column:
        fits = run["skip"] + run["take"] + run["tail"] == F.length(piece) + len(END)
        return F.when(fits, unescaped(piece.substr(run["skip"] + 1, run["take"]))).otherwise(
            F.raise_error(F.lit("the loss mask does not fit the formatted text")).cast("string")
        )

    texts = F.filter(F.zip_with("_pieces", "mask", lambda p, m: F.when(m["take"] > 0, loss(p, m))), lambda x: x.isNotNull())
    return made.withColumns({"turns": F.transform("_pieces", turn), "loss_texts": texts}).drop("_pieces")


def layouts(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One record per conversation from a table of turns, in the layout that its shape suggests.

    A question and its answer become a pair, three turns behind a system turn an instruction
    with input; other conversations of the three usual roles with an odd number are exchanges,
    and the rest are messages.
    """
    whole = rows.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct(
        F.col(turn).alias("n"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ))).alias("t"))
    roles = F.col("t.role")
    are = lambda *names: roles == F.array(*map(F.lit, names))
    kind = (
        F.when(are("user", "assistant"), "pair")
        .when(are("system", "user", "assistant"), "instruction_input")
        .when((F.size(F.array_except(roles, F.array(*map(F.lit, ("system", "user", "assistant"))))) == 0) & (F.pmod(F.col(conv), F.lit(2)) == 1), "exchanges")
        .otherwise("messages")
    )
    at = lambda i: F.get("t", F.lit(i))["text"]
    theirs = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    return whole.withColumn("_kind", kind).select(
        conv,
        F.when(F.col("_kind") == "pair", at(0)).alias("prompt"),
        F.when(F.col("_kind") == "pair", at(1)).alias("response"),
        F.when(F.col("_kind") == "instruction_input", at(0)).alias("instruction"),
        F.when(F.col("_kind") == "instruction_input", at(1)).alias("input"),
        F.when(F.col("_kind") == "instruction_input", at(2)).alias("output"),
        F.when(F.col("_kind") == "messages", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))).alias("messages"),
        F.when(F.col("_kind") == "exchanges", F.transform("t", lambda x: F.struct(theirs(x["role"]).alias("from"), x["text"].alias("value")))).alias("conversations"),
    )
