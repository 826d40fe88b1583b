"""Top-level ``{...}`` spans of a text and permissive object parsing."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.functions.text import CORRUPT, LENIENT, STRICT, bind
from turnpress.schemas import SPANS, TEXTS
from turnpress.session import sealed

# A quoted string (closed or not), one brace, or a run of anything else.
_ONE = r'"(?:[^"\\]++|\\.)*+"?|[{}]|[^"{}]++'
TOKEN = f"(?s){_ONE}"

# Nesting up to which an object is found whole by one linear expression. What is deeper, and
# a text behind a brace that never closes, is folded token by token instead: same spans.
DEPTH = 12


def _object(depth: int) -> str:
    inner = "" if depth == 1 else "|" + _object(depth - 1)
    return r'\{(?:[^{}"]++|"(?:[^"\\]++|\\.)*+"' + inner + r")*+\}"


# Objects, the rest of the text from a brace that opens none, and all that lies between.
_OBJECT = f"(?s){_object(DEPTH)}"
_PIECE = _OBJECT + r'|\{.*+|(?:"(?:[^"\\]++|\\.)*+"?|[^{"]++)++'

# Tokens that are folded together. Arrays grow inside one chunk only, so the work on a
# text grows with its length and not with its square.
CHUNK = 128
_CHUNK = f"(?s)(?:{_ONE}){{1,{CHUNK}}}"

# Marks the edges of spans in a copy of the text; the escape keeps it unambiguous.
_ESCAPE, _ESCAPED, _EDGE = "\x01", "\x01e", "\x01s"

# Words and escapes that mean something else in a Python literal than in JSON.
_LITERAL_ONLY = r"true|false|null|NaN|INF|Infinity|\\[/u]"

_SUM = "struct<net:int,low:int,size:int>"
_AT = "struct<pos:int,depth:int>"
_EDGES = "array<struct<pos:int,opens:boolean>>"
_FOUND = "array<struct<start:int,len:int,span:string>>"


def _tokens(chunk: Column) -> Column:
    return F.regexp_extract_all(chunk, F.lit(TOKEN), F.lit(0))


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_CHUNK), F.lit(0))


def _deeper(depth: Column, token: Column) -> Column:
    """Depth behind a token; a brace that closes nothing leaves it at zero."""
    return F.when(token == "{", depth + 1).when((token == "}") & (depth > 0), depth - 1).otherwise(depth)


def _beginnings(chunks: Column) -> Column:
    """Offset (from one) and depth at the start of every chunk.

    Of a chunk only the net change of depth, its lowest point and its length are needed:
    from depth d it ends at max(d + net, net - lowest).
    """

    def summed(chunk):
        def step(s, token):
            net = s["net"] + F.when(token == "{", 1).when(token == "}", -1).otherwise(0)
            return F.struct(
                net.alias("net"), F.least(s["low"], net).alias("low"), (s["size"] + F.length(token)).alias("size")
            ).cast(_SUM)

        zero = F.struct(F.lit(0).alias("net"), F.lit(0).alias("low"), F.lit(0).alias("size")).cast(_SUM)
        return F.aggregate(_tokens(chunk), zero, step)

    state = f"struct<pos:int,depth:int,at:array<{_AT}>>"
    zero = F.struct(F.lit(1).alias("pos"), F.lit(0).alias("depth"), F.array().cast(f"array<{_AT}>").alias("at")).cast(state)

    def next_chunk(s, c):
        here = F.struct(s["pos"].alias("pos"), s["depth"].alias("depth")).cast(_AT)
        return F.struct(
            (s["pos"] + c["size"]).alias("pos"),
            F.greatest(s["depth"] + c["net"], c["net"] - c["low"]).alias("depth"),
            F.concat(s["at"], F.array(here)).alias("at"),
        ).cast(state)

    return F.aggregate(F.transform(chunks, summed), zero, next_chunk, lambda s: s["at"])


def _edges(chunk: Column, begin: Column) -> Column:
    """Offsets in one chunk where top-level spans open, and behind where they close."""
    state = f"struct<pos:int,depth:int,edges:{_EDGES}>"
    zero = F.struct(begin["pos"].alias("pos"), begin["depth"].alias("depth"), F.array().cast(_EDGES).alias("edges")).cast(state)

    def step(s, token):
        after = s["pos"] + F.length(token)
        opens, closes = (token == "{") & (s["depth"] == 0), (token == "}") & (s["depth"] == 1)
        edge = F.array(F.struct(F.when(opens, s["pos"]).otherwise(after).alias("pos"), opens.alias("opens"))).cast(_EDGES)
        return F.struct(
            after.alias("pos"), _deeper(s["depth"], token).alias("depth"),
            F.when(opens | closes, F.concat(s["edges"], edge)).otherwise(s["edges"]).alias("edges"),
        ).cast(state)

    return F.aggregate(_tokens(chunk), zero, step, lambda s: s["edges"])


def _folded_offsets(text: Column) -> Column:
    """``(start, len)`` of every balanced top-level span; braces in strings do not count.

    Offsets count from one. Strings are single tokens; chunks of tokens are folded for
    their sums first, and then, each from its own beginning, for the edges of spans.
    """

    def paired(edges):
        starts, ends = F.filter(edges, lambda e: e["opens"]), F.filter(edges, lambda e: ~e["opens"])
        return bind(F.struct(starts.alias("a"), ends.alias("b")), lambda p: F.zip_with(
            F.slice(p["a"], F.lit(1), F.size(p["b"])), p["b"],
            lambda a, b: F.struct(a["pos"].alias("start"), (b["pos"] - a["pos"]).alias("len")),
        )).cast(SPANS)

    def found(chunks):
        return bind(F.flatten(F.zip_with(chunks, _beginnings(chunks), _edges)), paired)

    return F.when(F.instr(text, "{") > 0, bind(_chunks(text), found)).otherwise(F.array().cast(SPANS))


def _folded_spans(text: Column) -> Column:
    """Texts of the balanced top-level spans, in order of appearance.

    A copy of the text with a mark at every edge is split at the marks: every second piece
    is a span, and the last one is none if it never closes.
    """

    def marked(chunk, begin):
        state = "struct<depth:int,out:string>"
        zero = F.struct(begin["depth"].alias("depth"), F.lit("").alias("out")).cast(state)

        def step(s, token):
            piece = F.when((token == "{") & (s["depth"] == 0), F.concat(F.lit(_EDGE), token)).when(
                (token == "}") & (s["depth"] == 1), F.concat(token, F.lit(_EDGE))
            ).otherwise(token)
            return F.struct(_deeper(s["depth"], token).alias("depth"), F.concat(s["out"], piece).alias("out")).cast(state)

        return F.aggregate(_tokens(chunk), zero, step, lambda s: s["out"])

    def pieces(chunks):
        return F.split(F.array_join(F.zip_with(chunks, _beginnings(chunks), marked), ""), _EDGE, -1)

    def inside(parts):
        closed = F.filter(parts, lambda p, i: (i % 2 == 1) & (i < F.size(parts) - 1))
        return F.transform(closed, lambda p: F.replace(p, F.lit(_ESCAPED), F.lit(_ESCAPE)))

    whole = bind(_chunks(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPED))), lambda c: bind(pieces(c), inside))
    return F.when(F.instr(text, "{") > 0, whole).otherwise(F.array().cast(TEXTS))


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))


def _placed(pieces: Column) -> Column:
    """Objects among the pieces of a text with their offsets; work grows with the number of pieces."""
    blocks = F.when(F.size(pieces) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / CHUNK).cast("int")),
        lambda k: F.slice(pieces, k * CHUNK + 1, F.lit(CHUNK)),
    )).otherwise(F.array().cast("array<array<string>>"))

    def begins(sizes):
        state = "struct<pos:int,at:array<int>>"
        zero = F.struct(F.lit(1).alias("pos"), F.array().cast("array<int>").alias("at")).cast(state)
        return F.aggregate(sizes, zero, lambda s, n: F.struct(
            (s["pos"] + n).alias("pos"), F.concat(s["at"], F.array(s["pos"])).alias("at")
        ).cast(state), lambda s: s["at"])

    def found(block, begin):
        state = f"struct<pos:int,found:{_FOUND}>"
        zero = F.struct(begin.alias("pos"), F.array().cast(_FOUND).alias("found")).cast(state)

        def step(s, piece):
            here = F.array(F.struct(s["pos"].alias("start"), F.length(piece).alias("len"), piece.alias("span"))).cast(_FOUND)
            return F.struct(
                (s["pos"] + F.length(piece)).alias("pos"),
                F.when(F.startswith(piece, F.lit("{")), F.concat(s["found"], here)).otherwise(s["found"]).alias("found"),
            ).cast(state)

        return F.aggregate(block, zero, step, lambda s: s["found"])

    def size(block):
        return F.aggregate(block, F.lit(0), lambda n, piece: n + F.length(piece))

    return bind(blocks, lambda bs: F.flatten(F.zip_with(bs, begins(F.transform(bs, size)), found)))


def _split_rest(pieces: Column) -> Column:
    """``(closed, rest)``: the last piece is taken off where its brace opens no object of ``DEPTH`` levels."""
    last = F.get(pieces, F.size(pieces) - 1)
    left = F.startswith(last, F.lit("{")) & ~F.regexp_like(last, F.lit(f"^(?:{_OBJECT})$"))
    return F.when(left, F.struct(F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("closed"), last.alias("rest"))).otherwise(
        F.struct(pieces.alias("closed"), F.lit(None).cast("string").alias("rest"))
    )


def brace_objects(text: Column) -> Column:
    """``(start, len, span)`` of every balanced top-level span; braces in strings do not count.

    Offsets count from one. One expression cuts the text into objects and what lies between.
    """

    def both(p):
        before = F.length(text) - F.length(p["rest"])
        deep = bind(p["rest"], lambda rest: F.zip_with(_folded_offsets(rest), _folded_spans(rest), lambda at, span: F.struct(
            (at["start"] + before).alias("start"), at["len"].alias("len"), span.alias("span")
        ))).cast(_FOUND)
        return F.when(p["rest"].isNull(), _placed(p["closed"])).otherwise(F.concat(_placed(p["closed"]), deep))

    whole = bind(_pieces(text), lambda pieces: bind(_split_rest(pieces), both))
    return F.when(F.instr(text, "{") > 0, whole).otherwise(F.array().cast(_FOUND))


def brace_spans(text: Column) -> Column:
    """Texts of the balanced top-level spans, in order of appearance; see ``brace_objects``."""

    def both(p):
        closed = F.filter(p["closed"], lambda piece: F.startswith(piece, F.lit("{")))
        return F.when(p["rest"].isNull(), closed).otherwise(F.concat(closed, _folded_spans(p["rest"])))

    whole = bind(_pieces(text), lambda pieces: bind(_split_rest(pieces), both))
    return F.when(F.instr(text, "{") > 0, whole).otherwise(F.array().cast(TEXTS))


def _parses(text: Column, options: dict) -> Column:
    parsed = F.from_json(text, f"name string, {CORRUPT} string", options)
    return F.coalesce(parsed.isNotNull() & parsed[CORRUPT].isNull() & (F.length(text) > 0), F.lit(False))


def _parses_natively(text: Column) -> Column:
    lenient = ~F.regexp_like(text, F.lit(_LITERAL_ONLY)) & _parses(text, LENIENT)
    return _parses(text, STRICT) | F.coalesce(lenient, F.lit(False))


def _literal_objects(texts: Column) -> Column:
    """JSON texts of Python-literal dicts; NULL for anything else.

    The functions live inside this one so that they travel to the executors by value.
    """

    def convert(text):
        if text is None:
            return None
        for parse in (json.loads, ast.literal_eval):
            try:
                value = parse(text)
            except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
                continue
            if not isinstance(value, dict):
                return None
            return json.dumps(value, ensure_ascii=False, skipkeys=True, default=lambda v: [repr(v)])
        return None

    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda row: None if row is None else [convert(t) for t in row])

    return F.pandas_udf(run, TEXTS)(texts)


def with_objects(df: DataFrame, texts: str, out: str) -> DataFrame:
    """Array of texts -> array of object texts in ``out``; NULL where a text is no object.

    JSON and plain single-quoted objects stay on the JVM. Only what is left, such as
    ``{'a': True}``, crosses into Python: every other row sends a NULL.
    """
    left = F.transform(texts, lambda t: F.when(t.isNotNull() & ~_parses_natively(t), t))
    split = sealed(df).withColumn("_left", left).withColumn(
        "_left", F.when(F.exists("_left", lambda t: t.isNotNull()), F.col("_left"))
    )
    literal = sealed(sealed(split).withColumn("_literal", _literal_objects(F.col("_left"))))
    merged = F.transform(
        F.arrays_zip(F.col(texts).alias("native"), F.col("_left").alias("left"), F.col("_literal").alias("literal")),
        lambda z: F.when(z["left"].isNull(), z["native"]).otherwise(z["literal"]),
    )
    return literal.withColumn(
        out, F.when(F.col("_literal").isNull(), F.col(texts)).otherwise(merged)
    ).drop("_left", "_literal")
