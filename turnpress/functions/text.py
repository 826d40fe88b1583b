"""Text and JSON column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a text is trimmed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same white space as a regular-expression class (with the U flag).
SPACE_CLASS = r"[\s\x1c-\x1f]"

CORRUPT = "_corrupt"
STRICT = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": CORRUPT}
LENIENT = {"allowSingleQuotes": "true", "columnNameOfCorruptRecord": CORRUPT}

# One pass over JSON: text up to a structural comma or colon and the space behind it.
_STRUCTURAL = r'(?s)\G((?:[^",:]++|"(?:[^"\\]++|\\.)*+")*+)([,:])[ \t\n\r]*+'


def strip(c: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spaced_json(c: Column) -> Column:
    """JSON text with one space after every structural comma and colon."""
    return F.regexp_replace(c, _STRUCTURAL, "$1$2 ")


def json_string(c: Column) -> Column:
    """A text as a quoted JSON string."""
    quoted = F.to_json(F.array(c))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def _in_array(c: Column) -> Column:
    return F.concat(F.lit("["), c, F.lit("]"))


def _in_object(c: Column) -> Column:
    return F.concat(F.lit('{"v":'), c, F.lit("}"))


def is_json(c: Column) -> Column:
    """True when the whole text is one JSON value.

    The parser stops after the first complete value, so the text is tried inside
    an array and inside an object: nothing but a single value fits both.
    """
    array = F.from_json(_in_array(c), "array<string>", STRICT)
    obj = F.from_json(_in_object(c), f"v string, {CORRUPT} string", STRICT)
    return F.coalesce((F.size(array) == 1) & obj[CORRUPT].isNull(), F.lit(False))


def json_list(c: Column) -> Column:
    """Elements of a text that is exactly one JSON list, as texts; else NULL.

    Inside an array only a stray ``]`` behind the list can hide from the parser, so the
    second form is tried just for texts with two closing brackets in a row.
    """
    array = F.from_json(_in_array(c), "array<array<string>>", STRICT)

    def single(parsed):
        obj = F.from_json(_in_object(c), f"v array<string>, {CORRUPT} string", STRICT)
        whole = F.when(F.regexp_like(c, F.lit(r"\]\s*\]")), obj[CORRUPT].isNull()).otherwise(F.lit(True))
        return F.when((F.size(parsed) == 1) & whole, F.get(parsed, F.lit(0)))

    return bind(array, single)


def list_of_objects(c: Column) -> Column:
    """True unless an element of the JSON list is a string that looks like an object."""
    suspicious = F.regexp_like(c, F.lit(r'[\[,]\s*"\s*\{'))
    parsed = F.from_json(c, "array<map<string,string>>", STRICT)
    exact = parsed.isNotNull() & ~F.exists(parsed, lambda m: m.isNull())
    return F.when(suspicious, exact).otherwise(F.lit(True))


def variant_type(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_falsy_json(text: Column) -> Column:
    """JSON values that count as absent."""
    return text.isin("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}")
