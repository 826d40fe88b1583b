"""Tool specifications and tool calls, normalised from object texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.functions.spans import brace_spans, with_objects
from turnpress.functions.text import LENIENT, is_falsy_json, is_json, spaced_json, variant_type
from turnpress.schemas import CALLS, TOOLS
from turnpress.session import sealed

_FIELDS = "name variant, description variant, parameters string"
_HEAD = f"type string, function string, {_FIELDS}"


def _may_be_text(text: Column, field: str) -> Column:
    """True where ``field`` could hold a JSON string; without a quote behind it, it cannot."""
    return F.regexp_like(text, F.lit(rf"""{field}["']\s*:\s*["']|\\u"""))


def _holds_object(text: Column, value: Column, field: str) -> Column:
    """Whether the value of ``field`` (as text) is a JSON object and not a string like one."""
    exact = F.from_json(text, f"{field} map<string,string>", LENIENT)[field].isNotNull()
    looks = F.coalesce(F.startswith(value, F.lit("{")), F.lit(False))
    return looks & (~_may_be_text(text, field) | exact)


def _text_of(v: Column) -> Column:
    """A variant as text: strings as they are, other values as JSON."""
    return F.when(variant_type(v) == "STRING", F.variant_get(v, "$", "string")).otherwise(F.to_json(v))


def _description(v: Column) -> Column:
    text = F.to_json(v)
    return (
        F.when(v.isNull(), F.lit(""))
        .when(variant_type(v) == "STRING", F.variant_get(v, "$", "string"))
        .when(is_falsy_json(text), F.lit(""))
        .otherwise(text)
    )


def _other_parameters(text: Column) -> Column:
    """Parameters that are no object (rare): kept as JSON text, empty values as ``{}``."""
    v = F.from_json(text, "parameters variant", LENIENT)["parameters"]
    return F.when(is_falsy_json(F.to_json(v)), F.lit("{}")).otherwise(spaced_json(F.to_json(v)))


def _parameters(text: Column, compact: Column) -> Column:
    return (
        F.when(compact.isNull(), F.lit("{}"))
        .when(_holds_object(text, compact, "parameters"), spaced_json(compact))
        .otherwise(_other_parameters(text))
    )


def tool_specs(texts: Column) -> Column:
    """Object texts -> tool specs in wrapped form; NULL where the name is no string."""
    outer = F.transform(
        texts, lambda t: F.struct(t.alias("text"), F.from_json(t, _HEAD, LENIENT).alias("head"))
    )

    def unwrap(o):
        head = o["head"]
        fields = F.struct(*[head[c].alias(c) for c in ("name", "description", "parameters")])
        wrapped = (head["type"] == "function") & _holds_object(o["text"], head["function"], "function")
        inner = F.struct(
            head["function"].alias("text"), F.from_json(head["function"], _FIELDS, LENIENT).alias("spec")
        )
        return F.when(wrapped, inner).otherwise(F.struct(o["text"].alias("text"), fields.alias("spec")))

    return F.transform(
        F.transform(outer, unwrap),
        lambda p: F.when(
            variant_type(p["spec"]["name"]) == "STRING",
            F.struct(
                F.lit("function").alias("type"),
                F.struct(
                    F.variant_get(p["spec"]["name"], "$", "string").alias("name"),
                    _description(p["spec"]["description"]).alias("description"),
                    _parameters(p["text"], p["spec"]["parameters"]).alias("parameters"),
                ).alias("function"),
            ),
        ),
    ).cast(TOOLS)


def tool_calls(texts: Column) -> Column:
    """Object texts -> tool calls; NULL where the name is missing or the arguments are bad.

    Arguments end as JSON text: an object is written out, a string must itself be
    JSON and stays as it is, missing arguments become ``{}``.
    """
    parsed = F.transform(
        texts,
        lambda t: F.struct(
            t.alias("text"),
            F.from_json(t, "name variant, arguments string", LENIENT).alias("call"),
        ),
    )

    def kind(p):
        return variant_type(F.from_json(p["text"], "arguments variant", LENIENT)["arguments"])

    typed = F.transform(
        parsed,
        lambda p: F.struct(
            p["call"]["name"].alias("name"),
            F.when(_holds_object(p["text"], p["call"]["arguments"], "arguments"), spaced_json(p["call"]["arguments"]))
            .when(kind(p).isNull(), F.lit("{}"))
            .when((kind(p) == "STRING") & is_json(p["call"]["arguments"]), p["call"]["arguments"])
            .alias("arguments"),
        ),
    )
    return F.transform(
        typed,
        lambda c: F.when(
            c["name"].isNotNull() & c["arguments"].isNotNull(),
            F.struct(
                F.lit("function").alias("type"),
                F.struct(_text_of(c["name"]).alias("name"), c["arguments"].alias("arguments")).alias("function"),
            ),
        ),
    ).cast(CALLS)


def with_declared_tools(df: DataFrame, system: str = "system", out: str = "tools") -> DataFrame:
    """Tool specs found in a prose prompt; spans that do not normalise are skipped."""
    found = df.withColumn("_spans", brace_spans(F.coalesce(F.col(system), F.lit(""))))
    parsed = with_objects(found, "_spans", "_spans")
    specs = F.filter(tool_specs(F.col("_spans")), lambda s: s.isNotNull())
    return sealed(parsed.withColumn(out, specs).drop("_spans"))


def tool_names(tools: Column) -> Column:
    return F.transform(tools, lambda t: t["function"]["name"])


def called_names(messages: Column) -> Column:
    calls = F.flatten(F.transform(messages, lambda m: F.coalesce(m["tool_calls"], F.array().cast(CALLS))))
    return F.transform(calls, lambda c: c["function"]["name"])
