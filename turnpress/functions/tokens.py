"""Chat rendering, tokenisation and loss masks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.functions.text import json_string
from turnpress.schemas import IGNORE_INDEX, INTS, SEGMENT

# Markers of the public chat layout.
TURN_OPEN = "<|im_start|>"
TURN_CLOSE = "<|im_end|>"
END_OF_TEXT = "<|endoftext|>"

# The public tool block of that layout.
TOOLS_HEAD = (
    "\n\n# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_FOOT = (
    "\n</tools>\n\nFor each function call, return a json object with function name and arguments "
    "within <tool_call></tool_call> XML tags:\n<tool_call>\n"
    '{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call>'
)


@dataclass(frozen=True)
class ChatTemplate:
    """Layout of a rendered conversation.

    ``quoted_arguments`` writes call arguments as a JSON string instead of embedding
    the JSON value.
    """

    system_prompt: str = "You are a helpful assistant."
    quoted_arguments: bool = False


def tool_json(tool: Column) -> Column:
    fn = tool["function"]
    return F.concat(
        F.lit('{"type": "function", "function": {"name": '), json_string(fn["name"]),
        F.lit(', "description": '), json_string(fn["description"]),
        F.lit(', "parameters": '), fn["parameters"], F.lit("}}"),
    )


def _turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit(TURN_OPEN), role, F.lit("\n"), body, F.lit(TURN_CLOSE + "\n"))


def _segment(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"), (role == "assistant").alias("trained")).cast(SEGMENT)


def render_chat(messages: Column, tools: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """``array<struct<role, text, trained>>``: the system prompt, then one segment per message.

    Concatenating the texts gives the rendered conversation. Only assistant segments
    are trained; opener and closer belong to the segment.
    """
    first = F.get(messages, F.lit(0))
    own_prompt = first["role"] == "system"
    prompt = F.when(own_prompt, first["content"]).otherwise(F.lit(template.system_prompt))
    signatures = F.array_join(F.transform(tools, lambda t: F.concat(F.lit("\n"), tool_json(t))), "")
    block = F.when(F.size(tools) > 0, F.concat(F.lit(TOOLS_HEAD), signatures, F.lit(TOOLS_FOOT))).otherwise("")
    head = _segment(F.lit("system"), _turn(F.lit("system"), F.concat(prompt, block)))

    def call(c):
        arguments = c["function"]["arguments"]
        return F.concat(
            F.lit('\n<tool_call>\n{"name": "'), c["function"]["name"], F.lit('", "arguments": '),
            json_string(arguments) if template.quoted_arguments else arguments, F.lit("}\n</tool_call>"),
        )

    def body(m, i):
        content = F.coalesce(m["content"], F.lit(""))
        before = F.get(messages, i - 1)["role"]
        after = F.get(messages, i + 1)["role"]
        opens = ~F.coalesce((i > 0) & (before == "tool"), F.lit(False))
        closes = ~F.coalesce(after == "tool", F.lit(False))
        response = F.concat(
            F.when(opens, TURN_OPEN + "user").otherwise(""),
            F.lit("\n<tool_response>\n"), content, F.lit("\n</tool_response>"),
            F.when(closes, TURN_CLOSE + "\n").otherwise(""),
        )
        calls = F.array_join(F.transform(m["tool_calls"], call), "")
        calling = F.concat(
            F.lit(TURN_OPEN + "assistant"), F.when(content != "", F.concat(F.lit("\n"), content)).otherwise(""),
            calls, F.lit(TURN_CLOSE + "\n"),
        )
        return (
            F.when(m["role"] == "tool", response)
            .when((m["role"] == "assistant") & (F.size(m["tool_calls"]) > 0), calling)
            .otherwise(_turn(m["role"], content))
        )

    bodies = F.transform(messages, lambda m, i: _segment(m["role"], body(m, i)))
    rest = F.when(own_prompt, F.slice(bodies, F.lit(2), F.size(bodies))).otherwise(bodies)
    return F.when(F.size(messages) > 0, F.concat(F.array(head), rest))


def rendered_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


class ByteTokenizer:
    """UTF-8 byte ids 0..255 and one reserved id per marker; stays on the JVM.

    The bytes are read as Latin-1 so that each is one character, and each marker is
    replaced by the character whose code point is its id: one character per token.
    """

    specials = {END_OF_TEXT: 256, TURN_OPEN: 257, TURN_CLOSE: 258}

    def __init__(self, pad_id: int | None = None, eos_id: int = 256):
        self.pad_id, self.eos_id = pad_id, eos_id

    def _characters(self, text: Column) -> Column:
        out = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
        for marker, token in self.specials.items():
            out = F.replace(out, F.lit(marker), F.lit(chr(token)))
        return out

    def ids(self, text: Column) -> Column:
        chars = self._characters(text)
        none = F.array().cast(INTS)
        return F.when(text == "", none).otherwise(F.transform(F.split(chars, ""), lambda c: F.ascii(c)))

    def segment_ids(self, segments: Column) -> Column:
        return F.transform(segments, lambda s: self.ids(s["text"]))

    def n_tokens(self, segments: Column) -> Column:
        """Length without building any ids."""
        return F.length(self._characters(rendered_text(segments)))


class FileTokenizer:
    """A ``tokenizer.json`` vocabulary, applied to Arrow batches of segments.

    The file must be readable under the same path on every executor (``--files`` or a
    shared folder); each task loads it once.
    """

    def __init__(self, path: str, pad_id: int | None = None, eos_id: int | None = None):
        self.path, self.pad_id, self.eos_id = path, pad_id, eos_id

    def segment_ids(self, segments: Column) -> Column:
        path = self.path

        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            for rows in batches:
                flat = [t for row in rows if row is not None for t in row]
                coded = iter(tokenizer.encode_batch(flat, add_special_tokens=False))
                yield rows.map(lambda row: None if row is None else [next(coded).ids for _ in row])

        return F.pandas_udf(encode, T.ArrayType(INTS))(F.transform(segments, lambda s: s["text"]))

    def n_tokens(self, segments: Column) -> Column:
        return F.aggregate(self.segment_ids(segments), F.lit(0), lambda n, ids: n + F.size(ids))


def resolve_pad(tokenizer) -> int:
    """The padding id, else the end-of-text id."""
    pad = tokenizer.eos_id if tokenizer.pad_id is None else tokenizer.pad_id
    if pad is None:
        raise ValueError("the tokenizer has neither a padding nor an end-of-text id")
    return pad


def mask_labels(segments: Column, segment_ids: Column) -> Column:
    """Ids of trained segments, the ignore value elsewhere."""
    masked = F.zip_with(
        segments, segment_ids,
        lambda s, ids: F.when(s["trained"], ids).otherwise(F.array_repeat(F.lit(IGNORE_INDEX), F.size(ids))),
    )
    return F.flatten(masked)


def trainable(labels: Column) -> Column:
    return F.coalesce(F.exists(labels, lambda x: x != IGNORE_INDEX), F.lit(False))


def n_supervised(labels: Column) -> Column:
    return F.size(F.filter(labels, lambda x: x != IGNORE_INDEX))
