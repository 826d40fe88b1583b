"""Byte-level pair merges with the vocabulary of a file, over Arrow batches of segments.

The file is read once, on the driver, and sent to executors as a broadcast: its size is
that of a vocabulary, not of the data, and is checked. A text is cut at the special tokens
and then by the vocabulary's pattern; each distinct piece is merged once per task and
remembered, up to a bound. A piece of n bytes takes n log n steps, however long it is.
"""

from __future__ import annotations

import array
import base64
import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.functions.tokens import END_OF_TEXT, TURN_CLOSE, TURN_OPEN
from turnpress.schemas import INTS

# Fixed value: the public pattern of byte-level vocabularies that name none.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MOST_ENTRIES, REMEMBERED = 1 << 20, 1 << 17
"""The largest vocabulary that is broadcast, and the distinct pieces a task remembers."""


@dataclass(frozen=True)
class Vocabulary:
    """Merge order and ids by the bytes of an entry; ``whole`` looks a piece up before merging it."""

    ranks: dict[bytes, int]
    ids: dict[bytes, int]
    specials: dict[str, int]
    pattern: str
    whole: bool
    form: str | None = None


def byte_names() -> dict[str, int]:
    """The characters that JSON vocabularies write for bytes: printable Latin-1 as it is, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    names = {chr(b): b for b in plain}
    names.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return names


def read_ranks(path: str, pattern: str = PATTERN) -> Vocabulary:
    """A rank file: one entry per line in base 64 and its id. Chat markers get the ids after the last."""
    ids = {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, Path(path).read_bytes().splitlines())}
    last = max(ids.values())
    specials = {marker: last + 1 + i for i, marker in enumerate((END_OF_TEXT, TURN_OPEN, TURN_CLOSE))}
    return Vocabulary(ids, ids, specials, pattern, whole=True)


def read_json(path: str) -> Vocabulary:
    """A ``tokenizer.json`` of byte-level merges; any other kind is an error."""
    whole = json.loads(Path(path).read_text("utf-8"))
    model, steps = whole["model"], whole.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    form = (whole.get("normalizer") or {}).get("type")
    splits = [s["pattern"]["Regex"] for s in steps if s.get("type") == "Split" and "Regex" in s["pattern"] and s["behavior"] == "Isolated"]
    last = steps[-1]
    plain = (
        model.get("type") == "BPE" and last.get("type") == "ByteLevel" and not last["add_prefix_space"] and form in (None, "NFC", "NFKC")
        and len(splits) == len(steps) - 1 == (0 if last.get("use_regex", True) else 1)
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in whole.get("added_tokens", ()))
    )
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level vocabulary")
    names = byte_names()
    spelled = lambda entry: bytes(names[c] for c in entry)
    added = {t["content"]: t["id"] for t in whole.get("added_tokens", ())}
    ids = {spelled(entry): i for entry, i in model["vocab"].items() if entry not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ranks = {spelled(left + right): i for i, (left, right) in enumerate(pairs)}
    if len(ranks) < len(pairs):
        raise ValueError(f"{path} merges to one entry in two ways")
    return Vocabulary(ranks, ids, added, splits[0] if splits else PATTERN, bool(model.get("ignore_merges")), form)


def read_vocabulary(path: str, pattern: str = PATTERN) -> Vocabulary:
    found = read_json(path) if path.endswith(".json") else read_ranks(path, pattern)
    if len(found.ids) > MOST_ENTRIES:
        raise ValueError(f"{path} has {len(found.ids)} entries, more than {MOST_ENTRIES}")
    return found


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Parts of a piece after all merges, lowest rank first and then leftmost.

    Parts are linked by where they end; a queued merge holds only as long as both of its
    parts are still those that it was queued for.
    """
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(ranks[pair], i, i + 2) for i in range(n - 1) if (pair := piece[i : i + 2]) in ranks]
    heapq.heapify(queue)
    while queue:
        _, start, stop = heapq.heappop(queue)
        middle = end[start]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
            if (rank := ranks.get(piece[start : end[stop]])) is not None:
                heapq.heappush(queue, (rank, start, end[stop]))
        if (left := before[start]) >= 0 and (rank := ranks.get(piece[left:stop])) is not None:
            heapq.heappush(queue, (rank, left, stop))
    parts, start = [], 0
    while start < n:
        parts.append(piece[start : end[start]])
        start = end[start]
    return parts


class Encoder:
    """Texts to ids with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces = regex.compile(vocabulary.pattern).finditer
        longest = sorted(vocabulary.specials, key=len, reverse=True)
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.known: dict[str, list[int]] = {}

    def piece(self, text: str) -> list[int]:
        v, raw = self.vocabulary, text.encode()
        if v.whole and raw in v.ids:
            return [v.ids[raw]]
        return [v.ids[part] for part in merged(raw, v.ranks)]

    def plain(self, text: str) -> Iterator[list[int]]:
        known = self.known
        if self.vocabulary.form:
            text = unicodedata.normalize(self.vocabulary.form, text)
        for match in self.pieces(text):
            p = match.group()
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(p) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[p] = ids
            yield ids

    def encode(self, text: str, into: array.array) -> None:
        for i, part in enumerate(self.cuts.split(text) if self.cuts else [text]):
            if i % 2:
                into.append(self.vocabulary.specials[part])
            else:
                for ids in self.plain(part):
                    into.extend(ids)

    def lists(self, column: pa.Array) -> pa.Array:
        """An ``array<array<int>>`` for an ``array<string>``; NULL arrays stay NULL, NULL texts are empty."""
        into, ends = array.array("i"), [0]
        for text in column.flatten():
            self.encode(text.as_py() or "", into)
            ends.append(len(into))
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        inner = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(into, np.int32)))
        starts = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(starts, inner, mask=column.is_null())


class VocabularyTokenizer:
    """Ids by a rank file or a byte-level ``tokenizer.json``; only the driver needs to reach the file."""

    def __init__(self, path: str, pattern: str = PATTERN, pad_id: int | None = None, eos_id: int | None = None):
        self.path, self.pattern, self.pad_id = path, pattern, pad_id
        self.eos_id = read_vocabulary(path, pattern).specials.get(END_OF_TEXT) if eos_id is None else eos_id

    def segment_ids(self, segments: Column) -> Column:
        sent = SparkSession.active().sparkContext.broadcast(read_vocabulary(self.path, self.pattern))

        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = Encoder(sent.value)
            for batch in batches:
                yield encoder.lists(batch)

        return F.arrow_udf(encode, T.ArrayType(INTS))(F.transform(segments, lambda s: s["text"]))

    def n_tokens(self, segments: Column) -> Column:
        return F.aggregate(self.segment_ids(segments), F.lit(0), lambda n, ids: n + F.size(ids))
