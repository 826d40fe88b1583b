"""Byte-level BPE over a given vocabulary: encoding and decoding.

A pre-token that is a vocabulary entry as a whole is found by a minimal perfect hash: a
displacement per bucket sends each entry to a slot of its own, and the entry stored in
the slot tells members from strangers. Other pre-tokens are merged by a heap of adjacent
pairs over linked byte spans, lowest rank first and leftmost among equals, in n log n.

Contract. NULL text is empty text; an empty text has no tokens. Repeated rows are encoded
each on its own; other columns, whatever their names, are left as they are. Ids decode to
the very bytes of the text. The vocabulary is a file of bounded size that the driver reads
and every task receives.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MASK = (1 << 64) - 1
ROWS = 1000
"""Documents whose ids are gathered at a time."""

CACHE = 250_000
"""Pre-tokens whose ids a task keeps; the store is emptied when full, which changes no result."""


class PerfectHash:
    """Slots for a fixed set of byte strings, as many slots as strings."""

    def __init__(self, keys: list[bytes], load: int = 2):
        self.n = len(keys)
        self.buckets = max(1, self.n // load)
        self.shift = array("q", bytes(8 * self.buckets))
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [self.hashes(k) for k in keys]
        for i, (low, _) in enumerate(hashes):
            members[low % self.buckets].append(i)
        taken = [-1] * self.n
        for bucket in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            group = members[bucket]
            if len(group) < 2:
                break
            d = 0
            while True:
                slots = [self.slot(hashes[i][1], d) for i in group]
                if len(set(slots)) == len(slots) and all(taken[s] < 0 for s in slots):
                    break
                d += 1
            self.shift[bucket] = d
            for i, s in zip(group, slots, strict=True):
                taken[s] = i
        free = iter([s for s in range(self.n) if taken[s] < 0])
        for bucket, group in enumerate(members):
            if len(group) == 1:  # lone keys take what is left: the slot itself, as a negative number
                s = next(free)
                self.shift[bucket] = -s - 1
                taken[s] = group[0]
        self.order = taken

    @staticmethod
    def hashes(key: bytes) -> tuple[int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return h & MASK, h >> 64

    def slot(self, high: int, d: int) -> int:
        return ((high ^ (d * 0x9E3779B97F4A7C15 & MASK)) * 0xD6E8FEB86659FD93 & MASK) % self.n

    def find(self, key: bytes) -> int:
        """The only slot ``key`` can be in."""
        low, high = self.hashes(key)
        d = self.shift[low % self.buckets]
        return -d - 1 if d < 0 else self.slot(high, d)


class Codec:
    """Ranks of a vocabulary file (base64 token and rank per line) and its split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [(base64.b64decode(token), int(rank)) for token, rank in map(bytes.split, lines)]
        self.pattern = pattern
        self.ranks = dict(pairs)
        self.hash = PerfectHash([token for token, _ in pairs])
        self.slots = [pairs[i] for i in self.hash.order]
        self.tokens = {rank: token for token, rank in pairs}

    def whole(self, piece: bytes) -> int | None:
        token, rank = self.slots[self.hash.find(piece)]
        return rank if token == piece else None

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a pre-token that is no entry."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # end[i]: where the span that starts at i ends; 0: the span is gone
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (left := before[i]) >= 0 and (r := ranks.get(piece[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def ids(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        rank = self.whole(raw)
        return (rank,) if rank is not None else self.merged(raw)


class Known(dict):
    """Ids by pre-token, found when first asked for."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = self[piece] = self.codec.ids(piece)
        return found


def encoder(codec: Codec, text: str, out: str):
    """Batches to the same with ``out``, the ids of every text, ``ROWS`` rows at a time."""

    def run(batches):
        split, known = regex.compile(codec.pattern).findall, Known(codec)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                offsets, flat = [0], array("i")
                for value in batch.column(batch.schema.get_field_index(text)):
                    flat.extend(chain.from_iterable(map(known.__getitem__, split(value.as_py() or ""))))
                    offsets.append(len(flat))
                    if len(known) > CACHE:
                        known.clear()
                yield replaced(batch, out, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.array(flat, np.int32))))

    return run


def decoder(codec: Codec, ids: str, out: str):
    """Batches to the same with ``out``, the bytes that the ids stand for."""

    def run(batches):
        size = max(codec.tokens, default=-1) + 1
        lengths = np.zeros(size, np.int64)
        for rank, token in codec.tokens.items():
            lengths[rank] = len(token)
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        pool = np.frombuffer(b"".join(codec.tokens.get(i, b"") for i in range(size)), np.uint8)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            values = [spelled(v.values.to_numpy(), starts, lengths, pool) if v.is_valid else b"" for v in column]
            yield replaced(batch, out, pa.array(values, pa.binary()))

    return run


def replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    """``batch`` with ``column`` last, in place of one of that name."""
    rest = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in rest), column], [*rest, name])


def _extended(df: DataFrame, *new: T.StructField) -> T.StructType:
    names = {f.name for f in new}
    return T.StructType([f for f in df.schema.fields if f.name not in names] + list(new))


IDS = T.ArrayType(T.IntegerType(), False)


def encode(docs: DataFrame, codec: Codec, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text as ``out`` array<int>, in place of a column of that name."""
    return docs.mapInArrow(encoder(codec, text, out), _extended(docs, T.StructField(out, IDS)))


def decode(encoded: DataFrame, codec: Codec, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes its ids stand for as ``out``; NULL ids stand for none."""
    return encoded.mapInArrow(decoder(codec, ids, out), _extended(encoded, T.StructField(out, T.BinaryType())))


def encode_and_decode(docs: DataFrame, codec: Codec, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``decode`` of ``encode`` in one pass of one worker."""
    there, back = encoder(codec, text, ids), decoder(codec, ids, out)
    fields = _extended(docs, T.StructField(ids, IDS), T.StructField(out, T.BinaryType()))
    return docs.mapInArrow(lambda batches: back(there(batches)), fields)


def spelled(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pool: np.ndarray) -> bytes:
    """The bytes of ``ids`` by one gather from all tokens laid end to end."""
    each = lengths[ids]
    ends = np.cumsum(each)
    shift = np.repeat(starts[ids] - (ends - each), each)
    return pool[shift + np.arange(len(shift))].tobytes()
