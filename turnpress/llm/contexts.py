"""Language-model scores by context-tree weighting over bytes.

A text is its lower-cased words with one space between them and an end mark. Every byte is
eight binary decisions; each decision, after the bits before it, has a tree of contexts:
the last 0, 1, ... ``DEPTH`` bytes. A node's Krichevsky-Trofimov probability of its counts
Pe and the product of its children's weighted probabilities mix half and half,

    Pw = 1/2 Pe + 1/2 prod Pw(child),   Pw = Pe at full depth,

so Pe / 2 Pw is a node's own share of the mixture and the prediction of a bit mixes the
estimates (ones + 1/2) / (all + 1) of every depth with these shares. Counts come from the
training documents; contexts that only other documents have are nodes without counts.

Counting is exact and distributed. Documents come in blocks of rows. A block sends the
distinct byte runs and words it holds, with their training counts, to the partition that
owns them: runs by the last two bytes of context, words by leading bits of a hash. The
owner adds up all blocks, and answers each block with what it asked for. Requests are added
up for 64 blocks at a time, a part, and distinct codes only go on from there; answers come back
the same way, to the parts and from there to their blocks. Groups are read as streams. So a model
of any size reaches the texts in parts as large as their own vocabulary, and nothing is broadcast
but the upper two levels of the trees, 256 * 255 nodes. Codes travel as differences, and all
numbers with their bytes of equal weight side by side, compressed; texts as compressed pieces.

Contract. NULL and empty texts are the end mark alone. Documents are scored each on its
own, repeated rows equally; rows with a NULL id take part like any other. With no training
documents every bit has probability 1/2. Empty tables give empty results.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.llm.common import bounds, stored, texts

DEPTH = 6
"""Bytes of context, about a word with its space; the code of a run with its last byte fits 64 bits up to 6."""
END = b"\n"
WORD_BITS = 9
"""Leading bits of a word's hash that name its owner."""
RUN, WORD = 0, 1
BLOCKS = 64
"""Blocks whose requests to one owner are added up, and answered, together."""
PIECE = 1 << 20
"""Bytes of text that are looked up at a time, which bounds memory and changes no score."""
FOLD = 4 * PIECE
"""Bytes of text whose runs are made distinct at a time, and most bytes of cells in a batch."""

HALF = np.log(0.5)
ZSTD = {level: pa.Codec("zstd", compression_level=level) for level in (1, 3)}


def body(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


def squeezed(data: bytes, level: int) -> bytes:
    """Compressed bytes after their own length."""
    return len(data).to_bytes(8, "little") + ZSTD[level].compress(data, asbytes=True)


def restored(cell: bytes) -> bytes:
    size = int.from_bytes(cell[:8], "little")
    return ZSTD[1].decompress(cell[8:], size, asbytes=True) if size else b""


def packed(values: np.ndarray) -> bytes:
    """Numbers of eight bytes each, their bytes of equal weight side by side, compressed."""
    return squeezed(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(cell: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(restored(cell), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(kind).ravel()


def packed_codes(codes: np.ndarray) -> bytes:
    """Ascending codes, packed as differences."""
    steps = codes.copy()
    steps[1:] -= codes[:-1]
    return packed(steps)


def unpacked_codes(cell: bytes) -> np.ndarray:
    return np.cumsum(unpacked(cell, np.uint64), dtype=np.uint64)


def batched(rows, names: list[str], kinds: list[pa.DataType]):
    """Record batches of rows, at most 2,000 and about ``FOLD`` bytes of cells in one."""

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(c) for c in row if isinstance(c, bytes))
        if len(held) == 2000 or size > FOLD:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def run_codes(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per byte of all texts the code (last byte, byte before it, ..., the byte itself), and the bytes per text."""
    lead = END * DEPTH
    flat = np.frombuffer(b"".join(lead + b for b in bodies), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    n = len(flat) - DEPTH
    code = flat[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        code |= flat[DEPTH - back : DEPTH - back + n] << (8 * (DEPTH + 1 - back))
    inside = np.ones(n, bool)
    ends = np.cumsum(sizes + DEPTH)[:-1]
    for i in range(DEPTH):  # places where a text's lead itself would be the byte
        inside[ends - DEPTH + i] = False
    return code[inside], sizes


def word_codes(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the distinct words of all texts, the end mark among them; the place there of every token, and the tokens per text."""
    words = pc.split_pattern(pa.array([b[:-1] + b" " + END if len(b) > 1 else b for b in bodies], pa.binary()), " ")
    found = words.flatten().dictionary_encode()
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, found.dictionary.to_numpy(zero_copy_only=False)), np.uint64, len(found.dictionary))
    return codes, found.indices.to_numpy(), words.value_lengths().to_numpy().astype(np.int64)


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and their counts summed."""
    flat, many = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    starts, _ = bounds([flat])
    return flat[starts], np.add.reduceat(many[order], starts) if len(starts) else many


class Block:
    """Distinct codes of a block of documents, and their training counts."""

    def __init__(self):
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {RUN: [], WORD: []}
        self.bodies: dict[bool, list[bytes]] = {True: [], False: []}
        self.size = 0

    def add(self, text: bytes, train: bool) -> None:
        b = body(text.lower().split())
        self.bodies[train].append(b)
        self.size += len(b)
        if self.size > FOLD:
            self.fold()

    def fold(self) -> None:
        for train, bodies in self.bodies.items():
            if bodies:
                runs, n = np.unique(run_codes(bodies)[0], return_counts=True)
                words, place, _ = word_codes(bodies)
                for kind, codes, many in ((RUN, runs, n), (WORD, words, np.bincount(place, minlength=len(words)))):
                    self.held[kind].append((codes, many if train else np.zeros_like(many)))
        self.bodies, self.size = {True: [], False: []}, 0
        for kind, held in self.held.items():
            if len(held) > 3 and sum(len(codes) for codes, _ in held[1:]) > len(held[0][0]):  # each code is merged a few times
                self.held[kind] = [merged(*map(list, zip(*held, strict=True)))]

    def asked(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        self.fold()
        if not self.held[kind]:
            return np.zeros(0, np.int64 if kind == RUN else np.uint64), np.zeros(0, np.int64)
        return merged(*map(list, zip(*self.held[kind], strict=True)))

    def owned(self, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, counts and owners, in order of the codes."""
        codes, counts = self.asked(kind)
        owner = codes >> (8 * (DEPTH - 1)) if kind == RUN else codes >> np.uint64(64 - WORD_BITS)
        return codes, counts, owner.astype(np.int64)


def requests(docs: DataFrame) -> DataFrame:
    """(kind, owner, block, codes, counts) of docs (text, block, train)."""

    def rows(block: int, held: Block):
        for kind in (RUN, WORD):
            codes, counts, owner = held.owned(kind)
            for start, end in zip(*bounds([owner]), strict=True):
                yield kind, int(owner[start]), block, packed_codes(codes[start:end]), packed(counts[start:end])

    def found(batches):
        held, current = Block(), None
        for batch in batches:
            blocks, train = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for text, block, learn in zip(texts(batch), blocks, train, strict=True):
                if block != current:
                    if current is not None:
                        yield from rows(current, held)
                    held, current = Block(), block
                held.add(text, learn)
        if current is not None:
            yield from rows(current, held)

    def run(batches):
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        yield from batched(found(batches), ["kind", "owner", "block", "codes", "counts"], kinds)

    return docs.select("text", "block", "train").mapInArrow(run, "kind int, owner int, block bigint, codes binary, counts binary")


def groups(batches, keys: list[str]):
    """(key, iterator over the rows of a group) for batches sorted by ``keys``; no group is held."""
    rows = (r for batch in batches for r in batch.to_pylist())
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def summed(asked: DataFrame, keys: list[str]) -> DataFrame:
    """(kind, keys, codes, counts): one row per group with its distinct codes; memory holds those and little more."""

    def found(batches):
        for key, rows in groups(batches, ["kind", *keys]):
            codes, counts, size = [], [], 0
            for r in rows:
                codes.append(unpacked_codes(r["codes"]))
                counts.append(unpacked(r["counts"], np.int64))
                size += len(codes[-1])
                if size > PIECE and len(codes) > 8:
                    one, many = merged(codes, counts)
                    codes, counts, size = [one], [many], 0
            one, many = merged(codes, counts)
            yield *key, packed_codes(one), packed(many)

    def run(batches):
        kinds = [pa.int32()] * (1 + len(keys)) + [pa.binary(), pa.binary()]
        yield from batched(found(batches), names, kinds)

    names = ["kind", *keys, "codes", "counts"]
    dealt = asked.select(*names).repartition("kind", *keys).sortWithinPartitions("kind", *keys)
    return dealt.mapInArrow(run, ", ".join(f"{k} int" for k in ["kind", *keys]) + ", codes binary, counts binary")


def valued(totals: DataFrame, fn) -> DataFrame:
    """(kind, owner, codes, reply) with ``reply = fn(owner, codes, counts)`` for every code."""

    def run(batches):
        found = (
            (r["kind"], r["owner"], r["codes"], packed(fn(r["owner"], unpacked_codes(r["codes"]).view(np.int64), unpacked(r["counts"], np.int64))))
            for batch in batches
            for r in batch.to_pylist()
        )
        yield from batched(found, ["kind", "owner", "codes", "reply"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()])

    return totals.select("kind", "owner", "codes", "counts").mapInArrow(run, "kind int, owner int, codes binary, reply binary")


def answered(asked: DataFrame, replies: DataFrame, keys: list[str], to: str) -> DataFrame:
    """(kind, owner, ``to``, codes, reply): to every ``to`` the distinct codes it asked for and their values.

    ``replies`` has one row per group of ``keys`` with all the codes that the group asks for.
    """

    def found(batches):
        for key, rows in groups(batches, keys):
            first = next(rows)
            known, values = unpacked_codes(first["codes"]), unpacked(first["reply"], np.uint64)
            for one, pieces in groupby(rows, key=lambda r: r["to"]):
                cells = [r["codes"] for r in pieces]
                codes = [unpacked_codes(c) for c in cells]
                wanted = codes[0] if len(codes) == 1 else np.unique(np.concatenate(codes))
                cell = cells[0] if len(codes) == 1 else packed_codes(wanted)
                yield key[0], key[1], one, cell, packed(values[np.searchsorted(known, wanted)])

    def run(batches):
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        yield from batched(found(batches), ["kind", "owner", "to", "codes", "reply"], kinds)

    lead = replies.select(*keys, F.lit(None).cast("long").alias("to"), "codes", "reply")
    rows = lead.unionByName(asked.select(*keys, F.col(to).cast("long").alias("to"), "codes", F.lit(None).cast("binary").alias("reply")))
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("to").asc_nulls_first())
    sent = dealt.mapInArrow(run, "kind int, owner int, to bigint, codes binary, reply binary")
    return sent.select("kind", "owner", F.col("to").cast(asked.schema[to].dataType).alias(to), "codes", "reply")


def pieces(docs: DataFrame) -> DataFrame:
    """(block, keys, bodies) of docs (block, key, text): keys of a few rows, and their texts as they are scored, compressed."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            keys, blocks = batch.column(1), batch.column(0).to_numpy()
            for start, end in zip(*bounds([blocks]), strict=True):
                held, size = [], 0
                for i, text in enumerate(texts(batch.slice(start, end - start)), start + 1):
                    held.append(body(text.lower().split()))
                    size += len(held[-1])
                    if size > PIECE or i == end:
                        of = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), keys.slice(i - len(held), len(held)))
                        cell = squeezed(b"".join(held), 3)
                        yield pa.RecordBatch.from_arrays([pa.array(blocks[start : start + 1]), of, pa.array([cell], pa.binary())], ["block", "keys", "bodies"])
                        held, size = [], 0

    return docs.select("block", "key", "text").mapInArrow(run, f"block bigint, keys array<{kind}>, bodies binary")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of x >= 0.5, by Stirling's series eight places up."""
    low = np.ones_like(x)
    for i in range(8):
        low *= x + i
    y = x + 8
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(low)


SMALL = {plus: log_gamma(np.arange(4096.0) + plus) for plus in (0.5, 1.0)}


def log_gamma_of(n: np.ndarray, plus: float) -> np.ndarray:
    """log_gamma(n + plus) of counts n, the small ones looked up."""
    small = SMALL[plus]
    out = small[np.minimum(n, len(small) - 1).astype(np.int64)]
    large = np.nonzero(n >= len(small))
    out[large] = log_gamma(n[large] + plus)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log Pe of a zeros and b ones."""
    return log_gamma_of(a, 0.5) + log_gamma_of(b, 0.5) - log_gamma_of(a + b, 1.0) - np.log(np.pi)


def weighted(pe: np.ndarray, below: np.ndarray) -> np.ndarray:
    """log Pw from log Pe and the sum of log Pw of the children."""
    return np.logaddexp(HALF + pe, HALF + below)


class Level:
    """The nodes of one depth for one bit place: keys, counts, weighted probability, place of the parent."""

    def __init__(self, key: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None):
        self.key, self.a, self.b = key, a, b
        self.pe = estimate(a, b)
        self.pw = self.pe if below is None else weighted(self.pe, below)
        self.up = np.zeros(0, np.int64)

    def parent(self, key: np.ndarray) -> Level:
        keys, self.up = np.unique(key, return_inverse=True)
        add = lambda v: np.bincount(self.up, v, len(keys))
        return Level(keys, add(self.a), add(self.b), add(self.pw))

    def share(self) -> np.ndarray:
        return np.exp(HALF + self.pe - self.pw)

    def ones(self) -> np.ndarray:
        return (self.b + 0.5) / (self.a + self.b + 1)


def tree(codes: np.ndarray, counts: np.ndarray, place: int) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Levels from full depth up to two bytes of context for one bit place; the codes' leaves and bits."""
    byte, context = codes & 255, codes >> 8
    prefix, bit = byte >> (8 - place), (byte >> (7 - place)) & 1
    flat = context << 8 | prefix  # ascends with the codes
    starts, ends = bounds([flat])
    keys, leaf = flat[starts], np.repeat(np.arange(len(starts)), ends - starts)
    add = lambda v: np.bincount(leaf, v, len(keys))
    levels = [Level(keys, add(counts * (1 - bit)), add(counts * bit), None)]
    for _ in range(DEPTH - 2):
        last = levels[-1].key
        levels.append(levels[-1].parent((last >> 16) << 8 | last & 255))
    return levels, leaf, bit


def upper_sums(totals: DataFrame) -> DataFrame:
    """(last byte, node, zeros, ones, sum of log Pw) of the nodes with two bytes of context."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                codes, counts = unpacked_codes(r["codes"]).view(np.int64), unpacked(r["counts"], np.int64)
                for place in range(8):
                    top = tree(codes, counts, place)[0][-1]
                    last = np.full(len(top.key), r["owner"] >> 8, np.int32)
                    node = ((1 << place) | (top.key & 255)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (last, node, top.a, top.b, top.pw)], ["last", "node", "a", "b", "pw"])

    found = totals.mapInArrow(run, "last int, node int, a double, b double, pw double").groupBy("last", "node")
    return found.agg(*(F.sum(c).alias(c) for c in ("a", "b", "pw")))


def upper_levels(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Mixture so far and weight left to deeper contexts, per (last byte, node), from the upper two levels."""
    a, b, below = (np.zeros((256, 256)) for _ in range(3))
    for r in rows:
        a[r["last"], r["node"]], b[r["last"], r["node"]], below[r["last"], r["node"]] = r["a"], r["b"], r["pw"]
    one = estimate(a, b)
    pw = weighted(one, below)
    root = estimate(a.sum(0), b.sum(0))
    share0 = np.exp(HALF + root - weighted(root, pw.sum(0)))
    share1 = (1 - share0) * np.exp(HALF + one - pw)
    mixture = share0 * (b.sum(0) + 0.5) / (a.sum(0) + b.sum(0) + 1) + share1 * (b + 0.5) / (a + b + 1)
    return mixture, (1 - share0) - share1


def run_scores(mixture: np.ndarray, left: np.ndarray):
    """log10 of every byte's probability in its context, given the upper two levels."""

    def values(owner: int, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        score = np.zeros(len(codes))
        for place in range(8):
            levels, leaf, bit = tree(codes, counts, place)
            node = (1 << place) | (levels[-1].key & 255)
            mixed, rest = mixture[owner >> 8, node], left[owner >> 8, node]
            for above, below in zip(levels[:0:-1], levels[-2::-1], strict=True):
                share = rest * above.share()
                mixed, rest = (mixed + share * above.ones())[below.up], (rest - share)[below.up]
            one = (mixed + rest * levels[0].ones())[leaf]
            score += np.log10(np.where(bit == 1, one, 1 - one))
        return score

    return values


def training_size(of_words: DataFrame) -> tuple[int, int]:
    """Training tokens, and how many of them are distinct."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                n = unpacked(r["counts"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int(n.sum())]), pa.array([int((n > 0).sum())])], ["n", "v"])

    whole = of_words.mapInArrow(run, "n bigint, v bigint").agg(F.sum("n"), F.sum("v")).first()
    return int(whole[0] or 0), int(whole[1] or 0)


def score(docs: DataFrame, train: Column, block: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, n_bytes) of every whole text.

    ``train`` says which documents are learned from. ``block`` numbers blocks of documents,
    best a few thousand rows that stand together in a file. ``base_score`` is the smoothed
    unigram score of the same tokens; ``score`` is the trees' log10 probability.
    """
    kind = docs.schema[key].dataType.simpleString()
    block = F.coalesce(block.cast("long"), F.lit(0))
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), block.alias("block"), F.coalesce(train, F.lit(False)).alias("train"))
    blocks_ = docs.select("block").distinct().count()
    parts = -(-max(1, blocks_) // BLOCKS)
    asked = stored(requests(docs).withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")), "requests")
    sums = stored(summed(asked, ["owner", "part"]), "sums")
    totals = stored(summed(sums, ["owner"]), "totals") if parts > 1 else sums
    of_words, of_runs = totals.where(F.col("kind") == WORD), totals.where(F.col("kind") == RUN)
    counts = valued(of_words, lambda owner, codes, counts: counts)
    tokens, distinct = training_size(of_words)
    upper = upper_sums(of_runs).collect()  # 256 * 255 rows at most
    replies = stored(counts.unionByName(valued(of_runs, run_scores(*upper_levels(upper)))), "replies")
    floor = np.log10(tokens + 0.1 * (distinct + 1))
    names = ["key", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]

    def looked_up(codes: np.ndarray, known: np.ndarray, values: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        if not np.array_equal(known[at], codes):
            raise ValueError("a block was answered for other texts than it has")
        return values[at]

    def found(rows):
        """The scores of a block's pieces, which follow its answers."""
        answers: dict[int, list] = {RUN: [], WORD: []}
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for r in rows:
            if (bodies := r["bodies"].as_py()) is None:
                answers[r["kind"].as_py()].append((r["codes"].as_py(), r["reply"].as_py()))
                continue
            if not known:
                for k, value in ((RUN, np.float64), (WORD, np.int64)):
                    known[k] = np.concatenate([unpacked_codes(c) for c, _ in answers[k]]), np.concatenate([unpacked(v, value) for _, v in answers[k]])
                answers.clear()
            given = [line + END for line in restored(bodies).split(END)[:-1]]
            words, place, sizes = word_codes(given)
            c = looked_up(words, *known[WORD])[place]
            heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            n_known = np.add.reduceat((c > 0).astype(np.int64), heads)
            base = np.add.reduceat(np.log10(c + 0.1), heads) - sizes * floor
            codes, length = run_codes(given)
            heads = np.concatenate([[0], np.cumsum(length)[:-1]])
            some, where = np.unique(codes, return_inverse=True)
            scores = np.add.reduceat(looked_up(some.view(np.uint64), *known[RUN])[where], heads)
            made = (sizes, n_known, np.full(len(given), tokens, np.int64), base, scores, length)
            yield pa.RecordBatch.from_arrays([r["keys"].values, *map(pa.array, made)], names)

    def run(batches):
        rows = ({n: batch.column(n)[i] for n in batch.schema.names} for batch in batches for i in range(batch.num_rows))
        for _, of_block in groupby(rows, key=lambda r: r["block"].as_py()):
            yield from found(of_block)

    if parts > 1:  # an owner answers the parts, and these their blocks
        replies = answered(sums, replies, ["kind", "owner"], "part")
    sent = answered(asked, replies, ["kind", "owner", "part"] if parts > 1 else ["kind", "owner"], "block")
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    sent = sent.select("block", "kind", "owner", "codes", "reply", nothing(f"array<{kind}>", "keys"), nothing("binary", "bodies"))
    given = pieces(docs).select("block", nothing("int", "kind"), nothing("int", "owner"), nothing("binary", "codes"), nothing("binary", "reply"), "keys", "bodies")
    dealt = sent.unionByName(given).repartition("block").sortWithinPartitions("block", F.col("kind").asc_nulls_last(), "owner")
    schema = f"key {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_bytes bigint"
    return dealt.mapInArrow(run, schema).withColumnRenamed("key", key)
