"""Ranked lexical search: every item's best documents, by documents grouped on matched-term masks.

A document is read once. It becomes postings for the items' terms alone, in blocks of documents;
a block is one row of the stored index and knows its terms' counts, so corpus counts are a sum
over blocks. A block has a bitmap of documents per term. For an item the bitmaps of its terms
are turned into one mask per document (which terms it holds); equal masks are a group. A group's
bound is the sum of the highest contributions that its terms reach in the block. Groups are
scored by descending bound until the bound falls below the item's last kept score: what is left
cannot enter, not even by a tie. The best of all tasks meet in one ranked window.

Items come in blocks of at most ``pairs`` (item, term) pairs, checked before anything is sent to
executors (a larger item is a block of its own); every block of items is run against all documents.

Defined results: NULL or empty texts have no terms; such items and documents are never returned.
Rows with one item id are one item with the terms of all of them. Document rows are counted and
ranked as they are, repeated ids too; a NULL document id comes behind others of its score. Empty
tables give no rows. Only the named columns are read; other columns may have any name.
"""

from __future__ import annotations

import math
import string
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnpress.llm.common import bounds, stored, texts

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = 8192
"""Documents of a block at most; their places fit 16 bits."""
POSTINGS = 1 << 20
"""A block ends behind the document that fills so many postings."""
PAIRS = 200_000
"""(item, term) pairs sent to executors at once: some 10 MB."""

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: every other ASCII character ends one, only A-Z are lower-cased."""
    return text.translate(_TABLE).split()


def item_terms(items: DataFrame, item: str, text: str, pairs: int) -> tuple[DataFrame, int]:
    """Distinct ``(item, term, block)`` rows, stored, and the number of blocks.

    Items are dealt by a hash; the number of blocks doubles until none holds more than
    ``pairs`` rows or all larger ones hold a single item.
    """
    lowered = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    found = F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)))
    rows = stored(items.select(F.col(item).alias("item"), F.explode(found).alias("term")).distinct(), "item_terms")
    each = stored(rows.groupBy("item").agg(F.count("*").alias("n")), "item_sizes")
    place, blocks = F.xxhash64("item", F.lit(12)), 1
    while each.groupBy(F.pmod(place, F.lit(blocks))).agg(
        F.sum("n").alias("n"), F.count("*").alias("items")
    ).where((F.col("n") > pairs) & (F.col("items") > 1)).limit(1).collect():
        blocks *= 2
    return rows.withColumn("block", F.pmod(place, F.lit(blocks))), blocks


def index(docs: DataFrame, vocabulary: dict[bytes, int], doc: str, text: str) -> DataFrame:
    """One row per block of documents: their ids and sizes, and postings by term.

    ``present`` and ``held`` are the block's terms and how many documents hold each; ``at``
    (16 bits) and ``tf`` (32 bits) are the postings, term by term, documents ascending.
    """
    type_ = dict(docs.dtypes)[doc]

    def block(ids: list[pa.Array], sizes: array, counts: array, which: array, tf: array) -> pa.RecordBatch:
        at = np.repeat(np.arange(len(sizes)), np.frombuffer(counts, np.int32))
        term = np.frombuffer(which, np.int32)
        order = np.argsort(term, kind="stable")
        starts, ends = bounds([term[order]])
        made = {
            "ids": pa.ListArray.from_arrays([0, len(sizes)], pa.concat_arrays(ids)),
            "sizes": pa.array([np.frombuffer(sizes, np.int64).tobytes()]),
            "n_terms": pa.array([sum(sizes)], pa.int64()),
            "n_docs": pa.array([sum(1 for n in sizes if n)], pa.int64()),
            "present": pa.ListArray.from_arrays([0, len(starts)], pa.array(term[order][starts], pa.int32())),
            "held": pa.ListArray.from_arrays([0, len(starts)], pa.array((ends - starts).astype(np.int32))),
            "at": pa.array([at[order].astype(np.uint16).tobytes()]),
            "tf": pa.array([np.frombuffer(tf, np.int32)[order].tobytes()]),
        }
        return pa.RecordBatch.from_arrays(list(made.values()), list(made))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, counts, which, tf = [], array("q"), array("i"), array("i"), array("i")
        for batch in batches:
            taken, column = 0, batch.column(batch.schema.get_field_index(doc))
            for row, value in enumerate(texts(batch, text)):
                words = terms(value)
                seen = [(vocabulary[w], k) for w, k in Counter(words).items() if w in vocabulary]
                sizes.append(len(words))
                counts.append(len(seen))
                which.extend(t for t, _ in seen)
                tf.extend(k for _, k in seen)
                if len(sizes) == DOCS or len(which) >= POSTINGS:
                    yield block([*ids, column.slice(taken, row + 1 - taken)], sizes, counts, which, tf)
                    ids, taken = [], row + 1
                    sizes, counts, which, tf = array("q"), array("i"), array("i"), array("i")
            if taken < batch.num_rows:
                ids.append(column.slice(taken))
        if sizes:
            yield block(ids, sizes, counts, which, tf)

    schema = (
        f"ids array<{type_}>, sizes binary, n_terms bigint, n_docs bigint, present array<int>, held array<int>, at binary, tf binary"
    )
    return docs.select(doc, text).mapInArrow(run, schema)


class Best:
    """The best ``top`` documents of one item so far."""

    def __init__(self, top: int):
        self.top, self.scores, self.ids = top, np.zeros(0, np.int64), np.zeros(0, object)

    @property
    def least(self) -> int:
        """A score below this is out; an equal one may win by its id."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        near = scores >= self.least
        scores, ids = np.append(self.scores, scores[near]), np.append(self.ids, ids[near])
        if len(scores) > self.top:  # what lies below the last kept score needs no full order
            near = scores >= np.partition(scores, -self.top)[-self.top]
            scores, ids = scores[near], ids[near]
        order = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i] is None, ids[i]))[: self.top]
        self.scores, self.ids = scores[order], ids[order]


class Block:
    """A row of the index, ready to be asked for items."""

    def __init__(self, row: dict, mean: tuple[int, int]):
        n_docs, n_terms = mean
        self.ids = np.array(row["ids"], dtype=object)
        self.n = len(self.ids)
        sizes = np.frombuffer(row["sizes"], np.int64)
        at, tf = np.frombuffer(row["at"], np.uint16).astype(np.int64), np.frombuffer(row["tf"], np.int32).astype(np.int64)
        m = 100 - 50 + (50 * sizes * n_docs) // max(n_terms, 1)
        part = (1_000_000_000 * tf) // (1000 * tf + 20 * m[at])
        held = np.array(row["held"], np.int64)
        ends = np.cumsum(held)
        self.place = {t: i for i, t in enumerate(row["present"])}
        self.highest = np.maximum.reduceat(part, ends - held) if len(held) else part
        bits = np.zeros((len(held), self.n), bool)
        bits[np.repeat(np.arange(len(held)), held), at] = True
        self.bitmaps = np.packbits(bits, axis=1)
        # The same postings document by document, to score the documents of a group.
        order = np.argsort(at, kind="stable")
        self.term, self.part = np.repeat(np.arange(len(held)), held)[order], part[order]
        self.count = np.bincount(at, minlength=self.n)
        self.start = np.cumsum(self.count) - self.count

    def groups(self, own: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents ordered by mask, where the groups start and end, and their bounds."""
        bits = np.unpackbits(self.bitmaps[own], axis=1, count=self.n).T
        packed = np.packbits(bits, axis=1)
        masks = np.zeros((self.n, -(-packed.shape[1] // 8) * 8), np.uint8)
        masks[:, : packed.shape[1]] = packed
        columns = list(masks.view(np.uint64).T)
        docs = np.lexsort(columns)
        starts, ends = bounds([c[docs] for c in columns])
        return docs, starts, ends, bits[docs[starts]].astype(np.int64) @ (weights * self.highest[own])

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores; every document holds a term."""
        count = self.count[docs]
        ends = np.cumsum(count)
        at = np.arange(ends[-1]) + np.repeat(self.start[docs] - (ends - count), count)
        return np.add.reduceat(self.part[at] * weights[self.term[at]], ends - count)

    def search(self, wanted: list[int], weight: np.ndarray, best: Best) -> int:
        """Adds this block's documents to ``best``; returns how many were scored."""
        own = np.array([self.place[t] for t in wanted if t in self.place], np.int64)
        if not len(own):
            return 0
        weights = np.zeros(len(self.place), np.int64)
        weights[own] = weight[[t for t in wanted if t in self.place]]
        docs, starts, ends, most = self.groups(own, weights[own])
        order = np.argsort(-most, kind="stable")
        upto = np.cumsum((ends - starts)[order])
        done, scored, size = 0, 0, best.top
        while done < len(order) and most[order[done]] >= best.least:
            last = int(np.searchsorted(upto, scored + size)) + 1
            chosen = order[done:last]
            chosen = chosen[most[chosen] >= best.least]
            members = np.concatenate([docs[starts[g] : ends[g]] for g in chosen.tolist()])
            best.add(self.scores(members, weights), self.ids[members])
            done, scored, size = last, scored + len(members), size * 2
        return scored


def search(
    docs: DataFrame, items: DataFrame, top: int = 50, doc: str = "doc_id", text: str = "text",
    item: str = "item_id", question: str = "text", pairs: int = PAIRS,
) -> DataFrame:
    """``(item, rank, doc, score)``: the ``top`` best documents of every item, scores above 0."""
    types = {"item": dict(items.dtypes)[item], "doc": dict(docs.dtypes)[doc]}
    schema = f"item {types['item']}, doc {types['doc']}, score bigint"
    rows, blocks = item_terms(items, item, question, pairs)
    found = []
    for b in range(blocks):
        wanted: dict = {}
        vocabulary: dict[bytes, int] = {}
        for r in rows.where(F.col("block") == b).select("item", "term").collect():
            wanted.setdefault(r["item"], []).append(vocabulary.setdefault(r["term"].encode(), len(vocabulary)))
        if not wanted:
            continue
        table = stored(index(docs, vocabulary, doc, text), "postings")
        n_docs, n_terms = table.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_docs:
            break
        pair = table.select(F.explode(F.arrays_zip("present", "held")).alias("p"))
        df = dict(pair.groupBy("p.present").agg(F.sum("p.held")).collect())
        weight = np.zeros(len(vocabulary), np.int64)
        for t in range(len(vocabulary)):
            weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1)))
        found.append(table.mapInArrow(_asked(wanted, weight, (n_docs, n_terms), top, schema), schema))
    if not found:
        found = [docs.sparkSession.createDataFrame([], schema)]
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item), "rank", F.col("doc").alias(doc), "score")


def _asked(wanted: dict, weight: np.ndarray, mean: tuple[int, int], top: int, schema: str):
    """The best documents of a task's blocks, item by item."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    kinds = [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: Best(top) for i in wanted}
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block({c: batch.column(c)[row].as_py() for c in ("ids", "sizes", "present", "held", "at", "tf")}, mean)
                for i, own in wanted.items():
                    block.search(own, weight, best[i])
        items = [i for i, b in best.items() for _ in range(len(b.ids))]
        if items:
            columns = [items, [d for b in best.values() for d in b.ids], np.concatenate([b.scores for b in best.values()])]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["item", "doc", "score"])

    return run
