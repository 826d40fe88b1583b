"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through BK-trees.

Fingerprints within ``radius`` bits agree on some ``bands - radius`` of ``bands`` equal
slices. So every distinct fingerprint is dealt, per such choice of slices, to the shard
that its bits there name, and two linked ones meet in a shard for certain. A shard is a
BK-tree: children hang below their parent by their integer distance to it, and a search
follows only edges within the radius of the query's distance. Searches of one shard walk
the tree together, as arrays. A tree goes to the task that searches it and to no other:
all fingerprints have no size bound, so no tree of all is broadcast. A shard above
``cap`` is cut in chunks, and each two chunks meet in a block of their own.

Contract. NULL text is empty: fingerprint zero, linked like any other. Equal fingerprints
are one class and are linked once, whatever their number. Rows with a NULL key cannot be
named and are left out of the links; they come back with a NULL component. Repeated keys
give repeated rows. Empty tables give empty results.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.llm.common import Labels, blocks, bounds, components, map_batches, runs, stored, texts

LEAF = 24
"""Below a node with so few fingerprints its list is compared as a whole."""


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Majority of the bits of the shingles' XXH64 hashes, as a signed 64-bit integer."""
    words = text.lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    h = np.array([digest(join(w), seed) for w in zip(*(words[i:] for i in range(k)), strict=False)], np.uint64)
    set_ = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)]
        set_ += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * set_ > len(h), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(key, fp bigint) of every whole text."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"fp": pa.array([fingerprint(t, shingle) for t in texts(batch, text)], pa.int64())}

    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("fp", T.LongType()), T.StructField("text_hash", T.LongType()),
    ])
    return map_batches(docs.select(key, text, F.xxhash64(text).alias("text_hash")), run, schema)


def tree_links(points: np.ndarray, queries: np.ndarray, radius: int):
    """Pairs of positions (point, query) within ``radius``, by a BK-tree over ``points``.

    The tree is built as it is walked: a node takes the first of its points, deals the rest
    to children by distance, and hands each child the queries whose own distance to the node
    is within the radius of that child's edge. A child no query reaches is never built.
    """
    todo = [(np.arange(len(points)), np.arange(len(queries)))]
    while todo:
        at, ask = todo.pop()
        if len(at) <= LEAF:
            near = np.bitwise_count(points[at][:, None] ^ queries[ask][None, :]) <= radius
            i, j = np.nonzero(near)
            yield at[i], ask[j]
            continue
        top, rest = at[0], at[1:]
        far = np.bitwise_count(queries[ask] ^ points[top])
        hit = ask[far <= radius]
        yield np.full(len(hit), top), hit
        edges = np.bitwise_count(points[rest] ^ points[top])
        for edge in np.unique(edges):
            reach = ask[(far <= edge + radius) & (far + radius >= edge)]
            if len(reach):
                todo.append((rest[edges == edge], reach))


def links(fps: DataFrame, radius: int = 4, bands: int = 6, cap: int = 4096) -> DataFrame:
    """Edges (a, b) between the ids of distinct fingerprints (fp, id) that join all that are linked.

    Every shard returns a spanning forest of its links, not the pairs themselves.
    """
    cuts = [round(64 * i / bands) for i in range(bands + 1)]
    masks = [
        sum(((1 << cuts[b + 1]) - (1 << cuts[b])) for b in chosen) for chosen in combinations(range(bands), bands - radius)
    ]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    shard = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(signed)]
    dealt = blocks(fps.withColumn("shard", F.explode(F.array(*shard))), "shard", "fp", cap)
    keys = ["shard", "_lo", "_hi"]

    def search(batches):
        for table in runs(batches, keys):
            table = table.combine_chunks()
            column = {n: table.column(n).to_numpy() for n in table.column_names}
            fp = column["fp"].view(np.uint64)
            second = column["_second"].astype(bool)
            a, b = [], []
            for start, end in zip(*bounds([column[k] for k in keys]), strict=True):
                if end - start < 2:
                    continue
                ids, part, side = column["id"][start:end], fp[start:end], second[start:end]
                whole = column["_lo"][start] == column["_hi"][start]
                one = np.arange(end - start) if whole else np.flatnonzero(~side)
                two = one if whole else np.flatnonzero(side)
                labels = Labels(end - start)
                for i, j in tree_links(part[one], part[two], radius):
                    labels.join(one[i], two[j])
                moved, to = labels.edges()
                a.append(ids[moved])
                b.append(ids[to])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    packed = dealt.select(*keys, "_second", "fp", "id").repartition(*keys).sortWithinPartitions(*keys)
    return packed.mapInArrow(search, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 4, shingle: int = 4, bands: int = 6) -> DataFrame:
    """(key, fp, component_id): the smallest key reachable over linked fingerprints."""
    return groups(docs, key, text, radius, shingle, bands).select(key, "fp", "component_id")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 4, shingle: int = 4, bands: int = 6) -> DataFrame:
    """(key, fp, component_id, group, text_hash): the smallest key reachable over linked fingerprints.

    Groups are of fingerprints, so rows with one key and different texts are in the group of their
    own text each; ``group`` is its least fingerprint, ``text_hash`` the xxhash64 of the text.
    """
    prints = stored(fingerprints(docs, key, text, shingle), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min(key).alias("least")).where("least IS NOT NULL")
    classes = stored(classes.withColumn("id", F.col("fp")), "classes")
    joined = components(links(classes.select("fp", "id"), radius, bands))
    named = stored(classes.join(joined, "id", "left").select("fp", "least", F.coalesce("component_id", "fp").alias("group")), "groups")
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    known = prints.join(named.join(smallest, "group").select("fp", "component_id", "group"), "fp", "left")
    mine = lambda c: F.when(F.col(key).isNotNull(), F.col(c)).alias(c)
    return known.select(key, "fp", mine("component_id"), mine("group"), "text_hash")
