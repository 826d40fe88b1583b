"""Merkle manifest of a table: one root digest, and a proof for every row, by time-forward processing.

A row's leaf is the SHA-256 of its fields, each as UTF-8 byte count, ``:`` and value, or
``-`` if NULL. Rows with the same ``group`` value form a tree of fan-out 16; the roots of these
trees, in order of their group (NULL first, then bytewise), form the tree above them.

Time-forward processing labels every node by the last leaf below it and its level, so a
child has a smaller label than its parent, and hands digests forward in label order by an
external priority queue. Here a slice of time is a block of 4,096 sibling leaves (three levels)
and is swept by one task with a heap that holds at most 16 messages a level. Messages for
later slices are the external part: they go through a written table and Spark's sorting shuffle,
which hands them to the next slice in label order. A tree over n rows takes log(n) / 12 bits of
such slices. The way back runs the same slices against label order: a node gets the proof of
all above it, puts its siblings in front and hands that to its children.

Defined results: rows are ordered by key (NULL first), then leaf; equal rows are leaves of their
own with proofs of their own. A NULL field differs from an empty one. An empty table has no
root and gives no rows. Only the named columns are read; other columns may have any name.
No task holds more than a block and its messages; the driver gets one row per partition of
the sorted table and one per round.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.llm.common import bounds, runs, stored

FANOUT = 16
LEVELS = 3
BLOCK = FANOUT**LEVELS
"""Leaves of one slice of time."""

Proof = list[tuple[bytes, bytes]]
"""Digests left and right of the path, level by level from the leaf to the root."""


def field(column: Column, type_: str = "string") -> Column:
    """A value with its size in front, so that no two lists of fields give one text."""
    text = column.cast(type_)
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256))


def hashed(parts: Iterable[bytes]) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


def folded(leaf: bytes, proof: Proof) -> bytes:
    """The root that a leaf (hex) and a proof lead to."""
    for left, right in proof:
        leaf = hashed((left, leaf, right))
    return leaf


def written(proof: Proof) -> bytes:
    return b";".join(left + b"|" + right for left, right in proof)


def parsed(text: bytes) -> Proof:
    return [tuple(level.split(b"|")) for level in text.split(b";")] if text else []


def numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Adds ``tree`` (number of the group, groups in text order) and ``pos`` (row of the group).

    Rows are sorted over ranges of (group, order), so a group with a third of all rows is in many
    ranges. Rows and groups are counted inside their range; what a range lacks is the number of
    groups and, for its first group, of rows before it: one row per range, summed up on the driver.
    """
    keys = [F.col(group), *order]
    added = [T.StructField("part", T.IntegerType()), T.StructField("_tree", T.LongType()), T.StructField("_pos", T.LongType())]
    schema = T.StructType([*rows.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, tree, seen = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(batch.schema.get_field_index(group))
            starts, ends = bounds([np.asarray(names.to_pylist(), dtype=object)])
            if names[0].as_py() != last and last is not None:
                tree, seen = tree + 1, 0
            sizes = ends - starts
            pos = np.arange(batch.num_rows) - np.repeat(starts, sizes)
            pos[: sizes[0]] += seen
            trees = tree + np.repeat(np.arange(len(sizes)), sizes)
            made = [np.full(batch.num_rows, part, np.int32), trees, pos]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, made)], schema.fieldNames())
            seen = int(sizes[-1]) + (seen if len(sizes) == 1 else 0)
            tree, last = int(trees[-1]), names[-1].as_py()

    cut = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema), "ordered")
    ranges = cut.groupBy("part").agg(
        F.min(F.struct("_tree", group)).alias("first"),
        F.max(F.struct("_tree", "_pos", group)).alias("last"),
    ).collect()
    shifts, name, tree, ahead = [], None, -1, 0
    for r in sorted(ranges):
        goes_on = r["first"][group] == name
        base, before = (tree, ahead) if goes_on else (tree + 1, 0)
        shifts.append((r["part"], base, before))
        name, tree = r["last"][group], base + r["last"]["_tree"]
        ahead = r["last"]["_pos"] + 1 + (before if r["last"]["_tree"] == 0 else 0)
    offsets = cut.sparkSession.createDataFrame(shifts, "part int, base bigint, before bigint")
    first = F.when(F.col("_tree") == 0, F.col("before")).otherwise(0)
    # One row per range of the sort, so the broadcast is bounded by the number of partitions.
    return cut.join(F.broadcast(offsets), "part").withColumns(
        {"tree": F.col("base") + F.col("_tree"), "pos": F.col("_pos") + first}
    ).drop("part", "base", "before", "_tree", "_pos")


def sweep(leaves: list[bytes], alone: bool) -> tuple[list[tuple[int, list[bytes]]], bytes]:
    """Nodes of a block in label order, as (label, digests of its children), and the block's top.

    A block that is not alone in its tree is raised by all levels, short runs too; one that is
    alone ends at its first single node. The label is the last leaf below a node and its level.
    """
    n = len(leaves)
    high = LEVELS
    if alone:
        high = 0
        while FANOUT**high < n:
            high += 1

    def above(leaf: int, level: int) -> int:
        """Label of the node ``level`` levels above a leaf."""
        size = FANOUT**level
        return (min((leaf // size + 1) * size, n) - 1) * (LEVELS + 1) + level

    queue: list[tuple[int, int, bytes]] = []
    nodes = []
    top = leaves[-1]
    for leaf, value in enumerate(leaves):
        if not high:
            break
        heapq.heappush(queue, (above(leaf, 1), leaf, value))
        while queue and queue[0][0] // (LEVELS + 1) == leaf:
            label, _, child = heapq.heappop(queue)
            children = [child]
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            nodes.append((label, children))
            top = hashed(children)
            level = label % (LEVELS + 1)
            if level < high:
                heapq.heappush(queue, (above(leaf, level + 1), leaf, top))
    return nodes, top


def sweep_back(leaves: list[bytes], nodes: list[tuple[int, list[bytes]]], proof: Proof) -> list[Proof]:
    """Proofs of the leaves of a block, whose top has ``proof``: nodes against label order.

    A node's children are the nodes that come next at the level below, so labels from the end
    hand every child its proof before the child is looked at.
    """
    if not nodes:
        return [proof] * len(leaves)
    out: list[Proof] = [proof] * len(leaves)
    queue: list[tuple[int, Proof]] = [(-nodes[-1][0], proof)]
    for label, children in reversed(nodes):
        key, above = heapq.heappop(queue)
        assert key == -label
        last, level = divmod(label, LEVELS + 1)
        size = FANOUT ** (level - 1)
        first = last // (size * FANOUT) * size * FANOUT
        for i in range(len(children)):
            mine = [(b"".join(children[:i]), b"".join(children[i + 1 :])), *above]
            if level == 1:
                out[first + i] = mine
            else:
                end = min(first + (i + 1) * size, len(leaves)) - 1
                heapq.heappush(queue, (-(end * (LEVELS + 1) + level - 1), mine))
    return out


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).cast("bigint")


def _hex(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return [v.hex().encode() for v in column.to_pylist()]


def raised(nodes: DataFrame) -> DataFrame:
    """``(tree, pos, digest)`` of the tops of all blocks; ``pos`` is the block's place in its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["tree", "block"]):
            tree, block = (table.column(c).to_numpy() for c in ("tree", "block"))
            values = _hex(table.column("digest"))
            starts, ends = bounds([tree, block])
            tops = [
                bytes.fromhex(sweep(values[a:b], block[a] == 0 and b - a < BLOCK)[1].decode()) for a, b in zip(starts, ends)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree[starts]), pa.array(block[starts]), pa.array(tops, pa.binary())], ["tree", "pos", "digest"]
            )

    cut = nodes.select("tree", "pos", "digest", _block().alias("block"))
    ordered = cut.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    return ordered.mapInArrow(run, "tree bigint, pos bigint, digest binary")


def delivered(nodes: DataFrame, messages: DataFrame, schema: str, made: Callable[..., dict]) -> DataFrame:
    """What ``made(table of members, their digests, their proofs, the block's message)`` gives for every block.

    The message of a block, ``(tree, pos, proof, subroot, root)``, is sorted in front of its members.
    """
    names = [f.name for f in messages.select("proof", "subroot", "root").schema]
    own = [c for c in nodes.columns if c not in ("tree", "pos")]
    members = nodes.withColumns({"block": _block(), **{c: F.lit(None).cast("binary") for c in names}})
    heads = messages.select(
        "tree", F.lit(-1).cast("bigint").alias("pos"), *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in own],
        F.col("pos").alias("block"), *names,
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["tree", "block"]):
            starts, ends = bounds([table.column(c).to_numpy() for c in ("tree", "block")])
            done = []
            for a, b in zip(starts.tolist(), ends.tolist()):
                head = {c: table.column(c)[a].as_py() for c in ("pos", "block", *names)}
                if head["pos"] != -1:
                    raise ValueError("a block without a message")
                rows = table.slice(a + 1, b - a - 1)
                values = _hex(rows.column("digest"))
                nodes_of, _ = sweep(values, head["block"] == 0 and len(values) < BLOCK)
                proofs = sweep_back(values, nodes_of, parsed(head["proof"]))
                out = made(rows, values, proofs, head)
                done.append(pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in out.values()], list(out)))
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()

    both = heads.unionByName(members.select(heads.columns))
    return both.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(run, schema)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _handed_on(rows: pa.Table, values: list[bytes], proofs: list[Proof], head: dict) -> dict:
    """Messages for the blocks below; a subroot is known from its own tree down."""
    return {
        "tree": _one(rows.column("tree")), "pos": _one(rows.column("pos")),
        "proof": pa.array([written(p) for p in proofs], pa.binary()),
        "subroot": pa.array([head["subroot"]] * len(values), pa.binary()),
        "root": pa.array([head["root"]] * len(values), pa.binary()),
    }


def _to_trees(rows: pa.Table, values: list[bytes], proofs: list[Proof], head: dict) -> dict:
    """Messages above the trees: what a tree's root receives has that root as subroot."""
    return {**_handed_on(rows, values, proofs, head), "subroot": _one(rows.column("digest"))}


_MESSAGE = "tree bigint, pos bigint, proof binary, subroot binary, root binary"


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "source",
    key: str = "doc_id", claimed: dict[str, Column] | None = None, claims: Column | None = None, with_proof: bool = False,
) -> DataFrame:
    """``(key, leaf, subroot, root, proof_sha256, folded_root)`` of every row; ``proof`` too with ``with_proof``.

    ``claimed`` replaces columns of the rows that satisfy ``claims``: their ``folded_root`` starts
    from the leaf of the replaced values and takes the siblings of the manifest, as a reader would who
    holds a changed copy. ``proof`` is text: levels from the leaf up, parted by ``;``, each with
    the digests left and right of the path, parted by ``|``.
    """
    fields = {c: F.col(c) for c in columns}
    told = F.lit(None).cast("binary")
    if claimed:
        told = F.when(F.lit(True) if claims is None else claims, digest([*{**fields, **claimed}.values()]))
    name = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("n"))
    leaves = stored(
        docs.select(name.alias("name"), F.col(key).alias("key"), digest([*fields.values()]).alias("digest"), told.alias("told")),
        "leaves",
    )
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    rows = numbered(
        leaves.select("*", place.alias("place")), "name", [F.col("key").asc_nulls_first(), F.col("digest"), F.col("place")]
    ).drop("place", "name")

    slices, now = [rows], stored(raised(rows), "tops")
    while (far := now.agg(F.max("pos")).first()[0]):
        slices.append(now)
        now = stored(raised(now), "tops")
    types = dict(docs.select(F.col(key).alias("key")).dtypes)
    schema = f"key {types['key']}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    if with_proof:
        schema += ", proof string"
    if far is None:
        return docs.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)

    over, now = [], now.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "digest")
    while now.agg(F.count("*")).first()[0] > 1:
        over.append(now)
        now = stored(raised(now), "roots")
    empty = F.lit(b"")
    message = now.select("tree", "pos", empty.alias("proof"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(over):
        message = stored(delivered(nodes, message, _MESSAGE, _to_trees), "proofs")
    message = message.select(F.col("pos").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "proof", "subroot", "root")
    for nodes in reversed(slices[1:]):
        message = stored(delivered(nodes, message, _MESSAGE, _handed_on), "proofs")

    def judged(rows: pa.Table, values: list[bytes], proofs: list[Proof], head: dict) -> dict:
        told = rows.column("told").to_pylist()
        starts = [leaf if t is None else t.hex().encode() for leaf, t in zip(values, told)]
        n = len(values)
        out = {
            "key": _one(rows.column("key")),
            "leaf": [v.decode() for v in values],
            "subroot": [head["subroot"].hex()] * n,
            "root": [head["root"].hex()] * n,
            "proof_sha256": [hashed(x for level in p for x in level).decode() for p in proofs],
            "folded_root": [folded(leaf, p).decode() for leaf, p in zip(starts, proofs)],
        }
        if with_proof:
            out["proof"] = [written(p).decode() for p in proofs]
        return out

    return delivered(rows, message, schema, judged).withColumnRenamed("key", key)
