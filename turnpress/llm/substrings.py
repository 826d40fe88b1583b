"""Repeated passages: paragraph MinHash banding, and equal stretches inside paragraphs.

Paragraphs are lines of at least ``shortest`` words, and blocks: consecutive shorter lines,
as hard-wrapped text has them, that are ``shortest`` words together. Each one gets MinHash
values over its five-word shingles. Two of Jaccard similarity s agree on a band of ``ROWS`` values with
chance s**ROWS, so with ``BANDS`` bands a pair at 0.8 is missed with chance
(1 - 0.8**2)**6 = 0.002. Distinct paragraphs that collide in a band are compared by their
whole shingle sets, and those at ``similar`` or more are linked; copies are one class
before that. Components of the links are the clusters, and all but the first paragraph of
a cluster, by document and place, go. Shorter lines have too few shingles for a similarity
and are linked where they are equal, from one shingle (five words) on.

A passage also repeats inside otherwise different paragraphs. Every text is therefore cut
at places that depend on the nearby words alone (the least hash of a word pair in each
window of ``WINDOW`` pairs), so a shared passage is cut alike wherever it stands: between
two cuts are at most WINDOW words, and of any passage of more than 50 words at least 9 lie
in whole shared stretches. Stretches found before in another place go where an unbroken
run of them has ``RUN`` words; the run is then extended, word by word, to where its text and
the one it repeats stop agreeing.

Contract. NULL and empty texts have no passages. Letters A-Z are compared in lower case,
white space as one space. Offsets are bytes of the UTF-8 text. Rows with a NULL key are
left out of the comparison and never changed; equal rows are one document, so a repeated row
is no repetition of itself, and rows with one key and different texts are different
documents. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnpress.llm.common import Labels, blocks, bounds, components, map_batches, runs, stored, texts
from turnpress.operators.permutation import unused

BANDS, ROWS, SHINGLE = 6, 2, 5
WINDOW, RUN, WIDE, LONG = 20, 9, 6, 50
"""Word pairs per window; least words of a run; least words of the longest stretch in a run of up to LONG words."""
TOGETHER = 1 << 17
"""Words, of several texts or of one, whose stretches are found together."""
REACH = WINDOW + 1
"""Most words by which a match goes on beyond its whole shared stretches on one side."""

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ODD = np.uint64(0x9E3779B97F4A7C15)
TURN = np.random.default_rng(20).integers(1, 1 << 63, BANDS * ROWS, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the words."""
    gap = SPACE[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    return edge[::2], edge[1::2]


class _Hashes(dict):
    """Hashes of the words a worker has met lately; most words of a text are among them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_KNOWN = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``size`` words (all words, if there are fewer)."""
    size = min(size, len(hashes))
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        out = mixed(out + hashes[i : len(hashes) - size + 1 + i])
    return out


def lines(text: bytes, shortest: int, every: list[np.ndarray] | None = None):
    """(start, end, hashes of words, kind) of the paragraphs, blocks and shorter lines.

    ``every`` collects the hashes of all words of the text, line by line.
    """
    at, held, block, upto = 0, [], 0, 0
    every = [] if every is None else every
    for line in [*text.split(b"\n"), b""]:
        words = line.lower().split()
        end = at + len(line)
        if 0 < len(words) < shortest:
            if not held:
                block = at
            held.append(hashes := word_hashes(words))
            every.append(hashes)
            upto = end
            if len(words) >= SHINGLE:
                yield at, end, hashes, "line"
        else:
            if len(held) > 1 and sum(map(len, held)) >= shortest:
                yield block, upto, np.concatenate(held), "block"
            held = []
            if words:
                every.append(hashes := word_hashes(words))
                yield at, end, hashes, "paragraph"
        at = end + 1


PIECE = ["first_byte", "end_byte", "n_words", "hash", "kind", "place", "bands"]


def pieces(docs: DataFrame, key: str, text: str, shortest: int) -> DataFrame:
    """(key, first byte, end, n_words, hash, kind, place, bands) of all that is compared, in one pass over the texts.

    That is every paragraph and block, with its bands, every shorter line, and every stretch, with
    its ``place`` in the text.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column(0)
        row, starts, ends, counts, hashes, kinds, grams, sizes = [], [], [], [], [], [], [], []
        cut, held, size = [], [], 0
        for i, t in enumerate(texts(batch, text)):
            every: list[np.ndarray] = []
            for start, end, words, kind in lines(t, shortest, every):
                row.append(i)
                starts.append(start)
                ends.append(end)
                counts.append(len(words))
                hashes.append(xxhash.xxh3_64_intdigest(words.tobytes()))
                kinds.append(kind)
                if kind != "line":
                    grams.append(g := shingles(words))
                    sizes.append(len(g))
            if every:
                held.append((i, t, np.concatenate(every)))
                size += len(held[-1][2])
            if size > TOGETHER:
                cut.append(stretches(held))
                held, size = [], 0
        if held:
            cut.append(stretches(held))
        bands = np.zeros((len(grams), BANDS), np.uint64)
        if grams:
            flat, first = np.concatenate(grams), np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for i, turn in enumerate(TURN):
                least = np.minimum.reduceat(mixed(flat * turn), first)
                bands[:, i // ROWS] = mixed(bands[:, i // ROWS] * turn + least)
        none = [np.zeros(0, np.int64)] * 5 + [np.zeros(0, np.uint64)]
        cut_row, *cut_at = map(np.concatenate, zip(*cut, strict=True)) if cut else none
        n = len(cut_row)
        widths = [*(0 if kind == "line" else BANDS for kind in kinds), *[0] * n]
        packed = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *widths], dtype=np.int32)), pa.array((bands.ravel() >> np.uint64(32)).astype(np.uint32).view(np.int32))
        )
        number = lambda one, two: pa.array(np.concatenate([np.array(one, np.int64), two]).astype(np.int32))
        columns = [
            keys.take(pa.array(np.concatenate([np.array(row, np.int64), cut_row]))), number(starts, cut_at[1]), number(ends, cut_at[2]), number(counts, cut_at[3]),
            pa.array(np.concatenate([np.array(hashes, np.uint64), cut_at[4]]).view(np.int64)),
            pa.concat_arrays([pa.array(kinds, pa.string()), pa.repeat(pa.scalar("stretch"), n)]),
            number([0] * len(row), cut_at[0]), packed,
        ]
        return pa.RecordBatch.from_arrays(columns, [key, *PIECE])

    return _rows(docs, key, text, run, "first_byte int, end_byte int, n_words int, hash bigint, kind string, place int, bands array<int>")


def stretches(held: list[tuple[int, bytes, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """(row, place, first byte, end, n_words, hash) of the stretches of texts (row, text, hashes of all its words).

    Every text is cut by its own words; the texts are only laid end to end so that one step of
    array work is for many of them.
    """
    rows, bodies, every = zip(*held, strict=True)
    starts, ends = word_spans(b"\n".join(bodies))
    hashes = np.concatenate(every)
    n = np.fromiter(map(len, every), np.int64, len(every))
    head = np.cumsum(n) - n
    cut = np.zeros(len(hashes), bool)
    cut[head] = True
    if len(hashes) > WINDOW:
        least = least_places(mixed(hashes[:-1] * ODD + hashes[1:]))
        inside = np.arange(len(least)) + WINDOW < np.repeat(head + n, n)[: len(least)]
        cut[least[inside]] = True
    cuts = np.flatnonzero(cut)
    stops = np.append(cuts[1:], len(hashes))
    text = np.searchsorted(head, cuts, "right") - 1
    place = np.arange(len(cuts)) - np.searchsorted(cuts, head)[text]
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies)) + 1
    before = (np.cumsum(sizes) - sizes)[text]
    return np.array(rows)[text], place, starts[cuts] - before, ends[stops - 1] - before, stops - cuts, run_hashes(hashes, cuts, stops)


def least_places(values: np.ndarray) -> np.ndarray:
    """Where the first least value of every window of ``WINDOW`` values stands, by windows of doubled size."""
    place, size = np.arange(len(values)), 1
    while size < WINDOW:
        step = min(size, WINDOW - size)
        place = np.where(values[step:] < values[:-step], place[step:], place[:-step])
        values = np.minimum(values[step:], values[:-step])
        size += step
    return place


def run_hashes(hashes: np.ndarray, cuts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """One hash per run of words, of the words and their places in it."""
    place = np.arange(len(hashes)) - np.repeat(cuts, stops - cuts)
    of_word = mixed(mixed(hashes + (place + 1).astype(np.uint64) * ODD))
    return mixed(np.add.reduceat(of_word, cuts) + (stops - cuts).astype(np.uint64) * ODD)


def _rows(docs: DataFrame, key: str, text: str, make, columns: str) -> DataFrame:
    """Any number of rows per document; documents without key are left out."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *T.StructType.fromDDL(columns).fields])
    return docs.where(F.col(key).isNotNull()).select(key, text).mapInArrow(lambda batches: map(make, batches), schema)


def shingle_sets(docs: DataFrame, key: str, text: str, shortest: int) -> DataFrame:
    """(hash, grams) of the paragraphs and blocks of ``docs``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, grams = [], []
        for t in texts(batch, text):
            for _, _, words, kind in lines(t, shortest):
                if kind == "line":
                    continue
                hashes.append(xxhash.xxh3_64_intdigest(words.tobytes()))
                grams.append(np.unique(shingles(words)).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(grams, pa.list_(pa.int64()))], ["hash", "grams"])

    return docs.select(key, text).mapInArrow(lambda batches: map(run, batches), "hash bigint, grams array<bigint>")


def jaccard_links(flat: np.ndarray, sizes: np.ndarray, one: np.ndarray, two: np.ndarray, similar: float, width: int = 4096):
    """Pairs of rows (of ``one``, of ``two``) at ``similar`` or more, exactly.

    Shingles that only one row has cannot be in an intersection; over the others the
    intersections are products of 0/1 matrices, some columns at a time.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, gram, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[gram] > 1
    number = np.cumsum(times > 1) - 1
    gram, owner = number[gram[shared]], owner[shared]
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    common = np.zeros((len(one), len(two)), np.float32)
    place = [np.full(len(sizes), -1), np.full(len(sizes), -1)]
    place[0][one], place[1][two] = np.arange(len(one)), np.arange(len(two))
    top = int(gram[-1]) + 1 if len(gram) else 0
    for at in range(0, top, width):
        lo, hi = np.searchsorted(gram, [at, at + width])
        sides = []
        for where, n in zip(place, (len(one), len(two)), strict=True):
            m = np.zeros((n, min(width, top - at)), np.float32)
            r = where[owner[lo:hi]]
            m[r[r >= 0], (gram[lo:hi] - at)[r >= 0]] = 1
            sides.append(m)
        common += sides[0] @ sides[1].T
    union = sizes[one][:, None] + sizes[two][None, :] - common
    i, j = np.nonzero(common >= similar * union - 1e-6)
    return one[i], two[j]


def clusters(parts: DataFrame, docs: DataFrame, key: str, text: str, shortest: int, similar: float, cap: int = 2048) -> DataFrame:
    """(hash, cluster) of the paragraphs linked to a different one; cluster is the least hash."""
    firsts = parts.where("kind != 'line'").groupBy("hash").agg(F.min(F.struct(key, "bands")).alias("f")).select("hash", f"f.{key}", "f.bands")
    dealt = firsts.select(
        "hash", key, F.posexplode("bands").alias("_band", "_value")
    ).select("hash", key, F.xxhash64("_band", "_value").alias("bucket"))
    dealt = stored(dealt, "bands")
    crowded = dealt.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    meeting = stored(dealt.join(crowded, "bucket"), "meeting")
    holders = docs.join(meeting.select(key).distinct(), key, "left_semi")
    wanted = meeting.select("hash").distinct()
    sets = shingle_sets(holders, key, text, shortest).join(wanted, "hash", "left_semi").groupBy("hash").agg(F.min("grams").alias("grams"))
    keys = ["bucket", "_lo", "_hi"]
    rows = blocks(meeting.select("bucket", "hash").join(stored(sets, "sets"), "hash"), "bucket", "hash", cap)

    def compare(batches):
        for table in runs(batches, keys):
            table = table.combine_chunks()
            column = {n: table.column(n).to_numpy() for n in [*keys, "hash", "_second"]}
            grams = table.column("grams").combine_chunks()
            offsets, flat = grams.offsets.to_numpy(), grams.values.to_numpy()
            a, b = [], []
            for start, end in zip(*bounds([column[k] for k in keys]), strict=True):
                n = end - start
                if n < 2:
                    continue
                second = column["_second"][start:end].astype(bool)
                whole = column["_lo"][start] == column["_hi"][start]
                one = np.arange(n) if whole else np.flatnonzero(~second)
                two = one if whole else np.flatnonzero(second)
                sizes = np.diff(offsets[start : end + 1])
                labels = Labels(n)
                labels.join(*jaccard_links(flat[offsets[start] : offsets[end]], sizes, one, two, similar))
                moved, to = labels.edges()
                ids = column["hash"][start:end]
                a.append(ids[moved])
                b.append(ids[to])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    packed = rows.select(*keys, "_second", "hash", "grams").repartition(*keys).sortWithinPartitions(*keys)
    return components(packed.mapInArrow(compare, "a bigint, b bigint")).select(F.col("id").alias("hash"), F.col("component_id").alias("cluster"))


def neighbours(docs: DataFrame, sites: DataFrame, key: str, text: str) -> DataFrame:
    """(key, at, ahead, words, edges) of sites (key, at, ahead): up to REACH words on one side of a byte.

    ``words`` are hashes, the nearest first; ``edges`` are the bytes at their far ends.
    """
    asked = sites.groupBy(F.col(key).alias("_key")).agg(F.collect_set(F.struct("at", "ahead")).alias("_sites"))
    held = docs.select(key, text).join(asked, F.col(key) == F.col("_key")).drop("_key")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, row, at, ahead, words, edges = batch.column(0), [], [], [], [], []
        for i, (t, found) in enumerate(zip(texts(batch, text), batch.column(2), strict=True)):
            starts, ends = word_spans(t)
            for site in found.as_py():
                n = int(np.searchsorted(starts, site["at"]))
                near = np.arange(n, min(n + REACH, len(starts))) if site["ahead"] else np.arange(n - 1, max(n - REACH, 0) - 1, -1)
                row.append(i)
                at.append(site["at"])
                ahead.append(site["ahead"])
                words.append(word_hashes([t[a:b].lower() for a, b in zip(starts[near].tolist(), ends[near].tolist(), strict=True)]).view(np.int64))
                edges.append((ends if site["ahead"] else starts)[near].astype(np.int32))
        columns = [
            keys.take(pa.array(row, pa.int64())), pa.array(at, pa.int32()), pa.array(ahead, pa.bool_()),
            pa.array(words, pa.list_(pa.int64())), pa.array(edges, pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays(columns, [key, "at", "ahead", "words", "edges"])

    columns = "at int, ahead boolean, words array<bigint>, edges array<int>"
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *T.StructType.fromDDL(columns).fields])
    made = held.mapInArrow(lambda batches: map(run, batches), schema)
    return made.groupBy(key, "at", "ahead").agg(F.min(F.struct("words", "edges")).alias("m")).select(key, "at", "ahead", "m.*")


def extended(found: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Runs whose ends are where the texts stop agreeing, each with the first occurrence of its edge stretch.

    The kept run reaches as far as any run that repeats it.
    """
    side = lambda ahead, at, of: F.struct(F.lit(ahead).alias("ahead"), F.col(at).alias("at"), f"{of}.of", F.col(f"{of}.at").alias("of_at"))
    ends = found.where("NOT kept").select(key, F.explode(F.array(side(False, "first_byte", "_left"), side(True, "end_byte", "_right"))).alias("e")).select(key, "e.*")
    ends = stored(ends, "ends")
    sites = ends.select(key, "at", "ahead").union(ends.select("of", "of_at", "ahead")).distinct()
    near = stored(neighbours(docs, sites, key, text), "neighbours")
    other = near.select(F.col(key).alias("of"), F.col("at").alias("of_at"), "ahead", F.col("words").alias("_words"), F.col("edges").alias("_edges"))
    apart = F.array_position(F.zip_with("words", "_words", lambda x, y: F.coalesce(x == y, F.lit(False))), False).cast("int")
    both = ends.join(near, [key, "at", "ahead"]).join(other, ["of", "of_at", "ahead"])
    both = both.withColumn("more", F.when(apart == 0, F.size("words")).otherwise(apart - 1)).where("more > 0")
    both = stored(both.select(key, "at", "ahead", "of", "of_at", "more", F.get("edges", F.col("more") - 1).alias("edge"), F.get("_edges", F.col("more") - 1).alias("of_edge")), "grown")
    first = both.groupBy("of", "of_at", "ahead").agg(F.max(F.struct("more", "of_edge")).alias("m"))
    grown = both.select(key, "at", "ahead", "more", "edge", F.lit(False).alias("kept")).unionByName(
        first.select(F.col("of").alias(key), F.col("of_at").alias("at"), "ahead", "m.more", F.col("m.of_edge").alias("edge"), F.lit(True).alias("kept"))
    )
    grown = grown.distinct()
    out = found
    for ahead, end in ((False, "first_byte"), (True, "end_byte")):
        moved = grown.where(F.col("ahead") == ahead).select(key, F.col("at").alias(end), "kept", "more", "edge")
        out = out.join(moved, [key, end, "kept"], "left").withColumn(end, F.coalesce("edge", end)).withColumn(
            "n_words", F.col("n_words") + F.coalesce("more", F.lit(0))
        ).drop("more", "edge")
    return out


def repeated_runs(parts: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Spans of stretches that occur more than once: (key, first byte, end, n_words, class_id, kept)."""
    parts = parts.select(key, "place", "first_byte", "end_byte", "n_words", F.col("hash").alias("stretch"))
    # A plain count finds the few stretches that occur again; only these are ordered by place.
    crowded = parts.groupBy("stretch").agg(F.count("*").alias("n")).where("n > 1").select("stretch")
    again = stored(parts.join(crowded.hint("shuffle_hash"), "stretch"), "again")
    place = F.struct(key, "first_byte", "end_byte")
    first = again.groupBy("stretch").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).where("_first != _last").select(
        "stretch", F.col(f"_first.{key}").alias("_doc"), F.col("_first.first_byte").alias("_at"), F.col("_first.end_byte").alias("_end")
    )
    again = again.join(stored(first, "stretches"), "stretch").withColumn("kept", (F.col(key) == F.col("_doc")) & (F.col("first_byte") == F.col("_at")))
    order = Window.partitionBy(key, "kept").orderBy("place")
    run = again.dropDuplicates([key, "place"]).withColumn("_run", F.col("place") - F.row_number().over(order))
    found = run.groupBy(key, "kept", "_run").agg(
        F.min("first_byte").alias("first_byte"), F.max("end_byte").alias("end_byte"), F.sum("n_words").cast("int").alias("n_words"),
        F.min("_doc").alias("class_id"), F.max("n_words").alias("_wide"),
        F.min_by(F.struct(F.col("_doc").alias("of"), F.col("_at").alias("at")), "place").alias("_left"),
        F.max_by(F.struct(F.col("_doc").alias("of"), F.col("_end").alias("at")), "place").alias("_right"),
    )
    found = extended(stored(found.where(F.col("n_words") >= RUN), "found"), docs, key, text)
    return found.where((F.col("_wide") >= WIDE) | (F.col("n_words") > LONG)).select(key, "first_byte", "end_byte", "n_words", "class_id", "kept")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 25, similar: float = 0.8) -> DataFrame:
    """Every passage that repeats: (key, first_byte, end_byte, n_words, class_id, kept, kind, text_hash).

    ``class_id`` is the key of the document in which the passage comes first; that one is
    ``kept`` and comes back too. ``kind`` is paragraph, block, line or run. Where any key has two
    different texts, each of these is a document of its own, and ``text_hash`` (xxhash64 of the text)
    says which one a span belongs to; elsewhere it is NULL.
    """
    digest = F.xxhash64(text)
    several = docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
    if not several.where("low != high").limit(1).collect():
        return _repeats(docs.select(key, text), key, text, shortest, similar).withColumn("text_hash", F.lit(None).cast("bigint"))
    rows = docs.where(F.col(key).isNotNull()).select(F.struct(F.col(key).alias("key"), digest.alias("digest")).alias("document"), F.col(text).alias("body"))
    found = _repeats(rows, "document", "body", shortest, similar)
    columns = ["first_byte", "end_byte", "n_words", F.col("class_id.key").alias("class_id"), "kept", "kind"]
    return found.select(F.col("document.key").alias(key), *columns, F.col("document.digest").alias("text_hash"))


def _repeats(docs: DataFrame, key: str, text: str, shortest: int, similar: float) -> DataFrame:
    every = stored(pieces(docs, key, text, shortest), "pieces")
    parts = every.where("kind != 'stretch'").drop("place")
    named = clusters(parts, docs, key, text, shortest, similar)
    grouped = parts.drop("bands").join(named, "hash", "left").withColumn("cluster", F.coalesce("cluster", "hash"))
    grouped = stored(grouped.select(key, "first_byte", "end_byte", "n_words", "kind", "cluster"), "clustered")
    place = F.struct(key, "first_byte")
    first = grouped.groupBy("cluster").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).where("_first != _last")
    same = (
        grouped.join(first, "cluster")
        .select(
            key, "first_byte", "end_byte", "n_words", F.col(f"_first.{key}").alias("class_id"),
            (place == F.col("_first")).alias("kept"), "kind",
        )
        .distinct()
    )
    runs_ = repeated_runs(every.where("kind = 'stretch'"), docs, key, text).withColumn("kind", F.lit("run"))
    return same.unionByName(runs_)


def without_repeats(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spans that are not kept cut out; documents of which no word is left go.

    All columns stay, whatever their names. Text without a span is not touched.
    """
    found, touched, named, of = unused(docs, "found", "touched", "named", "of")
    span = F.struct("first_byte", "end_byte")
    cut = spans.where("NOT kept").groupBy(F.col(key).alias(named), F.col("text_hash").alias(of)).agg(F.array_sort(F.collect_list(span)).alias(found))
    same = (F.col(key) == F.col(named)) & (F.col(of).isNull() | (F.col(of) == F.xxhash64(text)))
    joined = docs.join(cut, same, "left").drop(named, of)

    def shorter(batch: pa.RecordBatch) -> dict:
        spans_of = batch.column(batch.schema.get_field_index(found))
        column = batch.column(batch.schema.get_field_index(text))
        out = []
        for value, own in zip(column, spans_of, strict=True):
            if not own.is_valid or not value.is_valid:
                out.append(value.as_py())
                continue
            raw, kept, at = value.as_buffer().to_pybytes(), [], 0
            for span in own.as_py():
                if span["first_byte"] > at:
                    kept.append(raw[at : span["first_byte"]])
                at = max(at, span["end_byte"])
            out.append(b"".join([*kept, raw[at:]]).decode())
        return {text: pa.array(out, column.type), touched: pa.array([v.is_valid for v in spans_of])}

    schema = T.StructType([*joined.schema.fields, T.StructField(touched, T.BooleanType())])
    done = map_batches(joined, shorter, schema)
    return done.where(~F.col(touched) | F.col(text).rlike(r"[^\x20\x09-\x0D]")).drop(found, touched)
