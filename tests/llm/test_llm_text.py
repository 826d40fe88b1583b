"""Operators on texts against brute force, with NULLs, empty and long texts, ties and clashing columns."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from turnpress.llm import bpe, chat, contexts, mixing, queries, quality, rules, simhash, substrings, toxicity
from turnpress.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, _fp string"
"""The columns of documents and two whose names the operators use themselves."""


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = np.random.default_rng(seed)
    made = [f"w{v}" if v % 3 else f"Éw{v}," for v in draw.integers(0, vocabulary, words)]
    return "\n".join(" ".join(made[i : i + 40]) for i in range(0, words, 40))


def corpus():
    base = [prose(i, 60 + 11 * i) for i in range(20)]
    rows = [(i, t, ("en", "de", None)[i % 3], f"s{i % 4}" if i % 5 else None, len(t), 0.0, "x") for i, t in enumerate(base)]
    extra = [
        None, "", " \n\t ", "a", "A b\x0bC", base[3], base[3], base[4].replace("w1", "v1", 1), "# $ " * 40,
        "same line here\n" * 30, "x" * 5000, "é中\U0001f600 " * 300, base[5] + "\n" + base[6], prose(77, 4000),
    ]
    rows += [(100 + i, t, "en", "s0", None, None, None) for i, t in enumerate(extra)]
    rows += [(None, base[0], None, None, None, None, None), rows[0], rows[0]]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def encoding():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().split(b"\n")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library_and_decode_to_the_text(spark, docs, none, encoding):
    codec = queries.vocabulary()
    done = bpe.decode(bpe.encode(docs, codec), codec)
    assert set(docs.columns) <= set(done.columns)
    found = done.select("text", "ids", "decoded").collect()
    assert len(found) == docs.count()
    for r in found:
        assert r["ids"] == encoding.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.decode(bpe.encode(none, codec), codec).count() == 0
    both = bpe.encode_and_decode(docs, codec).select("text", "ids", "decoded").collect()
    assert sorted(map(repr, both)) == sorted(map(repr, found))


def test_the_hash_is_perfect_and_minimal_and_turns_strangers_away(encoding):
    codec = queries.vocabulary()
    slots = {codec.hash.find(t) for t, _ in codec.slots}
    assert slots == set(range(len(codec.ranks)))
    assert all(codec.whole(t) == r for t, r in codec.ranks.items())
    assert codec.whole(b"no such entry at all") is None
    for piece in ("x" * 3000, "aab" * 500, "é" * 77, "\x00\x01"):
        assert [i for i in codec.ids(piece)] == encoding.encode_ordinary(piece)


def fingerprint(text):
    words = WORD.findall(text.translate(LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(keys, near):
    up = {k: k for k in keys}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in near:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def test_fingerprints_link_as_by_comparing_all(docs, none):
    found = rows_of(simhash.near_duplicates(docs))
    texts = collections.defaultdict(set)
    for i, t, *_ in corpus():
        texts[i].add(fingerprint(t or ""))
    for i, fp, _ in found:
        assert texts[i] == {fp & (2**64 - 1)}
    one = {i: next(iter(v)) for i, v in texts.items() if i is not None}
    want = linked(one, [(a, b) for a in one for b in one if a < b and (one[a] ^ one[b]).bit_count() <= 4])
    assert all((c is None) if i is None else c == want[i] for i, _, c in found)
    assert len(found) == len(corpus()) and simhash.near_duplicates(none).count() == 0


def test_tree_search_finds_all_within_the_radius():
    draw = np.random.default_rng(1)
    centre = draw.integers(0, 1 << 63, 12, np.uint64)
    points = np.concatenate([c ^ sum(np.uint64(1) << draw.integers(0, 64, 60, np.uint64) for _ in range(3)) for c in centre])
    pairs = {(int(i), int(j)) for a, b in simhash.tree_links(points, points, 4) for i, j in zip(a, b, strict=True)}
    want = {(i, j) for i in range(len(points)) for j in range(len(points)) if int(points[i] ^ points[j]).bit_count() <= 4}
    assert pairs >= want - {p for p in want if (p[1], p[0]) in pairs} and pairs <= want


def test_a_crowded_shard_is_cut_and_loses_no_link(spark):
    draw = np.random.default_rng(2)
    fps = {int(x) for x in draw.integers(0, 1 << 40, 30, np.int64)}
    fps |= {f ^ (1 << int(b)) ^ (1 << int(c)) for f in list(fps) for b, c in draw.integers(40, 63, (20, 2)) if b != c}
    rows = [(f, i) for i, f in enumerate(sorted(fps))]
    got = dict(rows_of(components(simhash.links(spark.createDataFrame(rows, "fp bigint, id bigint"), cap=16))))
    want = linked([i for _, i in rows], [(i, j) for f, i in rows for g, j in rows if i < j and (f ^ g).bit_count() <= 4])
    assert {i: got.get(i, i) for _, i in rows} == want


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components_reach_the_smallest_id(spark, shape):
    draw = np.random.default_rng(3)
    edges = {
        "path": [(i, i + 1) for i in range(60)], "star": [(500, i) for i in range(200)] + [(3, 3)],
        "random": [tuple(map(int, e)) for e in draw.integers(0, 300, (200, 2))], "none": [],
    }[shape]
    got = dict(rows_of(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    keys = {k for e in edges for k in e}
    assert {k: got.get(k, k) for k in keys} == linked(keys, edges)


def paragraph_classes(rows, shortest=25, similar=0.8):
    parts = []
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            w = WORD.findall(line.translate(LOWER))
            if len(w) >= shortest and i is not None:
                parts.append((i, {tuple(w[j : j + 5]) for j in range(len(w) - 4)}))
    near = [
        (a, b) for a in range(len(parts)) for b in range(a) if len(parts[a][1] & parts[b][1]) >= similar * len(parts[a][1] | parts[b][1])
    ]
    return parts, linked(range(len(parts)), near)


def test_repeated_paragraphs_are_those_of_all_pairs(spark, none):
    rows = [r for r in {x[0]: x for x in corpus()}.values()]
    df = spark.createDataFrame(rows, DOCS)
    found = [r for r in substrings.repeats(df).collect() if r["kind"] == "paragraph"]
    parts, root = paragraph_classes(rows)
    size = collections.Counter(root.values())
    want = collections.Counter(parts[n][0] for n in root if size[root[n]] > 1)
    assert collections.Counter(r["doc_id"] for r in found) == want
    assert sum(r["kept"] for r in found) == sum(s > 1 for s in size.values())
    assert substrings.repeats(none).count() == 0


def test_a_passage_inside_other_paragraphs_is_found_and_cut_once(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"a{i}x{j}" for j in range(70)) + " " + passage + " " + " ".join(f"b{i}x{j}" for j in range(70))) for i in range(5)]
    rows += [(9, " ".join(f"c{j}" for j in range(200))), (None, passage), (10, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = substrings.repeats(df).cache()
    assert {(r["doc_id"], r["kept"]) for r in spans.collect()} == {(i, i == 0) for i in range(5)}
    left = dict(rows_of(substrings.without_repeats(df, spans)))
    assert left[0] == rows[0][1] and left[9] == rows[5][1] and left[None] == passage and left[10] is None
    for i in range(1, 5):
        gone = set(rows[i][1].split()) - set(left[i].split())
        assert len(gone) >= substrings.RUN and gone <= set(passage.split())


def test_runs_reach_to_the_ends_of_the_passage(spark):
    rows = []
    for n, length in enumerate((51, 60, 90)):
        passage = [f"P{n}x{i}" for i in range(length)]
        rows += [(10 * n + i, [f"a{n}x{i}x{j}" for j in range(70 * (i != 1))], passage, [f"b{n}x{i}x{j}" for j in range(70 * (i != 2))]) for i in range(4)]
    df = spark.createDataFrame([(i, " ".join([*a, *p, *b])) for i, a, p, b in rows], "doc_id bigint, text string")
    spans = substrings.repeats(df).cache()
    left = dict(rows_of(substrings.without_repeats(df, spans)))
    found = {r["doc_id"]: r for r in spans.collect()}
    assert len(found) == spans.count() == len(rows)
    for i, a, p, b in rows:
        assert found[i]["n_words"] == len(p) and found[i]["kept"] == (i % 10 == 0)
        text = " ".join([*a, *p, *b])
        assert text[found[i]["first_byte"] : found[i]["end_byte"]] == " ".join(p)
        assert left[i].split() == (text.split() if i % 10 == 0 else [*a, *b])


def test_a_long_passage_of_a_short_phrase_is_found(spark):
    phrase = ["12", "x", "7", "y"] * 15
    rows = [(i, " ".join([*(f"a{i}x{j}" for j in range(60)), *phrase, *(f"b{i}x{j}" for j in range(60))])) for i in range(2)]
    found = substrings.repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    spans = [r for r in found.collect() if r["doc_id"] == 1 and not r["kept"]]
    assert spans and max(r["n_words"] for r in spans) > substrings.LONG


def test_wrapped_paragraphs_and_short_lines_are_compared(spark):
    wrapped = lambda words: "\n".join(" ".join(words[i : i + 13]) for i in range(0, len(words), 13))
    words = [f"h{j}" for j in range(160)]
    near = [f"{w}z" if j % 55 == 8 else w for j, w in enumerate(words)]  # 5-word Jaccard 0.83
    other = lambda i: "\n\n".join(" ".join(f"o{i}x{j}" for j in range(k, k + 30)) for k in (0, 30))
    rows = [(0, wrapped(words)), (1, wrapped(near)), (2, other(2) + "\nfive words are just enough\n\n"), (3, "Five words are just  enough\n" + other(3)), (4, "four words are few\n" + other(4)), (5, "four words are few\n" + other(5))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = substrings.repeats(df)
    assert {(r["doc_id"], r["kind"], r["class_id"], r["kept"]) for r in found.where("kind != 'run'").collect()} == {
        (0, "block", 0, True), (1, "block", 0, False), (0, "line", 0, True), (1, "line", 0, False), (2, "line", 2, True), (3, "line", 2, False)
    }
    left = dict(rows_of(substrings.without_repeats(df, found)))
    assert 1 not in left and left[3] == "\n" + other(3) and all(left[i] == rows[i][1] for i in (0, 2, 4, 5))


def test_jaccard_is_exact_in_narrow_columns():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 60, draw.integers(1, 50))) for _ in range(40)]
    flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    every = np.arange(len(sets))
    got = set(zip(*(x.tolist() for x in substrings.jaccard_links(flat, sizes, every, every, 0.3, width=7)), strict=True))
    want = {(i, j) for i in every for j in every if len(set(sets[i]) & set(sets[j])) >= 0.3 * len(set(sets[i]) | set(sets[j]))}
    assert got == want


def test_the_mix_meets_targets_and_is_the_same_again(docs, none):
    found = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    by = collections.defaultdict(list)
    for r in found:
        by[r["source"]].append(r)
    words = collections.defaultdict(list)
    for i, t, _, s, *_ in corpus():
        words[s].append(len(WORD.findall(t or "")))
    order = sorted(s for s in words if s is not None) + [None]
    weight = {s: n % 3 + 1 for n, s in enumerate(order)}
    size = {s: sum(v) for s, v in words.items()}
    full, target = set(), {}
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * size[s] if s in full else rest * weight[s] / free for s in order}
        above = {s for s in order if s not in full and target[s] > 3 * size[s]}
        if not above:
            break
        full |= above
    for s, rows in by.items():
        assert rows[0]["source_size"] == size[s] and math.isclose(rows[0]["target"], target[s])
        assert abs(sum(r["taken"] for r in rows) - target[s]) <= max(words[s]) * 3
        assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["times"] * r["size"] for r in rows)
        assert len({r["times"] for r in rows if r["size"]}) <= 2  # whole epochs, then a part
    assert mixing.repeated(docs).count() == sum(r["times"] for r in found)
    assert mixing.mix(none).count() == 0 and mixing.repeated(none).count() == 0


def test_copies_of_one_document_enter_one_by_one(spark):
    """A source of equal rows only, and one whose cut-off falls on them, come near their targets."""
    rows = [(1, "ten words " * 5, "a")] * 1000 + [(i, prose(i, 20 + i % 7), "b") for i in range(2, 402)] + [(5, "x y z", None)] * 30
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7)
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == len(rows)
    for source, size in (("a", 10), ("b", 26), (None, 3)):
        mine = [r for r in mixed if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= size / 2
    again = collections.Counter((r["doc_id"], r["source"]) for r in mixing.repeated(docs.repartition(3)).collect())
    entered = collections.Counter()
    for r in mixed:
        entered[r["doc_id"], r["source"]] += r["times"]
    assert again == +entered


def test_documents_of_greater_weight_enter_more_often(spark):
    letters, marks = "abcd " * 20, "#### " * 20
    rows = [(i, letters if i % 2 else marks, "s") for i in range(4000)] + [(-1, "w " * 100, "t")]
    taken = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).where("source = 's' AND times = 0 AND doc_id >= 0").collect()
    kind = collections.Counter(r["doc_id"] % 2 for r in taken)
    assert kind[0] > 1.5 * kind[1]


def test_rule_counts_and_fences(spark, docs, none):
    for r in rules.judge(docs).collect():
        texts = {t or "" for i, t, *_ in corpus() if i == r["doc_id"]}
        assert len(texts) == 1
        t = texts.pop()
        w = WORD.findall(t)
        at = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {j for i in range(len(w) - 2) if at[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    assert rules.judge(none).count() == 0
    odd = [(i, prose(i, 200), "en", "s") for i in range(60)] + [(99, prose(99, 200).replace(" ", "#$% "), "en", "s"), (98, prose(98, 200), None, None)]
    kept = {r["doc_id"]: r["kept"] for r in rules.judge(spark.createDataFrame(odd, "doc_id bigint, text string, lang string, source string")).collect()}
    assert not kept.pop(99) and all(kept.values())


def marked(i, n, symbols=0, lines=0, repeats=0, long=0):
    """A text of ``n`` words with so many symbols, repeated lines, repeats of three words and long words."""
    words = [f"w{i}x{j}" + "y" * 8 * (j < long) for j in range(n)]
    body = " ".join(w + "#" * (j < symbols) for j, w in enumerate(words))
    return body + "\nagain and" * (lines + 1) + " red blue green" * (repeats + 1)


def test_groups_get_fences_of_their_own(spark):
    """What is usual in one source is beyond the fence of another, for every measure; equal rows are never outside."""
    kinds = {"symbol_rate": {"symbols": 80}, "dup_line_rate": {"lines": 9}, "repeat_rate": {"repeats": 20}, "word_length": {"long": 150}}
    rows = [(i, marked(i, 150), "en", "plain") for i in range(300)]
    for k, (measure, odd) in enumerate(kinds.items(), 1):
        rows += [(1000 * k + i, marked(i, 150, **odd), "en", measure) for i in range(300)] + [(-k, marked(-k, 150, **odd), "en", "plain")]
    schema = "doc_id bigint, text string, lang string, source string"
    got = {r["doc_id"]: r for r in rules.judge(spark.createDataFrame(rows, schema)).collect()}
    for k, measure in enumerate(kinds, 1):
        assert measure in got[-k]["outside"] and not got[-k]["kept"]
    assert all(r["kept"] for i, r in got.items() if i >= 0)
    fences = rules.fences(rules.sketches(rules.statistics(spark.createDataFrame(rows, schema)), ["source"]), ["source"])
    fences = {r["source"]: r.asDict() for r in fences.collect()}
    for measure in kinds:
        assert fences[measure][f"high_{measure}"] > 1.3 * fences["plain"][f"high_{measure}"]
    same = [(i, marked(7, 90, 3, 2, 1, 5), "en", "s") for i in range(40)]
    assert all(r["kept"] for r in rules.judge(spark.createDataFrame(same, schema)).collect())


def test_small_groups_lean_on_wider_ones(spark):
    """A group of three odd rows is judged by its language, one of three hundred by itself; no row at all fails nothing."""
    odd = {"symbols": 80}
    rows = [(i, marked(i, 150), "en", "plain") for i in range(300)] + [(1000 + i, marked(i, 150, **odd), "en", "few") for i in range(3)]
    rows += [(2000 + i, marked(i, 150, **odd), "en", "many") for i in range(300)] + [(3000, "too short", "xx", "alone"), (3001, None, None, None)]
    judged = rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    fell = {r["doc_id"] for r in judged if not r["kept"]}
    assert len(judged) == len(rows) and fell >= {3000, 3001} and not any(i < 1000 or 2000 <= i < 3000 for i in fell)


def test_sketches_of_parts_add_up_and_quantiles_are_close(spark):
    draw = np.random.default_rng(6)
    values = [float(v) for v in draw.lognormal(0, 1, 4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(rules.bucket(F.col("v")).alias("b"))
    got = [r[0] for r in df.orderBy("b").select(rules.edge(F.col("b"))).collect()]
    for q in (0.1, 0.25, 0.5, 0.9):
        assert abs(got[int(q * 4000)] / np.sort(values)[int(q * 4000)] - 1) < 0.02


def test_quality_learns_and_handles_missing_labels(spark, docs, none):
    good = [(i, prose(i, 150)) for i in range(300)]
    bad = [(1000 + i, "BUY NOW!! #1 " * 40 if i % 2 else prose(i, 5) + " same same same" * 40) for i in range(80)]
    df = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(5, None), (None, 1)], "doc_id bigint, quality int")
    held = queries.fold(F.col("doc_id"), 4) == 2
    features = quality.feature_table(df)
    model = quality.fit(features.where(~held), labels)
    right = [(r["_s"] >= 0.7) == (r["doc_id"] < 1000) for r in quality.with_score(df, model, out="_s").where(held).collect()]
    assert np.mean(right) > 0.97
    stored = dict(rows_of(quality.score_features(features, model)))
    assert all(math.isclose(stored[i], s, abs_tol=1e-9) for i, _, s in rows_of(quality.with_score(df, model)))
    whole = quality.feature_table(docs)
    nothing = quality.fit(whole, labels.limit(0))
    assert {s for _, s in rows_of(quality.score_features(whole, nothing))} == {0.5}
    assert whole.count() == len(corpus()) and quality.feature_table(none).count() == 0


def test_network_gradients_are_right():
    draw = np.random.default_rng(8)
    net = toxicity.Network()
    net.p = {k: v.astype(np.float64) + 0.05 * draw.standard_normal(v.shape) for k, v in net.p.items()}
    words = toxicity.word_inputs([b"alpha", b"be", b"c", b"delta."])
    at = np.where(draw.random((3, toxicity.SPAN)) < 2, draw.integers(0, 4, (3, toxicity.SPAN)), 0)
    at[1, 5:], at[2, 1:] = -1, -1
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        s = net.logits(net.inputs(*words), at)
        return float(np.mean(np.logaddexp(0, s) - y * s))

    before = {k: v.copy() for k, v in net.p.items()}
    toxicity.DECAY, kept = 0.0, toxicity.DECAY
    net.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    net.learn(words, at, y, np.ones(3), 0.0)
    toxicity.DECAY = kept
    for k, (m, _) in net.moments.items():
        gradient, flat = (m * 10).ravel(), net.p[k].ravel()
        assert np.array_equal(before[k], net.p[k])
        for i in np.argsort(-np.abs(gradient))[:3]:
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert math.isclose((up - down) / 2e-4, gradient[i], rel_tol=0.02, abs_tol=1e-5), k


def test_network_learns_words_in_any_window(spark, docs, none):
    draw = np.random.default_rng(9)
    rows = []
    for i in range(400):
        words = prose(i, int(draw.integers(3, 200))).split()
        if i % 4 == 0:
            words[int(draw.integers(0, len(words)))] = ("vile", "scum.", "Hateful")[i % 3]
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(1, None)], "doc_id bigint, toxic int")
    held = queries.fold(F.col("doc_id"), 4) == 2
    model = toxicity.fit(df, labels.where(~held))
    right = [(r["score"] >= 0.3) == (r["doc_id"] % 4 == 0) for r in toxicity.scored(df, model).where(held).collect()]
    assert np.mean(right) > 0.9
    scores = rows_of(toxicity.scored(docs, model))
    assert len(scores) == len(corpus()) and all(0 <= s <= 1 for _, s in scores) and toxicity.scored(none, model).count() == 0
    assert {s for _, s in rows_of(toxicity.scored(docs, toxicity.fit(df, labels.limit(0))))} == {0.5}


def test_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 36, 37, 100):
        at, of = toxicity.windows(np.array([3, n]))
        assert set(at[of == 1][at[of == 1] >= 0]) == set(range(3, 3 + n))


def log_probability(training, text, depth=contexts.DEPTH):
    """Context-tree weighting by its definition: log10 of the bytes of text."""
    counts = collections.defaultdict(lambda: [0, 0])
    children = collections.defaultdict(set)

    def steps(body):
        data = b"\n" * depth + body
        for i in range(depth, len(data)):
            for place in range(8):
                yield data[i - depth : i][::-1], (place, data[i] >> (8 - place)), data[i] >> (7 - place) & 1

    for body, learn in [(b, True) for b in training] + [(text, False)]:
        for context, node, bit in steps(body):
            for d in range(depth + 1):
                counts[context[:d], node][bit] += learn
                if d:
                    children[context[: d - 1], node].add(context[:d])

    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(context, node):
        pe = estimate(*counts[context, node])
        if len(context) == depth:
            return pe
        below = sum(weighted(c, node) for c in children[context, node])
        return math.log(0.5) + np.logaddexp(pe, below)

    memo = {}
    total = 0.0
    for context, node, bit in steps(text):
        p = None
        for d in range(depth, -1, -1):
            a, b = counts[context[:d], node]
            own = (b + 0.5) / (a + b + 1)
            if p is None:
                p = own
            else:
                key = context[:d], node
                if key not in memo:
                    memo[key] = math.exp(math.log(0.5) + estimate(a, b) - weighted(*key))
                p = memo[key] * own + (1 - memo[key]) * p
        total += math.log10(p if bit else 1 - p)
    return total


def test_context_trees_by_their_definition(spark):
    rows = [(0, "Abra cadabra abra"), (1, "abra\n cad"), (2, "zebra bra é"), (3, None), (4, "unseen words"), (1, "abra\n cad")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    train = F.col("doc_id").isin(0, 1, 3)
    body = lambda t: contexts.body((t or "").encode().lower().split())
    training = [body(t) for i, t in rows if i in (0, 1, 3)]
    words = collections.Counter(w for b in training for w in [*b.split(), b"\n"])
    n, v = sum(words.values()), len(words)
    for blocks in (1, 3):
        got = contexts.score(df, train, F.col("doc_id") % blocks).collect()
        assert len(got) == len(rows)
        for r in got:
            text = dict(rows)[r["doc_id"]]
            tokens = [*body(text).split(), b"\n"]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(t in words for t in tokens), n)
            assert math.isclose(r["base_score"], sum(math.log10((words[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens), rel_tol=1e-9)
    # the trees hold all documents' contexts; those without counts change no probability
    got = {r["doc_id"]: r["score"] for r in contexts.score(df, train, F.lit(0)).collect()}
    for i, t in rows:
        assert math.isclose(got[i], log_probability(training, body(t)), rel_tol=1e-6)


def test_context_trees_beat_the_unigrams_on_held_out_texts(spark):
    scored = queries.QUERIES["op3_context_tree_scores"](spark, "/root/testdata/sf0.01").where("held_out")
    trees, unigrams = scored.agg(F.sum("score"), F.sum("base_score")).first()
    assert trees > unigrams


def test_context_tables_take_few_bytes_a_code(spark):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(1, 6))) for _ in range(20_000)]
    rows = [(" ".join(draw.choices(words, k=150)), i % 2, i % 3 > 0) for i in range(2000)]
    windows = [collections.Counter() for _ in range(2)]
    for text, block, _ in rows:
        data = b"\n" * contexts.DEPTH + contexts.body(text.encode().split())
        windows[block].update(data[i : i + contexts.DEPTH + 1] for i in range(len(data) - contexts.DEPTH))
    asked = contexts.requests(spark.createDataFrame(rows, "text string, block bigint, train boolean").coalesce(1).sortWithinPartitions("block"))
    runs = asked.where(F.col("kind") == contexts.RUN).select(F.sum(F.length("codes") + F.length("counts"))).first()[0]
    assert runs < 5 * sum(map(len, windows))  # 16 as plain numbers


def test_context_scores_do_not_depend_on_the_parts(spark, monkeypatch):
    rows = [(i, " ".join(f"{w}{i % 7}" for w in ("Abra", "cad", "é", "the")) if i % 5 else None, i % 6) for i in range(60)]
    df = spark.createDataFrame([*rows, (60, "no block", None)], "doc_id bigint, text string, block bigint")
    train = F.col("doc_id") % 3 > 0
    at_once = {r["doc_id"]: r for r in contexts.score(df, train, F.col("block")).collect()}
    asked, real = [], contexts.answered

    def answered(sums, replies, keys, to):
        back = real(sums, replies, keys, to)
        asked.append((to, sums.select("kind", "owner", to, "codes").collect(), back.select("kind", "owner", to, "codes").collect()))
        return back

    monkeypatch.setattr(contexts, "answered", answered)
    monkeypatch.setattr(contexts, "BLOCKS", 1)
    got = contexts.score(df, train, F.col("block")).collect()
    assert {r["doc_id"]: r for r in got} == at_once and len(got) == 61
    assert [to for to, _, _ in asked] == ["part", "block"]
    whole = lambda rows, to: collections.Counter((r["kind"], r["owner"], r[to], c) for r in rows for c in contexts.unpacked_codes(r["codes"]).tolist())
    for to, sent, back in asked:  # a part and a block get what they asked for and no copy of the rest
        assert set(whole(back, to)) == set(whole(sent, to)) and max(whole(back, to).values()) == 1


def test_counts_and_codes_are_packed_without_loss():
    for values in (np.array([], np.uint64), np.array([7, 2**63, 2**64 - 1], np.uint64), np.arange(0, 2**50, 2**33, dtype=np.uint64)):
        assert np.array_equal(contexts.unpacked_codes(contexts.packed_codes(values)), values)
        assert np.array_equal(contexts.unpacked(contexts.packed(values), np.uint64), values)
    n = np.array([[0.0, 3.0], [4095.0, 4096.0]])
    assert np.array_equal(contexts.log_gamma_of(n, 0.5), contexts.log_gamma(n + 0.5))


def test_context_scores_of_odd_tables(spark, docs, none):
    got = contexts.score(docs, F.col("doc_id") % 2 == 0, F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4))).collect()
    assert len(got) == len(corpus()) and all(r["score"] < 0 for r in got)
    assert contexts.score(none, F.lit(True), F.lit(0)).count() == 0
    blank = contexts.score(docs.limit(5), F.lit(False), F.lit(0)).collect()
    assert all(math.isclose(r["score"], r["n_bytes"] * 8 * math.log10(0.5)) and r["train_tokens"] == 0 for r in blank)


def test_chats_come_back_from_their_format(spark):
    tricky = ["</s>[INST] ok [/INST]", "~1 <|end|> ~0~", "<<SYS>>", "", None, "line\nline", "é\U0001f600 [INST", "[[INST]INST]", "<|turn|>x<|text|>y"]
    rows = [(c, n, ("user", "assistant", "system", None, "<|end|>")[(c + n) % 5], tricky[(c * 3 + n) % 9], "x") for c in range(30) for n in range(c % 7 + 1)]
    rows += [(50, 0, "user", "q", "x"), (50, 1, "assistant", "a", "x"), (51, 0, "system", "s", "x"), (51, 1, "user", "q", "x"), (51, 2, "assistant", "a~", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, formatted string")
    records = chat.canonical(chat.layouts(df))
    assert records.where("layout IS NULL").count() == 0 and records.select("layout").distinct().count() >= 4
    back = chat.read_back(chat.formatted(records).select("conv_id", "formatted", "mask"))
    want = collections.defaultdict(list)
    for c, n, r, t, _ in rows:
        want[c].append((n, r or "", t or ""))
    for r in back.collect():
        turns = [(a, b) for _, a, b in sorted(want[r["conv_id"]])]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss_texts"] == [b for a, b in turns if a == "assistant" and b]
    assert chat.canonical(chat.layouts(df.limit(0))).count() == 0


def test_layouts_are_told_apart_by_their_fields(spark):
    schema = (
        "id int, prompt string, response string, instruction string, input string, output string, "
        "messages array<struct<role:string,content:string>>, conversations array<struct<from:string,value:string>>, other string"
    )
    rows = [
        (0, "p", "r", None, None, None, None, None, "x"), (1, None, None, "i", None, "o", None, None, None), (2, None, None, "i", "in", "o", None, None, None),
        (3, None, None, None, None, None, [("user", None), (None, "t")], None, None), (4, None, None, None, None, None, None, [("human", "h"), ("gpt", "g"), ("tool", "t")], None),
        (5, "p", None, None, None, None, None, None, None), (6, None, None, None, None, None, [], None, None),
    ]
    got = {r["id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        0: ("pair", [("user", "p"), ("assistant", "r")]), 1: ("instruction", [("user", "i"), ("assistant", "o")]),
        2: ("instruction_input", [("system", "i"), ("user", "in"), ("assistant", "o")]), 3: ("messages", [("user", ""), ("", "t")]),
        4: ("exchanges", [("user", "h"), ("assistant", "g"), ("tool", "t")]), 5: (None, None), 6: ("messages", []),
    }


def test_the_chat_query_runs_no_python(spark):
    plan = queries.QUERIES["op9_chat_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_folds_are_crc32_of_the_id_as_text(spark):
    df = spark.createDataFrame([(i,) for i in (0, 7, -3, 10**12, None)], "k bigint")
    got = [r[0] for r in df.select(queries.fold(F.col("k"), 10)).collect()]
    assert got == [zlib.crc32(str(i).encode() if i is not None else b"") % 10 for i in (0, 7, -3, 10**12, None)]


def test_chat_digests(spark):
    rows = queries.QUERIES["op9_chat_format"](spark, "/root/testdata/sf0.001").where("conv_id = -7").collect()
    text = "</s>[INST] ok [/INST]"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert [tuple(r)[1:5] for r in rows] == [(2, sha(f"user\n{text}\nassistant\n{text}\n"), len(text), sha(text))]


def test_stretches_of_many_texts_are_those_of_each():
    """Cuts by the first least word pair of every window, found for texts laid end to end."""
    S, rng, held = substrings, np.random.default_rng(3), []
    for row, n in enumerate((1, 2, 20, 21, 22, 60, 400, 5)):
        words = [b"w%d" % i for i in rng.integers(0, 4 if row % 2 else 50, n)]
        held.append((2 * row, b" \n" * (row % 3) + b" ".join(words) + b"\t" * (row % 2), S.word_hashes(words)))
    found = list(zip(*(v.tolist() for v in S.stretches(held)), strict=True))
    wanted, known = [], {}
    for row, text, hashes in held:
        starts, ends = S.word_spans(text)
        pair = S.mixed(hashes[:-1] * S.ODD + hashes[1:])
        cuts = sorted({0, *(j + int(pair[j : j + S.WINDOW].argmin()) for j in range(len(pair) - S.WINDOW + 1))})
        for place, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(starts)], strict=True)):
            wanted.append((row, place, int(starts[a]), int(ends[b - 1]), b - a))
            known.setdefault(hashes[a:b].tobytes(), set()).add(found[len(wanted) - 1][5])
    assert [f[:5] for f in found] == wanted
    assert all(len(v) == 1 for v in known.values()) and len({h for v in known.values() for h in v}) == len(known)
    swapped = S.word_hashes([b"a", b"b"]), S.word_hashes([b"b", b"a"])
    assert len({int(S.stretches([(0, b"x y", h)])[5][0]) for h in swapped}) == 2
