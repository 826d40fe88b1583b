"""Merkle manifest, ranked search and license scan against brute-force versions, and odd rows."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from check import compare, database
from turnpress.llm import checks, licenses, manifest, queries, search

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_lexical_search", "op13_license_scan"])
def test_query_against_sql(spark, name):
    problem, n = compare(spark, database(SMALL), SMALL, queries.QUERIES[name], checks.CHECKS[name])
    assert problem is None and n > 0


# --- Merkle manifest ---

def digest(*parts):
    return sha256(b"".join(parts)).hexdigest().encode()


def leaf(row):
    i, text, lang, source, n = row
    fields = [b"-" if v is None else b"%d:%b" % (len(str(v).encode()), str(v).encode()) for v in (i, source, lang, n, text)]
    return digest(*fields)


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, i):
    out = []
    for nodes in tree[:-1]:
        a = i // 16 * 16
        out.append((nodes[a:i], nodes[i + 1 : a + 16]))
        i //= 16
    return out


def plain_manifest(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([leaf(r) for r in groups[s]]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            proof, text = path(trees[k], i) + path(top, k), r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate(str.maketrans(UPPER, LOWER))
            d = leaf((r[0], text, *r[2:]))
            for left, right in proof:
                d = digest(*left, d, *right)
            siblings = [x for left, right in proof for x in left + right]
            out.append((r[0], leaf(r).decode(), trees[k][-1][0].decode(), top[-1][0].decode(), digest(*siblings).decode(), d.decode()))
    return sorted(out, key=repr)


def proved(df, **more):
    claims = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    return manifest.manifest(df, claimed={"text": F.translate("text", UPPER, LOWER)}, claims=claims, **more)


def many_rows():
    rng = random.Random(3)
    rows = [
        (i, None if i % 11 == 0 else f"Text {i} Äß", None if i % 7 == 0 else "en", rng.choice(["a", "a", "a", "bé", None, "", f"c{i % 300}"]), i)
        for i in range(9000)
    ]
    return rows + [(5, "Same", "en", "a", 1)] * 600 + [(None,) * 5] * 3


@pytest.mark.parametrize("rows", [many_rows(), many_rows()[:1], [(i, "T", "en", "s", 1) for i in range(17)], [(i, "T", "en", str(i), 1) for i in range(40)]])
def test_manifest_equals_brute_force(spark, rows):
    got = proved(spark.createDataFrame(rows, DOCS).repartition(5))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(rows)


def test_manifest_without_rows(spark):
    assert proved(spark.createDataFrame([], DOCS)).collect() == []


def test_proofs_lead_to_the_root_and_only_from_their_leaf(spark):
    rows = [(i, f"t {i}", "en", "ab"[i % 2], i) for i in range(700)]
    extra = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("tree", "pos", "leaf", "root", "part", "block", "digest")})
    out = manifest.manifest(extra, with_proof=True).collect()
    for r in out:
        proof = manifest.parsed(r["proof"].encode())
        assert manifest.folded(r["leaf"].encode(), proof).decode() == r["root"] == r["folded_root"]
        assert manifest.folded(digest(b"other"), proof).decode() != r["root"]
    assert len({r["root"] for r in out}) == 1 and len({r["subroot"] for r in out}) == 2


@pytest.mark.parametrize("n,alone", [(1, True), (1, False), (16, True), (17, True), (300, False), (4096, False)])
def test_sweeps_of_a_block(n, alone):
    leaves = [digest(b"%d" % i) for i in range(n)]
    nodes, top = manifest.sweep(leaves, alone)
    assert [label for label, _ in nodes] == sorted(label for label, _ in nodes)
    for one, proof in zip(leaves, manifest.sweep_back(leaves, nodes, [(b"", b"x")])):
        assert manifest.folded(one, proof) == digest(top, b"x")


# --- ranked search ---

def plain_search(docs, items, top):
    word = re.compile(search.TERM)
    terms = lambda t: word.findall((t or "").translate(str.maketrans(UPPER, LOWER)))
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if c[t]
            )
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, top=50, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("score", "rank", "item", "term", "doc")})
    i = spark.createDataFrame(items, "item_id int, text string").withColumn("block", F.lit(1))
    return sorted(map(tuple, search.search(d.repartition(3), i, top, **more).collect()), key=repr)


def odd_texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "ß", "日本"]
    docs = [(i, " ".join(rng.choices(vocabulary[: rng.randint(3, 63)], k=rng.randint(0, 60)))) for i in range(700)]
    docs += [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 w2"), (900, None), (901, ""), (902, "w1," * 5000), (903, "---")] + [(i, "W3-w4") for i in range(1000, 1200)]
    items = [(1, "w1 w2 W2"), (2, "w3 w4 nowhere"), (3, None), (4, "!!"), (5, " ".join(vocabulary) + " " + " ".join(f"x{i}" for i in range(90)))]
    return docs, items + [(6, "w5"), (6, "w6 w5"), (None, "ß 日本")]


@pytest.mark.parametrize("top,pairs", [(50, 10**6), (3, 4)])
def test_search_equals_brute_force(spark, top, pairs):
    docs, items = odd_texts()
    assert searched(spark, docs, items, top, pairs=pairs) == plain_search(docs, items, top)


def test_search_over_several_blocks(spark, monkeypatch):
    docs, items = odd_texts()
    monkeypatch.setattr(search, "DOCS", 64)
    monkeypatch.setattr(search, "POSTINGS", 500)
    assert searched(spark, docs, items, 5) == plain_search(docs, items, 5)


def test_search_without_rows(spark):
    docs, items = odd_texts()
    assert searched(spark, [], items) == searched(spark, docs, []) == searched(spark, [(1, "--")], items) == []


def test_masks_below_the_bound_are_left_unscored():
    rng = np.random.default_rng(1)
    ids = list(range(4000))
    rare = 3950  # the last documents alone hold the heavy term
    held = [np.arange(4000), np.arange(0, 4000, 2), np.arange(rare, 4000)]
    row = {
        "ids": ids, "sizes": np.full(4000, 100).tobytes(), "present": [0, 1, 2], "held": [len(h) for h in held],
        "at": np.concatenate(held).astype(np.uint16).tobytes(), "tf": rng.integers(1, 3, sum(map(len, held))).astype(np.int32).tobytes(),
    }
    best = search.Best(50)
    scored = search.Block(row, (4000, 400_000)).search([0, 1, 2], np.array([10, 20, 9000]), best)
    assert set(best.ids) == set(range(rare, 4000)) and scored <= 200


# --- license scan ---

def wording(parts):
    """A template as a regular expression over words that each end in a space."""
    kinds = {licenses.ANY: r"\S+", licenses.NUMBER: "[0-9]+"}
    out = ""
    for p in parts:
        if isinstance(p, licenses.Region):
            out += "(?:(?:%s) ){%d,%d}" % ("|".join(kinds.get(w, w) for w in p.words), p.low, p.high)
        else:
            out += p + " " if isinstance(p, str) else f"(?:{wording(p)})?"
    return out


def scanned(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumns({c: F.lit(0) for c in ("base", "n_words", "found")})
    rows = licenses.scan(df, **more).orderBy("doc_id").collect()
    return [r["licenses"].asDict(True) for r in rows]


def test_templates_accept_their_own_wording_and_nothing_less(spark):
    texts = {}
    for label, markup in licenses.TEMPLATES.items():
        words = []
        for p in licenses.parse(markup):
            if isinstance(p, licenses.Region):
                words += [{licenses.ANY: "thing", licenses.NUMBER: "7"}.get(p.words[0], p.words[0])] * max(p.low, 1)
            elif isinstance(p, str):
                words.append(p.upper())
        texts[label] = words
    rows = scanned(spark, [" lorem. " + ", ".join(w) + " ipsum" for w in texts.values()])
    for label, r, words in zip(texts, rows, texts.values()):
        spans = [(f["word"], f["end"]) for f in r["found"] if f["label"] == label]
        assert spans == [(1, 1 + len(words))], label
    # A mandatory word in the middle replaced: no match.
    broken = []
    for label, words in texts.items():
        held = licenses.anchor(licenses.parse(licenses.TEMPLATES[label])).upper().split()
        at = next(i for i in range(len(words)) if words[i : i + len(held)] == held)
        broken.append(" ".join(words[:at] + ["other"] + words[at + 1 :]))
    for label, r in zip(texts, scanned(spark, broken)):
        assert label not in {f["label"] for f in r["found"]}


def test_automata_equal_regular_expressions():
    rng = random.Random(2)
    markup = "a [[b [[c]] {{1-2 number}}]] {{x | y}} {{0-2}} d [[e]]"
    parts, automaton = licenses.parse(markup), licenses.Automaton(licenses.parse(markup))
    for _ in range(3000):
        words = ["a", *rng.choices(["a", "b", "c", "d", "e", "x", "y", "1", "22", "z"], k=rng.randint(0, 9))]
        line = "".join(w + " " for w in words)
        ends = [k for k in range(1, len(words) + 1) if re.fullmatch(wording(parts), "".join(w + " " for w in words[:k]))]
        assert automaton.longest(words, 0) == max(ends, default=-1), line


def test_base_phrases_and_odd_texts(spark):
    long = "word " * 300_000 + "MIT\tLicense"
    rows = scanned(spark, ["mit license mit license cc-by", None, "", "mitlicense mit licenses", long, "Released under the MIT License."])
    assert [(p["label"], p["word"]) for p in rows[0]["base"]] == [("cc-by", 4), ("mit", 0), ("mit", 2)]
    assert rows[1] == rows[2] == {"n_words": 0, "base": [], "found": []}
    assert rows[3]["base"] == [] and rows[4]["base"] == [{"label": "mit", "word": 300_000}]
    assert rows[5]["found"] == [{"label": "mit-notice", "word": 0, "end": 5}]
    assert licenses.scan(spark.createDataFrame([], "text string")).collect() == []


@pytest.mark.parametrize("markup", ["{{1-3}} license", "[[a]] {{0-2 number}}", "[[a", "{{a | b}}"])
def test_templates_that_would_match_anything_are_refused(spark, markup):
    with pytest.raises(ValueError):
        licenses.scan(spark.range(1).select(F.lit("x").alias("text")), templates={"t": markup})
