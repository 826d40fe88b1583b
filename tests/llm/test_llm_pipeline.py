"""The pipeline's stages one by one, each against brute force on its own input."""

import collections
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from turnpress.llm import mixing, queries, simhash, substrings
from turnpress.llm.common import fold, read

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    inputs = [read(spark, SF, "documents")]
    for name, stage in pipeline.STAGES:
        stage(spark, inputs[-1], SF).write.parquet(str(folder / name))
        inputs.append(spark.read.parquet(str(folder / name)))
    return inputs


def test_all_but_the_last_keep_the_columns(stages):
    for after in stages[1:-1]:
        assert after.dtypes == stages[0].dtypes


def test_quality_keeps_what_the_classifier_accepts(spark, stages):
    scored = queries.QUERIES["op7_quality_discriminant"](spark, SF)
    want = {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    assert {r["doc_id"] for r in stages[1].collect()} == want
    assert 0 < len(want) < stages[0].count()


def test_one_document_of_each_group_stays(stages):
    found = simhash.near_duplicates(stages[1]).collect()
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted({r["component_id"] for r in found})


def test_no_long_line_is_left_twice(stages):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    lines = collections.Counter()
    for r in stages[3].collect():
        assert r["n_chars"] == len(r["text"]) and word.search(r["text"])
        lines.update({" ".join(w).lower() for line in r["text"].split("\n") if len(w := word.findall(line)) >= 25})
    assert max(lines.values()) == 1
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    assert all(len(r["text"]) <= len(before[r["doc_id"]]) for r in stages[3].collect())


def test_documents_enter_as_often_as_the_mix_says(stages):
    times = {r["doc_id"]: r["times"] for r in mixing.mix(stages[3]).collect()}
    assert collections.Counter(r["doc_id"] for r in stages[4].collect()) == collections.Counter({i: n for i, n in times.items() if n})


def test_tokens_are_those_of_the_texts(stages):
    codec = queries.vocabulary()
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        assert b"".join(codec.tokens[i] for i in r["ids"]).decode() == texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"])


def test_stages_take_empty_and_odd_rows(spark):
    schema = read(spark, SF, "documents").schema
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "word " * 60, "en", "s", 1), (3, "a b c " * 40, None, None, 2), (3, "a b c " * 40, None, None, 2)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema).withColumn("score", F.lit(1)).withColumn("size", F.lit(2))
        for _, stage in pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= 3 * max(1, len(rows))
    assert fold(F.col("doc_id"), 4) is not None


ROWS = "doc_id bigint, text string, source string"


def test_one_id_with_two_texts_is_two_documents(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, passage + ".", "a"), (2, passage + " and more", "a"), (2, "é" * 400 + " aé", "a"), (2, "é" * 400 + " aé", "a"), (3, "a" + "é" * 500, "b")]
    docs = spark.createDataFrame(rows, ROWS).repartition(3)
    spans = substrings.repeats(docs)
    assert {(r["doc_id"], r["class_id"]) for r in spans.where("NOT kept").collect()} == {(2, 1)}
    left = sorted(r["text"] for r in substrings.without_repeats(docs, spans).collect())
    assert left == sorted([passage + ".", "é" * 400 + " aé", "é" * 400 + " aé", "a" + "é" * 500])
    kept = pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["doc_id"] != 3) == sorted({(i, t) for i, t, _ in rows if i == 1 or t.startswith("é")})


@pytest.mark.parametrize("names", [
    ["_score", "_key", "_spans", "_touched", "_cut", "_name", "_size"],
    ["score", "key", "size", "found", "touched", "named", "of", "document", "digest", "source_size", "target"],
])
def test_stages_keep_columns_of_any_name(spark, names):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 97}" for k in range(40)), "ab"[i % 2]) for i in range(30)]
    docs = spark.createDataFrame(rows, ROWS).withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    labels = "/root/testdata/sf0.001"
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, labels)
        assert out.columns == docs.columns
        for r in out.collect():
            assert all(r[n] == f"{n}{r['doc_id']}" for n in names)
