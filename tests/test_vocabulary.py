"""Vocabularies from files, against the public libraries that read the same files."""

import base64
import json

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from turnpress.catalog import QUERIES, inputs
from turnpress.functions.tokens import TURN_CLOSE, TURN_OPEN, resolve_pad
from turnpress.functions.vocabulary import Encoder, VocabularyTokenizer, merged, read_vocabulary
from turnpress.operators.tokenize import tokenize

RANKS, JSON = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json"))
SF = "/root/testdata/sf0.001"
ODD = ["", " ", "\n\n  a", "don't I'LL", "naïve Ωμέγα 中文字 🙂🙂", "x" * 5000, "ab" * 3000, " " * 999, "1234567 89", "\x00 ­", "é"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoder, texts):
    return encoder.lists(pa.array([texts], pa.list_(pa.string()))).to_pylist()[0]


@pytest.mark.parametrize("path", [RANKS, JSON])
def test_ids_are_those_of_the_library(library, path):
    assert ids_of(Encoder(read_vocabulary(path)), ODD) == [library.encode_ordinary(t) for t in ODD]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, text):
    encoder = test_any_text.__dict__.setdefault("encoder", Encoder(read_vocabulary(RANKS)))
    if not any(marker in text for marker in encoder.vocabulary.specials):
        assert ids_of(encoder, [text]) == [library.encode_ordinary(text)]


def test_special_tokens_are_cut_out_first():
    text = "a<|endoftext|>b <|im_start|><|endoftext|>"
    assert ids_of(Encoder(read_vocabulary(JSON)), [text]) == [Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids]
    ranked = ids_of(Encoder(read_vocabulary(RANKS)), [TURN_OPEN + "x" + TURN_CLOSE])[0]
    assert (ranked[0], ranked[-1], len(ranked)) == (50257, 50258, 3)


def test_long_pieces_do_not_take_quadratic_time():
    ranks = read_vocabulary(RANKS).ranks
    assert b"".join(merged(b"ab" * 200_000, ranks)) == b"ab" * 200_000


def test_nulls_and_empty_batches():
    encoder = Encoder(read_vocabulary(RANKS))
    column = pa.array([None, [], ["hi", None, ""], None], pa.list_(pa.string()))
    assert encoder.lists(column).to_pylist() == [None, [], [encoder.piece("hi"), [], []], None]
    assert encoder.lists(column.slice(1, 2)).to_pylist() == [[], [encoder.piece("hi"), [], []]]
    assert encoder.lists(column.slice(0, 0)).to_pylist() == []


def test_other_kinds_of_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    whole = json.load(open(JSON))
    whole["model"]["merges"].append(whole["model"]["merges"][0])
    (tmp_path / "twice.json").write_text(json.dumps(whole))
    with pytest.raises(ValueError):
        read_vocabulary(str(tmp_path / "twice.json"))


def test_examples_with_a_vocabulary(spark, library):
    tokenizer = VocabularyTokenizer(RANKS)
    assert resolve_pad(tokenizer) == 50256 and resolve_pad(VocabularyTokenizer(JSON)) == 50256
    examples = inputs.conversations(spark, SF)
    rows = tokenize(examples, tokenizer).where("input_ids IS NOT NULL").collect()
    assert rows
    plain = {v: k for k, v in read_vocabulary(RANKS).specials.items()}
    for r in rows:
        assert len(r["input_ids"]) == len(r["labels"]) == r["n_tokens"]
        assert all(a in (b, -100) for a, b in zip(r["labels"], r["input_ids"], strict=True) if a != -100)
        assert plain[r["input_ids"][0]] == TURN_OPEN


def test_the_query_covers_whole_documents(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["tokenize_vocabulary"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["ord"]])
        assert (r["n_tokens"], r["id_sum"]) == (len(ids), sum(ids))
        assert r["id_moment"] == sum(i * x for i, x in enumerate(ids, 1))


def test_only_the_ids_cross_into_python(spark):
    plan = QUERIES["tokenize_vocabulary"](spark, SF).select(F.sum("n_tokens"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange hashpartitioning" not in plan
