"""Near-duplicate vectors against all pairs, and queries over the small tables."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from check import compare, database
from turnpress.llm import checks, neighbours, queries


def truth(vectors, least=0.95):
    """(links, component) per row by comparing all."""
    unit = [None if v is None else neighbours.unit(np.array(v, np.float32)) if None not in v else None for v in vectors]
    near = [[b for b in range(len(unit)) if b != a and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least] for a in range(len(unit))]
    root = list(range(len(unit)))
    for _ in unit:
        root = [min([root[a], *(root[b] for b in near[a])]) for a in range(len(unit))]
    return [len(n) for n in near], root


def sample():
    draw = np.random.default_rng(0)
    base = draw.standard_normal((60, 16))
    rows = [b for b in base for _ in range(1)]
    rows += [b + s * draw.standard_normal(16) for b in base[:20] for s in (0.02, 0.1, 0.2)]
    rows += [base[0]] * 5 + [base[1] * 3] + [base[2] + 0.01 * draw.standard_normal(16) for _ in range(40)]
    made = [[float(x) for x in r] for r in rows]
    return made + [None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] + [0.0] * 15, [1.0, 2.0], [2.0, 4.0]]


@pytest.mark.parametrize("cap", [8, 1024])
def test_links_and_components_of_all_pairs(spark, cap):
    vectors = sample()
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)] + [(None, vectors[0], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, digest int, id string")
    got = {r["id"]: r for r in neighbours.near_duplicates(df, tables=120, width=8, cap=cap).collect()}
    links, component = truth(vectors)
    assert len(got) == len(rows)
    none = got.pop(None)
    assert none["n_links"] == 0 and none["component_id"] is None and not none["kept"]
    assert [got[i]["n_links"] for i in range(len(vectors))] == links
    assert [got[i]["component_id"] for i in range(len(vectors))] == component
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_production_parameters_reach_the_recall(spark):
    draw = np.random.default_rng(1)
    base = draw.standard_normal((400, 64))
    noise = draw.standard_normal((400, 64))
    noise -= base * ((noise * base).sum(1) / (base * base).sum(1))[:, None]
    noise *= (np.linalg.norm(base, axis=1) / np.linalg.norm(noise, axis=1))[:, None]
    cosine = draw.uniform(0.951, 1, 400)[:, None]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * noise]))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = sum(r["n_links"] for r in neighbours.near_duplicates(df).collect())
    assert found >= 0.97 * 800


def test_one_id_with_two_vectors(spark):
    """Vectors link by what they are; an id that two rows share links nothing by itself."""
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [0.0, 2.0, 0.0]), (3, [0.0, 0.0, 1.0])]
    found = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted((r["id"], r["n_links"], r["component_id"]) for r in found) == [(1, 0, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_no_vectors(spark):
    assert neighbours.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_covers_its_table(spark, name):
    sf = "/root/testdata/sf0.001"
    df = queries.QUERIES[name](spark, sf)
    table = {"op1": "embeddings", "op9": "conversations", "op12": "benchmark"}.get(name.split("_")[0], "documents")
    key = {"embeddings": "vec_id", "conversations": "conv_id", "benchmark": "item_id"}.get(table, "doc_id")
    ids = {r[0] for r in df.select(key).collect()}
    want = set(pq.read_table(f"{sf}/{table}.parquet").column(key).to_pylist())
    if name.startswith("op10"):
        assert ids <= want
    else:
        assert ids - {-7} == want


@pytest.mark.parametrize("name", sorted(checks.CHECKS))
def test_queries_agree_with_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, database(sf), sf, queries.QUERIES[name], checks.CHECKS[name])[0] is None
