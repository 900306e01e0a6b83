"""Vector operators against brute force."""

import math

import numpy as np
import pytest
from brute import components, top_k
from pyspark.sql import functions as F

from factlake.llm import near_vectors, topk

SCHEMA = "vec_id long, embedding array<float>, label int, key long, v long"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((60, 16))
    rows = []
    for k in range(700):
        x = centres[k % 60] + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.3])
        rows.append((k, [float(np.float32(y)) for y in x], [0, 1, None][k % 60 % 3 if k % 60 < 57 else 2], 1, 2))
    rows += [(1000 + k, rows[0][1], 0, 1, 2) for k in range(40)]  # copies
    rows += [(2000, None, 0, 1, 2), (2001, [0.0] * 16, 0, 1, 2), (2002, [float("nan")] * 16, 0, 1, 2), (2003, [], 0, 1, 2), (2004, [1.0, None], 0, 1, 2), (2005, [float("inf")] * 16, 1, 1, 2), (2050, [1.0, 2.0], 0, 1, 2), (2051, [2.0, 4.0], 0, 1, 2)]
    return rows


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def links_of(rows, least):
    good = [(i, np.array(v), lab) for i, v, lab, *_ in rows if usable(v) and any(v) and lab is not None]
    return [(a, b) for k, (a, x, p) in enumerate(good) for b, y, q in good[:k] if p == q and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least]


def test_near_duplicates_exact_within_a_leaf(llm, vectors):
    got = near_vectors.near_duplicates(llm.createDataFrame(vectors, SCHEMA), 0.93, leaf=2000, trees=1).collect()
    links = links_of(vectors, 0.93)
    of = components([r[0] for r in vectors], links)
    n = dict.fromkeys(of, 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == sorted((i, n[i], of[i], of[i] == i) for i in of)


@pytest.mark.parametrize("rounds", [1, 4])
def test_recall_of_the_forest(llm, vectors, rounds):
    """With many small leaves; one round leaves large nodes, which are compared in blocks."""
    got = near_vectors.near_duplicates(llm.createDataFrame(vectors, SCHEMA), 0.93, leaf=16, rounds=rounds).collect()
    links = links_of(vectors, 0.93)
    found = sum(r["n_links"] for r in got)
    assert 0.97 * 2 * len(links) <= found <= 2 * len(links)


@pytest.mark.parametrize("rows, noise", [(300, 0.1), (3000, 0.3), (10000, 0.1), (6000, "groups")])
def test_recall_of_dense_groups(llm, rows, noise):
    """One label with more different vectors than a leaf holds, all near one another; production parameters."""
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((20 if noise == "groups" else 1, 64))
    x = (centres[np.arange(rows) % len(centres)] + (0.25 if noise == "groups" else noise) * rng.standard_normal((rows, 64))).astype(np.float32)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    table = llm.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors.near_duplicates(table, 0.93).collect()}
    assert len(got) == rows and all(got[k] <= links[k] for k in got)
    assert sum(got.values()) >= 0.9 * links.sum() > 0


def test_blocks_lose_nothing(llm, vectors, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 20)
    got = near_vectors.near_duplicates(llm.createDataFrame(vectors, SCHEMA), 0.93, leaf=5, trees=1, rounds=0).collect()
    assert sum(r["n_links"] for r in got) == 2 * len(links_of(vectors, 0.93))


@pytest.mark.parametrize("annulus, first", [(2048, 2048), (8, 10)])
def test_top_k(llm, vectors, annulus, first):
    table = llm.createDataFrame(vectors, SCHEMA)
    got = topk.top_k(table, table.where("vec_id % 50 = 0"), 5, n_pivots=7, annulus_rows=annulus, first_rows=first).collect()
    rows = {i: [math.floor(256 * x) for x in v] for i, v, *_ in vectors if usable(v)}
    want = []
    for size in {len(v) for v in rows.values()}:
        own = {i: v for i, v in rows.items() if len(v) == size}
        want += top_k(own, [i for i in own if i % 50 == 0], 5)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)


def test_top_k_leaves_most_rows_of_clusters_unvisited(llm):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((60, 32))
    x = centres[np.arange(6000) % 60] * (1 + 0.2 * rng.random((6000, 1))) + 0.1 * rng.standard_normal((6000, 32))
    table = llm.createDataFrame([(k, v.tolist()) for k, v in enumerate(x.astype(np.float32))], "vec_id long, embedding array<float>").repartition(2)
    found, visits = topk.search(table, table.where("vec_id % 100 = 0"), 5, n_pivots=150, annulus_rows=32, first_rows=64)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk._ranked(found, 5).collect())
    v = np.floor(256 * x.astype(np.float32).astype(np.float64)).astype(np.int64)
    want = []
    for i in range(0, 6000, 100):
        score = v @ v[i]
        best = [int(j) for j in np.lexsort((np.arange(6000), -score)) if j != i][:5]
        want += [(i, r, j, int(score[j])) for r, j in enumerate(best, 1)]
    assert got == sorted(want)
    share = visits.agg(F.sum("n")).first()[0] / (60 * 6000)
    assert share < 0.2, share
    assert visits.groupBy("query_id", "size", "pivot", "annulus").count().where("count > 1").isEmpty()


def test_no_vectors(llm):
    none = llm.createDataFrame([], SCHEMA)
    assert near_vectors.near_duplicates(none).count() == 0
    assert topk.top_k(none, none).count() == 0
