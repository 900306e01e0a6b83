"""Hard negatives and the threshold join against brute force."""

import math

import numpy as np
import pandas as pd
import pytest

from factlake.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, band long, norm string, size int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, is_anchor, n_pos=5, n_neg=5, percent=80):
    good = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab, *_ in rows if i is not None and lab is not None and usable(v)]
    out, done = [], set()
    for a, v, lab in sorted(good, key=lambda r: (r[0], r[2], r[1])):
        if not is_anchor(a) or a in done:
            continue
        done.add(a)
        scored = [(-sum(x * y for x, y in zip(v, w)), b, m) for b, w, m in good if b != a and len(w) == len(v)]
        positives = sorted((s, b) for s, b, m in scored if m == lab)[:n_pos]
        for p, b in positives:
            fits = sorted((s, c) for s, c, m in scored if m != lab and percent * -p <= 100 * -s <= 100 * -p)[:n_neg]
            out += [(a, b, k + 1, c, -p, -s) for k, (s, c) in enumerate(fits)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((12, 20))
    rows = []
    for k in range(600):
        x = centres[k % 12] * rng.choice([0.5, 1, 3]) + rng.standard_normal(20) * rng.choice([0.05, 0.5])
        rows.append((k, [float(np.float32(y)) for y in x], [0, 1, 1, 2, None][k % 5], 1, "x", 2))
    rows += [(1000 + k, rows[20][1], k % 2, 1, "x", 2) for k in range(30)]  # ties
    rows += rows[:5] + rows[20:24]  # repeated rows
    rows += [(2000, None, 0, 1, "x", 2), (2020, [0.0] * 20, 0, 1, "x", 2), (2021, [float("nan")] * 20, 0, 1, "x", 2), (2040, [], 0, 1, "x", 2), (2041, [], 0, 1, "x", 2), (2042, [], 1, 1, "x", 2)]
    rows += [(2060, [1.0, None], 0, 1, "x", 2), (2080, [1.0, 2.0], 0, 1, "x", 2), (2081, [2.0, 4.0], 0, 1, "x", 2), (2082, [2.0, 3.5], 3, 1, "x", 2), (None, [1.0, 2.0], 1, 1, "x", 2)]
    return rows


@pytest.mark.parametrize("block, sample", [(4096, 4096), (40, 60)])
def test_mine(llm, vectors, monkeypatch, block, sample):
    monkeypatch.setattr(hard_negatives, "QUERY_ROWS", 16)
    monkeypatch.setattr(hard_negatives.threshold_join, "__defaults__", (block,))
    table = llm.createDataFrame(vectors, SCHEMA)
    got = hard_negatives.mine(table, table.where("vec_id % 20 = 0"), sample_rows=sample)
    assert sorted(tuple(r) for r in got.collect()) == brute(vectors, lambda i: i % 20 == 0)


def test_empty(llm):
    none = llm.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(none, none).count() == 0


@pytest.mark.parametrize("low", [-math.inf, -50.0, 0.0, 400.0, 900.0])
def test_candidates_lose_nothing_and_prune(low):
    rng = np.random.default_rng(2)
    x = np.floor(rng.standard_normal((500, 30)) * np.linspace(9, 1, 30))
    q = x[:40]
    i, j, work = hard_negatives.candidates(q, np.full(40, low), x)
    got = set(zip(i.tolist(), j.tolist()))
    scores = q @ x.T
    assert got >= set(zip(*(z.tolist() for z in np.nonzero(scores >= low))))
    full = 40 * 500 * 30
    assert work <= full and (low < 900 or work < 0.4 * full and len(got) < 0.05 * 40 * 500)


@pytest.mark.parametrize("noise", [0.05, 0.3, 1.0])
@pytest.mark.parametrize("share", [1.0, 0.95, 0.8])
def test_candidates_keep_rows_that_the_index_leaves_out(noise, share):
    rng = np.random.default_rng(1)
    for dims in (16, 24, 64):
        centres = rng.standard_normal((3, dims))
        x = np.floor(256 * (centres[rng.integers(0, 3, 200)] + noise * rng.standard_normal((200, dims))))
        q = x[:20]
        scores = q @ x.T
        low = np.sort(scores, axis=1)[:, -6] * share
        i, j, _ = hard_negatives.candidates(q, low, x)
        assert set(zip(i.tolist(), j.tolist())) >= set(zip(*(z.tolist() for z in np.nonzero(scores >= low[:, None]))))


def test_scores_beyond_doubles_are_exact():
    v = [[2**31 + 1, 3], [2**30 + 7, -5]]
    queries = pd.DataFrame({"query_id": [1], "v": [v[0]], "windows": [[{"window": 0, "low": -(1 << 63), "high": (1 << 63) - 1}]]})
    rows = pd.DataFrame({"vec_id": [2], "v": [v[1]]})
    order = hard_negatives.Order.__new__(hard_negatives.Order)
    order.of = {}
    found, _ = hard_negatives.best_in_windows(queries, rows, 5, order)
    assert found["score"].tolist() == [(2**31 + 1) * (2**30 + 7) - 15]
