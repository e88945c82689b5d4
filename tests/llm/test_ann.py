import math

import numpy as np
import pytest

from lodeflow.llm import ann

SCHEMA = "vec_id bigint, embedding array<double>"


def plain(rows, k=10, every=100):
    """Each query against every row."""
    best = {}
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for q, a in ok:
        if q % every:
            continue
        for i, b in ok:
            if i != q and len(a) == len(b):
                d = float(np.sqrt(((np.array(a) - np.array(b)) ** 2).sum()))
                best.setdefault(q, {})[i] = min(d, best.get(q, {}).get(i, math.inf))
    return {q: sorted((d, i) for i, d in c.items())[:k] for q, c in best.items()}


def run(spark, rows, schema=SCHEMA, **more):
    out = {}
    for r in ann.search(spark.createDataFrame(rows, schema), **more).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


def recall(got, want):
    return sum(len({i for _, i in got.get(q, [])} & {i for _, i in w}) for q, w in want.items()) / sum(len(w) for w in want.values())


def rows_of(x, start=0):
    return [(start + i, [float(a) for a in v]) for i, v in enumerate(x)]


def test_edges_are_exact(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (10, [4.0, 6.0]), (10, [4.0, 6.0]), (10, [1.0, 2.5]), (20, None), (30, [0.0, 0.0]), (40, [math.nan, 1.0]), (50, [None, 1.0]), (60, [math.inf, 1.0]), (None, [1.0, 1.0]), (70, []), (80, [3.0]), (90, [3.0, 4.0, 5.0]), (-10, [-1.0, 0.0]), (5, [1e200, 1.0]), (15, [1e-200, 1e-200]), (25, [5.0])]
    assert run(spark, rows, k=3, every=10, parts=1) == plain(rows, 3, 10)
    assert run(spark, []) == {}
    assert run(spark, [(1, [1.0])]) == {}
    assert run(spark, [(0, [1.0])]) == {}
    assert run(spark, [(0, [0.0])]) == {}


def test_ties_and_a_hot_vector(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-2, 3, (900, 4)).astype(float)
    x[rng.random(900) < 0.4] = [1.0, 1.0, 0.0, 2.0]
    rows = rows_of(x)
    told = {}
    got = run(spark, rows, every=10, told=told)
    want = plain(rows, every=10)
    assert recall(got, want) >= 0.9 and told["parts"] > 1
    assert run(spark, rows, every=10, parts=1) == want
    for q, found in got.items():
        true = {i: d for d, i in plain(rows, 10**6, 10)[q]} if q < 30 else None
        assert true is None or all(true[i] == d for d, i in found)


@pytest.mark.parametrize("kind", ["clusters", "everywhere"])
def test_recall(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 16))
    if kind == "clusters":
        x = rng.standard_normal((40, 16))[rng.integers(0, 40, 4000)] * 3 + x * 0.3
    rows, told = rows_of(x), {}
    got, want = run(spark, rows, every=50, told=told), plain(rows, every=50)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert recall(got, want) >= 0.9
    if kind == "clusters":
        assert told["probes"] <= told["parts"] // 4
    true = {(q, i): d for q, w in want.items() for d, i in w}
    assert all(d == true[q, i] for q, v in got.items() for d, i in v if (q, i) in true)


def test_blocks_do_not_change_results(spark, monkeypatch):
    x = np.random.default_rng(7).standard_normal((600, 8))
    rows = rows_of(x)
    monkeypatch.setattr(ann, "BLOCK_VALUES", 64 * 8)
    assert run(spark, rows, every=2, parts=1) == plain(rows, every=2)


def test_partition_is_balanced_and_follows_the_graph(spark):
    rng = np.random.default_rng(1)
    x = np.repeat(np.eye(8) * 9, 32, axis=0) + rng.standard_normal((256, 8)) * 0.2
    near = ann.graph(spark, x)
    for i in range(256):
        assert set(near[i]) == set(np.argsort(((x - x[i]) ** 2).sum(axis=1), kind="stable")[1:11])
    label = ann.partition(x, near, 8)
    assert np.bincount(label).tolist() == [32] * 8
    assert (label[near] == label[:, None]).mean() > 0.8


def test_clashing_columns_and_floats(spark):
    rows = [(i, [float(i), 1.0], "x", 1, 2) for i in range(30)]
    got = run(spark, rows, "vec_id bigint, embedding array<float>, v string, part int, query_id int", k=2, every=10)
    assert got[10] == [(1.0, 9), (1.0, 11)]
