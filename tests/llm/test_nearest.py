from __future__ import annotations

import numpy as np
import pytest

from blotter.llm import nearest as N

SCHEMA = "vec_id long, embedding array<float>, extra string, score int"


def _brute(rows, queries, k):
    out = []
    for q in sorted(set(queries)):
        v = np.array(next(v for i, v in rows if i == q), np.float64)
        found = set()
        for i, w in rows:
            if i == q or len(w) != len(v):
                continue
            w = np.array(w, np.float64)
            found.add((-N.cosine(v[None, :], w[None, :])[0], i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("blocks", [(1024, 4096), (3, 16)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(N, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(N, "CANDIDATE_BLOCK", blocks[1])
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=24).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 380)]                      # a tie of many
    rows += [(i, (np.array(rows[1][1]) * i).tolist()) for i in range(400, 410)]
    rows += [(500, [1.0, 2.0, 3.0]), (550, [3.0, 2.0, 1.0]), (551, [-1.0, -2.0, -3.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    odd = [(600, None), (650, []), (651, [0.0] * 24), (652, [float("nan")] + [1.0] * 23), (653, [float("inf")] * 24),
           (654, [None] + [1.0] * 23), (None, rows[0][1]), (50, rows[50][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], SCHEMA).repartition(4)
    got = N.nearest(df, df.filter("vec_id % 50 = 0"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    want = _brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    assert sorted(map(tuple, got.collect())) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(0, [1.0, 2.0], "x", 1)], SCHEMA)
    assert N.nearest(none, none).count() == N.nearest(some, some).count() == N.nearest(some, none).count() == 0


def test_error_bounds_hold():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(60, 16)) * rng.choice([1, 1e-6, 1e9], (60, 1))
    a[0, 1:] = 0
    code, scale, error = N._quantised(a)
    unit = a / np.linalg.norm(a, axis=1, keepdims=True)
    approx = (code.astype(float) @ code.T.astype(float)) * scale[:, None] * scale[None, :]
    slack = error[:, None] + (1 + error[:, None]) * error[None, :]
    assert (np.abs(unit @ unit.T - approx) <= slack + 1e-12).all()


def test_neighbours_repeated_in_one_tile(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=24)
    rows = [(0, base)] + [(i, base + 0.05 * i * rng.normal(size=24)) for i in range(1, 8)]
    rows = [(i, v.astype(np.float32)) for i, v in rows]
    rows += [(i, w) for i, v in rows[1:] for w in (v, v, v, v, v, v * 2, v * 4)]  # equal rows, and equal scores
    rows += [(100 + i, rng.normal(size=24).astype(np.float32)) for i in range(200)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).coalesce(1)
    got = sorted(map(tuple, N.nearest(df, df.filter("vec_id in (0, 3)")).collect()))
    assert got == _brute(rows, [0, 3], 5) and len(got) == 10
