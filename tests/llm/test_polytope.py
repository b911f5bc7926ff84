from __future__ import annotations

import numpy as np
import pytest

from blotter.llm import polytope as P
from blotter.llm.nearest import cosine

SCHEMA = "vec_id long, embedding array<float>, label int, node string, code long, n_links int"


def plain(rows, threshold=0.98):
    """(vec_id, n_links, component_id, kept) by comparing all pairs of a label."""
    good = {i: np.array(v, np.float64) for i, (d, v, label) in enumerate(rows)
            if d is not None and label is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    links = {i: set() for i in range(len(rows))}
    for i, x in good.items():
        for j, y in good.items():
            if j > i and rows[i][2] == rows[j][2] and len(x) == len(y) and cosine(x[None], y[None])[0] >= threshold:
                links[i].add(j)
                links[j].add(i)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        todo, mine = [i], {i}
        while todo:
            more = links[todo.pop()] - mine
            mine |= more
            todo += more
        seen |= mine
        least = min((rows[j][0] for j in mine), default=None) if len(mine) > 1 else rows[i][0]
        for j in mine:
            out[j] = (rows[j][0], len(links[j]), least, rows[j][0] == least)
    return sorted(out, key=str)


def found(spark, rows, parts=4, schema=SCHEMA):
    df = spark.createDataFrame([(d, v, label, "x", 1, 2) for d, v, label in rows], schema).repartition(parts)
    out = P.near_duplicates(df)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=str)


def floats(v):
    return [float(np.float32(x)) for x in v]


def vectors(rng, n, dim, copies):
    base = rng.normal(size=(n, dim))
    rows = [(i, floats(v), int(i % 3)) for i, v in enumerate(base)]
    for k in range(copies):
        v = base[rng.integers(n)]
        noise = rng.normal(size=dim) * np.linalg.norm(v) / np.sqrt(dim)
        rows.append((1000 + k, floats(v * rng.choice([1, 1, 7.5]) + noise * rng.choice([0, 0.05, 0.15, 0.2, 0.3])), int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("block", [2048, 40])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = vectors(rng, 200, 24, 300)
    centre = rng.normal(size=24)                               # a large group of near copies, some exact
    rows += [(3000 + i, floats(centre + 0.08 * rng.normal(size=24)), 1) for i in range(150)]
    rows += [(4000 + i, rows[-1][1], 1) for i in range(60)]
    got, want = found(spark, rows), plain(rows)
    assert got == want
    assert max(n for _, n, _, _ in got) > 150


def test_odd_rows(spark):
    v = [1.0] + [0.25] * 7
    rows = [(1, v, 1), (2, [3 * x for x in v], 1), (3, v, 2), (4, v, None), (None, v, 1), (5, None, 1), (6, [], 1),
            (7, [0.0] * 8, 1), (8, [float("nan")] * 8, 1), (9, [None, *v[1:]], 1), (10, [float("inf"), *v[1:]], 1),
            (1, v, 1), (1, [-x for x in v], 1), (11, [1.0, 2.0], 1), (12, [1.0, 2.0], 1), (13, [5.0], 1), (14, [6.0], 1),
            (15, [-0.0, 1.0], 1), (16, [0.0, 1.0], 1), (17, [2.0] * 700, 3), (0, [2.0] * 700, 3)]
    want = [(d, n, c if d is not None else None, k) for d, n, c, k in plain(rows)]
    got = found(spark, rows)
    assert [g for g in got if g[0] is not None] == [w for w in want if w[0] is not None]
    assert [g for g in got if g[0] is None] == [(None, 0, None, True)]


def test_doubles_and_text_labels(spark):
    rows = [(1, [0.1, 0.2, 0.3], "a:b"), (2, [0.1, 0.2, 0.3000001], "a:b"), (3, [0.1, 0.2, 0.3], "a")]
    got = found(spark, rows, schema=SCHEMA.replace("array<float>", "array<double>").replace("label int", "label string"))
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1)]) == [(1, 0, 1, True)]


def test_rotation_keeps_lengths_and_chance_is_low_enough():
    rng = np.random.default_rng(1)
    for dim in (8, 24, 64, 256):
        a, b = (rng.normal(size=(1500, dim)) for _ in range(2))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= a * (a * b).sum(1, keepdims=True)
        c = 0.98 * a + np.sqrt(1 - 0.98 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        assert np.allclose(np.linalg.norm(P.rotated(a, [3, 1]), axis=1), 1)
        assert np.allclose((P.rotated(a, [3, 1]) * P.rotated(c, [3, 1])).sum(1), 0.98)
        for hashes in (1, 2, 3):
            (ha, pa), (hc, pc) = (P.buckets(x, hashes, 4) for x in (a, c))
            meet = (ha == hc) | (pa == hc[:, :, None]).any(2) | (pc == ha[:, :, None]).any(2)
            assert meet.mean() > P.chance(0.98, dim) ** hashes
        x, y = np.arange(1500), np.arange(1500, 3000)
        both = [np.concatenate(z).view(np.int64) for z in ((ha, hc), (pa, pc))]
        first = P._first_meeting(*both, x, y)
        assert (first == P._first_meeting(*both, y, x)).all()
        assert ((first == 0) == ~meet.any(1)).all()
