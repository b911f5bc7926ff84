from __future__ import annotations

import random

import numpy as np
import pytest

from blotter.llm import jaccard_join as J
from blotter.llm.components import components
from tests.llm import plain
from tests.llm.conftest import edge_rows, prose


def _key(r):
    return tuple((x is None, x or 0) for x in r)


def _run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((tuple(r) for r in J.jaccard_join(df).rows.collect()), key=_key)


def test_edge_rows(edge):
    got = sorted((tuple(r) for r in J.jaccard_join(edge).rows.collect()), key=_key)
    assert got == sorted(plain.components(edge_rows()), key=_key)


def test_empty_table(no_docs):
    r = J.jaccard_join(no_docs)
    assert r.rows.columns == ["doc_id", "n_shingles", "component_id"]
    assert r.rows.count() == 0 and r.links.count() == 0


def _families(rng, families, copies, words, changes):
    rows = []
    for _ in range(families):
        base = prose(rng, words, 3000)
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(changes + 1)):
                w[rng.randrange(words)] = f"c{rng.randrange(10 ** 6)}"
            rows.append((len(rows) + 100, " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small,block", [(32, 1024), (3, 8)])
def test_chains_of_near_copies(spark, monkeypatch, small, block):
    """Copies of one text that are mostly not near each other; both ways of round two."""
    monkeypatch.setattr(J, "SMALL_GROUP", small)
    monkeypatch.setattr(J, "BLOCK_SETS", block)
    rows = _families(random.Random(3), 3, 40, 80, 5)
    rows += [(i, " ".join(prose(random.Random(i), 60, 3000))) for i in range(30)]
    assert _run(spark, rows) == sorted(plain.components(rows), key=_key)


def test_shared_passage_links_nothing(spark):
    rng = random.Random(9)
    passage = prose(rng, 60, 3000)
    rows = [(i, " ".join([*prose(rng, 50, 3000), *passage, *prose(rng, 50, 3000)])) for i in range(60)]
    assert [r[2] for r in _run(spark, rows)] == list(range(60))


def test_threshold_is_inclusive(spark):
    # 7 words -> 3 shingles; 8 words -> 4, 3 of them shared: exactly 0.75
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "a b c d e f g h i")]
    assert [r[2] for r in _run(spark, rows)] == [r[2] for r in plain.components(rows)] == [1, 1, 1]


def test_packed_runs_round_trip():
    for v in ([], [0], [5, 5, 9], [1, 2 ** 50, 2 ** 63]):
        v = np.array(v, np.uint64)
        assert J._unpack(J._pack(v)).tolist() == v.tolist()


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001)], "a long, b long")
    got = dict(components(links).collect())
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
    assert components(links.limit(0)).count() == 0
