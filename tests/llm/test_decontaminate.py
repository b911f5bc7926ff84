from __future__ import annotations

import random

import numpy as np
import pytest

from blotter.llm import decontaminate as D
from blotter.llm.fm_index import FMIndex, WaveletTree, suffix_array
from tests.llm import plain
from tests.llm.conftest import edge_rows, prose

ITEMS = "item_id long, text string"


def _got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], [(s["first"], s["end"]) for s in r["spans"]])
                   for r in df.collect()), key=repr)


def _items(rng, rows):
    long = plain.ALNUM.findall(plain.lower(dict(rows)[12]))
    base = plain.ALNUM.findall(plain.lower(dict(rows)[7]))
    return [(1, " ".join(long[500:540])), (2, " ".join(base[3:13])), (3, "One, two"), (4, None), (5, "..."), (6, "É É"),
            (None, " ".join(base[40:52])), (7, " ".join(base[5:30])), (7, " ".join(base[5:30])),
            (8, " ".join(prose(rng, 30))), (10, "same line")]


@pytest.mark.parametrize("block_bytes", [8 << 20, 150])
def test_edge_rows(spark, edge, block_bytes):
    rows = edge_rows()
    items = _items(random.Random(1), rows)
    out = D.find_contamination(edge, spark.createDataFrame(items, ITEMS), block_bytes=block_bytes)
    assert out.columns == [c for c in edge.columns if c not in D.RESULTS] + list(D.RESULTS)
    assert _got(out) == sorted(plain.contamination(rows, items), key=repr)


def test_many_small_shards(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(D, "SHARD_WORDS", 50)
    rows = [(i, " ".join(prose(rng, rng.randrange(60), 6))) for i in range(60)]
    items = [(i, " ".join(prose(rng, rng.randrange(1, 7), 6))) for i in range(12)]
    out = D.find_contamination(spark.createDataFrame(rows, "doc_id long, text string"),
                               spark.createDataFrame(items, ITEMS), window=4)
    assert _got(out) == sorted(plain.contamination(rows, items, 4), key=repr)


def test_empty_tables(spark, edge, no_docs):
    none = spark.createDataFrame([], ITEMS)
    assert D.find_contamination(no_docs, none).count() == 0
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in D.find_contamination(edge, none).collect())


def test_suffixes_are_sorted_with_ends_by_position():
    rng = np.random.default_rng(0)
    for _ in range(50):
        sym = np.append(rng.integers(0, 3, rng.integers(0, 60)), 0)
        key = [[(0, j) if sym[j] == 0 else (1, int(sym[j])) for j in range(i, len(sym))] for i in range(len(sym))]
        assert suffix_array(sym).tolist() == sorted(range(len(sym)), key=key.__getitem__)


def test_wavelet_ranks():
    sym = np.random.default_rng(1).integers(0, 11, 500)
    tree = WaveletTree(sym, 10)
    zero = tree.rank(np.arange(11), np.zeros(11, np.int64))
    for i in (0, 1, 63, 64, 65, 499, 500):
        assert (tree.rank(np.arange(11), np.full(11, i)) - zero == np.bincount(sym[:i], minlength=11)).all()
    value, rank = tree.value(np.arange(500))
    assert (value == sym).all()


def test_search_and_locate():
    rng = np.random.default_rng(2)
    for _ in range(40):
        sym = np.append(rng.integers(0, rng.integers(2, 7), rng.integers(1, 300)), 0)
        index = FMIndex(sym)
        for m in (1, 2, 4):
            phrases = rng.integers(1, 7, (30, m))
            for p, lo, hi in zip(phrases, *index.search(phrases)):
                want = [i for i in range(len(sym) - m + 1) if (sym[i:i + m] == p).all()]
                assert sorted(index.locate(np.arange(lo, hi)).tolist()) == want
