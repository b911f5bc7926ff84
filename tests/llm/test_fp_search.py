from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from blotter.llm import fp_search as S

from .conftest import SCHEMA, edge_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    bags = [(d, Counter(t), len(t)) for d, t in ((d, terms(t)) for d, t in docs) if t]
    n_docs, n_all = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    asked: dict = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for d, bag, n in bags:
            m = 10 + (90 * n * n_docs) // n_all
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                        ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in wanted if t in bag)
            if score > 0 and d is not None:
                scored.append((-score, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, docs, items, parts=3, k=10):
    df = spark.createDataFrame([(d, t, "en", "s", 0, 0.5, "x", 1, "y", 2, 3, 4, "k", 5) for d, t in docs], SCHEMA)
    asked = spark.createDataFrame([(i, t, 7, 0.5) for i, t in items], "item_id long, text string, rank int, score double")
    out = S.rank_documents(df.repartition(parts), asked, k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()))


def corpus(rng, n):
    """Zipf-like words, copies, near copies and vectors that begin alike."""
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 300}"
    texts = [" ".join(word() for _ in range(rng.choice([1, 5, 40, 200]))) for _ in range(n)]
    for i in range(0, n // 3):
        at = rng.randrange(n)
        texts[at] = texts[i] + (f" {word()}" * rng.randrange(3))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("limits", [{}, {"SHARD": 40, "RUN": 3}, {"ITEM_TERMS": 60, "SHARD_TERMS": 500}])
def test_against_plain_scores(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(S, name, value)
    rng = random.Random(11)
    docs = corpus(rng, 900)
    items = [(100 + i, docs[rng.randrange(900)][1][:400]) for i in range(20)] + [(5, "w1 w2 unheard"), (6, "unheard")]
    assert found(spark, docs, items) == plain(docs, items)


def test_odd_rows(spark):
    docs = edge_rows()
    items = [(1, docs[6][1]), (2, None), (3, ""), (4, "same LINE É"), (4, "日本語"), (4, "same LINE É"), (None, "one two"),
             (5, "one two three four five"), (6, docs[11][1])]
    assert found(spark, docs, items) == plain(docs, items)


def test_ties_and_repeated_rows(spark):
    docs = [(i % 7, "alpha beta") for i in range(40)] + [(100 + i, "gamma delta") for i in range(40)] + [(3, "alpha")]
    items = [(1, "alpha beta"), (2, "gamma"), (3, "alpha gamma")]
    assert found(spark, docs, items, k=12) == plain(docs, items, k=12)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == found(spark, [(1, "a")], []) == found(spark, [], []) == []
    assert found(spark, [(1, None), (2, "!")], [(1, "a")]) == []


def test_bounds_cover_their_subtrees():
    """Every node's path part and rest bound the scores of its documents."""
    rng = np.random.default_rng(2)
    vectors = [np.unique(rng.integers(0, 12, rng.integers(1, 9))) for _ in range(400)]
    cut = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    flat, tfs = np.concatenate(vectors).astype(np.int32), rng.integers(1, 50, cut[-1]).astype(np.int32)
    tree = S.Tree(np.arange(400), rng.integers(10, 300, 400), cut, flat, tfs)
    item = np.array([0, 2, 3, 7, 11])
    w = np.array([900, 700, 500, 100, 20])
    dense = np.zeros(13, np.int64)
    dense[item] = w
    exact = np.array([sum(S.part_score(dense[t], tf, tree.m[i]) for t, tf in zip(
        tree.terms[a:b], tree.tfs[a:b])) for i, (a, b) in enumerate(zip(tree.first[:-1], tree.first[1:]))])
    rest = np.concatenate([np.cumsum(w[::-1])[::-1], [0]])
    nodes = np.arange(len(tree.lo))
    later = S.part_score(rest[np.searchsorted(item, tree.later)], tree.below, tree.least_m)
    path = np.zeros(len(nodes), np.int64)
    todo = [tree.branches - 1]
    while todo:
        i = todo.pop()
        kids = tree.kids[tree.child[i]:tree.child[i + 1]]
        for j in kids.tolist():
            assert tree.lo[i] <= tree.lo[j] < tree.hi[j] <= tree.hi[i]
            path[j] = path[i] + (tree._own_part(np.array([j]), dense)[0] if j < tree.branches else 0)
            todo += [j] * (j < tree.branches)
        assert sum(int(tree.hi[j] - tree.lo[j]) for j in kids) == tree.hi[i] - tree.lo[i]
    for j in nodes.tolist():
        assert exact[tree.lo[j]:tree.hi[j]].max() <= path[j] + later[j]
