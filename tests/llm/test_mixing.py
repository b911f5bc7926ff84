from __future__ import annotations

import random
from collections import defaultdict

import pytest

from blotter.llm.mixing import mix_sources, with_mix
from tests.llm import plain
from tests.llm.conftest import edge_rows


def _check(rows):
    """rows: (doc_id, source, size, source_size, target, taken)"""
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, s, size, *_, t in rows:
        sizes[s] += size
        taken[s] += t
        largest[s] = max(largest[s], size)
        assert t in (0, size, 2 * size)
    want = plain.targets(sizes)
    for _, s, _, source_size, target, _ in rows:
        assert source_size == sizes[s] and target == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    return taken, want


def test_targets_are_met_by_whole_documents(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([1, 5, 20, 60]), rng.choice(["a", "a", "a", "a", "é", "Z", None, "b"]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = [tuple(r) for r in mix_sources(df).collect()]
    taken, want = _check(out)
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)
    again = [tuple(r) for r in mix_sources(df.repartition(2)).collect()]
    assert sorted(out) == sorted(again) if None not in want else {r[0]: r for r in out} == {r[0]: r for r in again}


def test_a_larger_budget_contains_a_smaller_one(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = ({r["doc_id"]: r["taken"] for r in mix_sources(df, share=s).collect()} for s in (0.4, 0.7))
    assert all(one[i] <= two[i] for i in one) and one != two


def test_edge_rows_keep_all_columns(edge):
    out = with_mix(edge)
    assert [c for c in edge.columns if c not in ("size", "target", "taken")] == out.columns[:-4]
    rows = [(r["doc_id"], r["source"], r["size"], r["source_size"], r["target"], r["taken"]) for r in out.collect()]
    assert len(rows) == edge.count()
    _check(rows)
    sizes = {d: len(plain.NON_SPACE.findall(t or "")) for d, t in edge_rows() if d is not None}
    assert all(size == sizes[d] for d, _, size, *_ in rows if d is not None)
    narrow = {(d, s, t) for d, s, _, _, _, t in (tuple(r) for r in mix_sources(edge).collect())}
    assert narrow == {(d, s, t) for d, s, _, _, _, t in rows}


def test_empty_and_wordless_tables(spark, no_docs):
    assert mix_sources(no_docs).count() == 0 and with_mix(no_docs).count() == 0
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [tuple(r) for r in mix_sources(df).orderBy("doc_id").collect()] == [(1, "a", 0, 0, 0.0, 0), (2, None, 0, 0, 0.0, 0)]


def test_only_native_operators_run(edge):
    plan = with_mix(edge)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
