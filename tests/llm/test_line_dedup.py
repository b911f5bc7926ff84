from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import line_dedup as L
from blotter.session import scratch_path
from tests.llm import plain
from tests.llm.conftest import edge_rows


def _rows(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()),
                  key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def _want(rows, n):
    return sorted(plain.kept_lines(rows, n), key=lambda r: (r[0] is None, r[0] or 0, r[3]))


@pytest.mark.parametrize("n", [2, 3, 10])
def test_edge_rows(edge, n):
    out = L.line_dedup(edge, min_docs=n)
    assert [c for c in out.columns if c not in ("n_lines", "n_dropped")] == [c for c in edge.columns if c != "n_lines"]
    assert _rows(out) == _want(edge_rows(), n)


def test_empty_table(no_docs):
    assert L.line_dedup(no_docs).count() == 0


def test_insert_and_delete_are_reversible(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(f"line {rng.randrange(40)}" for _ in range(6))) for i in range(80)]
    schema = "doc_id long, text string"
    first, second = (spark.createDataFrame(r, schema) for r in (rows[:50], rows[50:]))
    index = L.LineIndex(spark, scratch_path(spark, "test-lines"), min_docs=10, shards=3)
    index.insert(first)
    assert _rows(index.apply(first)) == _want(rows[:50], 10)
    before = {tuple(r) for r in index.counts().collect()}
    index.insert(second)
    assert _rows(index.apply(first.union(second))) == _want(rows, 10)
    old = L.LineIndex(spark, index.path, min_docs=10, shards=3, version=1)
    assert _rows(old.apply(first)) == _want(rows[:50], 10)
    index.compact()
    index = L.LineIndex(spark, index.path, min_docs=10, shards=3, version=index.version)
    assert _rows(index.apply(first.union(second))) == _want(rows, 10)
    index.delete(second)
    assert {tuple(r) for r in index.counts().collect()} == before
    assert _rows(index.apply(first)) == _want(rows[:50], 10)
    chains = {r["shard"]: L.CuckooChain.from_bytes(r["filter"]) for r in index.filters().collect()}
    for r in index.blocked().collect():
        assert chains[r["shard"]].contains(np.array([r["hi"]]).view(np.uint64)).all()
    held = sum(int((t > 0).sum()) for c in chains.values() for t in c.tables)
    assert held == index.blocked().count()


def test_cuckoo_chain_grows_and_forgets():
    keys = np.random.default_rng(0).integers(0, 2 ** 63, 5000).astype(np.uint64)
    chain = L.CuckooChain()
    for part in np.array_split(keys, 7):
        chain.add(part)
    assert chain.contains(keys).all() and len(chain.tables) > 1
    others = np.random.default_rng(1).integers(0, 2 ** 63, 20000).astype(np.uint64)
    assert chain.contains(others).mean() < 0.005
    again = L.CuckooChain.from_bytes(chain.to_bytes())
    again.remove(keys[:2500])
    assert again.contains(keys[2500:]).all() and again.contains(keys[:2500]).mean() < 0.05
    again.remove(keys[2500:])
    assert not any((t > 0).any() for t in again.tables)


@pytest.mark.parametrize("n", [2, 3, 10])
def test_filters_too_large_to_send_are_probed_by_shard(edge, monkeypatch, n):
    monkeypatch.setattr(L, "BROADCAST_BYTES", -1)
    assert _rows(L.line_dedup(edge, min_docs=n)) == _want(edge_rows(), n)


@pytest.mark.parametrize("sent", [64 << 20, -1])
def test_hot_lines_are_spread(spark, monkeypatch, sent):
    monkeypatch.setattr(L, "BROADCAST_BYTES", sent)
    rng = random.Random(4)
    rows = [(i, "\n".join(["In every text"] + [f"line {rng.randrange(900)}" for _ in range(3)])) for i in range(400)]
    rows += [(None, "in every text\nline 1"), (None, "in every text"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    index = L.LineIndex(spark, scratch_path(spark, "test-hot"), min_docs=3, shards=5)
    index.insert(docs)
    lanes, parts = index._lanes()
    hot = index.blocked().select("hi", "lo", lanes.alias("lanes")).filter("lanes > 1")
    assert [r["lanes"] for r in hot.collect()] and hot.count() < parts
    likely = index._likely(docs, hot, parts)
    assert likely.groupBy("hi", "lo").agg({"lane": "max"}).filter("`max(lane)` > 5").count() == 1
    assert _rows(index.apply(docs)) == _want(rows, 3)


def test_the_filters_decide_what_is_looked_up(spark, monkeypatch):
    rows = [(i, f"a\nb\nc\nown {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = L.LineIndex(spark, scratch_path(spark, "test-filters"), min_docs=10, shards=5)
    index.insert(docs)
    for sent in (64 << 20, -1):
        monkeypatch.setattr(L, "BROADCAST_BYTES", sent)
        none = index.blocked().select("hi", "lo").limit(0).withColumn("lanes", F.lit(2))
        likely = index._likely(docs, none, 64)
        assert likely.count() < 160  # 150 references to three keys of 200
        assert likely.join(index.blocked(), ["hi", "lo"], "left_semi").count() == 150
