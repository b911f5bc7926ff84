from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from blotter.llm import quality, toxicity
from blotter.llm.boosted_trees import fit
from blotter.llm.doc_stats import NAMES, document_stats
from tests.llm import plain
from tests.llm.conftest import edge_rows, prose

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(900):
        w = prose(rng, rng.randrange(20, 200))
        junk, bad = rng.random() < 0.2, rng.random() < 0.2
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["scoundrel", "villain", "villainous"])
        if junk:
            w = [w[0]] * len(w) if rng.random() < 0.5 else [x + "###" for x in w]
        docs.append((i, " ".join(w)))
        if rng.random() < 0.9:
            labels.append((i, int(not junk), int(bad and not (junk and len(set(w)) == 1))))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS), labels


def _auc(rows, truth):
    one, zero = [s for d, s in rows if truth[d]], [s for d, s in rows if not truth[d]]
    return np.mean([(a > b) + (a == b) / 2 for a in one for b in zero])


def test_quality_on_held_out_documents(corpus):
    docs, labels, rows = corpus
    out = quality.score_quality(docs, quality.train(docs, labels)).select("doc_id", "score").collect()
    truth = {d: q for d, q, _ in rows if plain.held_out(d)}
    assert _auc([tuple(r) for r in out if r["doc_id"] in truth], truth) > 0.98
    assert all(0 <= r["score"] <= 1 for r in out)


def test_toxicity_on_held_out_documents(corpus):
    docs, labels, rows = corpus
    model = toxicity.train(docs, labels)
    out = toxicity.score_toxicity(docs, model).collect()
    truth = {d: t for d, _, t in rows if plain.held_out(d)}
    assert _auc([(r["doc_id"], r["score"]) for r in out if r["doc_id"] in truth], truth) > 0.95
    known = {d: t for d, _, t in rows}
    for r in out:
        assert 0 <= r["score"] <= 1
        assert all(known[n["doc_id"]] == n["label"] and not plain.held_out(n["doc_id"]) for n in r["neighbours"])


def test_toxicity_compares_texts_without_telling_terms(corpus, spark):
    docs, labels, rows = corpus
    out = toxicity.score_toxicity(docs, toxicity.train(docs, labels)).select("doc_id", "neighbours").collect()
    assert all(len(r["neighbours"]) == toxicity.NEIGHBOURS for r in out)
    # a sample of fewer than 40 texts has terms as well, and every example is found by its own text
    few = [(i, t, 0) for i, (t, *_) in enumerate([(f"plain words number w{i} here",) for i in range(20)])]
    few = [(3 * i, t, int(i % 4 == 0)) for i, t, _ in few if not plain.held_out(3 * i)]
    texts = spark.createDataFrame([(i, t) for i, t, _ in few], "doc_id long, text string")
    out = toxicity.score_toxicity(texts, toxicity.train(texts, spark.createDataFrame(
        [(i, 1, y) for i, _, y in few], LABELS))).collect()
    assert all(r["neighbours"][0]["doc_id"] == r["doc_id"] and r["neighbours"][0]["cosine"] > 0.999 for r in out)


def test_held_out_rule(spark):
    df = spark.createDataFrame([(i,) for i in [*range(40), None]], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", quality.held_out()).collect()}
    assert got.pop(None) is False
    assert got == {i: plain.held_out(i) for i in range(40)}


def test_training_is_bounded_and_never_held_out(corpus):
    _, labels, _ = corpus
    ids = [r["doc_id"] for r in quality.training_labels(labels, "quality", 25).collect()]
    assert 10 <= len(ids) <= 25 and not any(map(plain.held_out, ids))


@pytest.mark.parametrize("rows", [[], [(5, None, None)], [(5, 1, 1), (6, 1, 1)], [(6, 0, 0), (5, 1, 1), (5, 1, 1)]])
def test_edge_rows_with_few_labels(spark, edge, rows):
    labels = spark.createDataFrame(rows, LABELS)
    out = quality.score_quality(edge, quality.train(edge, labels))
    assert sorted(out.columns) == sorted(edge.columns) and out.count() == len(edge_rows())
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    out = toxicity.score_toxicity(edge, toxicity.train(edge, labels))
    assert all(0 <= r["score"] <= 1 for r in out.collect()) and out.count() == len(edge_rows())


def test_empty_tables(spark, no_docs, corpus):
    none = spark.createDataFrame([], LABELS)
    assert quality.score_quality(no_docs, quality.train(no_docs, none)).count() == 0
    assert toxicity.score_toxicity(no_docs, toxicity.train(no_docs, none)).count() == 0
    assert quality.score_quality(no_docs, quality.train(no_docs, corpus[1])).count() == 0


def test_statistics_do_not_depend_on_the_batch():
    texts = [t for _, t in edge_rows()]
    whole = document_stats(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"]), "t")
    assert whole.shape == (len(texts), len(NAMES)) and np.isfinite(whole).all()
    for i, t in enumerate(texts):
        one = document_stats(pa.RecordBatch.from_arrays([pa.array([t], pa.string())], ["t"]), "t")
        assert np.allclose(one[0], whole[i])
    stats = dict(zip(NAMES, document_stats(
        pa.RecordBatch.from_arrays([pa.array(["A a a b!! C##\nx x"], pa.string())], ["t"]), "t")[0]))
    assert stats["longest_run"] == 2 and stats["repeated_next"] == pytest.approx(3 / 7)
    assert stats["bang_ended"] == stats["symbol_ended"] == pytest.approx(1 / 7)


def test_flat_trees_split_like_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = fit(x, y, trees=30, depth=3)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.97
    for row in x[:20]:
        total = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        assert total == pytest.approx(model.raw(row[None, :])[0])


def test_block_max_neighbours_are_exact():
    rng = np.random.default_rng(3)
    n, terms = 400, 30
    dense = rng.random((n, terms)) * (rng.random((n, terms)) < 0.15)
    dense[:40] = dense[0]
    dense = dense[dense.any(1)]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    at, term = np.nonzero(dense)
    index = toxicity.BlockMaxIndex(at, term, dense[at, term], len(dense), terms)
    asked = np.nonzero(dense[:60])
    many = index.nearest(*asked, dense[asked], 60, 7)
    for i in range(60):
        got, cosine = many[i]
        one = index.nearest(np.zeros(len(q := np.flatnonzero(dense[i])), int), q, dense[i][q], 1, 7)[0]
        assert (one[0] == got).all() and (one[1] == cosine).all()  # the same bits in any batch
        score = dense @ dense[i]
        want = np.sort(score)[::-1][:7]
        assert np.allclose(cosine, want[want > 0])
        assert all(x < y for x, y, c, d in zip(got, got[1:], cosine, cosine[1:]) if c == d)
        assert np.allclose(score[got], cosine)


def test_isotonic_scores_rise():
    rng = np.random.default_rng(4)
    v = rng.random(300).round(2)
    x, y = toxicity._isotonic(v, (rng.random(300) < v).astype(int))
    assert (np.diff(x) >= 0).all() and (np.diff(y) >= -0.2).all() and ((y > 0) & (y < 1)).all()


def test_first_tree_takes_the_best_of_all_splits():
    """Against a search over every feature and every value between bins, node by node."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 4)).astype(np.float32).round(1)
    y = ((x[:, 1] > 0.4) | (x[:, 2] * x[:, 0] > 0.5)).astype(float)
    depth, l2, least = 3, 1.0, 2.0
    model = fit(x, y, trees=1, depth=depth, rate=0.5, bins=64, l2=l2, min_hessian=least)
    p = np.full(300, y.mean())
    g, h = y - p, p * (1 - p)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1])) for j in range(4)]

    def gain(rows, left):
        parts = [rows & left, rows & ~left]
        if any(h[q].sum() < least for q in parts):
            return 0.0
        return sum(g[q].sum() ** 2 / (h[q].sum() + l2) for q in parts) - g[rows].sum() ** 2 / (h[rows].sum() + l2)

    nodes = {0: np.ones(300, bool)}
    for node in range(2 ** depth - 1):
        rows = nodes[node]
        best = max((gain(rows, x[:, j] <= e) for j in range(4) for e in edges[j]), default=0.0)
        left = x[:, model.feature[0, node]] <= model.threshold[0, node]
        took = gain(rows, left) if np.isfinite(model.threshold[0, node]) else 0.0
        assert took == pytest.approx(max(best, 0.0), abs=1e-7)
        nodes[2 * node + 1], nodes[2 * node + 2] = rows & left, rows & ~left
    for k in range(2 ** depth):
        rows = nodes[2 ** depth - 1 + k]
        assert model.leaf[0, k] == pytest.approx(0.5 * g[rows].sum() / (h[rows].sum() + l2))


def _term_counts(text):
    out = Counter()
    for w in plain.ALNUM.findall(plain.lower(text)):
        w = w.encode()
        out[w] += 1
        for k in toxicity.PREFIXES:
            if len(w) > k:
                out[(k, w[:k])] += 1
    return out


def _sure(bags, labels):
    rows, ones = len(labels), sum(labels)
    n, a = Counter(t for b in bags for t in b), Counter(t for b, y in zip(bags, labels) if y for t in b)
    out, share = {}, ones / rows
    for t in n:
        lift = max(0, a[t] / n[t] - share) / (1 - share)
        chi2 = lift ** 2 * n[t] * rows * (1 - share) / (share * max(1, rows - n[t]))
        out[t] = toxicity.LEAST + (1 - toxicity.LEAST) * (lift * chi2 / (chi2 + toxicity.HALF_CHI2)) ** 2
    return out


def test_toxicity_against_a_plain_version_of_the_whole_query(corpus):
    """Terms, document frequencies, weights, neighbours, votes across folds, calibration and scores, all in plain Python."""
    docs, labels, rows = corpus
    texts = [(r["doc_id"], _term_counts(r["text"])) for r in docs.collect()]
    bags = dict(texts)
    known = {d: t for d, _, t in rows if not plain.held_out(d)}
    terms = {t for d in known for t in bags[d]}
    df = Counter(t for _, bag in texts for t in bag if t in terms)
    idf = {t: np.log1p(len(texts) / (1 + df[t])) for t in terms}

    def index(ids):
        sure = _sure([bags[d] for d in ids], [known[d] for d in ids])
        weight = {t: idf[t] * sure.get(t, toxicity.LEAST) for t in terms}

        def unit(bag):
            v = {t: (1 + np.log(n)) * weight[t] for t, n in bag.items() if t in terms}
            norm = np.sqrt(sum(x * x for x in v.values()))
            return {t: x / norm for t, x in v.items()}

        examples = [(d, unit(bags[d])) for d in ids]

        def near(bag):
            q = unit(bag)
            score = sorted(((sum(x * v.get(t, 0.0) for t, x in q.items()), d) for d, v in examples), reverse=True)
            return [(c, d) for c, d in score[:toxicity.NEIGHBOURS] if c > 0]

        return near

    vote = lambda found: sum(c * known[d] for c, d in found) / sum(c for c, _ in found)
    fold = {d: int(toxicity.mix64(np.array([d], np.uint64))[0] % np.uint64(toxicity.FOLDS)) for d in known}
    votes, truth = [], []
    for f in range(toxicity.FOLDS):
        others = index([d for d in known if fold[d] != f])
        mine = [d for d in known if fold[d] == f]
        votes += [vote(others(bags[d])) for d in mine]
        truth += [known[d] for d in mine]
    steps = toxicity._isotonic(np.array(votes), np.array(truth))
    near = index(list(known))
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, toxicity.train(docs, labels)).collect()}
    for d, bag in texts[::7]:
        want = near(bag)
        got = [n["cosine"] for n in out[d]["neighbours"]]
        assert np.allclose(got, [c for c, _ in want], atol=2e-6)
        assert out[d]["score"] == pytest.approx(np.interp(vote(want), *steps), abs=0.02)
