from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from blotter.llm import lm_scores as S
from tests.llm import plain
from tests.llm.conftest import edge_rows, prose

TEXT = "doc_id long, text string"


def _model(texts, vocab):
    token, history, pair = Counter(), Counter(), Counter()
    for t in texts:
        before = "<start>"
        for w in plain.ALNUM.findall(plain.lower(t)):
            w = w if w in vocab else "<other>"
            token[w] += 1
            history[before] += 1
            pair[before, w] += 1
            before = w
    return token, history, pair


def _losses(text, models, vocab, inside=(False, False)):
    """Of one text by both models, each without the text's own counts if it is ``inside`` that side."""
    scale = [min(sum(m[0].values()) for m in models) / max(1, sum(m[0].values())) for m in models]
    own = _model([text or ""], vocab)
    models = [[Counter({k: n - own[i][k] for k, n in c.items()}) if has else c for i, c in enumerate(m)]
              for m, has in zip(models, inside)]
    size = [sum(m[0].values()) for m in models]
    base = lambda w: ((1 - S.UNIFORM) * (models[0][0][w] + models[1][0][w]) / sum(size) + S.UNIFORM / (len(vocab) + 1)
                      if sum(size) else 1 / (len(vocab) + 1))
    out = []
    for (token, history, pair), total, by in zip(models, size, scale):
        before, loss, n = "<start>", 0.0, 0
        for w in plain.ALNUM.findall(plain.lower(text)):
            w = w if w in vocab else "<other>"
            uni = (1 - S.SHARED) * token[w] / total + S.SHARED * base(w) if total else base(w)
            loss -= math.log((pair[before, w] * by + S.PRIOR * uni) / (history[before] * by + S.PRIOR))
            before, n = w, n + 1
        out.append(loss / n if n else None)
    return out


@pytest.mark.parametrize("at_once", [250_000, 70])
def test_against_plain_models(spark, monkeypatch, at_once):
    monkeypatch.setattr(S, "SCORED_TOKENS", at_once)
    rng = random.Random(12)
    rows = [(i, " ".join(prose(rng, rng.randrange(60), 50))) for i in range(80)] + [(90, None), (91, "rare once"), (92, "")]
    target = [(i, " ".join(prose(rng, 30, 12))) for i in range(10)]
    docs, goal = spark.createDataFrame(rows, TEXT).repartition(3), spark.createDataFrame(target, TEXT)
    counts = sum((plain.count_words(t) for _, t in rows), Counter())
    vocab = {w for w, n in counts.items() if n >= S.MIN_COUNT}
    models = [_model([t for _, t in x], vocab) for x in (target, rows)]
    for r in S.score_texts(docs, goal, docs).collect():
        text = dict(rows)[r["doc_id"]]
        want = _losses(text, models, vocab, (False, True))
        if want[0] is None:
            assert r["n_tokens"] == 0 and r["score"] is None and r["target_loss"] is None
        else:
            assert r["target_loss"] == pytest.approx(want[0], rel=1e-9)
            assert r["background_loss"] == pytest.approx(want[1], rel=1e-9)
            assert r["score"] == pytest.approx(want[0] - want[1], abs=1e-9)


def test_texts_like_the_target_score_lower(spark):
    rng = random.Random(13)
    near = [(i, " ".join(prose(rng, 50, 20))) for i in range(30)]
    far = [(100 + i, " ".join(f"v{rng.randrange(300)}" for _ in range(50))) for i in range(60)]
    docs = spark.createDataFrame(near + far, TEXT)
    out = {r["doc_id"]: r["score"] for r in S.score_texts(docs, spark.createDataFrame(near[:10], TEXT), docs).collect()}
    assert max(out[i] for i, _ in near) < min(out[i] for i, _ in far)


def test_edge_rows_and_empty_tables(spark, edge, no_docs):
    out = S.score_texts(edge, edge, edge)
    assert out.count() == len(edge_rows())
    assert out.columns == [c for c in edge.columns if c not in S.RESULTS] + list(S.RESULTS)
    assert all(r["score"] is None or abs(r["score"]) < 1e-9 for r in out.collect())
    assert S.score_texts(no_docs, edge, edge).count() == 0
    assert S.score_texts(edge, no_docs, no_docs).count() == len(edge_rows())


def test_neither_words_nor_bigrams_are_capped(spark, monkeypatch):
    monkeypatch.setattr(S, "RUN_TOKENS", 20_000, raising=False)
    rng = random.Random(14)
    names = [f"v{i}" for i in range(70_000)] * 2  # more than 2^16 words, all as rare as the vocabulary allows
    rng.shuffle(names)
    rows = [(i, " ".join(names[1000 * i:1000 * (i + 1)])) for i in range(140)] + [(200, "v1 v2 once"), (201, None)]
    target = [(0, " ".join(names[500:1700] + ["unseen", "v5"]))]
    docs, goal = spark.createDataFrame(rows, TEXT).repartition(5), spark.createDataFrame(target, TEXT)
    vocab = set(names)
    models = [_model([t for _, t in x if t], vocab) for x in (target, rows)]
    out = {r["doc_id"]: r for r in S.score_texts(docs, goal, docs).collect()}
    assert len(out) == len(rows) and out[201]["n_tokens"] == 0 and out[201]["score"] is None
    for i in (0, 1, 2, 77, 139, 200):
        want = _losses(dict(rows)[i], models, vocab, (False, True))
        assert out[i]["target_loss"] == pytest.approx(want[0], rel=1e-9)
        assert out[i]["background_loss"] == pytest.approx(want[1], rel=1e-9)
        assert out[i]["score"] == pytest.approx(want[0] - want[1], abs=1e-9)
    # texts that are in neither side, by another DataFrame
    other = S.score_texts(spark.createDataFrame([(1, "v1 nothing"), (2, rows[3][1])], TEXT), goal, docs)
    got = {r["doc_id"]: r["score"] for r in other.collect()}
    for i, text in ((1, "v1 nothing"), (2, rows[3][1])):
        want = _losses(text, models, vocab)
        assert got[i] == pytest.approx(want[0] - want[1], abs=1e-9)


def test_a_frequent_text_is_joined_in_several_tasks(spark):
    rng = random.Random(15)
    rows = [(i, "the same text") for i in range(400)] + [(400 + i, None) for i in range(400)]
    rows += [(900 + i, " ".join(prose(rng, 20, 30))) for i in range(60)]
    docs = spark.createDataFrame(rows, TEXT).repartition(4)
    out = S.score_texts(docs, docs, docs)
    got = out.collect()
    assert sorted(r["doc_id"] for r in got) == [i for i, _ in rows]
    assert len({r["score"] for r in got if r["doc_id"] < 400}) == 1
    assert "__salt" in out._jdf.queryExecution().optimizedPlan().toString()


def test_a_word_that_a_side_lacks_costs_the_same_in_any_vocabulary(spark):
    scores = []
    for n in (1000, 20_000):
        docs = [(i, " ".join(f"v{i * 50 + j}" for j in range(50))) for i in range(n // 50)] * 2
        frames = [spark.createDataFrame(x, TEXT) for x in ([(-1, "v1 v3 v5")], [(0, "v2 v4 v2 v4 v6")], docs)]
        scores.append(S.score_texts(*frames).first()["score"])
    assert scores[0] == pytest.approx(scores[1], abs=0.05)
