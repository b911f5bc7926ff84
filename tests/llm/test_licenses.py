from __future__ import annotations

import random
import re

from blotter.llm.licenses import BASE_PHRASES, NOTICES, TEMPLATES, scan_licenses
from tests.llm import plain
from tests.llm.conftest import edge_rows, prose


def _rows(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                   for r in df.collect()), key=repr)


def _want(rows):
    out = []
    for d, t in rows:
        n, at, labels = plain.phrase_places(t, BASE_PHRASES)
        out.append((d, n, len(at), at[0] if at else None, at[-1] if at else None, ",".join(labels)))
    return sorted(out, key=repr)


def test_base_places_against_plain_search(spark):
    rng = random.Random(6)
    bits = ["MIT", "license", "Apache-License", "general", "public", "license,", "mit license", "x", "GENERAL Public\nLicense"]
    rows = [(i, " ".join(rng.choices(bits, k=rng.randrange(40)))) for i in range(120)]
    rows += [(7, "mit license"), (7, "mit license"), (8, "the apache license mit"), (None, "mit license"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _rows(scan_licenses(df)) == _want(rows)


def test_edge_rows(edge):
    assert _rows(scan_licenses(edge)) == _want(edge_rows())
    assert all(r["labels"] == "" and r["score"] == 0 for r in scan_licenses(edge).collect())


def test_notices_exact_and_changed(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for i, (notice, label) in enumerate(NOTICES.items()):
        w = notice.split()
        rows.append((2 * i, " ".join([*prose(rng, 30), *w, *prose(rng, 30)])))
        want[2 * i] = label
        if len(w) >= 15:  # two words put in: the votes fall on neighbouring diagonals
            rows.append((2 * i + 1, " ".join([*prose(rng, 9), *w[:6], "really", *w[6:12], "so", *w[12:]])))
            want[2 * i + 1] = label
    rows.append((998, "Licensed under CC BY-NC 4.0."))
    rows.append((999, "permission of the software and to the license in source " * 5))
    out = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, label in want.items():
        assert label in out[d]["labels"].split(",") and out[d]["score"] >= 0.7
        assert any(s["label"] == label for s in out[d]["spans"] or [])
    assert out[998]["labels"] == "cc-by-nc-4.0" and out[999]["labels"] == ""


def test_empty_table(no_docs):
    assert scan_licenses(no_docs).count() == 0


def _found(text, notices, k=2, slack=3, short=8, cover=0.7):
    """(label, first, end, cover) of every verified notice by plain search over all diagonals."""
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain.lower(t))
    pairs = lambda w: list(zip(w, w[1:]))
    have, out = pairs(tok(text)), []
    for notice, label in notices.items():
        want = pairs(tok(notice))
        lines = {}
        for p, x in enumerate(have):
            for a, y in enumerate(want):
                if x == y:
                    lines.setdefault(p - a, {}).setdefault(a, []).append(p)
        for d, hits in lines.items():
            if len(hits) == len(want):
                out.append((label, d, d + len(want) + k - 1, 1.0))
            elif len(want) >= short and all((len(hits), -d) >= (len(o), -e) for e, o in lines.items() if abs(e - d) <= slack):
                near = [o for e, o in lines.items() if abs(e - d) <= slack]
                share = len(set().union(*near)) / len(want)
                if share >= cover:
                    at = [p for o in near for q in o.values() for p in q]
                    out.append((label, min(at), max(at) + k, share))
    return sorted(out)


def test_notices_beside_their_own_words_against_plain_search(spark):
    """Each notice, whole or changed, between words of its own: what lies beside it never hides it."""
    rng = random.Random(13)
    rows = []
    for notice in TEMPLATES:
        w = notice.split()
        for kind in range(6):
            own = list(w)
            for _ in range(max(1, len(w) // 20) if kind >= 3 else 0):  # a twentieth of the words changed, left out or put in
                at = rng.randrange(len(own))
                own[at:at + 1] = rng.choice([["changed"], [], [own[at], "more"]])
            beside = [rng.choice(w) for _ in range(40)] if kind % 3 else [*w[-2:] * 4, *w[:3]]
            cut = rng.randrange(len(beside))
            rows.append((len(rows), " ".join([*beside[:cut], *own, *beside[cut:]])))
    rows.append((len(rows), "licensed under the Apache License, Version 2.0" + " the license" * 4))
    out = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, text in rows:
        got = sorted((s["label"], s["first"], s["end"], round(s["cover"], 9)) for s in out[d]["spans"] or [])
        assert got == sorted((x, a, b, round(c, 9)) for x, a, b, c in _found(text, TEMPLATES)), text
        if d < len(rows) - 1:
            notice, label = list(TEMPLATES.items())[d // 6]
            assert d % 6 >= 3 and len(notice.split()) < 20 or label in out[d]["labels"].split(","), (label, text)
    assert "apache-2.0" in out[len(rows) - 1]["labels"] and out[len(rows) - 1]["score"] == 1.0


def test_longer_templates_than_a_mask(spark):
    words = [f"t{i}" for i in range(500)]
    texts = [(1, " ".join(["x", *words, "y"])), (2, " ".join(words[:320])), (3, " ".join([*words[:200], *words[210:]]))]
    out = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"),
                                                 notices={" ".join(words): "long"}).collect()}
    assert out[1]["labels"] == "long" and tuple(out[1]["spans"][0])[:2] == (1, 501)
    assert out[2]["labels"] == "" and out[3]["labels"] == ""  # parts further apart than SLACK words are two spans
