from __future__ import annotations

import random

import pytest

#: Columns that clash with names the operators use inside or return.
EXTRA = "score double, n_words string, size int, target string, taken int, n_lines int, id long, key string, items int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def prose(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def edge_rows():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows, odd bytes."""
    rng = random.Random(5)
    long = " ".join(prose(rng, 30_000, 5000))
    base = prose(rng, 120)
    near = [*base[:60], "changed", *base[61:]]
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One two THREE four"), (6, "one two three four"),
        (7, " ".join(base)), (8, " ".join(base)), (8, " ".join(base)), (9, " ".join(near).upper()),
        (10, "\n".join(["same line", "É ÀÇ other", "same line  ", ""])), (11, "\tSAME line\nmine\x00\x7f"),
        (12, long), (13, long + " tail"), (None, " ".join(base)), (None, "nobody's text here at all, friend"),
        (14, "日本語 テキスト 🎉 naïve É É É É É É"), (15, "x" * 300_000), (16, "\n" * 50), (17, "a\nb\nsame line\nc"),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(d, t, "en", None if i % 4 == 0 else f"s{i % 3}", 0, 0.5, "x", 1, "y", 2, 3, 4, "k", 5)
            for i, (d, t) in enumerate(edge_rows())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
