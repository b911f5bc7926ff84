from __future__ import annotations

import os
import random
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from blotter.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.llm import plain
from tests.llm.conftest import prose
from tests.oracle_check import _rows, duck

tables = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    rng = random.Random(21)
    rows, labels, items = [], [], [(1, " ".join(prose(rng, 30, 9000))), (2, "short item here")]
    for i in range(300):
        w = prose(rng, rng.randrange(30, 90), 3000)
        kind = i % 10
        if kind == 1 and i > 20:
            w = rows[i - 11][1].split(" ")[:-1]
        if kind == 2:
            w = [w[0]] * len(w)
        if kind == 3:
            w[10:10] = items[0][1].split()[5:17]
        text = " ".join(w) + ("\nShared footer line" if i % 3 == 0 else "")
        rows.append((i, text, "en", None if i % 17 == 0 else f"s{i % 4}", len(text)))
        labels.append((i, int(kind != 2), 0))
    rows += [(1000, None, None, None, None), (1001, "", "en", "s0", 0)]
    path = str(tmp_path_factory.mktemp("sf"))
    for name, data, schema in (("documents", rows, COLUMNS), ("labels", labels, "doc_id long, quality int, toxic int"),
                               ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return path, rows, items


def _stage(n, spark, docs, path):
    df = P.STAGES[n][1](spark, docs, path)
    if n < len(P.STAGES) - 1:
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    return df


def test_stages_against_plain_versions(spark, small):
    path, rows, items = small
    docs = spark.createDataFrame(rows, COLUMNS)
    good = _stage(0, spark, docs, path)
    kept = {r["doc_id"] for r in good.collect()}
    assert all((i in kept) == (i % 10 != 2) for i in range(300))
    texts = [(r[0], r[1]) for r in rows]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in _stage(1, spark, docs, path).collect()}
    assert got == {d: (t, len(t)) for d, _, _, t in plain.kept_lines(texts, 10)}
    got = sorted(r["doc_id"] for r in _stage(2, spark, docs, path).collect())
    want = sorted(d for d, _, c in plain.components(texts) if d == c)
    assert got == want and len(want) < len(texts)
    got = {r["doc_id"] for r in _stage(3, spark, docs, path).collect()}
    clean = {d for d, _, hit, _, _ in plain.contamination(texts, items) if not hit}
    assert got == clean and len(clean) < len(texts)
    out = _stage(4, spark, docs, path).collect()
    taken, sizes = Counter(), Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(plain.NON_SPACE.findall(t or ""))
    for r in out:
        taken[r["source"]] += r["taken"]
    for s, target in plain.targets(sizes).items():
        assert abs(taken[s] - target) <= 92


def test_near_duplicates_keep_one_row_of_repeated_rows(spark, small):
    text = " ".join(prose(random.Random(1), 50))
    rows = [(5, text, "en", "a", 1), (5, text, "en", "a", 1), (3, text, "en", "a", 1), (None, text, "en", "a", 1),
            (8, "", "en", "a", 0), (9, None, "en", "a", 0)]
    out = P.near_duplicates(spark, spark.createDataFrame(rows, COLUMNS), small[0])
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [3, 8, 9, None]
    rows = rows[:2]
    out = P.near_duplicates(spark, spark.createDataFrame(rows, COLUMNS), small[0])
    assert [r["doc_id"] for r in out.collect()] == [5]


def test_near_duplicates_of_one_id_with_different_texts(spark, small):
    rng = random.Random(4)
    one, two, three = (" ".join(prose(rng, 50, 9000)) for _ in range(3))
    rows = [(5, one, "en", "a", 1), (5, two, "en", "a", 1), (5, three, "en", "a", 1), (3, three, "en", "a", 1),
            (7, two, "en", "a", 1), (7, two, "en", "a", 2)]
    out = P.near_duplicates(spark, spark.createDataFrame(rows, COLUMNS), small[0])
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == sorted([(5, one), (5, two), (3, three)])
    assert out.columns == COLUMNS.replace(" long", "").replace(" string", "").split(", ")


def test_run_is_the_stages_in_turn(spark, small):
    path, rows, _ = small
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for n in range(5):
        docs = P.shared_table(_stage(n, spark, docs, path), "test-stage")
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, P.run(spark, path).collect()))


def test_stages_on_an_empty_table(spark, small):
    docs = spark.createDataFrame([], COLUMNS)
    for n in range(5):
        assert _stage(n, spark, docs, small[0]).count() == 0


@tables
@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_oracle(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = duck(SF_SMALL).sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


@tables
def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert [n for n, _ in P.STAGES] and "pipeline" in entry.queries()
