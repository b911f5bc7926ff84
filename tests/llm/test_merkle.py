from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from blotter.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos int, root string, path string"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text=None) -> str:
    doc_id, source, lang, n_chars, own = row
    fields = (doc_id, source, lang, n_chars, own if text is None else text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def lowered(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """The levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def flanks(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % 16
        out.append(("".join(level[first:i]), "".join(level[i + 1:first + 16])))
        i //= 16
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    per = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: tree([leaf(r) for r in per[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources]) if rows else []
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(per[s]):
            sides = flanks(trees[s], i) + flanks(top, k)
            tampered = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            acc = leaf(r, lowered(r[4])) if tampered else leaf(r)
            for before, after in sides:
                acc = sha(before + acc + after)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], sha("".join(b + a for b, a in sides)), acc, acc == top[-1][0]))
    return out


def found(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(parts)
    out = M.verify(M.with_case_tampering(df))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in out.collect()]


def key(row):
    return str(row)


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [256], [257], [1, 16, 17, 300], [4100, 1, 40]])
def test_tree_shapes(spark, sizes):
    rows = [(1000 * k + i, f"s{k}", "en", i, f"Text {i}") for k, n in enumerate(sizes) for i in range(n)]
    random.Random(3).shuffle(rows)
    assert sorted(found(spark, rows), key=key) == sorted(plain(rows), key=key)


def test_many_sources(spark):
    rows = [(i, f"src{i % 300}", None, None, "Same") for i in range(700)]
    assert sorted(found(spark, rows), key=key) == sorted(plain(rows), key=key)


def test_odd_rows(spark):
    rows = [(1, None, "en", 3, "One"), (2, "", "en", 0, ""), (3, "É", None, None, None), (4, "z", "de", 9, "É ÀB" * 5000),
            (None, "z", "de", 1, "x"), (None, "z", "de", 1, "x"), (5, "z", "en", 1, "SAME"), (5, "z", "en", 1, "SAME"),
            (5, "z", "en", 1, "other"), (-7, "z", "en", 1, "A"), (10, "z", "en", 1, "A"), (9, "z", "en", 1, "A"),
            (15, "z", None, -4, None), (20, "\U0001f389", "en", 1, "high"), (21, "～", "en", 1, "bmp")]
    rows += [(7, "hot", "en", 1, "copies")] * 600
    got = found(spark, rows)
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_only_changed_texts_fail(spark):
    rows = [(i, "s", "en", 1, "Upper" if i % 2 else "lower") for i in range(100)]
    for doc_id, *_, verified in found(spark, rows):
        assert verified == (not (zlib.crc32(str(doc_id).encode()) % 5 == 0 and doc_id % 2 == 1))


def test_empty_table_and_no_check(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert M.verify(none).count() == 0
    one = spark.createDataFrame([(1, "s", "en", 1, "t", 1, "x", "y")], SCHEMA)
    r = M.manifest(one).first()
    assert r["root"] == r["subroot"] == r["leaf"] == r["checked_leaf"] and r["path"] == []


def test_manifest_finds_other_changes(spark):
    """A text that is given, lost or cut off later leads to another root."""
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
                                  F.lit(4).alias("n_chars"), F.when(F.col("id") % 4 != 3, F.lit("text")).alias("text"))
    later = F.when(F.col("doc_id") % 4 == 0, F.lit("tex")).when(F.col("doc_id") % 4 == 1, F.lit(None)).when(
        F.col("doc_id") % 4 == 3, F.lit("")).otherwise(F.col("text"))
    rows = M.verify(docs.withColumn("checked_text", later)).collect()
    assert {r["doc_id"] for r in rows if r["verified"]} == {i for i in range(40) if i % 4 == 2}
