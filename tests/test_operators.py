from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from blotter.operators import (
    composite_reduce_mean,
    count_and_mean,
    count_by,
    exact_mean,
    hot_keys,
    in_list,
    join,
    lookup,
    measured_bytes,
    rank_within,
    require_unique,
    semi_join,
    top_k_keys,
    top_k_rows,
    top_n_per_group,
    union_by_position,
)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def facts(spark):
    # area 1 is hot: a third of the rows or more
    rows = [(i, 1 if i % 2 == 0 else i % 5) for i in range(60)]
    return spark.createDataFrame(rows, "id long, prec int")


@pytest.fixture
def dims(spark):
    return spark.createDataFrame([(0, "zero"), (1, "one"), (1, "one_b"), (2, "two"), (3, "three")],
                                 "prec int, division string")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_strategies_agree_and_multiply_duplicates(spark, facts, dims):
    expected = _rows(join(facts, dims, "prec", strategy="merge"))
    n_one = facts.filter("prec = 1").count()
    assert len(expected) == facts.filter("prec <> 4").count() + n_one  # prec 1 twice on the right
    for strategy, salt in [("broadcast", None), ("shuffle_hash", None), (None, None), ("merge", 4),
                           ("shuffle_hash", 3)]:
        assert _rows(join(facts, dims, "prec", strategy=strategy, salt=salt)) == expected


@pytest.mark.parametrize("strategy,node", [("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"),
                                           ("shuffle_hash", "ShuffledHashJoin")])
def test_strategy_hints_reach_the_plan(spark, facts, dims, strategy, node):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert node in _plan(join(facts, dims, "prec", strategy=strategy))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_over_the_bound_raises(spark, facts, dims):
    size = measured_bytes(dims)
    assert size == 5 * 32 + len("zerooneone_btwothree")
    assert _rows(join(facts, dims, "prec", strategy="broadcast", max_broadcast_bytes=size)) == _rows(
        join(facts, dims, "prec"))
    with pytest.raises(ValueError, match="bound"):
        join(facts, dims, "prec", strategy="broadcast", max_broadcast_bytes=size - 1)
    nested = spark.sql("SELECT array(1, 2) a, named_struct('x', 'yy') s, cast(null AS string) t")
    assert measured_bytes(nested) > measured_bytes(nested.select("t")) and measured_bytes(dims.limit(0)) == 0


def test_lookup_default(spark, facts, dims):
    out = lookup(facts, dims.filter("prec <> 1"), "prec", ["division"])
    assert out.count() == facts.count()
    assert {r.division for r in out.filter("prec = 1").collect()} == {"Unknown"}


def test_lookup_is_a_map_of_one_value_per_key(spark, facts, dims):
    table = dims.union(spark.createDataFrame([(4, None), (0, None)], dims.schema))
    out = lookup(facts, table, "prec", ["division"])
    assert out.count() == facts.count()
    got = {r.prec: r.division for r in out.collect()}
    assert got[1] == "one" and got[0] == "zero" and got[4] is None


def test_semi_join_and_in_list(spark, facts):
    keys = spark.createDataFrame([(1,), (1,), (3,)], "prec int")
    a = _rows(semi_join(facts, keys, "prec").select("id", "prec"))
    b = _rows(in_list(facts, "prec", [1, 3]))
    assert a == b and len(a) == facts.filter("prec in (1, 3)").count()
    assert in_list(facts, "prec", []).count() == 0


def test_require_unique(spark, dims):
    assert require_unique(dims.filter("division <> 'one_b'"), "prec").count() == 4
    with pytest.raises(Exception, match="duplicate"):
        require_unique(dims, "prec").collect()


def test_top_n_keeps_ties_and_plans_group_limit(spark):
    counts = spark.createDataFrame(
        [(2015, 1, 10), (2015, 2, 9), (2015, 3, 8), (2015, 4, 8), (2015, 5, 1), (2016, 1, 3)],
        "year int, month int, n long")
    out = top_n_per_group(counts, "year", "n", 3)
    assert sorted((r.year, r.month, r.ranking) for r in out.collect()) == [
        (2015, 1, 1), (2015, 2, 2), (2015, 3, 3), (2015, 4, 3), (2016, 1, 1)]
    assert "WindowGroupLimit" in _plan(out)
    ranked = rank_within(counts, "year", "n")
    assert ranked.filter("year = 2015 and month = 5").first().ranking == 5


def test_top_k(spark):
    df = spark.createDataFrame([(k, v) for k, v in zip("abcdef", [5, 9, 9, 1, 7, 3])], "k string, v int")
    assert [r.k for r in top_k_rows(df, [F.desc("v"), F.asc("k")], 3).collect()] == ["b", "c", "e"]
    assert top_k_keys(df, "k", [F.asc("v"), F.asc("k")], 2).first().keys == ["d", "f"]
    assert "TakeOrderedAndProject" in _plan(top_k_rows(df, [F.desc("v"), F.asc("k")], 3))


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 0.0005), ("b", 0.0)], "k string, x double")
    got = {r.k: (r.n, r.mean) for r in count_and_mean(df, "k", "x").collect()}
    assert got == {"a": (2, 1.5), "b": (2, 0.0)}
    c = {r.k: r for r in count_by(df, "k").collect()}
    assert c["a"].crime_total == 2
    d = {r.k: r for r in composite_reduce_mean(df.withColumn("c", F.upper("k")), "k", "x", carry="c").collect()}
    assert d["a"].c == "A" and d["a"].total == 3.0 and d["a"].mean == 1.5


def test_union_by_position(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2, "y"), (2, "y")], "other int, t string")
    out = union_by_position(a, b)
    assert out.columns == ["id", "s"] and out.count() == 3
    with pytest.raises(ValueError):
        union_by_position(a, spark.range(1))


@pytest.mark.parametrize("strategy", [None, "merge", "shuffle_hash"])
def test_salting_keeps_results_on_every_shuffled_join(spark, facts, dims, strategy):
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert _rows(join(facts, dims, "prec", how, strategy=strategy, salt=3)) == _rows(join(facts, dims, "prec", how))
    with pytest.raises(ValueError, match="salt"):
        join(facts, dims, "prec", strategy="broadcast", salt=3)


def _salts(df):
    """Rows of each (key, salt) that a salted join shuffles on its left side."""
    from blotter.operators import joins

    seen = []
    plain = joins._SALT
    real = type(df).join

    def spy(self, other, on=None, how=None):
        if isinstance(on, list) and plain in on:
            seen.append(self.groupBy(*on).count().collect())
        return real(self, other, on, how)

    return seen, spy, real


def _spied(monkeypatch, left, right, **kw):
    seen, spy, real = _salts(left)
    monkeypatch.setattr(type(left), "join", spy)
    out = join(left, right, "prec", **kw)
    monkeypatch.setattr(type(left), "join", real)
    return out, seen


def test_salting_splits_equal_rows_and_spreads_a_hot_key(spark, monkeypatch):
    dims = spark.range(50).select(F.col("id").cast("int").alias("prec"), F.concat(F.lit("d"), F.col("id")).alias("division"))
    # 20,000 rows that are all alike, from 32 tasks
    alike = spark.range(0, 20_000, 1, 32).select(F.lit(7).alias("prec"))
    salted, seen = _spied(monkeypatch, alike, dims, strategy="merge", salt=8)
    assert salted.groupBy("prec", "division").count().collect() == [(7, "d7", 20_000)]
    assert len(seen[0]) == 4 and max(r["count"] for r in seen[0]) < 0.6 * 20_000  # four shuffle partitions: four salts
    # one key with many different rows from one task: every salt takes its share
    hot = spark.range(0, 4000, 1, 1).select("id", F.lit(7).alias("prec"))
    salted, seen = _spied(monkeypatch, hot, dims, strategy="merge", salt=8)
    assert _rows(salted.select("id", "prec", "division")) == _rows(hot.join(dims, "prec").select("id", "prec", "division"))
    assert len(seen[0]) == 4 and max(r["count"] for r in seen[0]) < 0.35 * 4000


def test_salting_copies_only_the_rows_of_hot_keys(spark, monkeypatch):
    """100 keys, one of them with half the rows: the others keep salt 0 and one copy of their right row."""
    left = spark.range(10_000).select("id", F.when(F.col("id") % 2 == 0, 3).otherwise((F.col("id") % 100).cast("int")).alias("prec"))
    right = spark.range(100).select(F.col("id").cast("int").alias("prec"), F.col("id").alias("v"))
    salted, seen = _spied(monkeypatch, left, right, strategy="merge", salt=16)
    salts = {}
    for r in seen[0]:
        salts.setdefault(r["prec"], set()).add(r["__salt"])
    assert len(salts.pop(3)) == 3 and all(s == {0} for s in salts.values())  # half the rows fill two of four tasks
    assert _rows(salted.select("id", "prec", "v")) == _rows(left.join(right, "prec").select("id", "prec", "v"))
    # no hot key: the plain join, with no salt in its plan
    even = left.filter("id % 2 = 1")
    assert "__salt" not in _plan(join(even, right, "prec", salt=16)) and "__salt" in _plan(salted)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salting_of_null_keys_maps_and_several_columns(spark, how):
    left = spark.sql("""SELECT id, CASE WHEN id % 3 > 0 THEN CAST(id % 3 AS DOUBLE) END a, CASE WHEN id % 5 = 0 THEN -0.0D ELSE 1.5D END b,
                        map('x', id % 2) m, array(id) l FROM range(3000)""")
    right = spark.sql("""SELECT * FROM VALUES (1, 0.0D, 'p'), (1, 1.5D, 'q'), (2, 1.5D, 'r'), (2, 1.5D, 's'), (NULL, 1.5D, 't') AS t(a, b, s)""")
    text = lambda df: sorted(str(r) for r in df.collect())
    want = text(left.join(right, ["a", "b"], how))
    assert text(join(left, right, ["a", "b"], how, salt=5)) == want and want


def test_salting_needs_comparable_keys(spark):
    left, right = spark.sql("SELECT 1 k FROM range(9)"), spark.sql("SELECT '1' k, 2 v")
    with pytest.raises(ValueError, match="cast"):
        join(left, right, "k", salt=3)
    with pytest.raises(ValueError, match="preserve"):
        join(left, right.withColumn("k", F.lit(1)), "k", "right", salt=3)
    assert join(left, right.withColumn("k", F.lit(1).cast("bigint")), "k", salt=3).count() == 9
    assert join(left.limit(0), right.withColumn("k", F.lit(1)), "k", salt=3).count() == 0


def test_hot_keys(spark):
    df = spark.range(0, 30_000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 10 == 1, "b").otherwise(F.col("id").cast("string")).alias("k"))
    exact = {r["h"]: r["count"] for r in df.groupBy(F.xxhash64("k").alias("h")).count().filter("count > 1").collect()}
    found = hot_keys(df, "k", 0.02)
    assert {h for h, _, _ in found} == set(exact) and {t for _, _, t in found} == {30_000}
    assert all(exact[h] * 0.9 <= n <= exact[h] for h, n, _ in found)  # 18,000 distinct keys: the counts are lower bounds
    assert hot_keys(df, "k", 0.5) == [] and hot_keys(df.limit(0), "k", 0.1) == []
    with pytest.raises(ValueError):
        hot_keys(df, "k", 0)


def test_exact_means_have_the_same_bits_in_any_order(spark):
    df = spark.range(0, 20_000, 1, 1).select((F.col("id") % 3).alias("k"), (F.sin("id") * F.pow(10.0, F.col("id") % 9)).alias("x"),
                                             (F.col("id") % 5).alias("w"))
    df = df.withColumn("x", F.when(F.col("w") == 4, F.lit(float("nan"))).otherwise(F.col("x")))

    def means(parts, f):
        return {r[0]: tuple(r)[1:] for r in f(df.repartition(parts, F.pmod(F.hash("x"), F.lit(1000)) + parts)).collect()}

    for f in (lambda d: count_and_mean(d, "k", "x", decimals=None),
              lambda d: composite_reduce_mean(d.filter("w < 4"), "k", "x", decimals=9),
              lambda d: d.groupBy("k").agg(exact_mean(F.col("x"), F.col("w")))):
        one = means(1, f)
        assert one == means(7, f) == means(211, f) and len(one) == 3
    got = df.groupBy("k").agg(exact_mean(F.col("x"), F.col("w")).alias("m"),
                              (F.sum(F.when(F.col("w") < 4, F.col("x") * F.col("w"))) / F.sum(F.when(F.col("w") < 4, F.col("w")))).alias("p"))
    assert all(abs(r["m"] - r["p"]) < 1e-6 * (1 + abs(r["p"])) for r in got.collect())


def test_broadcast_side_is_computed_once(spark, facts):
    ran = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        ran.add(1)
        return f"d{x}"

    side = spark.range(0, 5, 1, 1).select(F.col("id").cast("int").alias("prec"), counted("id").alias("division"))
    assert join(facts, side, "prec", strategy="broadcast").count() == 60
    join(facts, side, "prec", strategy="broadcast").collect()
    assert ran.value == 10


def test_require_unique_ignores_null_keys(spark):
    table = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "prec int, division string")
    assert require_unique(table, "prec").count() == 3
    assert join(spark.range(3).select(F.col("id").cast("int").alias("prec")), require_unique(table, "prec"), "prec").count() == 1
