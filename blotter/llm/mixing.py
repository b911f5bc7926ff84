"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 60-bit hash. Per source, sizes are summed by the
first 12 bits of the hash; the bucket in which the running sum passes the
source's budget is the boundary, and only its documents are summed again by the
next 12 bits, three times over. What is left is one threshold per source: the
documents below it are taken once more. Nothing is sorted, and what is taken for
a larger budget contains what is taken for a smaller one.

A source's target over its size gives whole passes (0, 1 or 2 of every document)
and a rest that the threshold fills; the documents of the last bucket, too fine
to cut, are taken if that comes nearer the target.

Rows: a null text has size 0; a null source is a source of its own, after the
others; equal ids (and all null ids) hash alike and are taken alike. An empty
table gives an empty result. Columns of the input that are also results
(``size``, ``source_size``, ``target``, ``taken``) are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import shared_table

WEIGHTS = (3, 1, 2)
SHARE = 1.5           # of all words
MOST = 2              # times a document may be taken
_BITS, _LEVELS, _WIDTH = 12, 3, 60
_WORD = r"[^\x20\x09-\x0D]+"


def _hash(key: Column) -> Column:
    text = F.concat(F.lit("mix:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, _WIDTH // 4), 16, 10).cast("long")


def _bucket(level: int) -> Column:
    return F.shiftright("h", _WIDTH - _BITS * (level + 1)).bitwiseAND((1 << _BITS) - 1)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights in code-point order of the sources
    (null last), no target above ``most`` times its source, the excess dealt to the others by weight.

    One row per source goes through one task.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights)) + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    order = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1))
    rest = F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing))
    whole = F.sum("source_size").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    levels = ranked.withColumn("level", (whole * F.lit(float(share)) - F.coalesce(before, F.lit(0))) / rest)
    top = F.max("level").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return levels.withColumn("target", F.least(F.col("cap").cast("double"), top * F.col("w"))).select(
        "source", "source_size", "target")


def _thresholds(base: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """(source, source_size, target, passes, below): hashes under ``below`` are taken once more."""
    passes = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size"))))
    state = targets.withColumn("passes", F.coalesce(passes, F.lit(0)).cast("long"))
    state = (state.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
             .withColumn("below", F.lit(0).cast("long")))
    inside = base
    for level in range(_LEVELS):
        sums = (inside.groupBy("source", _bucket(level).alias("b")).agg(F.sum("size").alias("s")))
        up_to = F.sum("s").over(W.partitionBy("source").orderBy("b"))
        sums = sums.withColumn("before", up_to - F.col("s")).withColumnRenamed("source", "src")
        edge = sums.join(state.select("source", "rest"), F.col("src").eqNullSafe(F.col("source")))
        edge = edge.filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("s") > F.col("rest")))
        edge = shared_table(edge.select("src", "b", "before", "s"), "mix-boundary", small=True)
        shift = _WIDTH - _BITS * (level + 1)
        found = state.join(edge, F.col("source").eqNullSafe(F.col("src")), "left")
        left = F.col("rest") - F.col("before")
        below = F.col("below") + F.shiftleft(F.col("b"), shift)
        if level == _LEVELS - 1:
            below = below + F.when(left * 2 >= F.col("s"), 1 << shift).otherwise(0)
        state = found.select("source", "source_size", "target", "passes",
                             F.coalesce(left, "rest").alias("rest"), F.coalesce(below, "below").alias("below"))
        inside = inside.join(edge.select("src", "b"), F.col("source").eqNullSafe(F.col("src"))
                             & (_bucket(level) == F.col("b")), "left_semi")
    return state


def _sized(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.regexp_count(text_col, F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
            _hash(F.col(id_col)).alias("h")]


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return shared_table(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                                    *_sized(id_col, text_col)), "mix-sizes")


def _plan(base: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = _thresholds(base, shared_table(source_targets(sizes, weights, share, most), "mix-targets", small=True), most)
    plan = plan.drop("rest").withColumnsRenamed({c: f"__mix_{c}" for c in plan.columns})
    return shared_table(plan, "mix-plan", small=True)  # its size is then known, and the documents needn't be shuffled to meet it


def _taken(size: Column, h: Column) -> Column:
    once_more = F.when(h < F.col("__mix_below"), 1).otherwise(0)
    return (size * (F.col("__mix_passes") + once_more)).alias("taken")


def _of_source() -> list[Column]:
    return [F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target")]


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(``id_col``, ``source_col``, size, source_size, target, taken) of every row of ``docs``."""
    base = _measured(docs, id_col, text_col, source_col)
    joined = base.join(_plan(base, weights, share, most), F.col("source").eqNullSafe(F.col("__mix_source")))
    return joined.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", *_of_source(),
                         _taken(F.col("size"), F.col("h")))


def with_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target and taken: the whole rows meet the small plan, not each other."""
    docs = docs.drop("size", "source_size", "target", "taken")
    plan = _plan(_measured(docs, id_col, text_col, source_col), weights, share, most)
    joined = docs.join(plan, docs[source_col].cast("string").eqNullSafe(plan["__mix_source"]))
    size, h = _sized(id_col, text_col)
    return (joined.withColumns({"__mix_size": size, "__mix_h": h})
            .select(*docs.columns, F.col("__mix_size").alias("size"), *_of_source(),
                    _taken(F.col("__mix_size"), F.col("__mix_h"))))
