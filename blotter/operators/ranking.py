"""Ranking, top-N per group and global top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, partition_by: str | Sequence[str], order_by: str,
                descending: bool = True, out: str = "ranking") -> DataFrame:
    """``rank()`` over (partition by ... order by ...): ties share a rank and
    leave a gap after them."""
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    o = F.col(order_by).desc() if descending else F.col(order_by).asc()
    return df.withColumn(out, F.rank().over(Window.partitionBy(*parts).orderBy(o)))


def top_n_per_group(df: DataFrame, partition_by: str | Sequence[str], order_by: str, n: int = 3,
                    descending: bool = True, out: str = "ranking") -> DataFrame:
    """Rows whose rank within their group is at most ``n``.

    Ties are kept, so a group can return more than ``n`` rows. Spark plans
    this as a partial ``WindowGroupLimit`` before the shuffle and a final one
    after it, so only candidate rows cross the network.
    """
    return rank_within(df, partition_by, order_by, descending, out).filter(F.col(out) <= n)


def top_k_rows(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """Global top-k rows by ``order_by`` (give a unique last key for a
    deterministic result). Each task keeps only its own k best rows."""
    return df.orderBy(*order_by).limit(k)


def top_k_keys(df: DataFrame, key: str, order_by: Sequence[Column], k: int = 3,
               out: str = "keys") -> DataFrame:
    """One row with the keys of the global top-k rows, as a sorted array."""
    return top_k_rows(df, order_by, k).agg(F.sort_array(F.collect_list(key)).alias(out))
