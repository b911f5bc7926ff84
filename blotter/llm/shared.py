"""Helpers common to the operators: Arrow functions and tables in the shared folder."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


@contextmanager
def _by_value():
    """Functions of this subpackage travel inside the task, so executors need not have it installed."""
    package = sys.modules[__package__]
    cloudpickle.register_pickle_by_value(package)
    try:
        yield
    finally:
        cloudpickle.unregister_pickle_by_value(package)


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` with the function shipped by value."""
    with _by_value():
        return df.mapInArrow(fn, schema)


def arrow_groups(df: DataFrame, key: str | list[str], fn, schema) -> DataFrame:
    """``df.groupBy(key).applyInArrow`` over record batches, with the function shipped by value."""

    def group(k: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(k, batches)

    with _by_value():
        return df.groupBy(*([key] if isinstance(key, str) else key)).applyInArrow(group, schema)


def send(spark: SparkSession, model):
    """Broadcast an object of this subpackage's classes; the caller has bounded its size. ``received`` reads it."""
    with _by_value():
        return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(sent, keep: bool = True):
    """The object sent. Without ``keep`` its bytes leave the task's memory again and are read anew next time."""
    model = pickle.loads(sent.value)
    if not keep and getattr(sent, "_path", None):
        sent.__dict__.pop("_value", None)
    return model


def shared_table(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Write ``df`` to the folder every executor shares and read it back.

    Cuts the lineage: a lost executor later costs only the tasks it ran. A
    ``small`` table (a few narrow columns, cheap to make) gets at most two files
    for each core, however many shuffle partitions there are.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if small:
        df = df.coalesce(2 * spark.sparkContext.defaultParallelism)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts (one aggregated row comes to the driver)."""
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def parts_for(total_bytes: int, part_bytes: int, least: int = 1) -> int:
    return int(max(least, -(-total_bytes // part_bytes)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def most(rows: DataFrame, column: str, limit: int) -> DataFrame:
    """The rows with the largest values of ``column`` (at least 0), at most ``limit`` of them.

    Values fall into classes (whole numbers below 1024, then 64 classes for each
    doubling); as many whole classes as fit are taken, the highest first. The
    driver gets one count for each class and no task more than it keeps, as
    sorting would. ``rows`` should be a written table: it is read twice.
    """
    v = F.col(column).cast("double")
    kind = F.when(v < 1024, F.floor(v)).otherwise(1024 + F.floor((F.log2(v) - 10) * 64)).cast("long")
    lowest, total = None, 0
    for r in sorted(rows.groupBy(kind.alias("k")).count().collect(), key=lambda r: -r["k"]):
        total += r["count"]
        if total > limit:
            break
        lowest = r["k"]
    return rows.filter(F.lit(False) if lowest is None else kind >= lowest)
