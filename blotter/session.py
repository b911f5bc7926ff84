"""Session helpers.

Library functions never create or stop a session: they take the caller's
``SparkSession`` (or a DataFrame bound to one). ``build_session`` exists for
tests, the bench and command-line use on a single machine; on a cluster the
caller builds the session with the cluster's own settings.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on for reproducible results. Timestamps are
# parsed from wall-clock text, so the session time zone must be fixed.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that make the plans behave well at scale. AQE re-plans joins at
# runtime (late broadcast, skew splitting, partition coalescing).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a
    # whole-stage method beyond that runs interpreted. Spark's documentation
    # recommends this limit on HotSpot so such stages fall back to
    # per-operator generated code, which is compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    master: str | None = None,
    app_name: str = "blotter",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **SCALE_CONF, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def cluster_conf(total_cores: int, scan_split_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run, from the cluster's cores.

    The reports shuffle a row per group and task, not their input, so the
    shuffle width follows the cores (three waves of tasks), whatever the size
    of the input: a width that grew with it would cost the driver a status
    for every pair of map task and partition. AQE coalesces partitions that
    turn out small and splits skewed ones; raise
    ``spark.sql.shuffle.partitions`` for jobs that do shuffle their input.
    """
    return {
        **REQUIRED_CONF,
        **SCALE_CONF,
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(3 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


_LOCAL_SCRATCH: list[tempfile.TemporaryDirectory] = []  # removed when the interpreter ends


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name storage that every executor reaches
    (HDFS, object store); without it this raises, because files in a machine's
    own folder would be missing elsewhere. Only a local master gets a private
    temporary folder, which is removed when the program ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.TemporaryDirectory(prefix="blotter-scratch-", ignore_cleanup_errors=True)
        _LOCAL_SCRATCH.append(folder)
        configured = folder.name
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_LEASES: list[tuple[str, str]] = []  # (application, folder) of the open ``scratch`` blocks, innermost last


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path on it."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(sc._jsc.hadoopConfiguration()), folder


def _app_folder(spark: SparkSession) -> str:
    """This application's folder under the checkpoint folder; it goes when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/blotter-{spark.sparkContext.applicationId}"
    files, folder = _folder(spark, path)
    if files.mkdirs(folder):
        files.deleteOnExit(folder)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder.

    Tables are written there and read lazily, so they live until the block of
    ``scratch`` they were made in ends, ``drop_scratch`` is called or the driver ends.
    """
    app = spark.sparkContext.applicationId
    mine = [folder for owner, folder in _LEASES if owner == app]
    return f"{mine[-1] if mine else _app_folder(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read back: computed once, with a known size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Scratch tables made inside the block are deleted at its end: use their results, or write them, inside."""
    folder = f"{_app_folder(spark)}/lease-{uuid.uuid4().hex}"
    lease = (spark.sparkContext.applicationId, folder)
    _LEASES.append(lease)
    try:
        yield folder
    finally:
        _LEASES.remove(lease)
        files, path = _folder(spark, folder)
        files.delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application, before ``spark.stop()`` or when their results are written."""
    files, path = _folder(spark, _app_folder(spark))
    files.delete(path, True)
