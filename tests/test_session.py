import os
import subprocess
import sys
import time
import types

import pytest

from blotter.session import checkpoint_dir, cluster_conf, drop_scratch, scratch, scratch_path, scratch_table


def test_cluster_conf_follows_the_cores():
    conf = cluster_conf(8000)
    assert conf["spark.sql.shuffle.partitions"] == "24000"
    assert cluster_conf(64)["spark.sql.shuffle.partitions"] == "192"
    assert conf["spark.sql.session.timeZone"] == "UTC" and conf["spark.sql.adaptive.enabled"] == "true"


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base.rstrip("/")) and a != b


def _fake(master, configured=None):
    told = {}
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: told.get("dir"),
                               getConf=lambda: {"spark.checkpoint.dir": configured} if configured else {},
                               setCheckpointDir=lambda d: told.update(dir=d))
    return types.SimpleNamespace(sparkContext=sc)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_fake("spark://host:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_dir(_fake("local-cluster[2,1,1024]"))
    assert checkpoint_dir(_fake("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert os.path.isdir(checkpoint_dir(_fake("local[2]")))


def _found(folder):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(folder) for f in names)


def test_a_lease_drops_its_tables(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    outer = scratch_table(spark.range(3), "outer")
    before = _found(base)
    with scratch(spark) as folder:
        assert scratch_table(spark.range(5), "inner").count() == 5
        with scratch(spark) as nested:
            scratch_table(spark.range(2), "nested")
            assert _found(nested.removeprefix("file:"))
        assert not os.path.exists(nested.removeprefix("file:"))
        assert scratch_path(spark, "x").startswith(folder)
    assert _found(base) == before and outer.count() == 3
    with pytest.raises(ZeroDivisionError), scratch(spark):
        scratch_table(spark.range(5), "inner")
        1 / 0
    assert _found(base) == before


@pytest.mark.parametrize("end", ["", "drop_scratch(s)\n", "s.stop()\n"])
def test_nothing_is_left_in_a_shared_folder(tmp_path, end):
    """Of a non-local file system path (here through viewfs), too."""
    (tmp_path / "kept").write_text("not ours")
    code = ("from blotter.session import build_session, scratch_table, drop_scratch\n"
            f"s = build_session('local[1]', extra={{'spark.checkpoint.dir': 'viewfs://shared/check',\n"
            f" 'spark.hadoop.fs.viewfs.mounttable.shared.link./check': 'file://{tmp_path}'}})\n"
            "assert scratch_table(s.range(5), 'x').count() == 5\n"
            f"import os; assert any(n.endswith('.parquet') for _, _, f in os.walk('{tmp_path}') for n in f)\n" + end)
    env = {**os.environ, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=200)
    for _ in range(100):  # the JVM may end a little later
        if (left := _found(tmp_path)) == [str(tmp_path / "kept")]:
            break
        time.sleep(0.2)
    assert left == [str(tmp_path / "kept")]
