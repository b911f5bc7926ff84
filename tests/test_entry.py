"""The driver contract, checked against DuckDB on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_check import _rows, duck

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "crime_total", "ranking"]
    assert df.count() > 0


OWN = sorted(entry._QUERIES)


def test_every_query_of_the_reports_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql()) and set(OWN) <= set(entry.queries())


def test_corpus_part_is_optional(tmp_path):
    """Without the corpus subpackage and its pipeline the rest still imports."""
    import shutil
    import subprocess
    import sys

    from tests.conftest import ROOT

    for name in ("blotter", "__spark_entry__.py", "duck_oracles.py"):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(OWN))] * 2, out.stderr[-2000:]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_udf_query_runs_from_another_directory(tmp_path):
    """Executors need not import the package: the pandas UDF ships by value."""
    import subprocess
    import sys

    from tests.conftest import ROOT

    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "import __spark_entry__ as e\n"
            "s = SparkSession.builder.master('local[2]').getOrCreate()\n"
            "print('rows', e.queries()['udf_distance'](s, %r).agg({'distance_km': 'sum'}).first()[0])\n") % (ROOT, SF_SMALL)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "rows " in out.stdout
