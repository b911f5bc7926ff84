from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from blotter.llm.shared import most, parts_for, received, send
from blotter.llm.text import mix64


@pytest.mark.parametrize("limit", [0, 1, 2, 3, 50, 120, 10 ** 6])
def test_most_takes_whole_classes_from_the_top(spark, limit):
    values = [*range(100), *[3] * 40, 1500.0, 1_000_000.0, 1_000_001.0, 2e12]
    got = sorted(r["v"] for r in most(spark.createDataFrame([(float(v),) for v in values], "v double"), "v", limit).collect())
    assert len(got) <= limit and got == sorted(values)[len(values) - len(got):]
    if limit >= len(values):
        assert len(got) == len(values)
    if limit == 50:
        assert len(got) == 50 and min(got) == 54
    if limit == 2:
        assert got == [2e12]  # 1,000,000 and 1,000,001 are one class and don't both fit


def test_most_of_nothing(spark):
    assert most(spark.createDataFrame([], "v long"), "v", 5).count() == 0


def test_sent_objects_arrive(spark):
    sent = send(spark, {"a": mix64})
    assert received(sent)["a"].__name__ == "mix64"
    assert parts_for(0, 10) == 1 and parts_for(21, 10) == 3 and parts_for(1, 10, 8) == 8
    assert spark.range(3).select(F.lit(1)).count() == 3
