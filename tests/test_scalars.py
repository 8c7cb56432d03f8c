from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from spendcast.functions.scalars import (
    fixed_decimals,
    month_name,
    percent_change,
    round_half_even,
    session_info,
    years_between,
)
from spendcast.schemas import MONTH_NAMES

TIES = [0.25, 0.35, -0.25, 2.5, 1.05, 12.345, 0.15000000000000002, 1e9 + 0.05]


def test_rounding_equals_array_rounding(spark):
    df = spark.createDataFrame([(v,) for v in TIES], "v double")
    got = [r[0] for r in df.select(round_half_even(F.col("v"), 1)).collect()]
    assert got == [float(np.round(v, 1)) for v in TIES]
    assert got[0] == 0.2


def test_text_equals_python_format(spark):
    values = [0.125, 2.675, 3.0, 1234567.891, -0.5, 0.005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(fixed_decimals(F.col("v"), 2)).collect()] == [f"{v:.2f}" for v in values]


def test_percent_change(spark):
    df = spark.createDataFrame([(11.0, 10.0), (5.0, 0.0), (None, 1.0)], "n double, o double")
    assert [r[0] for r in df.select(percent_change(F.col("n"), F.col("o"))).collect()] == [10.0, None, None]


def test_plain_division_by_zero_fails(spark):
    with pytest.raises(ArithmeticException):
        spark.createDataFrame([(5.0, 0.0)], "n double, o double").select(F.col("n") / F.col("o")).collect()


def test_month_names(spark):
    df = spark.sql("SELECT make_date(2024, m, 1) AS d FROM (SELECT explode(sequence(1, 12)) AS m)")
    assert [r[0] for r in df.orderBy("d").select(month_name("d")).collect()] == list(MONTH_NAMES)


def test_years_are_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT date'1997-05-01' AS DATE, 1 AS v UNION ALL SELECT date'1999-01-01', 2").write.parquet(path)
    df = spark.read.parquet(path).filter(years_between("DATE", 1997, 1998))
    assert [r["v"] for r in df.collect()] == [1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(DATE,1997-01-01)" in plan and "LessThan(DATE,1999-01-01)" in plan


def test_session_info(spark):
    row = session_info(spark).first()
    assert row["version"].startswith("4.") and row["database"] == "default" and row["user"]


