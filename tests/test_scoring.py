from __future__ import annotations

import itertools
import math
import subprocess
import sys

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.sql import functions as F

from spendcast.functions.scoring import (
    Polynomial,
    batch_function,
    polynomial_exponents,
    register_array_function,
    register_batch_function,
    score,
)
from spendcast.schemas import FEATURES

rng = np.random.default_rng(7)
MODEL = Polynomial(
    FEATURES,
    polynomial_exponents(4, 2),
    tuple(rng.normal(size=14) * 1e5),
    -2.5e-7,
    (250000.0, 400000.0, 2000.0, 500.0),
    (1e5, 3.3e4, 1.0, 250.0),
)
BUDGETS = [(250000, 250000, 200000, 450000), (500000, 500000, 500000, 500000), (8500, 9500, 2000, 500)]


def by_hand(model, values):
    z = [(v - c) / s for v, c, s in zip(values, model.centers, model.scales)]
    terms = (w * math.prod(a**e for a, e in zip(z, row)) for w, row in zip(model.weights, model.exponents))
    return abs(model.intercept + sum(terms))


@pytest.fixture
def budgets(spark):
    return spark.createDataFrame([(i, *b) for i, b in enumerate(BUDGETS)], ["SCENARIO_ID", *FEATURES])


@pytest.mark.parametrize("inputs, degree", [(1, 2), (2, 2), (4, 1), (4, 2), (4, 3), (3, 4)])
def test_terms_are_in_the_order_of_the_expansion(spark, inputs, degree):
    primes = (2.0, 3.0, 5.0, 7.0)[:inputs]
    df = spark.createDataFrame([primes], [f"x{i}" for i in range(inputs)])
    vector = VectorAssembler(inputCols=df.columns, outputCol="v").transform(df)
    expanded = PolynomialExpansion(degree=degree, inputCol="v", outputCol="p").transform(vector).first()["p"]
    ours = [math.prod(p**e for p, e in zip(primes, row)) for row in polynomial_exponents(inputs, degree)]
    assert ours == list(expanded)
    assert len(ours) == math.comb(inputs + degree, degree) - 1


def test_all_ways_of_scoring_agree(spark, budgets):
    register_array_function(spark, MODEL, "predict_roi")
    register_batch_function(spark, MODEL, "batch_predict_roi")
    scored = score(budgets, MODEL, output="native").select(
        "SCENARIO_ID",
        "native",
        F.call_udf("predict_roi", F.array(*FEATURES)).alias("by_array"),
        F.call_udf("batch_predict_roi", *FEATURES).alias("by_batch"),
    )
    for row in scored.orderBy("SCENARIO_ID").collect():
        expected = by_hand(MODEL, BUDGETS[row["SCENARIO_ID"]])
        for way in ("native", "by_array", "by_batch"):
            assert row[way] == pytest.approx(expected, rel=1e-12)


def test_call_from_sql_text(spark):
    register_array_function(spark, MODEL, "predict_roi")
    values = dict(zip("abcd", BUDGETS[0]))
    got = spark.sql("SELECT predict_roi(array(:a, :b, :c, :d)) AS PREDICTED_ROI", args=values).first()[0]
    assert got == pytest.approx(by_hand(MODEL, BUDGETS[0]), rel=1e-12)


def test_registering_again_replaces(spark, budgets):
    register_array_function(spark, MODEL, "predict_roi")
    register_array_function(spark, Polynomial.plain(FEATURES, 1, (1, 0, 0, 0), 0.5), "predict_roi")
    row = budgets.select(F.call_udf("predict_roi", F.array(*FEATURES)).alias("p")).orderBy("p").first()
    assert row["p"] == 8500.5


def test_too_short_array_fails(spark):
    register_array_function(spark, MODEL, "predict_roi")
    with pytest.raises((PySparkException, Py4JJavaError)):
        spark.sql("SELECT predict_roi(array(a)) FROM VALUES (1.0D) AS t(a)").collect()


def test_negative_predictions_are_folded(spark, budgets):
    model = Polynomial.plain(FEATURES, 1, (-1.0, 0.0, 0.0, 0.0), 0.0)
    got = {r["SCENARIO_ID"]: r["PREDICTED_ROI"] for r in score(budgets, model).collect()}
    assert got == {0: 250000.0, 1: 500000.0, 2: 8500.0}


def test_null_budget_gives_null_everywhere(spark):
    register_array_function(spark, MODEL, "predict_roi")
    register_batch_function(spark, MODEL, "batch_predict_roi")
    df = spark.createDataFrame([(1, None, 3, 4), (1, 2, 3, 4)], ", ".join(f"{f} long" for f in FEATURES))
    scored = score(df, MODEL, output="a").select(
        "SOCIAL_MEDIA",
        "a",
        F.call_udf("predict_roi", F.array(*FEATURES)).alias("b"),
        F.call_udf("batch_predict_roi", *FEATURES).alias("c"),
    )
    for row in scored.collect():
        empty = row["SOCIAL_MEDIA"] is None
        assert [row[c] is None for c in "abc"] == [empty] * 3


def test_inputs_are_bound_by_name(spark):
    df = spark.createDataFrame([(4, 3, 2, 1)], "EMAIL int, VIDEO int, SOCIAL int, SEARCH_ENGINE int")
    model = Polynomial.plain(FEATURES, 1, (1000.0, 100.0, 10.0, 1.0), 0.0)
    assert score(df, model, {"SOCIAL_MEDIA": "SOCIAL"}).first()["PREDICTED_ROI"] == 1234.0


def test_weight_count_is_checked():
    with pytest.raises(ValueError):
        Polynomial.plain(FEATURES, 2, (1.0,), 0.0)


def test_native_and_array_scorers_stay_in_the_jvm(spark, budgets):
    register_array_function(spark, MODEL, "predict_roi")
    frames = [score(budgets, MODEL), budgets.select(F.call_udf("predict_roi", F.array(*FEATURES)))]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan


def test_batch_scorer_uses_arrow(spark, budgets):
    register_batch_function(spark, MODEL, "batch_predict_roi")
    plan = budgets.select(F.call_udf("batch_predict_roi", *FEATURES))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_batch_function_needs_no_package_on_the_workers(tmp_path):
    """The function travels by value: plain arrays, numpy and pyarrow."""
    payload = tmp_path / "function.pkl"
    payload.write_bytes(cloudpickle.dumps(batch_function(MODEL).func))
    code = (
        "import pickle, sys, pyarrow as pa\n"
        "f = pickle.load(open(sys.argv[1], 'rb'))\n"
        "columns = tuple(pa.array([v]) for v in (250000, 250000, 200000, 450000))\n"
        "print(repr(next(f(iter([columns])))[0].as_py()))\n"
        "assert not [m for m in sys.modules if m.startswith('spendcast')]\n"
    )
    out = subprocess.run(
        [sys.executable, "-c", code, str(payload)], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    value = float(out.stdout.strip().removeprefix("np.float64(").removesuffix(")"))
    assert value == pytest.approx(by_hand(MODEL, BUDGETS[0]), rel=1e-12)


def test_literals_read_back_exactly(spark):
    for value in itertools.chain(MODEL.weights, (1e-300, 123456789.123456789, -1e22, 0.1)):
        model = Polynomial.plain(("x",), 1, (0.0,), value)
        assert spark.range(1).select(F.expr(model.sql(["id"]))).first()[0] == value
