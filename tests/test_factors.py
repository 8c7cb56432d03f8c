"""Triangular factors against numpy on the rows themselves."""

from __future__ import annotations

import numpy as np
import pytest

from spendcast.functions.scoring import polynomial_exponents
from spendcast.operators.split import exact_split
from spendcast.plans import factors as fa
from spendcast.plans import training as tr
from spendcast.plans.search import search_model
from tests.test_training import MONTHS, frame, months, r2


def design(x, degree, rows):
    z = (x - x[rows].mean(axis=0)) / x[rows].std(axis=0, ddof=1)
    return np.column_stack([np.ones(len(z)), *(np.prod(z ** np.array(e), axis=1) for e in polynomial_exponents(4, degree))])


def sides(df):
    marks = {(r["YEAR"], r["MONTH"]): r["IS_TEST"] for r in exact_split(df, ["YEAR", "MONTH"]).collect()}
    return np.array([marks[2000 + i // 12, i % 12 + 1] for i in range(MONTHS)])


def errors(spark, x, y, degree):
    """How far the training scores of both solvers are from numpy's on the rows."""
    df = frame(spark, x, y)
    test = sides(df)
    terms = design(x, degree, ~test)
    t = (y - y[~test].mean()) / y[~test].std(ddof=1)
    weights = np.linalg.lstsq(terms[~test], t[~test], rcond=None)[0]
    want = r2(t[~test], terms[~test] @ weights), r2(t[test], terms[test] @ weights)
    found = {}
    for solver in ("qr", "sums"):
        report = tr.train_revenue_model(df, folds=0, degree=degree, solver=solver).report
        found[solver] = max(abs(report["train_r2"] - want[0]), abs(report["test_r2"] - want[1]) / max(1, abs(want[1])))
    return found


def test_degree_four_and_nearly_collinear_channels(spark):
    x, y = months(noise=3e4)
    x[:, 1] = x[:, 0] + np.random.default_rng(2).integers(-5000, 5000, MONTHS)  # a condition number of some 1e9
    found = errors(spark, x, y, 4)
    assert found["qr"] < 1e-8
    assert found["sums"] > 1e-6  # where sums of products have lost their digits


@pytest.mark.parametrize("degree", [1, 2])
def test_both_solvers_agree_on_well_conditioned_rows(spark, degree):
    x, y = months(noise=2e4)
    assert max(errors(spark, x, y, degree).values()) < 1e-8
    df = frame(spark, x, y)
    sums, qr = (tr.train_revenue_model(df, folds=10, degree=degree, solver=s) for s in ("sums", "qr"))
    assert [s["N_ROWS"] for s in qr.fold_scores] == [s["N_ROWS"] for s in sums.fold_scores]
    assert [s["R2"] for s in qr.fold_scores] == pytest.approx([s["R2"] for s in sums.fold_scores], abs=1e-8)
    assert qr.polynomial.weights == pytest.approx(sums.polynomial.weights, rel=1e-6)


def test_many_partitions_are_merged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(fa, "_AT_ONCE", 3)
    x, y = months(noise=2e4)
    df = frame(spark, x, y)
    many = tr.train_revenue_model(df.repartition(29), folds=4, solver="qr")
    one = tr.train_revenue_model(df.coalesce(1), folds=4, solver="qr")
    assert [s["R2"] for s in many.fold_scores] == pytest.approx([s["R2"] for s in one.fold_scores], abs=1e-10)
    assert many.report["test_r2"] == pytest.approx(one.report["test_r2"], abs=1e-10)


def test_constant_channel_and_label(spark):
    x, y = months(constant=2)
    assert tr.train_revenue_model(frame(spark, x, y), folds=3, solver="qr").report["train_r2"] > 0.99
    assert tr.train_revenue_model(frame(spark, x, np.full(MONTHS, 5.0)), folds=0, solver="qr").report["train_r2"] is None


def test_search_by_factors(spark):
    x, y = months(noise=1e5)
    df = frame(spark, x, y)
    found = [search_model(df, (1, 2), (0.0, 3.0), folds=5, solver=s) for s in ("sums", "qr")]
    assert found[0].degree == found[1].degree and found[0].penalty == found[1].penalty
    assert [s["R2"] for s in found[0].candidates] == pytest.approx([s["R2"] for s in found[1].candidates], abs=1e-8)
