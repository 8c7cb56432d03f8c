"""Grid search against fits to the rows themselves."""

from __future__ import annotations

import numpy as np
import pytest

from spendcast.functions.scoring import polynomial_exponents, score
from spendcast.operators.split import exact_split
from spendcast.plans import training as tr
from spendcast.plans.search import candidate_frame, chosen_frame, search_model
from tests.test_training import MONTHS, frame, months, r2

DEGREES, PENALTIES = (3, 1, 2), (0.0, 0.5, 20.0)


def design(z, degree):
    return np.column_stack([np.ones(len(z)), *(np.prod(z ** np.array(e), axis=1) for e in polynomial_exponents(4, degree))])


def ridge(x, y, penalty):
    """By an extended system of rows, not by normal equations."""
    extra = np.sqrt(penalty) * np.eye(x.shape[1])
    extra[0] = 0
    return np.linalg.lstsq(np.vstack([x, extra]), np.concatenate([y, np.zeros(x.shape[1])]), rcond=None)[0]


def test_every_candidate_equals_a_direct_fit(spark):
    x, y = months(noise=2e5)
    df = frame(spark, x, y)
    result = search_model(df, DEGREES, PENALTIES, folds=5)
    marks = {(r["YEAR"], r["MONTH"]): r for r in exact_split(df, ["YEAR", "MONTH"], folds=5).collect()}
    keys = [(2000 + i // 12, i % 12 + 1) for i in range(MONTHS)]
    test = np.array([marks[k]["IS_TEST"] for k in keys])
    fold = np.array([-1 if marks[k]["FOLD"] is None else marks[k]["FOLD"] for k in keys])
    z = (x - x[~test].mean(axis=0)) / x[~test].std(axis=0, ddof=1)
    t = (y - y[~test].mean()) / y[~test].std(ddof=1)
    found = {(s["DEGREE"], s["PENALTY"], s["FOLD"]): s["R2"] for s in result.candidates}
    assert len(found) == 3 * 3 * 5
    means = {}
    for degree in DEGREES:
        terms = design(z, degree)
        for penalty in PENALTIES:
            for f in range(5):
                kept, held = ~test & (fold != f), fold == f
                weights = ridge(terms[kept], t[kept], penalty)
                want = r2(t[held], terms[held] @ weights)
                assert found[degree, penalty, f] == pytest.approx(want, abs=1e-6)
                means.setdefault((degree, penalty), []).append(want)
    best = max(means, key=lambda k: np.mean(means[k]))
    assert (result.degree, result.penalty) == best
    assert result.mean_r2 == pytest.approx(np.mean(means[best]), abs=1e-6)
    terms = design(z, best[0])
    weights = ridge(terms[~test], t[~test], best[1])
    assert result.train_r2 == pytest.approx(r2(t[~test], terms[~test] @ weights), abs=1e-8)
    assert result.test_r2 == pytest.approx(r2(t[test], terms[test] @ weights), abs=1e-6)
    scored = score(df, result.polynomial).orderBy("YEAR", "MONTH").collect()
    direct = np.abs(terms @ weights * y[~test].std(ddof=1) + y[~test].mean())
    assert [r["PREDICTED_ROI"] for r in scored] == pytest.approx(direct, rel=1e-8)
    assert candidate_frame(spark, result).count() == 45 and chosen_frame(spark, result).count() == 1


def test_a_search_without_choice_is_a_training_run(spark):
    x, y = months(noise=1e4)
    df = frame(spark, x, y)
    result = search_model(df, [2], [0.0], folds=10)
    trained = tr.train_revenue_model(df, folds=10, degree=2)
    assert [s["R2"] for s in result.candidates] == pytest.approx([s["R2"] for s in trained.fold_scores], abs=1e-9)
    assert result.test_r2 == pytest.approx(trained.report["test_r2"], abs=1e-9)


def test_the_grid_costs_no_further_pass(spark):
    x, y = months(noise=1e4)
    df = frame(spark, x, y)
    context = spark.sparkContext
    jobs = []
    for name, grid in (("one", ([2], [0.0])), ("many", ([1, 2], [0.0, 0.1, 1.0, 10.0, 100.0]))):
        context.setJobGroup(name, name)
        search_model(df, *grid, folds=4)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(name)))
    context.setJobGroup("", "")
    assert jobs[0] == jobs[1]


def test_simple_data_take_the_simple_model(spark):
    x, y = months()
    y = 5.0 + x[:, 0] * 2.0 + np.random.default_rng(1).normal(size=MONTHS) * 1e5
    result = search_model(frame(spark, x, y), (1, 2, 3), (0.0,), folds=5)
    assert result.degree == 1


def test_a_wrong_grid_is_refused(spark):
    x, y = months()
    for grid in (([], [0.0]), ([1], []), ([1], [-1.0])):
        with pytest.raises(ValueError):
            search_model(frame(spark, x, y), *grid)
    with pytest.raises(tr.TooFewRows, match="fold"):
        search_model(frame(spark, x[:8], y[:8]), [1], folds=10)
