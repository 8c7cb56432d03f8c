"""Grid search over degree and penalty from one pass over the rows.

The sums of products of all terms of the highest degree hold those of every lower
degree as a part, and a ridge penalty adds to their diagonal. So every candidate is
fitted and scored on every fold, and the chosen one on all training rows, from the
same sums: one row for each fold and one for the test side, whatever the grid.

Terms are products of inputs in units of their deviation around their mean, the
label likewise; the penalty is on the squared weights of these terms, in rows, and
not on the intercept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spendcast.functions.scoring import Polynomial, polynomial_exponents
from spendcast.plans.factors import Factor
from spendcast.plans.training import SOLVERS, NormalEquations, TooFewRows, prepared_rows, scaled_base, weighted
from spendcast.schemas import FEATURES, LABEL

CANDIDATES = T.StructType(
    [
        T.StructField("DEGREE", T.IntegerType()),
        T.StructField("PENALTY", T.DoubleType()),
        T.StructField("FOLD", T.IntegerType()),
        T.StructField("R2", T.DoubleType()),
    ]
)
CHOSEN = T.StructType(
    [
        T.StructField("DEGREE", T.IntegerType()),
        T.StructField("PENALTY", T.DoubleType()),
        T.StructField("MEAN_R2", T.DoubleType()),
        T.StructField("TRAIN_R2", T.DoubleType()),
        T.StructField("TEST_R2", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class SearchResult:
    """Scores of every candidate and fold, the chosen candidate, and its fit to all training rows."""

    candidates: list[dict]
    degree: int
    penalty: float
    mean_r2: float
    train_r2: float | None
    test_r2: float | None
    polynomial: Polynomial


def search_model(
    rows: DataFrame,
    degrees: Sequence[int] = (1, 2, 3),
    penalties: Sequence[float] = (0.0,),
    folds: int = 10,
    keys: Sequence[str] | None = None,
    seed: int = 42,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    solver: str = "sums",
) -> SearchResult:
    """Choose degree and penalty by the mean fold score; of equal ones the lower degree, then the larger penalty.

    A fold whose label does not vary has no score and is left out of the means.
    Raises TooFewRows where a fold or the training side has no rows.
    """
    if folds < 2 or not degrees or not penalties or min(penalties) < 0:
        raise ValueError("a search takes two folds or more, a degree, and penalties of zero or more")
    prepared = prepared_rows(rows, keys, seed, folds, features, label)
    base, mean, spread = scaled_base(prepared, features, label, max(degrees))
    parts = SOLVERS[solver](prepared, base, mean, spread, label)
    training = {fold: own for (is_test, fold), own in parts.items() if not is_test}
    empty = [f for f in range(folds) if f not in training]
    if empty:
        raise TooFewRows(f"no training rows in fold {', '.join(map(str, empty))} of {folds}")
    every = _total(list(training.values()))
    others = {fold: _total([p for f, p in training.items() if f != fold]) for fold in training}
    scores = []
    for degree in sorted(set(degrees)):
        terms = _terms(base, degree)
        for penalty in sorted(set(map(float, penalties))):
            for fold, own in sorted(training.items()):
                weights = others[fold].part(terms).solve(penalty)
                scores.append({"DEGREE": degree, "PENALTY": penalty, "FOLD": fold, "R2": own.part(terms).r2(weights)})

    def average(degree: int, penalty: float) -> float:
        found = [s["R2"] for s in scores if (s["DEGREE"], s["PENALTY"]) == (degree, penalty) and s["R2"] is not None]
        return float(np.mean(found)) if found else -np.inf

    pairs = sorted({(s["DEGREE"], s["PENALTY"]) for s in scores}, key=lambda p: (p[0], -p[1]))
    degree, penalty = max(pairs, key=lambda p: average(*p))  # the first of equal ones
    terms = _terms(base, degree)
    weights = every.part(terms).solve(penalty)
    test = _total([p for (is_test, _), p in parts.items() if is_test])
    lower = replace(base, exponents=polynomial_exponents(len(features), degree))
    return SearchResult(
        scores,
        degree,
        penalty,
        average(degree, penalty),
        every.part(terms).r2(weights),
        test.part(terms).r2(weights) if test else None,
        weighted(lower, weights, mean, spread),
    )


def _total(parts: list[NormalEquations] | list[Factor]) -> NormalEquations | Factor | None:
    return sum(parts[1:], parts[0]) if parts else None


def _terms(base: Polynomial, degree: int) -> list[int]:
    """Places of the terms up to a degree, the constant first, in the order of an expansion of that degree."""
    place = {e: i for i, e in enumerate(base.exponents, 1)}
    return [0, *(place[e] for e in polynomial_exponents(len(base.features), degree))]


def candidate_frame(spark: SparkSession, result: SearchResult) -> DataFrame:
    """The scores of every candidate, one row per fold."""
    return spark.createDataFrame([tuple(s[f.name] for f in CANDIDATES) for s in result.candidates], CANDIDATES)


def chosen_frame(spark: SparkSession, result: SearchResult) -> DataFrame:
    """The chosen candidate as one row."""
    row = (result.degree, result.penalty, result.mean_r2, result.train_r2, result.test_r2)
    return spark.createDataFrame([row], CHOSEN)
