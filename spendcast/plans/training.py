"""Fit, check, gate and save the revenue model.

The model is a Spark ML pipeline: assemble, standardise, expand to a polynomial,
least squares. Standardising the channels before the expansion gives the same
predictions as standardising the terms after it, since a full polynomial of
scaled inputs is a full polynomial of the inputs; but x and x*x are no longer
nearly collinear, which keeps the normal equations well conditioned.

A run reads the features three times, whatever their size, and keeps no copy of
them: the keys alone for the cuts of an exact split (now and then again, for the
few rows about a cut), then all once for means and deviations and once for sums of
products of terms, grouped by side of the split and fold. The fit, R2 on both sides
and every fold score follow from these sums, one row per fold and one for the test
side. What is saved are the solved weights; the pipeline is fitted on request only.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce
from operator import or_
from typing import NamedTuple

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendcast.functions.scoring import Polynomial, polynomial_exponents
from spendcast.operators.split import exact_split
from spendcast.plans.factors import factors
from spendcast.registry import SnapshotLog, read_text, write_text
from spendcast.schemas import FEATURES, LABEL, MONTH_KEYS, TRAIN_REPORT
from spendcast.workspace import remove_folder

MODEL_RUNS = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("model_path", T.StringType()),
        *TRAIN_REPORT.fields,
        # One clock for all runs below a root, whoever started them; the current model goes by it.
        T.StructField("run_time", T.LongType()),
    ]
)
# What a root keeps: runs in its registry, and models that passed their gate.
KEPT_RUNS = 200
KEPT_MODELS = 5
# Sums in one aggregation: with more fields than this Spark leaves generated code.
_SUMS_AT_ONCE = 80
_FOLD_SCORES = T.StructType(
    [
        T.StructField("FOLD", T.IntegerType()),
        T.StructField("N_ROWS", T.LongType()),
        T.StructField("R2", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class TrainResult:
    """What a training run leaves behind."""

    report: dict
    polynomial: Polynomial | None
    fold_scores: list[dict]
    model_path: str | None
    pipeline: PipelineModel | None = None


class TooFewRows(ValueError):
    """There are not enough rows to fit, to test or to fill every fold."""


def revenue_pipeline(degree: int, features: Sequence[str] = FEATURES, label: str = LABEL) -> Pipeline:
    """The unfitted pipeline."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="error"),
            StandardScaler(inputCol="raw_features", outputCol="scaled_features", withMean=True, withStd=True),
            PolynomialExpansion(degree=degree, inputCol="scaled_features", outputCol="features"),
            LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=0.0),
        ]
    )


def to_polynomial(model: PipelineModel) -> Polynomial:
    """The fitted pipeline as a plain formula."""
    assembler, scaler, expansion, regression = model.stages
    features = tuple(assembler.getInputCols())
    # A constant channel has no deviation; the scaler maps it to 0, any scale does.
    scales = tuple(float(s) or 1.0 for s in scaler.std)
    return Polynomial(
        features,
        polynomial_exponents(len(features), expansion.getDegree()),
        tuple(float(w) for w in regression.coefficients),
        float(regression.intercept),
        tuple(float(m) for m in scaler.mean),
        scales,
    )


def split_keys(df: DataFrame) -> list[str]:
    """The month if the frame has it, else every column: a row's content is its key."""
    names = {c.upper() for c in df.columns}
    return list(MONTH_KEYS) if names.issuperset(MONTH_KEYS) else list(df.columns)


def prepared_rows(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    seed: int = 42,
    folds: int = 0,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
) -> DataFrame:
    """Features and label as doubles, IS_TEST and FOLD; the keys have done their work."""
    marked = exact_split(df, list(keys or split_keys(df)), seed, folds=folds)
    numbers = [F.col(c).cast("double").alias(c) for c in (*features, label)]
    marks = ["IS_TEST", "FOLD"] if folds else ["IS_TEST"]
    return marked.select(*numbers, *marks)


def _r2(squared_error: float, variance: float) -> float | None:
    return 1.0 - squared_error / variance if variance else None


def _term(inputs: Sequence[Column], exponents: Sequence[int]) -> Column:
    factors = [inputs[i] for i, e in enumerate(exponents) for _ in range(e)]
    total = factors[0] if factors else F.lit(1.0)
    for factor in factors[1:]:
        total = total * factor
    return total


@dataclass(frozen=True)
class NormalEquations:
    """Normal equations of some rows: sums of products of terms, with the label, and of the squared label."""

    gram: np.ndarray
    moment: np.ndarray
    squares: float

    @property
    def count(self) -> int:
        return int(round(self.gram[0, 0]))

    def __add__(self, other: NormalEquations) -> NormalEquations:
        return NormalEquations(self.gram + other.gram, self.moment + other.moment, self.squares + other.squares)

    def part(self, terms: Sequence[int]) -> NormalEquations:
        """The equations of some of the terms."""
        return NormalEquations(self.gram[np.ix_(terms, terms)], self.moment[list(terms)], self.squares)

    def solve(self, penalty: float = 0.0) -> np.ndarray:
        """The weights with the least squared error, plus ``penalty`` times the squared weights without the constant."""
        added = np.full(len(self.moment), penalty)
        added[0] = 0.0
        return np.linalg.lstsq(self.gram + np.diag(added), self.moment, rcond=None)[0]

    def r2(self, weights: np.ndarray) -> float | None:
        error = float(self.squares - 2 * weights @ self.moment + weights @ self.gram @ weights)
        spread = float(self.squares - self.moment[0] ** 2 / self.gram[0, 0])
        # A label that does not vary leaves only rounding noise here.
        return _r2(error, spread) if spread > 1e-12 * self.squares else None


class FittedRows(NamedTuple):
    """A model over all rows and its R2 on them."""

    polynomial: Polynomial
    r2: float | None


def fit_rows(rows: DataFrame, features: Sequence[str], label: str, degree: int) -> FittedRows:
    """Fit on every row of a frame, without a split; two passes."""
    all_rows = prepared_rows(rows, [label], features=features, label=label)
    all_rows = all_rows.withColumns({"IS_TEST": F.lit(False), "FOLD": F.lit(0)})
    base, mean, spread = scaled_base(all_rows, features, label, degree)
    (found,) = normal_equations(all_rows, base, mean, spread, label).values()
    weights = found.solve()
    return FittedRows(weighted(base, weights, mean, spread), found.r2(weights))


def scaled_base(rows: DataFrame, features: Sequence[str], label: str, degree: int) -> tuple[Polynomial, float, float]:
    """A polynomial that knows its centers and scales but no weights, with mean and deviation of the label."""
    n = len(features)
    found = _sides(features, label, rows)
    if found[f"m{n}"] is None:
        raise TooFewRows("no training rows")
    exponents = polynomial_exponents(n, degree)
    # A constant channel has no deviation; any scale does.
    base = Polynomial(
        tuple(features), exponents, tuple(0.0 for _ in exponents), 0.0,
        tuple(float(found[f"m{i}"]) for i in range(n)), tuple(float(found[f"s{i}"] or 1.0) for i in range(n)),
    )
    return base, float(found[f"m{n}"]), float(found[f"s{n}"] or 1.0)


def weighted(base: Polynomial, weights: np.ndarray, mean: float, spread: float) -> Polynomial:
    scaled = tuple(float(w * spread) for w in weights[1:])
    return replace(base, weights=scaled, intercept=float(weights[0] * spread + mean))


def _sides(features: Sequence[str], label: str, rows: DataFrame) -> dict:
    """Means and deviations over the training side, from one pass that looks for missing numbers on both sides."""
    inputs = [*features, label]
    training = ~F.col("IS_TEST")
    numbers = [
        f(F.when(training, F.col(c))).alias(f"{n}{i}") for i, c in enumerate(inputs) for n, f in (("m", F.avg), ("s", F.stddev_samp))
    ]
    missing = reduce(or_, (F.col(c).isNull() | F.isnan(c) for c in inputs))
    counts = [F.count_if(missing & side).alias(name) for name, side in (("training", training), ("test", F.col("IS_TEST")))]
    found = rows.agg(*numbers, *counts).first()
    for side in ("training", "test"):
        if found[side]:
            raise ValueError(f"{found[side]} {side} rows hold a null or NaN in {', '.join(inputs)}")
    return found.asDict()


def sums_of_products(rows: DataFrame, polynomial: Polynomial, mean: float, spread: float, label: str = LABEL) -> list[DataFrame]:
    """The frames whose rows, one per side and fold, make up the normal equations.

    Many pairs of terms have the same product, which is summed once. A frame holds as
    many sums as fit into generated code; up to degree 2 over four inputs one does.
    """
    terms, products, _ = _products(polynomial)
    scaled = rows.select(
        "IS_TEST",
        "FOLD",
        ((F.col(label) - F.lit(mean)) / F.lit(spread)).alias("y"),
        *[
            ((F.col(f) - F.lit(center)) / F.lit(scale)).alias(f"x{i}")
            for i, (f, center, scale) in enumerate(zip(polynomial.features, polynomial.centers, polynomial.scales))
        ],
    )
    inputs = [F.col(f"x{i}") for i in range(len(polynomial.features))]
    sums = [F.sum(_term(inputs, e)).alias(f"p{k}") for k, e in enumerate(products)]
    sums += [F.sum(_term(inputs, e) * F.col("y")).alias(f"q{i}") for i, e in enumerate(terms)]
    sums.append(F.sum(F.col("y") * F.col("y")).alias("yy"))
    count = -(-len(sums) // _SUMS_AT_ONCE) if len(sums) > 100 - 4 else 1
    return [scaled.groupBy("IS_TEST", "FOLD").agg(*sums[i::count]) for i in range(count)]


def _products(polynomial: Polynomial) -> tuple[tuple, list, dict]:
    """Terms with the constant, the distinct products of two of them, and each product's place."""
    terms = ((0,) * len(polynomial.features), *polynomial.exponents)
    products = list(dict.fromkeys(tuple(a + b for a, b in zip(s, t)) for s in terms for t in terms))
    return terms, products, {exponents: k for k, exponents in enumerate(products)}


def normal_equations(rows: DataFrame, polynomial: Polynomial, mean: float, spread: float, label: str) -> dict:
    """Normal equations by (IS_TEST, FOLD)."""
    terms, _, place = _products(polynomial)
    merged: dict[tuple, dict] = {}
    for frame in sums_of_products(rows, polynomial, mean, spread, label):
        for row in frame.collect():  # at most two rows per fold
            merged.setdefault((row["IS_TEST"], row["FOLD"]), {}).update(row.asDict())

    def equations(row: dict) -> NormalEquations:
        gram = [[row[f"p{place[tuple(a + b for a, b in zip(s, t))]}"] for t in terms] for s in terms]
        return NormalEquations(np.array(gram), np.array([row[f"q{i}"] for i in range(len(terms))]), row["yy"])

    return {key: equations(row) for key, row in merged.items()}


# How the parts of a fit are made: by (IS_TEST, FOLD), to be added up, solved and scored.
SOLVERS = {"sums": normal_equations, "qr": factors}


def fold_scores(parts: dict[int, NormalEquations], folds: int) -> list[dict]:
    """R2 on every fold of a model fitted to the other folds; every fold has to have rows.

    Least squares needs only sums of products of terms, and those of the other folds
    add up.
    """
    empty = [f for f in range(folds) if f not in parts]
    if empty:
        raise TooFewRows(f"no training rows in fold {', '.join(map(str, empty))} of {folds}")
    scores = []
    for fold, own in sorted(parts.items()):
        others = [p for f, p in parts.items() if f != fold]
        weights = sum(others[1:], others[0]).solve()
        scores.append({"FOLD": int(fold), "N_ROWS": own.count, "R2": own.r2(weights)})
    return scores


def cross_validate(
    rows: DataFrame, polynomial: Polynomial, mean: float, variance: float, folds: int, label: str = LABEL
) -> list[dict]:
    """The fold scores of prepared rows, from one grouped aggregation."""
    training = rows.filter(~F.col("IS_TEST"))
    parts = normal_equations(training, polynomial, mean, variance**0.5 or 1.0, label)
    return fold_scores({fold: own for (_, fold), own in parts.items()}, folds)


def train_revenue_model(
    features: DataFrame,
    folds: int = 10,
    degree: int = 2,
    train_threshold: float = 0.85,
    test_threshold: float = 0.85,
    save_root: str | None = None,
    keys: Sequence[str] | None = None,
    seed: int = 42,
    version: int | None = None,
    pipeline: bool = False,
    solver: str = "sums",
) -> TrainResult:
    """Fit on the training side, score both sides, save if both scores reach their threshold.

    Without ``save_root`` nothing is saved. ``folds`` below 2 skips cross validation.
    ``solver`` is "sums" (of products, inside generated code) or "qr" (triangular factors,
    for many terms or nearly collinear channels). ``pipeline`` also fits the Spark ML pipeline on the training side, which reads the
    rows again. Raises TooFewRows where a fit, a test score or a fold score has no rows
    to go by.
    """
    folds = folds if folds >= 2 else 0
    rows = prepared_rows(features, keys, seed, folds)
    if not folds:
        rows = rows.withColumn("FOLD", F.lit(0))
    base, mean, spread = scaled_base(rows, FEATURES, LABEL, degree)
    parts = SOLVERS[solver](rows, base, mean, spread, LABEL)
    train = [p for (is_test, _), p in parts.items() if not is_test]
    test = [p for (is_test, _), p in parts.items() if is_test]
    scores = fold_scores({fold: p for (is_test, fold), p in parts.items() if not is_test}, folds) if folds else []
    train = sum(train[1:], train[0])
    weights = train.solve()
    train_r2 = train.r2(weights)
    test_r2 = sum(test[1:], test[0]).r2(weights) if test else None
    polynomial = weighted(base, weights, mean, spread)

    passed = passes_gate(train_r2, train_threshold) and passes_gate(test_r2, test_threshold)
    report = _report(train_r2, train_threshold, test_r2, test_threshold, bool(save_root) and passed)
    path = None
    if save_root:
        path = save_model(features.sparkSession, save_root, polynomial if passed else None, report, version)
    fitted = revenue_pipeline(degree).fit(rows.filter(~F.col("IS_TEST"))) if pipeline else None
    return TrainResult(report, polynomial, scores, path, fitted)


def _report(train_r2, train_threshold, test_r2, test_threshold, saved: bool) -> dict:
    return {
        "train_r2": train_r2,
        "train_threshold": float(train_threshold),
        "test_r2": test_r2,
        "test_threshold": float(test_threshold),
        "model_saved": saved,
    }


def record_failed_run(
    spark: SparkSession, root: str, train_threshold: float, test_threshold: float, version: int | None = None
) -> None:
    """Record a run without scores: the gate was not passed, the older model stays."""
    save_model(spark, root, None, _report(None, train_threshold, None, test_threshold, False), version)


def passes_gate(r2: float | None, threshold: float) -> bool:
    """A score that could not be computed does not pass."""
    return r2 is not None and r2 >= threshold


def report_frame(spark: SparkSession, result: TrainResult) -> DataFrame:
    """The training report as one row."""
    return spark.createDataFrame([tuple(result.report[f.name] for f in TRAIN_REPORT)], TRAIN_REPORT)


def fold_frame(spark: SparkSession, result: TrainResult) -> DataFrame:
    """The cross validation scores, one row per fold."""
    return spark.createDataFrame([tuple(s[f.name] for f in _FOLD_SCORES) for s in result.fold_scores], _FOLD_SCORES)


def _model_log(spark: SparkSession, root: str) -> SnapshotLog:
    return SnapshotLog(spark, f"{root}/model_runs")


def save_model(
    spark: SparkSession, root: str, model: Polynomial | None, report: dict, version: int | None = None
) -> str | None:
    """Record the run, and store the model in a new version folder if its gate passed.

    A model becomes current by its row in the registry, committed last, so readers
    never see a half-written model and a failed gate leaves the older one current.
    Several writers may train below one root. The last KEPT_RUNS runs stay (and the
    one of the current model), and the last KEPT_MODELS models; an older run keeps
    its report and loses its path.
    """
    now = int(time.time_ns())
    version = now if version is None else version
    # A version that is trained again gets a folder of its own, as readers may hold the older one.
    path = f"{root}/models/run={now}/version={version}" if report["model_saved"] else None
    if path:
        write_text(spark, f"{path}/polynomial.json", json.dumps(asdict(model)))
    row = {"version": version, "model_path": path, **{f.name: report[f.name] for f in TRAIN_REPORT}, "run_time": now}
    gone: list[str] = []

    def add(rows: list[dict]) -> list[dict]:
        rows = sorted([*rows, row], key=lambda r: r["run_time"])
        saved = [r for r in rows if r["model_path"]]
        gone[:] = [r["model_path"] for r in saved[:-KEPT_MODELS]]
        rows = [r | {"model_path": None} if r["model_path"] in gone else r for r in rows]
        return [r for i, r in enumerate(rows) if i >= len(rows) - KEPT_RUNS or (saved and r is saved[-1])]

    _model_log(spark, root).commit(add)
    for old in gone:
        remove_folder(spark, old)
    return path


def model_runs(spark: SparkSession, root: str) -> DataFrame:
    """The training runs that are kept: version, model path if saved, and the report."""
    rows = _model_log(spark, root).rows()
    return spark.createDataFrame([tuple(r[f.name] for f in MODEL_RUNS) for r in rows], MODEL_RUNS)


def is_trained(spark: SparkSession, root: str, version: int) -> bool:
    """Whether a version has a run."""
    return any(r["version"] == version for r in _model_log(spark, root).rows())


def current_run(spark: SparkSession, root: str) -> dict | None:
    """The latest run whose model passed its gate, by the time of the run."""
    saved = [r for r in _model_log(spark, root).rows() if r["model_path"]]
    return max(saved, key=lambda r: r["run_time"], default=None)


def load_model(spark: SparkSession, path: str) -> Polynomial:
    """The model of a version folder."""
    text = read_text(spark, f"{path}/polynomial.json")
    if text is None:
        raise LookupError(f"no model at {path}")
    found = json.loads(text)
    exponents = tuple(tuple(e) for e in found["exponents"])
    numbers = {k: tuple(found[k]) for k in ("features", "weights", "centers", "scales")}
    return Polynomial(exponents=exponents, intercept=found["intercept"], **numbers)


def current_model(spark: SparkSession, root: str) -> Polynomial:
    """The latest model that passed its gate."""
    run = current_run(spark, root)
    if run is None:
        raise LookupError(f"no model under {root} has passed its gate")
    return load_model(spark, run["model_path"])
