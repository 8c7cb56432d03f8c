"""Splits, least squares and the training report.

The SQL for a least squares fit removes one term after the other from the rest
(Gram-Schmidt); what remains of the label is the residual. It shares nothing with
the normal equations the fit uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.entries.common import (
    FEATURES_SQL,
    NET_PRICE_SQL,
    ORDER_CHANNELS,
    ROW_FEATURES_SQL,
    Entry,
    net_price_features,
    revenue,
    row_features,
    spend,
    table,
)
from spendcast.functions.scoring import polynomial_exponents, score
from spendcast.operators.split import exact_split, with_split
from spendcast.plans.features import feature_table
from spendcast.plans.training import (
    current_model,
    fit_rows,
    fold_frame,
    report_frame,
    revenue_pipeline,
    to_polynomial,
    train_revenue_model,
)
from spendcast.plans.search import candidate_frame, chosen_frame, search_model
from spendcast.schemas import FEATURES, MONTH_KEYS
from spendcast.workspace import new_folder


_LINE_KEYS = ("l_orderkey", "l_linenumber")


def _months(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table, stored once: training reads it several times."""
    path = new_folder(spark, "features")
    feature_table(spend(spark, folder), revenue(spark, folder), ORDER_CHANNELS).write.parquet(path)
    return spark.read.parquet(path)


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return with_split(orders, ["o_orderkey"], 42, folds=10)


def kfold_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return hash_split(spark, folder).groupBy("IS_TEST", "FOLD").agg(F.count(F.lit(1)).alias("N_ROWS"))


def exact_split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A fifth of all lines for the test, the others in ten folds of the same size."""
    return exact_split(table(spark, folder, "lineitem").select(*_LINE_KEYS), list(_LINE_KEYS), 42, folds=10)


def exact_split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return exact_split_rows(spark, folder).groupBy("IS_TEST", "FOLD").agg(F.count(F.lit(1)).alias("N_ROWS"))


def ols_degree1(spark: SparkSession, folder: str) -> DataFrame:
    """Price on quantity over every line: slope, intercept and R2, from two passes."""
    rows = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    fitted = fit_rows(rows, ["l_quantity"], "l_extendedprice", degree=1)
    # Weight and center are those of the scaled input.
    slope = fitted.polynomial.weights[0] / fitted.polynomial.scales[0]
    intercept = fitted.polynomial.intercept - slope * fitted.polynomial.centers[0]
    row = (round(slope, 4), round(intercept, 3), round(fitted.r2, 6))
    return spark.createDataFrame([row], "SLOPE double, INTERCEPT double, R2 double")


def ols_quadratic(spark: SparkSession, folder: str) -> DataFrame:
    """Price on quantity and its square, through the pipeline of the model."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    fitted = revenue_pipeline(2, ["l_quantity"], "l_extendedprice").fit(lines)
    predicted = score(lines, to_polynomial(fitted), output="PREDICTED")
    return predicted.select("l_orderkey", "l_linenumber", F.round("PREDICTED", 4).alias("PREDICTED"))


def _rounded_report(spark: SparkSession, result) -> DataFrame:
    report = report_frame(spark, result)
    return report.withColumns({c: F.round(c, 6) for c in ("train_r2", "test_r2")})


def train_report(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_report(spark, train_revenue_model(_months(spark, folder)))


def train_report_without_folds(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_report(spark, train_revenue_model(_months(spark, folder), folds=0))


def train_report_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Training on one row per lineitem row instead of one per month."""
    return _rounded_report(spark, train_revenue_model(row_features(spark, folder), keys=list(_LINE_KEYS)))


def train_report_qr(spark: SparkSession, folder: str) -> DataFrame:
    """The same from triangular factors instead of sums of products."""
    return _rounded_report(spark, train_revenue_model(row_features(spark, folder), keys=list(_LINE_KEYS), solver="qr"))


def cv_scores(spark: SparkSession, folder: str) -> DataFrame:
    result = train_revenue_model(_months(spark, folder), folds=10)
    return fold_frame(spark, result).withColumn("R2", F.round("R2", 6))


def cv_scores_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Ten folds of the model of degree 2 over one row per lineitem row."""
    result = train_revenue_model(row_features(spark, folder), folds=10, degree=2, keys=list(_LINE_KEYS))
    return fold_frame(spark, result).withColumn("R2", F.round("R2", 6))


def train_gate_passed(spark: SparkSession, folder: str) -> DataFrame:
    """Degree 2, ten folds, both thresholds at 0.85: net prices fit well enough for the model to be saved."""
    root = new_folder(spark, "models")
    result = train_revenue_model(net_price_features(spark, folder), 10, 2, 0.85, 0.85, save_root=root, keys=list(_LINE_KEYS))
    return _rounded_report(spark, result)


def saved_model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Train, pass the gate, save, load the current model, score every line."""
    rows = net_price_features(spark, folder)
    root = new_folder(spark, "models")
    train_revenue_model(rows, 10, 2, 0.85, 0.85, save_root=root, keys=list(_LINE_KEYS))
    scored = score(exact_split(rows, list(_LINE_KEYS)), current_model(spark, root))
    return scored.select(*_LINE_KEYS, "IS_TEST", F.round("PREDICTED_ROI", 1).alias("PREDICTED_ROI"))


_GRID = {"degrees": (1, 2), "penalties": (0.0, 50.0, 5000.0), "folds": 10}


def _search(spark: SparkSession, folder: str):
    rows = table(spark, folder, "lineitem").select(*_LINE_KEYS, "l_quantity", "l_extendedprice")
    return search_model(rows, keys=list(_LINE_KEYS), features=["l_quantity"], label="l_extendedprice", **_GRID)


def grid_search_folds(spark: SparkSession, folder: str) -> DataFrame:
    """Price on quantity over every line: each degree and penalty on each of ten folds."""
    return candidate_frame(spark, _search(spark, folder)).withColumn("R2", F.round("R2", 6))


def grid_search_chosen(spark: SparkSession, folder: str) -> DataFrame:
    """The best of them, fitted to all training lines."""
    chosen = chosen_frame(spark, _search(spark, folder))
    return chosen.withColumns({c: F.round(c, 6) for c in ("MEAN_R2", "TRAIN_R2", "TEST_R2")})


def _digest(keys: tuple[str, ...]) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5(concat_ws(':', {parts}, '42'))"


def hashed_sql(source: str, keys: tuple[str, ...], folds: int = 10) -> str:
    """Sides and folds by the digits of the hash."""
    number = f"CAST('0x' || substr({_digest(keys)}, 1, 8) AS BIGINT)"
    return (
        f"SELECT * EXCLUDE n, n % 10 < 2 AS IS_TEST, CAST(n // 10 % {folds} AS INT) AS FOLD "
        f"FROM (SELECT *, {number} AS n FROM ({source}))"
    )


def split_sql(source: str, keys: tuple[str, ...], folds: int = 10) -> str:
    """Sides and folds by the rank of the hash: the first fifth is the test side, equal keys stay together."""
    place, size, larger = "(nth - test - 1)", f"((total - test) // {folds})", f"((total - test) % {folds})"
    fold = (
        f"CASE WHEN {place} < {larger} * ({size} + 1) THEN {place} // ({size} + 1) "
        f"ELSE {larger} + ({place} - {larger} * ({size} + 1)) // nullif({size}, 0) END"
    )
    return (
        f"SELECT * EXCLUDE (nth, total, test), nth <= test AS IS_TEST, CASE WHEN nth > test THEN CAST({fold} AS INT) END AS FOLD "
        f"FROM (SELECT *, (total * 2 + 9) // 10 AS test FROM (SELECT *, rank() OVER (ORDER BY {_digest(keys)}) AS nth, "
        f"count(*) OVER () AS total FROM ({source})))"
    )


def residual_steps(
    source: str, keys: tuple[str, ...], degree: int, by_fold: bool = False, label: str = "REVENUE",
    features: tuple[str, ...] = FEATURES,
) -> str:
    """CTEs ending in ``final``: key, IS_TEST, FOLD, y (label), r (residual on every row).

    A row takes part in the fit if IS_TEST is false; with ``by_fold`` each row
    appears once per held-out fold ``HELD`` and that fold takes no part.
    """
    terms = polynomial_exponents(len(features), degree)
    over = "OVER (PARTITION BY HELD)"
    if by_fold:
        rows = f"SELECT * FROM ({source}), range(10) held(HELD) WHERE NOT IS_TEST"
        part = "FILTER (WHERE FOLD <> HELD)"
    else:
        rows = f"SELECT *, 0 AS HELD FROM ({source})"
        part = "FILTER (WHERE NOT IS_TEST)"
    names = ", ".join(keys)
    same = f"{names}, IS_TEST, FOLD, HELD, y"
    scaled = ", ".join(
        f"(CAST({f} AS DOUBLE) - avg(CAST({f} AS DOUBLE)) {part} {over}) "
        f"/ stddev_samp(CAST({f} AS DOUBLE)) {part} {over} AS z{i}"
        for i, f in enumerate(features)
    )
    products = [" * ".join(f"z{i}" for i, e in enumerate(term) for _ in range(e)) for term in terms]
    ctes = [
        f"fit_rows AS ({rows})",
        f"scaled AS (SELECT {names}, IS_TEST, FOLD, HELD, CAST({label} AS DOUBLE) AS y, {scaled} FROM fit_rows)",
        f"products AS (SELECT {same}, " + ", ".join(f"{p} AS t{k}" for k, p in enumerate(products)) + " FROM scaled)",
        f"step0 AS (SELECT {same}, "
        + ", ".join(f"t{k} - avg(t{k}) {part} {over} AS t{k}" for k in range(len(terms)))
        + f", y - avg(y) {part} {over} AS r FROM products)",
    ]
    for k in range(len(terms)):
        rest = [f"t{j}" for j in range(k + 1, len(terms))] + ["r"]
        reduced = ", ".join(
            f"{c} - t{k} * (sum({c} * t{k}) {part} {over}) / (sum(t{k} * t{k}) {part} {over}) AS {c}" for c in rest
        )
        ctes.append(f"step{k + 1} AS MATERIALIZED (SELECT {same}, {reduced} FROM step{k})")
    ctes.append(f"final AS (SELECT * FROM step{len(terms)})")
    return ",\n".join(ctes)


# Undefined where the label does not vary, as in a fold of one row.
_R2 = "1 - sum(r * r) {f} / nullif(var_pop(y) {f} * count(*) {f}, 0)"


def report_sql(source: str, keys: tuple[str, ...], degree: int = 2, saved: bool = False) -> str:
    train = _R2.format(f="FILTER (WHERE NOT IS_TEST)")
    test = _R2.format(f="FILTER (WHERE IS_TEST)")
    return (
        f"WITH {residual_steps(split_sql(source, keys), keys, degree)} "
        f"SELECT round({train}, 6) AS train_r2, CAST(0.85 AS DOUBLE) AS train_threshold, "
        f"round({test}, 6) AS test_r2, CAST(0.85 AS DOUBLE) AS test_threshold, {str(saved).lower()} AS model_saved FROM final"
    )


def folds_sql(source: str, keys: tuple[str, ...], degree: int = 2) -> str:
    return (
        f"WITH {residual_steps(split_sql(source, keys), keys, degree, by_fold=True)} "
        f"SELECT FOLD, count(*) AS N_ROWS, round({_R2.format(f='')}, 6) AS R2 FROM final WHERE FOLD = HELD GROUP BY FOLD"
    )


def grid_sql() -> str:
    """CTEs ending in ``scored``: DEGREE, PENALTY, FOLD (null: fitted to all training rows), R2, TRAIN_R2 and TEST_R2.

    With one input the weights of degree 1 and 2 are a quotient and Cramer's rule.
    """
    source = "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem"
    grid = ", ".join(f"({d}, CAST({p} AS DOUBLE))" for d in _GRID["degrees"] for p in _GRID["penalties"])
    fit, own = "FILTER (NOT IS_TEST AND FOLD IS DISTINCT FROM HELD)", "FILTER (NOT IS_TEST AND FOLD = HELD)"
    # Centered sums over the rows of a fit; a is the term, b its square, y the label.
    cov = ", ".join(f"covar_pop({x}, {y}) {fit} * count(*) {fit} AS s{x}{y}" for x, y in (("a", "a"), ("a", "b"), ("b", "b"), ("a", "y"), ("b", "y")))
    means = ", ".join(f"avg({x}) {fit} AS m{x}" for x in "aby")
    w1 = "CASE DEGREE WHEN 1 THEN say / (saa + PENALTY) ELSE (say * (sbb + PENALTY) - sby * sab) / ((saa + PENALTY) * (sbb + PENALTY) - sab * sab) END"
    w2 = "CASE DEGREE WHEN 1 THEN 0 ELSE (sby * (saa + PENALTY) - say * sab) / ((saa + PENALTY) * (sbb + PENALTY) - sab * sab) END"
    r2 = "1 - sum(e * e) {f} / nullif(var_pop(y) {f} * count(*) {f}, 0)"
    return (
        f"WITH parts AS ({split_sql(source, _LINE_KEYS)}), "
        "z AS (SELECT IS_TEST, FOLD, (l_quantity - avg(l_quantity) FILTER (NOT IS_TEST) OVER ()) / stddev_samp(l_quantity) FILTER (NOT IS_TEST) OVER () AS a, "
        "(l_extendedprice - avg(l_extendedprice) FILTER (NOT IS_TEST) OVER ()) / stddev_samp(l_extendedprice) FILTER (NOT IS_TEST) OVER () AS y FROM parts), "
        "rows_ AS (SELECT *, a * a AS b FROM z, (SELECT unnest([NULL, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS HELD)), "
        f"sums AS (SELECT HELD, {cov}, {means} FROM rows_ GROUP BY HELD), "
        f"fitted AS (SELECT *, {w1} AS w1, {w2} AS w2 FROM sums, (VALUES {grid}) g(DEGREE, PENALTY)), "
        "errors AS (SELECT r.IS_TEST, r.FOLD, f.HELD, DEGREE, PENALTY, r.y, r.y - my - w1 * (a - ma) - w2 * (b - mb) AS e "
        "FROM rows_ r JOIN fitted f ON r.HELD IS NOT DISTINCT FROM f.HELD), "
        f"scored AS (SELECT DEGREE, PENALTY, HELD AS FOLD, {r2.format(f=own)} AS R2, "
        f"{r2.format(f='FILTER (NOT IS_TEST)')} AS TRAIN_R2, {r2.format(f='FILTER (IS_TEST)')} AS TEST_R2 FROM errors GROUP BY 1, 2, 3)"
    )


_SPLIT_ORDERS_SQL = hashed_sql("SELECT o_orderkey, o_custkey FROM orders", ("o_orderkey",))
_LINES_SQL = "SELECT *, false AS IS_TEST, 0 AS FOLD FROM lineitem"
_QUADRATIC_STEPS = residual_steps(_LINES_SQL, _LINE_KEYS, 2, label="l_extendedprice", features=("l_quantity",))

ENTRIES = {
    "hash_split": Entry(hash_split, _SPLIT_ORDERS_SQL),
    "kfold_sizes": Entry(
        kfold_sizes, f"SELECT IS_TEST, FOLD, count(*) AS N_ROWS FROM ({_SPLIT_ORDERS_SQL}) GROUP BY 1, 2"
    ),
    "exact_split": Entry(exact_split_rows, split_sql("SELECT l_orderkey, l_linenumber FROM lineitem", _LINE_KEYS)),
    "exact_split_sizes": Entry(
        exact_split_sizes,
        "SELECT IS_TEST, FOLD, count(*) AS N_ROWS FROM "
        f"({split_sql('SELECT l_orderkey, l_linenumber FROM lineitem', _LINE_KEYS)}) GROUP BY 1, 2",
    ),
    "ols_degree1": Entry(
        ols_degree1,
        "SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS SLOPE, "
        "round(regr_intercept(l_extendedprice, l_quantity), 3) AS INTERCEPT, "
        "round(regr_r2(l_extendedprice, l_quantity), 6) AS R2 FROM lineitem",
    ),
    "ols_quadratic": Entry(
        ols_quadratic,
        f"WITH {_QUADRATIC_STEPS} SELECT l_orderkey, l_linenumber, round(abs(y - r), 4) AS PREDICTED FROM final",
    ),
    "grid_search_folds": Entry(
        grid_search_folds, f"{grid_sql()} SELECT DEGREE, PENALTY, FOLD, round(R2, 6) AS R2 FROM scored WHERE FOLD IS NOT NULL"
    ),
    "grid_search_chosen": Entry(
        grid_search_chosen,
        f"{grid_sql()} SELECT DEGREE, PENALTY, round(m, 6) AS MEAN_R2, round(TRAIN_R2, 6) AS TRAIN_R2, round(TEST_R2, 6) AS TEST_R2 "
        "FROM (SELECT DEGREE, PENALTY, avg(R2) AS m FROM scored WHERE FOLD IS NOT NULL GROUP BY 1, 2) JOIN "
        "(SELECT * EXCLUDE (FOLD, R2) FROM scored WHERE FOLD IS NULL) USING (DEGREE, PENALTY) ORDER BY m DESC, DEGREE, PENALTY DESC LIMIT 1",
    ),
    "train_report": Entry(train_report, report_sql(FEATURES_SQL, MONTH_KEYS)),
    "train_report_without_folds": Entry(train_report_without_folds, report_sql(FEATURES_SQL, MONTH_KEYS)),
    "train_report_rows": Entry(train_report_rows, report_sql(ROW_FEATURES_SQL, _LINE_KEYS)),
    "train_report_qr": Entry(train_report_qr, report_sql(ROW_FEATURES_SQL, _LINE_KEYS)),
    "cv_scores": Entry(cv_scores, folds_sql(FEATURES_SQL, MONTH_KEYS)),
    "cv_scores_rows": Entry(cv_scores_rows, folds_sql(ROW_FEATURES_SQL, _LINE_KEYS)),
    "train_gate_passed": Entry(train_gate_passed, report_sql(NET_PRICE_SQL, _LINE_KEYS, saved=True)),
    "saved_model_predictions": Entry(
        saved_model_predictions,
        f"WITH {residual_steps(split_sql(NET_PRICE_SQL, _LINE_KEYS), _LINE_KEYS, 2)} "
        "SELECT l_orderkey, l_linenumber, IS_TEST, round(abs(y - r), 1) AS PREDICTED_ROI FROM final",
    ),
}
