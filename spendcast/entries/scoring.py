"""Scoring every row of a table with fixed weights, in each of the offered ways."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.entries.common import Entry, row_features
from spendcast.functions.scoring import Polynomial, register_array_function, register_batch_function, score
from spendcast.schemas import FEATURES
from spendcast.sources.tables import run_sql

# Weights in the order of the expansion: s, ss, o, so, oo, v, sv, ov, vv, e, se, oe, ve, ee.
WEIGHTS = (1.5, -0.02, 30.0, 0.25, -12.0, -45.0, 0.5, 8.0, 21.0, -2.25, 0.0625, 1.75, -3.5, 0.125)
INTERCEPT = -40.0
MODEL = Polynomial.plain(FEATURES, 2, WEIGHTS, INTERCEPT)

_TERMS = (
    "{s}", "{s} * {s}", "{o}", "{s} * {o}", "{o} * {o}", "{v}", "{s} * {v}", "{o} * {v}", "{v} * {v}",
    "{e}", "{s} * {e}", "{o} * {e}", "{v} * {e}", "{e} * {e}",
)


def polynomial_sql(s: str, o: str, v: str, e: str) -> str:
    """The fixed polynomial written out."""
    terms = (f"({w}e0) * {t.format(s=s, o=o, v=v, e=e)}" for w, t in zip(WEIGHTS, _TERMS, strict=True))
    return f"abs(({INTERCEPT}e0) + {' + '.join(terms)})"


def _predictions(df: DataFrame) -> DataFrame:
    return df.select("l_orderkey", "l_linenumber", "PREDICTED_ROI")


def score_fixed_weights(spark: SparkSession, folder: str) -> DataFrame:
    return _predictions(score(row_features(spark, folder), MODEL))


def score_array_function(spark: SparkSession, folder: str) -> DataFrame:
    register_array_function(spark, MODEL, "predict_roi")
    prediction = F.call_udf("predict_roi", F.array(*FEATURES))
    return _predictions(row_features(spark, folder).withColumn("PREDICTED_ROI", prediction))


def score_sql_text(spark: SparkSession, folder: str) -> DataFrame:
    register_array_function(spark, MODEL, "predict_roi")
    return run_sql(
        spark,
        "SELECT l_orderkey, l_linenumber, "
        "predict_roi(array(SEARCH_ENGINE * :unit, SOCIAL_MEDIA * :unit, VIDEO * :unit, EMAIL * :unit)) "
        "AS PREDICTED_ROI FROM {scenarios}",
        {"unit": 2.0},
        scenarios=row_features(spark, folder),
    )


def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    register_batch_function(spark, MODEL, "batch_predict_roi")
    prediction = F.call_udf("batch_predict_roi", *FEATURES)
    return _predictions(row_features(spark, folder).withColumn("PREDICTED_ROI", prediction))


_INPUTS = ("l_quantity", "l_discount", "l_tax", "CAST(l_linenumber AS DOUBLE)")
_SQL = f"SELECT l_orderkey, l_linenumber, {polynomial_sql(*_INPUTS)} AS PREDICTED_ROI FROM lineitem"
_DOUBLED = [f"({text} * 2)" for text in _INPUTS]

ENTRIES = {
    "score_fixed_weights": Entry(score_fixed_weights, _SQL),
    "score_array_function": Entry(score_array_function, _SQL),
    "score_batch": Entry(score_batch, _SQL),
    "score_sql_text": Entry(
        score_sql_text,
        f"SELECT l_orderkey, l_linenumber, {polynomial_sql(*_DOUBLED)} AS PREDICTED_ROI FROM lineitem",
    ),
}
