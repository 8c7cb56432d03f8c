"""Jobs that can be called by name with positional arguments."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from spendcast.functions.scoring import Polynomial, register_array_function, register_batch_function
from spendcast.plans.features import feature_table
from spendcast.plans.training import current_model, train_revenue_model
from spendcast.sources.tables import overwrite_table

_JOBS: dict[str, Callable[..., Any]] = {}


def register(name: str, job: Callable[..., Any], replace: bool = True) -> None:
    """Make a job known by name. Its first argument is the session."""
    if not replace and name in _JOBS:
        raise ValueError(f"job {name} exists")
    _JOBS[name] = job


def call(spark: SparkSession, name: str, *args: Any) -> Any:
    """Run a job by name."""
    if name not in _JOBS:
        raise LookupError(f"no job {name}; known jobs: {', '.join(sorted(_JOBS))}")
    return _JOBS[name](spark, *args)


def build_feature_table(
    spark: SparkSession,
    spend_table: str = "CAMPAIGN_SPEND",
    revenue_table: str = "MONTHLY_REVENUE",
    features_table: str = "MARKETING_BUDGETS_FEATURES",
    features_path: str | None = None,
) -> str:
    """Rebuild the feature table from the spend and revenue tables."""
    features = feature_table(spark.table(spend_table), spark.table(revenue_table))
    overwrite_table(features, features_table, features_path)
    return "SUCCESS"


def train_model(
    spark: SparkSession,
    features_table: str = "MARKETING_BUDGETS_FEATURES",
    folds: int = 10,
    degree: int = 2,
    train_threshold: float = 0.85,
    test_threshold: float = 0.85,
    save: bool = False,
    model_root: str | None = None,
) -> dict:
    """Train on a feature table; returns the training report.

    To be saved, a model needs a root: the one that ``deploy_functions`` and a refresh use.
    """
    if save and not model_root:
        raise ValueError("saving a model takes a model_root")
    result = train_revenue_model(
        spark.table(features_table), folds, degree, train_threshold, test_threshold, save_root=model_root if save else None
    )
    return result.report


def deploy_functions(
    spark: SparkSession,
    model_root: str,
    array_name: str = "predict_roi",
    batch_name: str = "batch_predict_roi",
) -> Polynomial:
    """Register both scoring functions with the current model, replacing older ones.

    The model is read once, here; its weights travel with the plan.
    """
    model = current_model(spark, model_root)
    register_array_function(spark, model, array_name)
    register_batch_function(spark, model, batch_name)
    return model


register("build_feature_table", build_feature_table)
register("train_model", train_model)
register("deploy_functions", deploy_functions)
