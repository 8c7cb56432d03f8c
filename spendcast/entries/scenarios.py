"""Budget history from orders, one scenario per lineitem row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendcast.entries.common import BUDGETS_SQL, SCENARIOS_SQL, Entry, budgets, scenarios
from spendcast.entries.scoring import MODEL, polynomial_sql
from spendcast.plans import scenarios as plans
from spendcast.schemas import BUDGETS, BUDGET_ALLOCATIONS_AND_ROI_DDL, CHANNEL_LABELS, MONTH_NAMES
from spendcast.sources.tables import append_by_name, create_or_replace_table
from spendcast.workspace import new_folder


def budget_history_long(spark: SparkSession, folder: str) -> DataFrame:
    return plans.budget_history_long(budgets(spark, folder))


def month_allocations(spark: SparkSession, folder: str) -> DataFrame:
    return plans.month_allocations(budgets(spark, folder))


def june_allocations(spark: SparkSession, folder: str) -> DataFrame:
    return plans.month_allocations(budgets(spark, folder), month="June")


def last_month_allocations(spark: SparkSession, folder: str) -> DataFrame:
    return plans.last_month_allocations(budgets(spark, folder))


def month_roi(spark: SparkSession, folder: str) -> DataFrame:
    return plans.month_roi(budgets(spark, folder))


def last_month_roi(spark: SparkSession, folder: str) -> DataFrame:
    return plans.last_month_roi(budgets(spark, folder))


def scenario_vs_last(spark: SparkSession, folder: str) -> DataFrame:
    return plans.scenario_vs_last_month(scenarios(spark, folder), budgets(spark, folder), MODEL)


def scenario_dataset(spark: SparkSession, folder: str) -> DataFrame:
    predicted = plans.predict_scenarios(scenarios(spark, folder), MODEL)
    return plans.scenario_dataset(budgets(spark, folder), predicted)


def save_scenario(spark: SparkSession, folder: str) -> DataFrame:
    """Saved scenarios are added to the history; nothing is overwritten."""
    path = new_folder(spark, "budgets")
    name = "budgets_" + path[-12:]
    create_or_replace_table(spark, name, BUDGET_ALLOCATIONS_AND_ROI_DDL, path)
    append_by_name(budgets(spark, folder), name)
    plans.save_scenarios(plans.predict_scenarios(scenarios(spark, folder), MODEL), name)
    return spark.table(name)


_THOUSANDS = [f"CAST({b} * 1000 AS DOUBLE)" for b in BUDGETS]
_PREDICTED_SQL = f"SELECT *, {polynomial_sql(*_THOUSANDS)} / 1.0e5 AS PREDICTED_ROI FROM ({SCENARIOS_SQL})"
_MONTHS = "[" + ", ".join(f"'{m}'" for m in MONTH_NAMES) + "]"
_ACTUAL_SQL = f"SELECT * FROM ({BUDGETS_SQL}) WHERE MONTH <> 'July'"


def _long(source: str, ids: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{b}' AS CHANNEL, {b} AS BUDGET FROM {source} WHERE {b} IS NOT NULL" for b in BUDGETS
    )


_HISTORY_SQL = f"WITH actual AS ({_ACTUAL_SQL}) {_long('actual', 'MONTH, ROI')}"
_LAST_SQL = f"SELECT arg_max(ROI, list_position({_MONTHS}, MONTH)) AS LAST_ROI FROM ({_ACTUAL_SQL})"
_LABEL_CASE = "CASE CHANNEL " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in CHANNEL_LABELS.items()) + " END"

ENTRIES = {
    "budget_history_long": Entry(budget_history_long, _HISTORY_SQL),
    "month_allocations": Entry(month_allocations, f"SELECT MONTH, CHANNEL, BUDGET FROM ({_HISTORY_SQL})"),
    "june_allocations": Entry(
        june_allocations, f"SELECT MONTH, ROI, CHANNEL, BUDGET FROM ({_HISTORY_SQL}) WHERE MONTH = 'June'"
    ),
    "last_month_allocations": Entry(
        last_month_allocations,
        f"WITH history AS ({_HISTORY_SQL}) SELECT MONTH, ROI, CHANNEL, BUDGET FROM history "
        f"WHERE list_position({_MONTHS}, MONTH) = (SELECT max(list_position({_MONTHS}, MONTH)) FROM history)",
    ),
    "month_roi": Entry(month_roi, f"SELECT DISTINCT MONTH, ROI FROM ({_HISTORY_SQL})"),
    "last_month_roi": Entry(last_month_roi, _LAST_SQL),
    "scenario_vs_last": Entry(
        scenario_vs_last,
        f"WITH p AS ({_PREDICTED_SQL}), l AS ({_LAST_SQL}), c AS (SELECT SCENARIO_ID, PREDICTED_ROI, LAST_ROI, "
        "round_even((PREDICTED_ROI - LAST_ROI) / LAST_ROI * 100, 1) AS CHANGE_PCT FROM p, l) "
        "SELECT SCENARIO_ID, PREDICTED_ROI, LAST_ROI, CHANGE_PCT, "
        "printf('$ %.2f million', PREDICTED_ROI) AS ROI_LABEL, "
        "printf('%.1f %% vs last month', CHANGE_PCT) AS CHANGE_LABEL FROM c",
    ),
    "scenario_dataset": Entry(
        scenario_dataset,
        f"WITH actual AS ({_ACTUAL_SQL}), future AS (SELECT SCENARIO_ID, 'July' AS MONTH, "
        f"{', '.join(BUDGETS)}, PREDICTED_ROI AS ROI FROM ({_PREDICTED_SQL})), "
        f"rows AS ({_long('actual', 'CAST(NULL AS BIGINT) AS SCENARIO_ID, MONTH, ROI')} "
        f"UNION ALL {_long('future', 'SCENARIO_ID, MONTH, ROI')}) "
        f"SELECT SCENARIO_ID, MONTH, ROI, {_LABEL_CASE} AS CHANNEL, BUDGET, "
        f"CAST(list_position({_MONTHS}, MONTH) AS INT) AS MONTH_IX, MONTH = 'July' AS IS_SCENARIO FROM rows",
    ),
    "save_scenario": Entry(
        save_scenario,
        f"SELECT MONTH, {', '.join(BUDGETS)}, ROI FROM ({BUDGETS_SQL}) UNION ALL "
        f"SELECT 'July' AS MONTH, {', '.join(BUDGETS)}, PREDICTED_ROI AS ROI FROM ({_PREDICTED_SQL})",
    ),
}
