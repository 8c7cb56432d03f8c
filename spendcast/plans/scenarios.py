"""Budget history, what-if scenarios and their comparison with the last month.

A scenario is a row with a SCENARIO_ID and the four budget columns; every function
takes any number of them and stays one lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendcast.functions.scalars import fixed_decimals, percent_change
from spendcast.functions.scoring import Polynomial
from spendcast.operators.reshape import flag_equal, last_by_order, order_index, recode, unpivot_long
from spendcast.schemas import BUDGETS, CHANNEL_LABELS, FEATURES, MONTH_NAMES, SCENARIO_MONTH
from spendcast.sources.tables import append_by_name

# Sliders hold thousands, and the display divides by a hundred thousand.
BUDGET_UNIT = 1000
ROI_UNIT = 100000


def actual_months(budgets: DataFrame, scenario_month: str = SCENARIO_MONTH) -> DataFrame:
    """Rows that are not saved scenarios; rows without a month go too."""
    return budgets.filter(F.col("MONTH") != F.lit(scenario_month))


def budget_history_long(budgets: DataFrame, scenario_month: str = SCENARIO_MONTH) -> DataFrame:
    """MONTH, ROI, CHANNEL, BUDGET: one row per month and channel.

    The filter comes first, so only rows that stay are expanded.
    """
    return unpivot_long(actual_months(budgets, scenario_month), "Budget", "Channel", BUDGETS)


def month_allocations(
    budgets: DataFrame, month: str | None = None, scenario_month: str = SCENARIO_MONTH
) -> DataFrame:
    """Budgets per month and channel without the ROI, of all months or of one."""
    long = budget_history_long(budgets, scenario_month)
    if month is not None:
        return long.filter(F.col("MONTH") == F.lit(month))
    return long.drop("ROI")


def last_month_allocations(
    budgets: DataFrame,
    months: Sequence[str] = MONTH_NAMES,
    scenario_month: str = SCENARIO_MONTH,
) -> DataFrame:
    """Budgets and ROI per channel of the latest month in calendar order."""
    index = order_index("MONTH", months)
    actual = actual_months(budgets, scenario_month)
    last = actual.agg(F.max(index).alias("MONTH_IX")).scalar()
    return unpivot_long(actual.filter(index == last), "Budget", "Channel", BUDGETS)


def month_roi(budgets: DataFrame, scenario_month: str = SCENARIO_MONTH) -> DataFrame:
    """Distinct MONTH, ROI pairs of months with at least one budget.

    Equal to the distinct pairs of the long history, without expanding it first.
    """
    any_budget = F.coalesce(*[F.col(b) for b in BUDGETS]).isNotNull()
    return actual_months(budgets, scenario_month).filter(any_budget).select("MONTH", "ROI").distinct()


def last_month_roi(
    budgets: DataFrame,
    months: Sequence[str] = MONTH_NAMES,
    scenario_month: str = SCENARIO_MONTH,
) -> DataFrame:
    """One row, LAST_ROI: the ROI of the latest month in calendar order."""
    known = month_roi(budgets, scenario_month).withColumn("MONTH_IX", order_index("MONTH", months))
    # max_by has no say on ties: take the greatest ROI if a month has several.
    per_month = known.filter(F.col("MONTH_IX").isNotNull()).groupBy("MONTH_IX").agg(F.max("ROI").alias("ROI"))
    return last_by_order(per_month, "ROI", F.col("MONTH_IX"), "LAST_ROI")


def predict_scenarios(
    scenarios: DataFrame,
    model: Polynomial,
    budget_unit: float = BUDGET_UNIT,
    roi_unit: float = ROI_UNIT,
) -> DataFrame:
    """Add PREDICTED_ROI in display units; budgets are bound to features by name."""
    budget_of = dict(zip(FEATURES, BUDGETS, strict=True))
    inputs = [f"(`{budget_of[f]}` * {budget_unit})" for f in model.features]
    return scenarios.withColumn("PREDICTED_ROI", F.abs(F.expr(model.sql(inputs))) / F.lit(float(roi_unit)))


def scenario_vs_last_month(
    scenarios: DataFrame,
    budgets: DataFrame,
    model: Polynomial,
    budget_unit: float = BUDGET_UNIT,
    roi_unit: float = ROI_UNIT,
    months: Sequence[str] = MONTH_NAMES,
    scenario_month: str = SCENARIO_MONTH,
) -> DataFrame:
    """Prediction per scenario, its change against the last month, and both as text."""
    last = last_month_roi(budgets, months, scenario_month).scalar()
    predicted = predict_scenarios(scenarios, model, budget_unit, roi_unit)
    compared = predicted.select("SCENARIO_ID", "PREDICTED_ROI", last.alias("LAST_ROI"))
    compared = compared.withColumn("CHANGE_PCT", percent_change(F.col("PREDICTED_ROI"), F.col("LAST_ROI")))
    return compared.withColumns(
        {
            "ROI_LABEL": F.concat(F.lit("$ "), fixed_decimals(F.col("PREDICTED_ROI"), 2), F.lit(" million")),
            "CHANGE_LABEL": F.concat(fixed_decimals(F.col("CHANGE_PCT"), 1), F.lit(" % vs last month")),
        }
    )


def scenario_dataset(
    budgets: DataFrame,
    predicted: DataFrame,
    months: Sequence[str] = MONTH_NAMES,
    scenario_month: str = SCENARIO_MONTH,
) -> DataFrame:
    """History and scenarios in one long table, ready to draw.

    ``predicted`` comes from ``predict_scenarios``. History rows carry no SCENARIO_ID:
    they are stored once, not once per scenario.
    """
    future = predicted.select(
        "SCENARIO_ID",
        F.lit(scenario_month).alias("MONTH"),
        *BUDGETS,
        F.col("PREDICTED_ROI").alias("ROI"),
    )
    # All that depends on the month alone is computed before a row becomes four.
    wide = actual_months(budgets, scenario_month).unionByName(future, allowMissingColumns=True)
    wide = wide.withColumns(
        {"MONTH_IX": order_index("MONTH", months), "IS_SCENARIO": flag_equal("MONTH", scenario_month)}
    )
    return recode(unpivot_long(wide, "Budget", "Channel", BUDGETS), CHANNEL_LABELS, ["CHANNEL"])


def save_scenarios(predicted: DataFrame, table: str, scenario_month: str = SCENARIO_MONTH) -> None:
    """Append scenarios to the budget table under the scenario month."""
    rows = predicted.select(
        F.lit(scenario_month).alias("MONTH"), *BUDGETS, F.col("PREDICTED_ROI").alias("ROI")
    )
    append_by_name(rows, table)
