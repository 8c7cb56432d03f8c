"""How the driver tables stand in for spend, revenue, budgets and scenarios."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.functions.scalars import month_name
from spendcast.operators.reshape import pivot_wide
from spendcast.schemas import BUDGETS


class Entry(NamedTuple):
    """A query, and SQL for the same result; None where SQL cannot express it."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


# Order priorities as channels; 5-LOW stays unlisted.
ORDER_CHANNELS = {
    "1-URGENT": "SEARCH_ENGINE",
    "2-HIGH": "SOCIAL_MEDIA",
    "3-MEDIUM": "VIDEO",
    "4-NOT SPECIFIED": "EMAIL",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(column: str) -> Column:
    """Cents are exact as decimals, so a sum does not depend on its order."""
    return F.col(column).cast("decimal(18,2)")


def spend(spark: SparkSession, folder: str) -> DataFrame:
    """orders as daily spend."""
    return table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("DATE"),
        F.col("o_orderpriority").alias("CHANNEL"),
        money("o_totalprice").alias("TOTAL_COST"),
    )


def event_spend(spark: SparkSession, folder: str) -> DataFrame:
    """events as daily spend, columns in another order."""
    return table(spark, folder, "events").select(
        money("value").alias("TOTAL_COST"),
        F.col("event_type").alias("CHANNEL"),
        F.col("ts").cast("date").alias("DATE"),
    )


def revenue(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as revenue, many rows per month."""
    return table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias("YEAR"),
        F.month("l_shipdate").alias("MONTH"),
        money("l_extendedprice").alias("REVENUE"),
    )


def budgets(spark: SparkSession, folder: str) -> DataFrame:
    """orders as budgets in millions and ROI per month name."""
    channels = dict(zip(ORDER_CHANNELS, BUDGETS))
    named = spend(spark, folder).select(month_name("DATE").alias("MONTH"), "CHANNEL", "TOTAL_COST")
    wide = pivot_wide(named, "CHANNEL", "TOTAL_COST", channels, ["MONTH"])
    millions = [F.floor(F.floor(b) / 1000000).cast("bigint").alias(b) for b in BUDGETS]
    total = sum((F.floor(b).cast("bigint") for b in BUDGETS[1:]), F.floor(BUDGETS[0]).cast("bigint"))
    return wide.select("MONTH", *millions, (total.cast("double") / F.lit(1.0e7)).alias("ROI"))


def scenarios(spark: SparkSession, folder: str) -> DataFrame:
    """One scenario per lineitem row."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("SCENARIO_ID"),
        F.col("l_quantity").cast("bigint").alias("SEARCHENGINE"),
        F.rint(F.col("l_discount") * 100).cast("bigint").alias("SOCIALMEDIA"),
        F.rint(F.col("l_tax") * 100).cast("bigint").alias("VIDEO"),
        (F.col("l_linenumber") * 10).cast("bigint").alias("EMAIL"),
    )


def row_features(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem rows as a feature table that grows with the data."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("SEARCH_ENGINE"),
        F.col("l_discount").alias("SOCIAL_MEDIA"),
        F.col("l_tax").alias("VIDEO"),
        F.col("l_linenumber").cast("double").alias("EMAIL"),
        F.col("l_extendedprice").alias("REVENUE"),
    )


def net_price_features(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """lineitem rows whose net price is nearly a polynomial of degree 2 of price, discount, tax and quantity."""
    return table(spark, folder, "lineitem").select(
        *more,
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("SEARCH_ENGINE"),
        F.col("l_discount").alias("SOCIAL_MEDIA"),
        F.col("l_tax").alias("VIDEO"),
        F.col("l_quantity").alias("EMAIL"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("REVENUE"),
    )


SPEND_SQL = (
    "SELECT CAST(o_orderdate AS DATE) AS DATE, o_orderpriority AS CHANNEL, "
    "CAST(o_totalprice AS DECIMAL(18,2)) AS TOTAL_COST FROM orders"
)
REVENUE_SQL = (
    "SELECT CAST(year(l_shipdate) AS INT) AS YEAR, CAST(month(l_shipdate) AS INT) AS MONTH, "
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS REVENUE FROM lineitem"
)


def conditional_sums(channels: dict[str, str], kind: str = "DECIMAL(28,2)") -> str:
    """One summed column per channel as SQL text."""
    return ", ".join(
        f"CAST(sum(CASE WHEN CHANNEL = '{name}' THEN TOTAL_COST END) AS {kind}) AS {alias}"
        for name, alias in channels.items()
    )


WIDE_SQL = (
    "SELECT CAST(year(DATE) AS INT) AS YEAR, CAST(month(DATE) AS INT) AS MONTH, "
    f"{conditional_sums(ORDER_CHANNELS)} FROM ({SPEND_SQL}) GROUP BY 1, 2"
)
MONTHLY_SQL = f"SELECT YEAR, MONTH, CAST(sum(REVENUE) AS DECIMAL(28,2)) AS REVENUE FROM ({REVENUE_SQL}) GROUP BY 1, 2"
JOINED_SQL = f"SELECT * FROM ({WIDE_SQL}) JOIN ({MONTHLY_SQL}) USING (YEAR, MONTH)"
FEATURES_SQL = (
    f"SELECT * FROM ({JOINED_SQL}) WHERE SEARCH_ENGINE IS NOT NULL AND SOCIAL_MEDIA IS NOT NULL "
    "AND VIDEO IS NOT NULL AND EMAIL IS NOT NULL AND REVENUE IS NOT NULL"
)
_FLOORS = [
    f"CAST(floor(sum(CASE WHEN CHANNEL = '{name}' THEN TOTAL_COST END)) AS BIGINT)" for name in ORDER_CHANNELS
]
BUDGETS_SQL = (
    "SELECT monthname(DATE) AS MONTH, "
    + ", ".join(f"{total} // 1000000 AS {b}" for total, b in zip(_FLOORS, BUDGETS))
    + f", CAST({' + '.join(_FLOORS)} AS DOUBLE) / 1.0e7 AS ROI FROM ({SPEND_SQL}) GROUP BY 1"
)
SCENARIOS_SQL = (
    "SELECT l_orderkey * 10 + l_linenumber AS SCENARIO_ID, CAST(l_quantity AS BIGINT) AS SEARCHENGINE, "
    "CAST(round(l_discount * 100) AS BIGINT) AS SOCIALMEDIA, CAST(round(l_tax * 100) AS BIGINT) AS VIDEO, "
    "CAST(l_linenumber * 10 AS BIGINT) AS EMAIL FROM lineitem"
)
ROW_FEATURES_SQL = (
    "SELECT l_orderkey, l_linenumber, l_quantity AS SEARCH_ENGINE, l_discount AS SOCIAL_MEDIA, "
    "l_tax AS VIDEO, CAST(l_linenumber AS DOUBLE) AS EMAIL, l_extendedprice AS REVENUE FROM lineitem"
)
NET_PRICE_SQL = (
    "SELECT l_orderkey, l_linenumber, l_extendedprice AS SEARCH_ENGINE, l_discount AS SOCIAL_MEDIA, l_tax AS VIDEO, "
    "l_quantity AS EMAIL, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS REVENUE FROM lineitem"
)
