"""Spend, revenue and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.entries.common import (
    FEATURES_SQL,
    MONTHLY_SQL,
    ORDER_CHANNELS,
    SPEND_SQL,
    WIDE_SQL,
    Entry,
    event_spend,
    revenue,
    spend,
)
from spendcast.functions.scalars import years_between
from spendcast.operators.reshape import pivot_wide
from spendcast.plans import features


def spend_per_channel(spark: SparkSession, folder: str) -> DataFrame:
    return features.spend_per_channel(spend(spark, folder))


def spend_per_channel_events(spark: SparkSession, folder: str) -> DataFrame:
    return features.spend_per_channel(event_spend(spark, folder))


def spend_wide(spark: SparkSession, folder: str) -> DataFrame:
    return features.spend_per_month_wide(spend(spark, folder), ORDER_CHANNELS)


def spend_wide_from_long(spark: SparkSession, folder: str) -> DataFrame:
    """Group by channel first, then pivot: every remaining column is a group key."""
    long = features.spend_per_channel(spend(spark, folder))
    wide = pivot_wide(long, "CHANNEL", "TOTAL_COST", ORDER_CHANNELS)
    return wide.select("YEAR", "MONTH", *[F.col(c).cast("decimal(28,2)").alias(c) for c in ORDER_CHANNELS.values()])


def spend_wide_years(spark: SparkSession, folder: str) -> DataFrame:
    two_years = spend(spark, folder).filter(years_between("DATE", 1996, 1997))
    return features.spend_per_month_wide(two_years, ORDER_CHANNELS)


def spend_wide_zero_filled(spark: SparkSession, folder: str) -> DataFrame:
    wide = features.spend_per_month_wide(event_spend(spark, folder), {"click": "CLICK", "none": "NONE"}, True)
    return wide.select("YEAR", "MONTH", *[F.col(c).cast("decimal(28,2)").alias(c) for c in ("CLICK", "NONE")])


def revenue_per_month(spark: SparkSession, folder: str) -> DataFrame:
    return features.revenue_per_month(revenue(spark, folder))


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return features.feature_table(spend(spark, folder), revenue(spark, folder), ORDER_CHANNELS)


def feature_table_without_month(spark: SparkSession, folder: str) -> DataFrame:
    return features.feature_table(spend(spark, folder), revenue(spark, folder), ORDER_CHANNELS, keep_month=False)


def partial_month(spark: SparkSession, folder: str) -> DataFrame:
    return features.flag_partial_month(revenue_per_month(spark, folder))


_LONG_SQL = (
    "SELECT CAST(year(DATE) AS INT) AS YEAR, CAST(month(DATE) AS INT) AS MONTH, CHANNEL, "
    "CAST(sum(TOTAL_COST) AS DECIMAL(28,2)) AS TOTAL_COST FROM ({source}) GROUP BY 1, 2, 3"
)
_EVENTS_SQL = (
    "SELECT CAST(ts AS DATE) AS DATE, event_type AS CHANNEL, CAST(value AS DECIMAL(18,2)) AS TOTAL_COST FROM events"
)

ENTRIES = {
    "spend_per_channel": Entry(spend_per_channel, _LONG_SQL.format(source=SPEND_SQL)),
    "spend_per_channel_events": Entry(spend_per_channel_events, _LONG_SQL.format(source=_EVENTS_SQL)),
    "spend_wide": Entry(spend_wide, WIDE_SQL),
    "spend_wide_from_long": Entry(spend_wide_from_long, WIDE_SQL),
    "spend_wide_years": Entry(spend_wide_years, f"SELECT * FROM ({WIDE_SQL}) WHERE YEAR BETWEEN 1996 AND 1997"),
    "spend_wide_zero_filled": Entry(
        spend_wide_zero_filled,
        "SELECT CAST(year(DATE) AS INT) AS YEAR, CAST(month(DATE) AS INT) AS MONTH, "
        "CAST(coalesce(sum(CASE WHEN CHANNEL = 'click' THEN TOTAL_COST END), 0) AS DECIMAL(28,2)) AS CLICK, "
        f"CAST(0 AS DECIMAL(28,2)) AS NONE FROM ({_EVENTS_SQL}) GROUP BY 1, 2",
    ),
    "revenue_per_month": Entry(revenue_per_month, MONTHLY_SQL),
    "feature_table": Entry(feature_table, FEATURES_SQL),
    "feature_table_without_month": Entry(
        feature_table_without_month,
        f"SELECT SEARCH_ENGINE, SOCIAL_MEDIA, VIDEO, EMAIL, REVENUE FROM ({FEATURES_SQL})",
    ),
    "partial_month": Entry(
        partial_month,
        f"WITH m AS ({MONTHLY_SQL}), t AS (SELECT max(YEAR * 12 + MONTH) AS ix, avg(REVENUE) AS mean FROM m) "
        "SELECT YEAR, MONTH, REVENUE, (YEAR * 12 + MONTH = ix) AND (REVENUE < mean * 0.5) AS IS_PARTIAL FROM m, t",
    ),
}
