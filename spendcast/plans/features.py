"""Monthly spend by channel joined with monthly revenue."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendcast.operators.reshape import pivot_wide
from spendcast.schemas import CHANNEL_COLUMNS, LABEL, MONTH_KEYS


def month_of(date_column: str) -> list[Column]:
    """YEAR and MONTH of a date as grouping columns."""
    return [F.year(date_column).alias("YEAR"), F.month(date_column).alias("MONTH")]


def spend_per_channel(spend: DataFrame) -> DataFrame:
    """Total cost per year, month and channel."""
    return spend.groupBy(*month_of("DATE"), "CHANNEL").agg(F.sum("TOTAL_COST").alias("TOTAL_COST"))


def spend_per_month_wide(
    spend: DataFrame, channels: Mapping[str, str] = CHANNEL_COLUMNS, fill_zero: bool = False
) -> DataFrame:
    """Total cost per year and month, one column per listed channel.

    Summed per channel first: a daily row then updates one total, where pivoting it
    directly would update one per listed channel. Unlisted channels share one group, so
    both exchanges carry a few rows per task and month, however many names there are.
    """
    listed = F.when(F.col("CHANNEL").isin(*channels), F.col("CHANNEL"))
    per_channel = spend_per_channel(spend.withColumn("CHANNEL", listed))
    return pivot_wide(per_channel, "CHANNEL", "TOTAL_COST", channels, MONTH_KEYS, fill_zero)


def revenue_per_month(revenue: DataFrame) -> DataFrame:
    """Total revenue per year and month; the input may hold several rows per month."""
    return revenue.groupBy(*MONTH_KEYS).agg(F.sum(LABEL).alias(LABEL))


def feature_table(
    spend: DataFrame,
    revenue: DataFrame,
    channels: Mapping[str, str] = CHANNEL_COLUMNS,
    keep_month: bool = True,
    fill_zero: bool = False,
) -> DataFrame:
    """Months with spend in every channel and with revenue.

    Both sides are reduced to one row per month before the join, so it never meets
    a hot key and its size does not depend on the size of the inputs. YEAR and
    MONTH stay as row keys for the split; ``keep_month=False`` drops them.
    """
    # A missing date joins nothing, and a month of unlisted channels only is incomplete
    # unless it is filled. Said on the columns themselves, both filters reach the scan.
    spend = spend.filter(F.col("DATE").isNotNull())
    if not fill_zero:
        spend = spend.filter(F.col("CHANNEL").isin(*channels))
    wide = spend_per_month_wide(spend, channels, fill_zero)
    features = wide.join(revenue_per_month(revenue), list(MONTH_KEYS), "inner").dropna(how="any")
    return features if keep_month else features.drop(*MONTH_KEYS)


def flag_partial_month(monthly: DataFrame, value: str = LABEL, ratio: float = 0.5) -> DataFrame:
    """Mark the last month when its value is below ``ratio`` times the mean of all months."""
    index = F.col("YEAR") * 12 + F.col("MONTH")
    # One scalar subquery for both figures: it needs the same columns as the frame
    # itself, so Spark reuses the monthly totals and the source is read once.
    figures = F.struct(F.max(index).alias("last"), F.avg(F.col(value).cast("double")).alias("mean"))
    whole = monthly.agg(figures.alias("whole")).scalar()
    is_last = index == whole["last"]
    return monthly.withColumn("IS_PARTIAL", is_last & (F.col(value) < whole["mean"] * F.lit(ratio)))
