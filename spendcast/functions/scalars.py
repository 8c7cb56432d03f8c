"""Scalar column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.schemas import MONTH_NAMES


def round_half_even(value: Column, digits: int) -> Column:
    """Round a double, ties to even: scale, round to a whole number, scale back.

    This is how array libraries round, so results agree with them to the last bit,
    and it stays double arithmetic where ``bround`` goes through a decimal per row.
    """
    factor = F.lit(10.0**digits)
    return F.rint(value * factor) / factor


def percent_change(new: Column, old: Column, digits: int = 1) -> Column:
    """Change from old to new in percent, ties rounded to even; NULL when old is 0."""
    return round_half_even(F.try_divide(new - old, old) * F.lit(100.0), digits)


def fixed_decimals(value: Column, digits: int) -> Column:
    """A number as text with a fixed count of decimals, ties to even; inf, -inf and nan as Python writes them."""
    number = value.cast("double")
    text = F.call_function("format_number", value, F.lit("0." + "0" * digits))
    return (
        F.when(F.isnan(number), "nan")
        .when(number == float("inf"), "inf")
        .when(number == float("-inf"), "-inf")
        .otherwise(text)
    )


def month_name(date_column: str) -> Column:
    """English month name; a lookup by number, where a date format would build text row by row."""
    return F.element_at(F.array(*[F.lit(name) for name in MONTH_NAMES]), F.month(date_column))


def years_between(date_column: str, first_year: int, last_year: int) -> Column:
    """Filter on whole years as a range of dates.

    A condition on year(date) stops at the scan; a range on the column itself is
    pushed to Parquet and skips row groups.
    """
    date = F.col(date_column)
    return (date >= F.lit(dt.date(first_year, 1, 1))) & (date < F.lit(dt.date(last_year + 1, 1, 1)))


def session_info(spark: SparkSession) -> DataFrame:
    """Current user, catalog, database and Spark version as one row."""
    return spark.sql(
        "SELECT current_user() AS user, current_catalog() AS catalog, "
        "current_database() AS database, version() AS version"
    )
