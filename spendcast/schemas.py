"""Table schemas and the fixed values the operators share."""

from __future__ import annotations

import calendar

from pyspark.sql import types as T

_COUNT = T.DecimalType(38, 0)

CAMPAIGN_SPEND = T.StructType(
    [
        T.StructField("CAMPAIGN", T.StringType()),
        T.StructField("CHANNEL", T.StringType()),
        T.StructField("DATE", T.DateType()),
        T.StructField("TOTAL_CLICKS", _COUNT),
        T.StructField("TOTAL_COST", _COUNT),
        T.StructField("ADS_SERVED", _COUNT),
    ]
)

# YEAR and MONTH are int, the type of year(date) and month(date): decimal keys
# would cost a cast and one more exchange in a sort-merge join.
MONTHLY_REVENUE = T.StructType(
    [
        T.StructField("YEAR", T.IntegerType()),
        T.StructField("MONTH", T.IntegerType()),
        T.StructField("REVENUE", T.DoubleType()),
    ]
)

BUDGET_ALLOCATIONS_AND_ROI = T.StructType(
    [
        T.StructField("MONTH", T.StringType()),
        T.StructField("SEARCHENGINE", T.LongType()),
        T.StructField("SOCIALMEDIA", T.LongType()),
        T.StructField("VIDEO", T.LongType()),
        T.StructField("EMAIL", T.LongType()),
        T.StructField("ROI", T.DoubleType()),
    ]
)

TRAIN_REPORT = T.StructType(
    [
        T.StructField("train_r2", T.DoubleType()),
        T.StructField("train_threshold", T.DoubleType()),
        T.StructField("test_r2", T.DoubleType()),
        T.StructField("test_threshold", T.DoubleType()),
        T.StructField("model_saved", T.BooleanType()),
    ]
)

# Column definitions for strict tables: a varchar rejects an over-long value on write.
CAMPAIGN_SPEND_DDL = (
    "CAMPAIGN VARCHAR(60), CHANNEL VARCHAR(60), DATE DATE, "
    "TOTAL_CLICKS DECIMAL(38,0), TOTAL_COST DECIMAL(38,0), ADS_SERVED DECIMAL(38,0)"
)
MONTHLY_REVENUE_DDL = "YEAR INT, MONTH INT, REVENUE DOUBLE"
BUDGET_ALLOCATIONS_AND_ROI_DDL = (
    "MONTH VARCHAR(30), SEARCHENGINE BIGINT, SOCIALMEDIA BIGINT, VIDEO BIGINT, EMAIL BIGINT, ROI DOUBLE"
)

# Channel codes in the spend table and the feature columns they become.
CHANNEL_COLUMNS = {
    "search_engine": "SEARCH_ENGINE",
    "social_media": "SOCIAL_MEDIA",
    "video": "VIDEO",
    "email": "EMAIL",
}
FEATURES = ("SEARCH_ENGINE", "SOCIAL_MEDIA", "VIDEO", "EMAIL")
LABEL = "REVENUE"
MONTH_KEYS = ("YEAR", "MONTH")

# Budget columns in the order of FEATURES, and their display labels.
BUDGETS = ("SEARCHENGINE", "SOCIALMEDIA", "VIDEO", "EMAIL")
CHANNEL_LABELS = {
    "SEARCHENGINE": "Search engine",
    "SOCIALMEDIA": "Social media",
    "VIDEO": "Video",
    "EMAIL": "Email",
}

MONTH_NAMES = tuple(calendar.month_name[1:])
SCENARIO_MONTH = "July"
