from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendcast.operators.reshape import (
    flag_equal,
    last_by_order,
    order_index,
    pivot_wide,
    recode,
    recode_by_table,
    sort_by_list,
    unpivot_long,
)
from spendcast.plans.features import feature_table, flag_partial_month, spend_per_month_wide
from spendcast.schemas import CAMPAIGN_SPEND, MONTH_NAMES, MONTHLY_REVENUE
from tests.helpers import rows

D = dt.date
NAMES = {"search_engine": "SEARCH_ENGINE", "video": "VIDEO"}


def spend(spark, *items):
    data = [("c", channel, day, Decimal(1), Decimal(cost), Decimal(1)) for channel, day, cost in items]
    return spark.createDataFrame(data, CAMPAIGN_SPEND)


def test_pivot_groups_by_every_remaining_column(spark):
    df = spark.createDataFrame(
        [(2020, 1, "video", 5), (2020, 1, "video", 2), (2020, 2, "search_engine", 1)], "Y int, M int, C string, V int"
    )
    assert rows(pivot_wide(df, "C", "V", NAMES)) == [(2020, 1, None, 7), (2020, 2, 1, None)]


def test_pivot_keeps_the_row_of_an_unlisted_name(spark):
    df = spark.createDataFrame([(1, "radio", 5)], "M int, C string, V int")
    wide = pivot_wide(df, "C", "V", NAMES)
    assert rows(wide) == [(1, None, None)]
    assert wide.dropna().count() == 0
    assert rows(pivot_wide(df, "C", "V", NAMES, fill_zero=True)) == [(1, 0, 0)]


def test_pivot_equals_builtin_pivot(spark):
    df = spark.range(2000).select(
        (F.col("id") % 7).alias("G"), F.concat(F.lit("n"), F.col("id") % 5).alias("C"), F.col("id").alias("V")
    )
    names = {"n0": "A", "n3": "B"}
    builtin = df.groupBy("G").pivot("C", list(names)).sum("V")
    assert rows(pivot_wide(df, "C", "V", names)) == rows(builtin)


def test_spend_sum_over_38_digits_fails(spark):
    big = "9" * 38
    df = spend(spark, ("video", D(2020, 1, 1), big), ("video", D(2020, 1, 2), big))
    with pytest.raises(ArithmeticException):
        spend_per_month_wide(df).collect()


def test_feature_table_edges(spark):
    four = ("search_engine", "social_media", "video", "email")
    full = [(c, D(2020, 1, d), 10) for c in four for d in (1, 2)]
    three = [(c, D(2020, 2, 1), 10) for c in four[:3]]
    unlisted = [("radio", D(2020, 3, 1), 10)]
    no_revenue = [(c, D(2020, 4, 1), 10) for c in four]
    no_date = [(c, None, 10) for c in four]
    nan_month = [(c, D(2020, 5, 1), 10) for c in four]
    spends = spend(spark, *full, *three, *unlisted, *no_revenue, *no_date, *nan_month)
    revenue = spark.createDataFrame(
        [
            (2020, 1, 100.0), (2020, 1, 50.0), (2020, 2, 1.0), (2020, 3, 1.0),
            (None, None, 1.0), (2020, 5, float("nan")), (2020, 6, 1.0),
        ],
        MONTHLY_REVENUE,
    )
    ten = Decimal(20)
    assert rows(feature_table(spends, revenue)) == [(2020, 1, ten, ten, ten, ten, 150.0)]
    assert feature_table(spends, revenue, keep_month=False).columns == [
        "SEARCH_ENGINE", "SOCIAL_MEDIA", "VIDEO", "EMAIL", "REVENUE",
    ]
    filled = feature_table(spends, revenue, fill_zero=True)
    assert [r["MONTH"] for r in filled.orderBy("MONTH").collect()] == [1, 2, 3]


def test_wide_spend_keeps_a_month_of_unlisted_channels(spark):
    df = spend(spark, ("radio", D(2020, 3, 1), 1), ("tv", D(2020, 3, 1), 1), (None, D(2020, 4, 1), 1))
    assert rows(spend_per_month_wide(df)) == [(2020, 3, None, None, None, None), (2020, 4, None, None, None, None)]
    assert rows(spend_per_month_wide(df, fill_zero=True)) == [(2020, 3, 0, 0, 0, 0), (2020, 4, 0, 0, 0, 0)]


def test_partial_last_month_is_flagged_and_kept(spark):
    df = spark.createDataFrame([(2022, 3, 3.3), (2022, 4, 3.1), (2022, 5, 1.1)], MONTHLY_REVENUE)
    assert [tuple(r)[1:] for r in flag_partial_month(df).orderBy("MONTH").collect()] == [
        (3, 3.3, False), (4, 3.1, False), (5, 1.1, True),
    ]


def test_unpivot_names_are_upper_case_and_nulls_go(spark):
    df = spark.createDataFrame([("May", 1.5, 3, None)], "MONTH string, ROI double, SEARCHENGINE long, VIDEO long")
    long = unpivot_long(df, "Budget", "Channel", ["SearchEngine", "Video"])
    assert long.columns == ["MONTH", "ROI", "CHANNEL", "BUDGET"]
    assert rows(long) == [("May", 1.5, "SEARCHENGINE", 3)]
    kept = unpivot_long(df, "Budget", "Channel", ["SearchEngine", "Video"], include_nulls=True)
    assert rows(kept) == [("May", 1.5, "SEARCHENGINE", 3), ("May", 1.5, "VIDEO", None)]


def test_unpivot_filter_is_applied_before_rows_multiply(spark):
    df = spark.createDataFrame([("May", 1, 2), ("July", 3, 4)], "MONTH string, A long, B long")
    plan = unpivot_long(df, "v", "n", ["A", "B"]).filter("MONTH <> 'July'")._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert text.index("Expand") < text.index("NOT (MONTH")


def test_recode_all_string_columns_or_some(spark):
    df = spark.createDataFrame([("a", "a", 1)], "X string, Y string, N int")
    assert rows(recode(df, {"a": "b"})) == [("b", "b", 1)]
    assert rows(recode(df, {"a": "b"}, ["Y"])) == [("a", "b", 1)]


def test_order_by_list(spark):
    df = spark.createDataFrame([("March",), ("Undecember",), ("January",), (None,)], "MONTH string")
    assert [r[0] for r in sort_by_list(df, "MONTH", MONTH_NAMES).collect()][:2] == ["January", "March"]
    assert rows(df.select("MONTH", order_index("MONTH", MONTH_NAMES).alias("i"))) == [
        ("January", 1), ("March", 3), ("Undecember", None), (None, None),
    ]


def test_last_by_order(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 3, 7.0), ("b", 2, 1.0)], "G string, IX int, V double")
    assert rows(last_by_order(df, "V", F.col("IX"), "LAST")) == [(7.0,)]
    assert rows(last_by_order(df, "V", F.col("IX"), "LAST", ["G"])) == [("a", 7.0), ("b", 1.0)]


def test_filters_and_flag_on_null(spark):
    df = spark.createDataFrame([("July",), ("May",), (None,)], T.StructType([T.StructField("MONTH", T.StringType())]))
    assert rows(df.filter(F.col("MONTH") != "July")) == [("May",)]
    assert rows(df.select(flag_equal("MONTH", "July"))) == [(False,), (False,), (True,)]


def test_one_hot_month_and_channel(spark):
    """A third of all rows in one month and one channel; totals against a plain loop."""
    four = ("search_engine", "social_media", "video", "email")
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("video"))
        .otherwise(F.element_at(F.array(*[F.lit(c) for c in four]), (F.col("id") % 4 + 1).cast("int")))
        .alias("CHANNEL"),
        F.when(F.col("id") % 3 == 0, F.lit(D(2020, 6, 1)))
        .otherwise(F.date_add(F.lit(D(2019, 1, 1)), (F.col("id") % 900).cast("int")))
        .alias("DATE"),
        (F.col("id") % 97).cast("decimal(38,0)").alias("TOTAL_COST"),
    )
    totals = {}
    for i in range(30000):
        channel = "video" if i % 3 == 0 else four[i % 4]
        day = D(2020, 6, 1) if i % 3 == 0 else D(2019, 1, 1) + dt.timedelta(days=i % 900)
        key = (day.year, day.month)
        totals.setdefault(key, dict.fromkeys(four))
        totals[key][channel] = (totals[key][channel] or 0) + i % 97
    expected = sorted(((*k, *[None if v[c] is None else Decimal(v[c]) for c in four]) for k, v in totals.items()), key=repr)
    assert rows(spend_per_month_wide(hot)) == expected


CODES = [("a", "Alpha"), ("b", "Beta"), ("c", None), (None, "never"), ("z", "Zed")]


def coded(spark):
    values = ["a"] * 400 + ["b", "c", "x", None, "Alpha"] * 20
    return spark.createDataFrame(
        [(n, v, values[-1 - n], "kept") for n, v in enumerate(values)], "n int, CODE string, second string, `new_CODE` string"
    )


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_recode_by_table(spark, broadcast_rows):
    df = coded(spark).repartition(5)
    mapping = spark.createDataFrame(CODES, "CODE string, LABEL string")
    found = recode_by_table(df, mapping, ["CODE", "second"], broadcast_rows=broadcast_rows)
    assert found.columns == df.columns
    labels = {c: v for c, v in CODES if c is not None}
    want = [(r["n"], labels.get(r["CODE"], r["CODE"]), labels.get(r["second"], r["second"]), "kept") for r in df.collect()]
    assert rows(found) == sorted(want, key=repr)
    assert recode_by_table(df.limit(0), mapping, ["CODE"], broadcast_rows=broadcast_rows).count() == 0
    empty = recode_by_table(df, mapping.limit(0), ["CODE"], broadcast_rows=broadcast_rows)
    assert rows(empty) == rows(df)


def test_recode_by_table_refuses_a_code_with_two_labels(spark):
    mapping = spark.createDataFrame([("a", "x"), ("a", "y")], "c string, l string")
    with pytest.raises(ValueError, match="several labels for a"):
        recode_by_table(coded(spark), mapping, ["CODE"], code="c", label="l")


def test_a_hot_code_is_dealt_over_tasks(spark):
    """Three quarters of the rows share a code or have none; no partition of the join takes more than its share."""
    df = spark.range(8000).select("id", F.when(F.col("id") % 4 < 2, "hot").when(F.col("id") % 4 == 3, F.concat(F.lit("c"), "id")).alias("CODE"))
    mapping = spark.createDataFrame([("hot", "Hot"), ("c3", "three")], "CODE string, LABEL string")
    found = recode_by_table(df, mapping, ["CODE"], broadcast_rows=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = recode_by_table(df, mapping, ["CODE"], broadcast_rows=0)
        sizes = plan.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 2 * 8000 / 8
        broadcast = recode_by_table(df, mapping, ["CODE"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found.groupBy("CODE").count().filter("CODE in ('Hot', 'three')").orderBy("CODE").collect() == [("Hot", 4000), ("three", 1)]
    assert "Exchange hashpartitioning" not in broadcast
