"""Single operators on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.entries.common import (
    MONTHLY_SQL,
    ORDER_CHANNELS,
    SPEND_SQL,
    WIDE_SQL,
    Entry,
    conditional_sums,
    event_spend,
    money,
    revenue,
    spend,
    table,
)
from spendcast.functions.scalars import fixed_decimals, month_name, percent_change
from spendcast.operators.reshape import (
    RECODE_BROADCAST_ROWS,
    flag_equal,
    last_by_order,
    order_index,
    pivot_wide,
    recode,
    recode_by_table,
    sort_by_list,
    unpivot_long,
)
from spendcast.plans.features import revenue_per_month, spend_per_channel, spend_per_month_wide
from spendcast.schemas import MONTH_NAMES
from spendcast.sources.tables import run_sql

_SEGMENT_LABELS = {
    "AUTOMOBILE": "Automobile",
    "BUILDING": "Building",
    "FURNITURE": "Furniture",
    "HOUSEHOLD": "Household",
    "MACHINERY": "Machinery",
}


def scan_project(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("PRICE"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("NET_PRICE"),
    )


def sql_param_query(spark: SparkSession, folder: str) -> DataFrame:
    return run_sql(
        spark,
        "SELECT o_orderkey, o_totalprice AS TOTAL_COST FROM {source} "
        "WHERE o_orderpriority <> :channel AND o_totalprice >= :least",
        {"channel": "5-LOW", "least": 100000.0},
        source=table(spark, folder, "orders"),
    )


def filter_ne(spark: SparkSession, folder: str) -> DataFrame:
    return spend(spark, folder).filter(F.col("CHANNEL") != "5-LOW")


def filter_eq(spark: SparkSession, folder: str) -> DataFrame:
    return spend(spark, folder).filter(F.col("CHANNEL") == "1-URGENT")


def drop_rename(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").drop("o_orderstatus", "o_orderdate")
    return orders.withColumnsRenamed({"o_orderpriority": "CHANNEL", "o_totalprice": "TOTAL_COST"})


def _customer_years(spark: SparkSession, folder: str) -> DataFrame:
    """Spend per customer and year by channel: many groups lack a channel."""
    orders = table(spark, folder, "orders").select(
        "o_custkey",
        F.year("o_orderdate").alias("YEAR"),
        F.col("o_orderpriority").alias("CHANNEL"),
        money("o_totalprice").alias("TOTAL_COST"),
    )
    return pivot_wide(orders, "CHANNEL", "TOTAL_COST", ORDER_CHANNELS)


_CUSTOMER_YEARS_SQL = (
    f"SELECT o_custkey, YEAR, {conditional_sums(ORDER_CHANNELS)} FROM ("
    "SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS YEAR, o_orderpriority AS CHANNEL, "
    "CAST(o_totalprice AS DECIMAL(18,2)) AS TOTAL_COST FROM orders) GROUP BY 1, 2"
)


def pivot_derived_groups(spark: SparkSession, folder: str) -> DataFrame:
    return _customer_years(spark, folder)


def dropna_any(spark: SparkSession, folder: str) -> DataFrame:
    return _customer_years(spark, folder).dropna(how="any")


def recode_values(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return recode(customers, _SEGMENT_LABELS, ["c_mktsegment"])


def unpivot_values(spark: SparkSession, folder: str) -> DataFrame:
    return unpivot_long(_customer_years(spark, folder), "Budget", "Channel", list(ORDER_CHANNELS.values()))


def unpivot_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    wide = _customer_years(spark, folder)
    return unpivot_long(wide, "Budget", "Channel", list(ORDER_CHANNELS.values()), include_nulls=True)


def _unpivot_sql(where: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT o_custkey, YEAR, '{c}' AS CHANNEL, {c} AS BUDGET FROM wide {where.format(c=c)}"
        for c in ORDER_CHANNELS.values()
    )
    return f"WITH wide AS ({_CUSTOMER_YEARS_SQL}) {parts}"


def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_custkey", "o_orderpriority").distinct()


def last_value(spark: SparkSession, folder: str) -> DataFrame:
    monthly = revenue_per_month(revenue(spark, folder))
    return last_by_order(monthly, "REVENUE", F.col("YEAR") * 12 + F.col("MONTH"), "LAST_REVENUE")


def last_value_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return last_by_order(orders, "o_totalprice", F.col("o_orderkey"), "LAST_PRICE", ["o_custkey"])


def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return spend(spark, folder).unionByName(event_spend(spark, folder))


def inner_join_using(spark: SparkSession, folder: str) -> DataFrame:
    wide = spend_per_month_wide(spend(spark, folder), ORDER_CHANNELS)
    return wide.join(revenue_per_month(revenue(spark, folder)), ["YEAR", "MONTH"])


def sorted_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy("o_custkey", "o_orderkey")


def top_n_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return spend_per_channel(spend(spark, folder)).orderBy("YEAR", "MONTH", "CHANNEL").limit(10)


def _with_month_name(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", month_name("o_orderdate").alias("MONTH"))


def custom_order_index(spark: SparkSession, folder: str) -> DataFrame:
    named = _with_month_name(spark, folder).withColumn("MONTH_IX", order_index("MONTH", MONTH_NAMES))
    return sort_by_list(named, "MONTH", MONTH_NAMES, "o_orderkey")


def custom_order_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of the list sort, which only the right order gives."""
    named = _with_month_name(spark, folder)
    return sort_by_list(named, "MONTH", MONTH_NAMES, "o_orderkey").limit(50)


def flag_scenario(spark: SparkSession, folder: str) -> DataFrame:
    named = _with_month_name(spark, folder)
    return named.withColumns({"IS_SCENARIO": flag_equal("MONTH", "July"), "ROI": F.lit(8.5)})


def pct_change(spark: SparkSession, folder: str) -> DataFrame:
    """Every order against the mean order of the last month."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", money("o_totalprice").alias("TOTAL_COST")
    )
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    means = orders.groupBy(month.alias("IX")).agg(
        (F.sum("TOTAL_COST").cast("double") / F.count(F.lit(1))).alias("MEAN")
    )
    last = last_by_order(means, "MEAN", F.col("IX"), "LAST").scalar()
    return orders.select("o_orderkey", percent_change(F.col("TOTAL_COST").cast("double"), last).alias("CHANGE_PCT"))


def format_label(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("o_totalprice") / F.lit(100000.0)
    return table(spark, folder, "orders").select(
        "o_orderkey", F.concat(F.lit("$ "), fixed_decimals(value, 2), F.lit(" million")).alias("ROI_LABEL")
    )


def absolute_value(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", F.abs("c_acctbal").alias("BALANCE"))


def array_of_columns(spark: SparkSession, folder: str) -> DataFrame:
    values = F.array("l_quantity", "l_discount", "l_tax")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.size(values).alias("N"), values[0].alias("FIRST"), values[2].alias("LAST")
    )


def _named_lines(spark: SparkSession, folder: str, broadcast_rows: int) -> DataFrame:
    parts = table(spark, folder, "part").select(F.concat(F.lit("P"), "p_partkey").alias("CODE"), F.col("p_name").alias("LABEL"))
    suppliers = table(spark, folder, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("CODE"), F.col("s_name").alias("LABEL"))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("P"), "l_partkey").alias("PART"),
        F.concat(F.lit("S"), "l_suppkey").alias("SUPPLIER"),
    )
    return recode_by_table(lines, parts.unionByName(suppliers), ["PART", "SUPPLIER"], broadcast_rows=broadcast_rows)


def recode_by_small_table(spark: SparkSession, folder: str) -> DataFrame:
    """Names of part and supplier for every line, by one map that is small enough for every task."""
    return _named_lines(spark, folder, RECODE_BROADCAST_ROWS)


def recode_by_large_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same by joins, as for a map of any size."""
    return _named_lines(spark, folder, 0)


_NAMED_SQL = (
    "SELECT l_orderkey, l_linenumber, coalesce(p_name, 'P' || l_partkey) AS PART, coalesce(s_name, 'S' || l_suppkey) AS SUPPLIER "
    "FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey"
)

ENTRIES = {
    "scan_project": Entry(
        scan_project,
        "SELECT l_orderkey, l_linenumber, l_extendedprice AS PRICE, "
        "l_extendedprice * (1 - l_discount) AS NET_PRICE FROM lineitem",
    ),
    "sql_param_query": Entry(
        sql_param_query,
        "SELECT o_orderkey, o_totalprice AS TOTAL_COST FROM orders "
        "WHERE o_orderpriority <> '5-LOW' AND o_totalprice >= 100000.0",
    ),
    "filter_ne": Entry(filter_ne, f"SELECT * FROM ({SPEND_SQL}) WHERE CHANNEL <> '5-LOW'"),
    "filter_eq": Entry(filter_eq, f"SELECT * FROM ({SPEND_SQL}) WHERE CHANNEL = '1-URGENT'"),
    "drop_rename": Entry(
        drop_rename,
        "SELECT o_orderkey, o_custkey, o_totalprice AS TOTAL_COST, o_orderpriority AS CHANNEL FROM orders",
    ),
    "pivot_derived_groups": Entry(pivot_derived_groups, _CUSTOMER_YEARS_SQL),
    "dropna_any": Entry(
        dropna_any,
        f"SELECT * FROM ({_CUSTOMER_YEARS_SQL}) WHERE o_custkey IS NOT NULL AND YEAR IS NOT NULL AND "
        + " AND ".join(f"{c} IS NOT NULL" for c in ORDER_CHANNELS.values()),
    ),
    "recode_by_table": Entry(recode_by_small_table, _NAMED_SQL),
    "recode_by_join": Entry(recode_by_large_table, _NAMED_SQL),
    "recode_values": Entry(
        recode_values,
        "SELECT c_custkey, CASE c_mktsegment "
        + " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in _SEGMENT_LABELS.items())
        + " ELSE c_mktsegment END AS c_mktsegment FROM customer",
    ),
    "unpivot_long": Entry(unpivot_values, _unpivot_sql("WHERE {c} IS NOT NULL")),
    "unpivot_with_nulls": Entry(unpivot_with_nulls, _unpivot_sql("")),
    "distinct_rows": Entry(distinct_rows, "SELECT DISTINCT o_custkey, o_orderpriority FROM orders"),
    "last_by_order": Entry(
        last_value, f"SELECT arg_max(REVENUE, YEAR * 12 + MONTH) AS LAST_REVENUE FROM ({MONTHLY_SQL})"
    ),
    "last_by_order_per_group": Entry(
        last_value_per_group,
        "SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS LAST_PRICE FROM orders GROUP BY o_custkey",
    ),
    "union_by_name": Entry(
        union_by_name,
        f"{SPEND_SQL} UNION ALL BY NAME SELECT CAST(value AS DECIMAL(18,2)) AS TOTAL_COST, "
        "event_type AS CHANNEL, CAST(ts AS DATE) AS DATE FROM events",
    ),
    "inner_join_using": Entry(
        inner_join_using, f"SELECT * FROM ({WIDE_SQL}) JOIN ({MONTHLY_SQL}) USING (YEAR, MONTH)"
    ),
    "sorted_rows": Entry(
        sorted_rows, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey"
    ),
    "top_n_sorted": Entry(
        top_n_sorted,
        "SELECT CAST(year(DATE) AS INT) AS YEAR, CAST(month(DATE) AS INT) AS MONTH, CHANNEL, "
        f"CAST(sum(TOTAL_COST) AS DECIMAL(28,2)) AS TOTAL_COST FROM ({SPEND_SQL}) "
        "GROUP BY 1, 2, 3 ORDER BY 1, 2, 3 LIMIT 10",
    ),
    "custom_order_index": Entry(
        custom_order_index,
        "SELECT o_orderkey, monthname(o_orderdate) AS MONTH, CAST(list_position(["
        + ", ".join(f"'{m}'" for m in MONTH_NAMES)
        + "], monthname(o_orderdate)) AS INT) AS MONTH_IX FROM orders",
    ),
    "custom_order_first": Entry(
        custom_order_first,
        "SELECT o_orderkey, monthname(o_orderdate) AS MONTH FROM orders ORDER BY month(o_orderdate), o_orderkey LIMIT 50",
    ),
    "flag_scenario": Entry(
        flag_scenario,
        "SELECT o_orderkey, monthname(o_orderdate) AS MONTH, "
        "CASE WHEN monthname(o_orderdate) = 'July' THEN true ELSE false END AS IS_SCENARIO, "
        "CAST(8.5 AS DOUBLE) AS ROI FROM orders",
    ),
    "pct_change": Entry(
        pct_change,
        "WITH means AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) AS ix, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean FROM orders GROUP BY 1), "
        "last AS (SELECT arg_max(mean, ix) AS roi FROM means) "
        "SELECT o_orderkey, round_even((o_totalprice - roi) / roi * 100, 1) AS CHANGE_PCT FROM orders, last",
    ),
    "format_label": Entry(
        format_label, "SELECT o_orderkey, printf('$ %.2f million', o_totalprice / 100000.0) AS ROI_LABEL FROM orders"
    ),
    "absolute_value": Entry(absolute_value, "SELECT c_custkey, abs(c_acctbal) AS BALANCE FROM customer"),
    "array_of_columns": Entry(
        array_of_columns,
        "SELECT l_orderkey, l_linenumber, CAST(len([l_quantity, l_discount, l_tax]) AS INT) AS N, "
        "l_quantity AS FIRST, l_tax AS LAST FROM lineitem",
    ),
}
