"""Loading, appending and refreshing whole tables through files."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendcast.entries.common import (
    FEATURES_SQL,
    NET_PRICE_SQL,
    ORDER_CHANNELS,
    SPEND_SQL,
    WIDE_SQL,
    Entry,
    event_spend,
    net_price_features,
    revenue,
    spend,
    table,
)
from spendcast.entries.training import report_sql, residual_steps, split_sql
from spendcast.functions.live import LiveScorer
from spendcast.jobs import call
from spendcast.operators.reshape import recode
from spendcast.plans.features import spend_per_month_wide
from spendcast.plans.training import model_runs, train_revenue_model
from spendcast.schemas import CHANNEL_COLUMNS, FEATURES, MONTH_KEYS, TRAIN_REPORT
from spendcast.sources.landing import bulk_load, load_new_files, load_table_once, narrow_counts, read_csv, stream_csv
from spendcast.sources.tables import append_by_name, bounded_pandas, create_or_replace_table, insert_rows, overwrite_table
from spendcast.streaming.ledger import LedgerRefresh
from spendcast.streaming.refresh import Refresh, current_features, retrain_with
from spendcast.workspace import new_folder, remove_folder

_SPEND = T.StructType(
    [
        T.StructField("DATE", T.DateType()),
        T.StructField("CHANNEL", T.StringType()),
        T.StructField("TOTAL_COST", T.DecimalType(18, 2)),
    ]
)
_SPEND_DDL = "DATE DATE, CHANNEL VARCHAR(60), TOTAL_COST DECIMAL(18,2)"
# Rows dated before this day arrive first, the others later.
_SECOND_DROP = "1998-07-01"
_DEPLOYED_KEYS = ("l_orderkey", "l_linenumber")


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "csv")
    spend(spark, folder).write.option("header", "true").csv(path)
    return narrow_counts(read_csv(spark, path, _SPEND))


def bulk_load_table(spark: SparkSession, folder: str) -> DataFrame:
    """Typed table, then every file of a landing folder."""
    landing, path = new_folder(spark, "landing"), new_folder(spark, "spend")
    name = "spend_" + path[-12:]
    spend(spark, folder).write.option("header", "true").csv(landing)
    create_or_replace_table(spark, name, _SPEND_DDL, path)
    bulk_load(spark, landing, _SPEND, name)
    return spark.table(name)


def overwrite_from_query(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "wide")
    name = "wide_" + path[-12:]
    overwrite_table(spend_per_month_wide(spend(spark, folder), ORDER_CHANNELS), name, path)
    return spark.table(name)


def append_rows_by_name(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "spend")
    name = "appended_" + path[-12:]
    create_or_replace_table(spark, name, _SPEND_DDL, path)
    append_by_name(spend(spark, folder), name)
    append_by_name(event_spend(spark, folder), name)
    return spark.table(name)


def incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two drops of files, three runs; the last run finds nothing new."""
    root = new_folder(spark, "load")
    rows = spend(spark, folder)
    for drop in (F.col("DATE") < _SECOND_DROP, F.col("DATE") >= _SECOND_DROP):
        rows.filter(drop).write.mode("append").option("header", "true").csv(f"{root}/landing")
        _load(spark, root)
    _load(spark, root)
    return spark.read.schema(_SPEND).parquet(f"{root}/table")


def _load(spark: SparkSession, root: str) -> None:
    source = stream_csv(spark, f"{root}/landing", _SPEND)
    load_new_files(source, f"{root}/table", f"{root}/checkpoint").awaitTermination()


def replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """Filled with events, replaced at the same path, filled with spend: only spend is there."""
    path = new_folder(spark, "spend")
    name = "replaced_" + path[-12:]
    for rows in (event_spend(spark, folder), spend(spark, folder)):
        create_or_replace_table(spark, name, _SPEND_DDL, path)
        append_by_name(rows, name)
    return spark.table(name)


def load_table_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The same landing area loaded twice into a table with another order of columns, each row once."""
    root = new_folder(spark, "load-once")
    name = "loaded_" + root[-12:]
    spend(spark, folder).write.option("header", "true").csv(f"{root}/landing")
    create_or_replace_table(spark, name, "TOTAL_COST DECIMAL(18,2), DATE DATE, CHANNEL STRING", f"{root}/table")
    for _ in range(2):
        load_table_once(stream_csv(spark, f"{root}/landing", _SPEND), name, f"{root}/checkpoint")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _landed_in_two_drops(spark: SparkSession, folder: str, between, **more) -> DataFrame:
    """Spend in two drops of files, loaded after each; ``between`` gets the table's name before every load."""
    root = new_folder(spark, "load-table")
    name = "landed_" + root[-12:]
    rows = spend(spark, folder)
    create_or_replace_table(spark, name, "TOTAL_COST DECIMAL(18,2), DATE DATE, CHANNEL VARCHAR(60)", f"{root}/table")
    for drop in (F.col("DATE") < _SECOND_DROP, F.col("DATE") >= _SECOND_DROP):
        rows.filter(drop).write.mode("append").option("header", "true").csv(f"{root}/landing")
        between(name)
        for attempt in range(2):
            source = stream_csv(spark, f"{root}/landing", _SPEND)
            try:
                load_table_once(source, name, f"{root}/checkpoint", **(more if attempt == 0 else {}))
            except StreamingQueryException:
                if not more:
                    raise
    return spark.table(name)


def load_then_insert(spark: SparkSession, folder: str) -> DataFrame:
    """A table that takes files of spend, each once though it is loaded twice, and rows of events before each load."""
    halves = iter((F.col("DATE") < "2024-01-05", F.col("DATE") >= "2024-01-05"))
    return _landed_in_two_drops(
        spark, folder, lambda name: append_by_name(event_spend(spark, folder).filter(next(halves)), name)
    )


def load_after_crash(spark: SparkSession, folder: str) -> DataFrame:
    """Every load is lost after its files have been moved and before they are committed, and tried again."""

    def lost(batch: int) -> None:
        raise RuntimeError(f"batch {batch} is lost before its commit")

    return _landed_in_two_drops(spark, folder, lambda name: None, before_commit=lost)


def overwrite_from_itself(spark: SparkSession, folder: str) -> DataFrame:
    """A table of spend, overwritten by its own totals per day and channel, and by those above the mean of their channel."""
    path = new_folder(spark, "itself")
    name = "itself_" + path[-12:]
    overwrite_table(spend(spark, folder), name, path)
    totals = spark.table(name).groupBy("DATE", "CHANNEL").agg(F.sum("TOTAL_COST").cast("decimal(18,2)").alias("TOTAL_COST"))
    overwrite_table(totals, name, path)
    days = spark.table(name)
    means = days.groupBy("CHANNEL").agg(F.sum("TOTAL_COST").alias("ALL_COST"), F.count(F.lit(1)).alias("N"))
    above = days.join(means, "CHANNEL").filter(F.col("TOTAL_COST") * F.col("N") > F.col("ALL_COST"))
    overwrite_table(above.select("DATE", "CHANNEL", "TOTAL_COST"), name, path)
    return spark.table(name)


def insert_then_read(spark: SparkSession, folder: str) -> DataFrame:
    """A table filled from orders, then three literal rows by column name."""
    path = new_folder(spark, "inserted")
    name = "inserted_" + path[-12:]
    overwrite_table(spend(spark, folder), name, path)
    insert_rows(spark, name, ["CHANNEL", "DATE"], [("email", dt.date(2020, 1, 1)), ("video", None), (None, None)])
    return spark.table(name)


def bounded_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The ten largest orders as a bounded local result, which is a frame again."""
    largest = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    largest = largest.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
    return spark.createDataFrame(bounded_pandas(largest, 10), "o_orderkey long, o_totalprice double")


class _Feed:
    """Drops of spend and revenue below a new folder, and refreshes of it."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.root = spark, new_folder(spark, "refresh")
        self.costs, self.income = spend(spark, folder), revenue(spark, folder)
        # Both folders exist before the first rows do.
        self.drop("false", "false")

    def drop(self, costs: str, income: str) -> None:
        self.costs.filter(costs).write.mode("append").parquet(f"{self.root}/spend")
        self.income.filter(income).write.mode("append").parquet(f"{self.root}/revenue")

    def refresh(self, channels=ORDER_CHANNELS, **more) -> Refresh:
        return Refresh(
            self.spark,
            self.spark.readStream.schema(self.costs.schema).parquet(f"{self.root}/spend"),
            self.spark.readStream.schema(self.income.schema).parquet(f"{self.root}/revenue"),
            self.out,
            channels,
            **more,
        )

    @property
    def out(self) -> str:
        return f"{self.root}/out"

    def three_drops(self, **more) -> None:
        """Spend of the first years, all revenue, the rest of the spend; a refresh after each."""
        for costs, income in ((f"DATE < '{_SECOND_DROP}'", "false"), ("false", "true"), (f"DATE >= '{_SECOND_DROP}'", "false")):
            self.drop(costs, income)
            self.refresh(**more).run_once()

    def features(self) -> DataFrame:
        features = current_features(self.spark, self.out)
        return features.select(
            "YEAR", "MONTH", *[F.col(c).cast("decimal(28,2)").alias(c) for c in (*ORDER_CHANNELS.values(), "REVENUE")]
        )


def refresh_chain(spark: SparkSession, folder: str) -> DataFrame:
    """The features after three drops, the first without revenue, with a retrain after each."""
    feed = _Feed(spark, folder)
    feed.three_drops(retrain=retrain_with())
    return feed.features()


def refresh_retrain(spark: SparkSession, folder: str) -> DataFrame:
    """The report of the training run that followed the third refresh."""
    feed = _Feed(spark, folder)
    feed.three_drops(retrain=retrain_with())
    runs = model_runs(spark, feed.out)
    last = runs.agg(F.max("run_time").alias("run_time")).scalar()
    report = [f.name for f in TRAIN_REPORT]
    rounded = {c: F.round(c, 6) for c in ("train_r2", "test_r2")}
    return runs.filter(F.col("run_time") == last).select(*report).withColumns(rounded)


def refresh_new_channels(spark: SparkSession, folder: str) -> DataFrame:
    """A refresh of two channels, then four: the root is rebuilt for them."""
    feed = _Feed(spark, folder)
    feed.drop(f"DATE < '{_SECOND_DROP}'", "true")
    feed.refresh(dict(list(ORDER_CHANNELS.items())[:2])).run_once()
    feed.drop(f"DATE >= '{_SECOND_DROP}'", "false")
    feed.refresh().rebuild()
    return feed.features()


def refresh_suspend_resume(spark: SparkSession, folder: str) -> DataFrame:
    """A refresh by interval, suspended between two drops."""
    feed = _Feed(spark, folder)
    refresh = feed.refresh()
    for costs, income in ((f"DATE < '{_SECOND_DROP}'", "true"), (f"DATE >= '{_SECOND_DROP}'", "false")):
        feed.drop(costs, income)
        refresh.resume("1 second").processAllAvailable()
        refresh.suspend()
    return feed.features()


def refresh_corrected_files(spark: SparkSession, folder: str) -> DataFrame:
    """Three landings of spend and one of revenue; one is corrected and one removed before the last refresh."""
    root = new_folder(spark, "ledger")
    costs, income = spend(spark, folder), revenue(spark, folder)

    def land(kind: str, name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/{kind}/{name}")

    doubled = costs.withColumn("TOTAL_COST", (F.col("TOTAL_COST") * 2).cast("decimal(18,2)"))
    land("spend", "early", doubled.filter(F.col("DATE") < _SECOND_DROP))
    land("spend", "late", costs.filter(F.col("DATE") >= _SECOND_DROP))
    land("spend", "wrong", costs.withColumn("CHANNEL", F.lit("1-URGENT")))
    land("revenue", "all", income)
    readers = [spark.read.schema(rows.schema).parquet for rows in (costs, income)]
    refresh = LedgerRefresh(spark, f"{root}/spend/*", f"{root}/revenue/*", *readers, f"{root}/out", ORDER_CHANNELS)
    refresh.run_once()
    land("spend", "early", costs.filter(F.col("DATE") < _SECOND_DROP))
    refresh.run_once()
    remove_folder(spark, f"{root}/spend/wrong")
    refresh.run_once()
    kinds = {c: F.col(c).cast("decimal(28,2)") for c in (*ORDER_CHANNELS.values(), "REVENUE")}
    return current_features(spark, f"{root}/out").select("YEAR", "MONTH", *[v.alias(c) for c, v in kinds.items()])


def deployed_model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Trained by a refresh on months, then by the job on lines, deployed from the root both use: the later run counts."""
    feed = _Feed(spark, folder)
    feed.three_drops(retrain=retrain_with())
    path = new_folder(spark, "net-price")
    name = "net_price_" + path[-12:]
    overwrite_table(net_price_features(spark, folder), name, path)
    call(spark, "train_model", name, 10, 2, 0.85, 0.85, True, feed.out)
    call(spark, "deploy_functions", feed.out, "deployed_by_array", "deployed_by_batch")
    inputs = [F.col(f).cast("double") for f in FEATURES]
    return spark.table(name).select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.call_udf("deployed_by_array", F.array(*inputs)), 1).alias("BY_ARRAY"),
        F.round(F.call_udf("deployed_by_batch", *inputs), 1).alias("BY_BATCH"),
    )


def live_scores_after_retrain(spark: SparkSession, folder: str) -> DataFrame:
    """Every line scored by one stream in two drops; between them a model of three times the price becomes current."""
    root = new_folder(spark, "live")
    rows = net_price_features(spark, folder, "l_shipdate")
    early = F.col("l_shipdate") < _SECOND_DROP
    scorer = LiveScorer(spark, f"{root}/models")
    for drop, factor in ((early, 1), (~early, 3)):
        train_revenue_model(
            rows.drop("l_shipdate").withColumn("REVENUE", F.col("REVENUE") * factor), save_root=f"{root}/models", keys=list(_DEPLOYED_KEYS)
        )
        rows.filter(drop).write.mode("append").parquet(f"{root}/landing")
        arrived = spark.readStream.schema(rows.schema).parquet(f"{root}/landing")
        scorer.score_stream(
            arrived, lambda scored, number: scored.write.mode("overwrite").parquet(f"{root}/scored/batch-{number}"), f"{root}/checkpoint", None
        ).awaitTermination()
    scored = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("PREDICTED_ROI", T.DoubleType())]))
    return scored.parquet(f"{root}/scored/*").select("l_orderkey", "l_linenumber", F.round("PREDICTED_ROI", 1).alias("PREDICTED_ROI"))


def job_feature_table(spark: SparkSession, folder: str) -> DataFrame:
    """Spend with channel codes and revenue as tables, then the feature job by name."""
    codes = dict(zip(ORDER_CHANNELS, CHANNEL_COLUMNS))
    names = {}
    for kind, rows in (
        ("spend", recode(spend(spark, folder), codes, ["CHANNEL"])),
        ("revenue", revenue(spark, folder)),
    ):
        path = new_folder(spark, kind)
        names[kind] = f"{kind}_{path[-12:]}"
        overwrite_table(rows, names[kind], path)
    path = new_folder(spark, "features")
    name = f"features_{path[-12:]}"
    call(spark, "build_feature_table", names["spend"], names["revenue"], name, path)
    return spark.table(name)


_BOTH_SQL = (
    f"{SPEND_SQL} UNION ALL BY NAME SELECT CAST(value AS DECIMAL(18,2)) AS TOTAL_COST, "
    "event_type AS CHANNEL, CAST(ts AS DATE) AS DATE FROM events"
)

_ABOVE_SQL = (
    "WITH days AS (SELECT DATE, CHANNEL, CAST(sum(TOTAL_COST) AS DECIMAL(18,2)) AS TOTAL_COST "
    f"FROM ({SPEND_SQL}) GROUP BY 1, 2) SELECT DATE, CHANNEL, TOTAL_COST FROM (SELECT *, sum(TOTAL_COST) OVER c AS every, "
    "count(*) OVER c AS n FROM days WINDOW c AS (PARTITION BY CHANNEL)) WHERE TOTAL_COST * n > every"
)
_INSERTED_SQL = (
    f"{SPEND_SQL} UNION ALL SELECT * FROM (VALUES (DATE '2020-01-01', 'email', CAST(NULL AS DECIMAL(18,2))), "
    "(CAST(NULL AS DATE), 'video', NULL), (NULL, NULL, NULL))"
)
_DATED_SQL = NET_PRICE_SQL.replace("SELECT ", "SELECT l_shipdate, ", 1)
# The job splits by every column, as the table has no month.
_ALL_COLUMNS = (*_DEPLOYED_KEYS, *FEATURES, "REVENUE")

ENTRIES = {
    "csv_roundtrip": Entry(csv_roundtrip, SPEND_SQL),
    "bulk_load": Entry(bulk_load_table, SPEND_SQL),
    "replace_table": Entry(replace_table, SPEND_SQL),
    "load_table_once": Entry(load_table_twice, SPEND_SQL),
    "load_then_insert": Entry(load_then_insert, _BOTH_SQL),
    "load_after_crash": Entry(load_after_crash, SPEND_SQL),
    "overwrite_from_itself": Entry(overwrite_from_itself, _ABOVE_SQL),
    "insert_then_read": Entry(insert_then_read, _INSERTED_SQL),
    "bounded_sample": Entry(
        bounded_sample, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"
    ),
    "overwrite_from_query": Entry(overwrite_from_query, WIDE_SQL),
    "append_by_name": Entry(append_rows_by_name, _BOTH_SQL),
    "incremental_load": Entry(incremental_load, SPEND_SQL),
    "refresh_chain": Entry(refresh_chain, FEATURES_SQL),
    "refresh_new_channels": Entry(refresh_new_channels, FEATURES_SQL),
    "refresh_suspend_resume": Entry(refresh_suspend_resume, FEATURES_SQL),
    "refresh_corrected_files": Entry(refresh_corrected_files, FEATURES_SQL),
    "refresh_retrain": Entry(refresh_retrain, report_sql(FEATURES_SQL, MONTH_KEYS)),
    "deployed_model_predictions": Entry(
        deployed_model_predictions,
        f"WITH {residual_steps(split_sql(NET_PRICE_SQL, _ALL_COLUMNS), _DEPLOYED_KEYS, 2)} SELECT l_orderkey, "
        "l_linenumber, round(abs(y - r), 1) AS BY_ARRAY, round(abs(y - r), 1) AS BY_BATCH FROM final",
    ),
    "live_scores_after_retrain": Entry(
        live_scores_after_retrain,
        f"WITH {residual_steps(split_sql(_DATED_SQL, _DEPLOYED_KEYS), (*_DEPLOYED_KEYS, 'l_shipdate'), 2)} SELECT l_orderkey, "
        f"l_linenumber, round(abs(y - r) * CASE WHEN l_shipdate < '{_SECOND_DROP}' THEN 1 ELSE 3 END, 1) AS PREDICTED_ROI FROM final",
    ),
    "job_feature_table": Entry(job_feature_table, FEATURES_SQL),
}
