from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spendcast.schemas import (
    BUDGET_ALLOCATIONS_AND_ROI,
    BUDGET_ALLOCATIONS_AND_ROI_DDL,
    CAMPAIGN_SPEND,
    CAMPAIGN_SPEND_DDL,
    MONTHLY_REVENUE,
    MONTHLY_REVENUE_DDL,
)
from spendcast.sources.landing import bulk_load, load_new_files, narrow_counts, read_csv, stream_csv
from spendcast.sources.tables import (
    append_by_name,
    bounded_pandas,
    bounded_rows,
    create_or_replace_table,
    insert_rows,
    literal_frame,
    overwrite_table,
    run_sql,
)
from tests.helpers import rows

# A failed task may reach Python as either.
TASK_FAILURE = (PySparkException, Py4JJavaError)


def write_csv(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


@pytest.mark.parametrize(
    "ddl, schema",
    [
        (CAMPAIGN_SPEND_DDL, CAMPAIGN_SPEND),
        (MONTHLY_REVENUE_DDL, MONTHLY_REVENUE),
        (BUDGET_ALLOCATIONS_AND_ROI_DDL, BUDGET_ALLOCATIONS_AND_ROI),
    ],
)
def test_declared_tables_have_the_schema(spark, table_name, ddl, schema):
    create_or_replace_table(spark, table_name, ddl)
    found = spark.table(table_name).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]


def test_replace_empties_the_table(spark, table_name):
    create_or_replace_table(spark, table_name, MONTHLY_REVENUE_DDL)
    insert_rows(spark, table_name, ["YEAR", "MONTH", "REVENUE"], [(2020, 1, 1.5)])
    assert spark.table(table_name).count() == 1
    create_or_replace_table(spark, table_name, MONTHLY_REVENUE_DDL)
    assert spark.table(table_name).count() == 0


def test_insert_rows_into_named_columns(spark, table_name):
    create_or_replace_table(spark, table_name, BUDGET_ALLOCATIONS_AND_ROI_DDL)
    insert_rows(spark, table_name, ["ROI", "MONTH", "EMAIL"], [(7.5, "March", 15)])
    spark.sql(f"INSERT INTO {table_name} (MONTH, ROI) VALUES ('April', 1.0)")
    assert rows(spark.table(table_name)) == [
        ("April", None, None, None, None, 1.0), ("March", None, None, None, 15, 7.5),
    ]
    with pytest.raises(ValueError):
        insert_rows(spark, table_name, ["NOPE"], [(1,)])


def test_too_long_text_is_refused(spark, table_name):
    create_or_replace_table(spark, table_name, BUDGET_ALLOCATIONS_AND_ROI_DDL)
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH|exceeds"):
        insert_rows(spark, table_name, ["MONTH"], [("x" * 31,)])


def test_append_matches_names_in_any_order_and_case(spark, table_name):
    create_or_replace_table(spark, table_name, MONTHLY_REVENUE_DDL)
    append_by_name(spark.createDataFrame([(9.0, 2021, 2)], "revenue double, Year int, MONTH int"), table_name)
    assert rows(spark.table(table_name)) == [(2021, 2, 9.0)]
    with pytest.raises(ValueError):
        append_by_name(spark.createDataFrame([(1,)], "other int"), table_name)


def test_overwrite_replaces_rows_and_schema(spark, table_name):
    overwrite_table(spark.range(3), table_name)
    overwrite_table(spark.range(2).withColumn("x", F.lit("a")), table_name)
    assert rows(spark.table(table_name.upper())) == [(0, "a"), (1, "a")]
    overwrite_table(spark.table(table_name).filter("id = 1"), table_name)
    assert rows(spark.table(table_name)) == [(1, "a")]


def test_literals_and_bound_parameters(spark):
    frame = literal_frame(spark, [1, 2, 3], ["col1"])
    assert rows(frame) == [(1,), (2,), (3,)]
    assert rows(literal_frame(spark, [(1, "a")], ["n", "t"])) == [(1, "a")]
    got = run_sql(spark, "SELECT col1 FROM {f} WHERE col1 >= :least", {"least": 2}, f=frame)
    assert rows(got) == [(2,), (3,)]
    text = "x' OR '1'='1"
    assert run_sql(spark, "SELECT :t AS t", {"t": text}).first()["t"] == text


def test_bounded_results(spark):
    assert len(bounded_rows(spark.range(100), 10)) == 10
    assert len(bounded_pandas(spark.range(10), 10)) == 10
    with pytest.raises(ValueError):
        bounded_pandas(spark.range(11), 10)


GOOD = "YEAR,MONTH,REVENUE\n2012,5,3264300.11\n"


def test_csv_is_typed_and_strict(spark, tmp_path):
    write_csv(tmp_path / "a", "1.csv", GOOD)
    assert rows(read_csv(spark, str(tmp_path / "a"), MONTHLY_REVENUE)) == [(2012, 5, 3264300.11)]
    write_csv(tmp_path / "b", "1.csv", "YEAR,MONTH,REVENUE\n2012,5,lots\n")
    with pytest.raises(TASK_FAILURE):
        read_csv(spark, str(tmp_path / "b"), MONTHLY_REVENUE).collect()
    write_csv(tmp_path / "c", "1.csv", "YEAR,MON,REVENUE\n2012,5,1.0\n")
    with pytest.raises(TASK_FAILURE):
        read_csv(spark, str(tmp_path / "c"), MONTHLY_REVENUE).collect()


def test_bulk_load_appends(spark, tmp_path, table_name):
    write_csv(tmp_path / "in", "1.csv", GOOD)
    write_csv(tmp_path / "in", "2.csv", "YEAR,MONTH,REVENUE\n2012,6,1.0\n")
    create_or_replace_table(spark, table_name, MONTHLY_REVENUE_DDL)
    bulk_load(spark, str(tmp_path / "in"), MONTHLY_REVENUE, table_name)
    assert rows(spark.table(table_name)) == [(2012, 5, 3264300.11), (2012, 6, 1.0)]


def test_new_files_are_loaded_once(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))

    def load():
        load_new_files(stream_csv(spark, landing, MONTHLY_REVENUE, max_files=1), table, checkpoint).awaitTermination()
        return spark.read.schema(MONTHLY_REVENUE).parquet(table).count()

    write_csv(tmp_path / "in", "1.csv", GOOD)
    assert load() == 1
    assert load() == 1
    write_csv(tmp_path / "in", "2.csv", "YEAR,MONTH,REVENUE\n2012,6,1.0\n2012,7,2.0\n")
    assert load() == 3


def test_narrowing_fails_loudly(spark):
    day = dt.date(2020, 1, 1)
    small = spark.createDataFrame([("c", "video", day, Decimal(1), Decimal(2), Decimal(3))], CAMPAIGN_SPEND)
    assert narrow_counts(small).schema["TOTAL_COST"].dataType.precision == 18
    assert rows(narrow_counts(small)) == rows(small)
    large = spark.createDataFrame([("c", "video", day, Decimal(1), Decimal(10) ** 20, Decimal(3))], CAMPAIGN_SPEND)
    with pytest.raises(TASK_FAILURE):
        narrow_counts(large).collect()
