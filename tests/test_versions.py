"""Tables that are replaced in one step, and tables that take loads and inserts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spendcast.schemas import MONTHLY_REVENUE
from spendcast.sources import landing as ld
from spendcast.sources import tables as tb
from tests.helpers import rows

COLUMNS = "YEAR INT, MONTH INT, REVENUE DOUBLE"


def arrive(spark, folder, data, name=None):
    frame = spark.createDataFrame(data, MONTHLY_REVENUE).coalesce(1)
    frame.write.mode("append").option("header", "true").csv(folder)


def load(spark, tmp_path, table, checkpoint="c", **more):
    source = ld.stream_csv(spark, str(tmp_path / "in"), MONTHLY_REVENUE)
    ld.load_table_once(source, table, str(tmp_path / checkpoint), **more)
    return rows(spark.table(table).select("YEAR", "MONTH", "REVENUE"))


def crash(number):
    raise RuntimeError("lost driver")


@pytest.fixture
def table(spark, tmp_path, table_name):
    tb.create_or_replace_table(spark, table_name, "REVENUE DOUBLE, MONTH INT, YEAR INT", str(tmp_path / "t"))
    return table_name


def test_loads_and_inserts_into_one_table(spark, tmp_path, table):
    tb.insert_rows(spark, table, ["YEAR", "MONTH"], [(2000, 1)])
    arrive(spark, str(tmp_path / "in"), [(2012, 5, 1.5), (2012, 6, 2.5)])
    load(spark, tmp_path, table)
    load(spark, tmp_path, table)
    tb.insert_rows(spark, table, ["YEAR", "MONTH"], [(2001, 1)])
    arrive(spark, str(tmp_path / "in"), [(2013, 1, 3.0)])
    found = load(spark, tmp_path, table)
    assert found == [(2000, 1, None), (2001, 1, None), (2012, 5, 1.5), (2012, 6, 2.5), (2013, 1, 3.0)]


def test_a_crash_before_the_commit_adds_nothing_twice(spark, tmp_path, table):
    arrive(spark, str(tmp_path / "in"), [(2012, 5, 1.5)])
    with pytest.raises(Exception, match="lost driver"):
        load(spark, tmp_path, table, before_commit=crash)
    assert load(spark, tmp_path, table) == [(2012, 5, 1.5)]
    arrive(spark, str(tmp_path / "in"), [(2012, 6, 2.5)])
    with pytest.raises(Exception, match="lost driver"):
        load(spark, tmp_path, table, before_commit=crash)
    # Another checkpoint sees every file again: what was committed is left out, what was not is replaced.
    assert load(spark, tmp_path, table, checkpoint="other") == [(2012, 5, 1.5), (2012, 6, 2.5)]
    assert load(spark, tmp_path, table) == [(2012, 5, 1.5), (2012, 6, 2.5)]


def test_a_failed_batch_leaves_the_table_as_it_was(spark, tmp_path, table_name):
    tb.create_or_replace_table(spark, table_name, "NAME VARCHAR(3), N INT", str(tmp_path / "t"))
    tb.insert_rows(spark, table_name, ["NAME", "N"], [("abc", 1)])
    schema = "NAME string, N int"
    spark.createDataFrame([("abcd", 2)], schema).write.option("header", "true").csv(str(tmp_path / "in"))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        ld.load_table_once(ld.stream_csv(spark, str(tmp_path / "in"), schema), table_name, str(tmp_path / "c"))
    assert rows(spark.table(table_name)) == [("abc", 1)]


def test_many_loads_leave_few_logs_and_a_replaced_table_loads_again(spark, tmp_path, table, monkeypatch):
    monkeypatch.setattr(ld, "_KEPT_LOGS", 3)
    for n in range(8):
        arrive(spark, str(tmp_path / "in"), [(2012, n, 1.0)])
        load(spark, tmp_path, table)
    location = tb.table_location(spark, table)
    assert ld.loaded_files(spark, location).distinct().count() == 8
    assert len([n for n in tb.names_in(spark, location + tb.LOADS) if n.startswith("log-")]) <= 4
    assert len(load(spark, tmp_path, table, checkpoint="again")) == 8
    tb.create_or_replace_table(spark, table, COLUMNS, str(tmp_path / "t"))
    assert len(load(spark, tmp_path, table, checkpoint="third")) == 8


def test_a_table_of_a_streaming_sink_takes_no_other_rows(spark, tmp_path, table_name):
    arrive(spark, str(tmp_path / "in"), [(2012, 5, 1.5)])
    tb.create_or_replace_table(spark, table_name, COLUMNS, str(tmp_path / "t"))
    source = ld.stream_csv(spark, str(tmp_path / "in"), MONTHLY_REVENUE)
    writer = source.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    writer.toTable(table_name).awaitTermination()
    for write in (
        lambda: tb.insert_rows(spark, table_name, ["YEAR"], [(1,)]),
        lambda: tb.append_by_name(spark.range(1).select(F.col("id").cast("int").alias("YEAR")), table_name),
        lambda: ld.bulk_load(spark, str(tmp_path / "in"), MONTHLY_REVENUE, table_name),
        lambda: tb.overwrite_table(spark.range(1), table_name),
        lambda: load(spark, tmp_path, table_name),
    ):
        with pytest.raises(ValueError, match="streaming sink"):
            write()


@pytest.mark.parametrize("path", [True, False])
def test_overwrite_from_itself(spark, tmp_path, table_name, path):
    path = str(tmp_path / "t") if path else None
    tb.overwrite_table(spark.range(10), table_name, path)
    for _ in range(3):
        tb.overwrite_table(spark.table(table_name).select((F.col("id") + 1).alias("id")), table_name, path)
    assert sorted(r["id"] for r in spark.table(table_name).collect()) == list(range(3, 13))
    base = tb.table_location(spark, table_name).rsplit("/", 1)[0]
    assert len(tb.names_in(spark, base)) == 1 + tb.GRACE


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path, table_name):
    tb.overwrite_table(spark.range(3), table_name, str(tmp_path / "t"))
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        tb.overwrite_table(broken, table_name, str(tmp_path / "t"))
    assert rows(spark.table(table_name)) == [(0,), (1,), (2,)]


def test_a_reader_that_began_before_ends_on_the_old_version(spark, tmp_path, table_name):
    tb.overwrite_table(spark.range(100), table_name, str(tmp_path / "t"))
    reader = spark.table(table_name).toLocalIterator()
    first = next(reader)
    frame = spark.read.parquet(tb.table_location(spark, table_name))
    tb.overwrite_table(spark.range(5), table_name, str(tmp_path / "t"))
    assert sorted([first["id"], *(r["id"] for r in reader)]) == list(range(100))
    assert frame.count() == 100
    assert spark.table(table_name).count() == 5


def test_other_columns_make_another_table(spark, tmp_path, table_name):
    tb.create_or_replace_table(spark, table_name, "name VARCHAR(5), n INT", str(tmp_path / "t"))
    tb.insert_rows(spark, table_name, ["name", "n"], [("a", 1)])
    tb.create_or_replace_table(spark, table_name, "name VARCHAR(5), n INT", str(tmp_path / "t"))
    assert spark.table(table_name).count() == 0
    with pytest.raises(Exception):
        tb.insert_rows(spark, table_name, ["name"], [("too long",)])
    tb.create_or_replace_table(spark, table_name, "other DATE", str(tmp_path / "t"))
    assert spark.table(table_name).columns == ["other"]
