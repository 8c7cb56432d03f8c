"""Replacing and loading tables, and the edges of the scorers."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendcast.functions.scalars import fixed_decimals
from spendcast.functions.scoring import Polynomial, register_array_function, register_batch_function, score
from spendcast.schemas import FEATURES, MONTHLY_REVENUE
from spendcast.sources.landing import bulk_load, load_table_once, read_csv, stream_csv
from spendcast.sources.tables import create_or_replace_table, insert_rows
from tests.helpers import rows

MODEL = Polynomial.plain(FEATURES, 1, [1.0, 2.0, 3.0, 4.0], 0.5)


def test_replace_with_a_path_empties_the_table(spark, tmp_path, table_name):
    for value in ("a", "b"):
        create_or_replace_table(spark, table_name, "name VARCHAR(5), n INT", str(tmp_path / "t"))
        assert spark.table(table_name).count() == 0
        insert_rows(spark, table_name, ["name", "n"], [(value, 1)])
        assert rows(spark.table(table_name)) == [(value, 1)]
    with pytest.raises(Exception):
        insert_rows(spark, table_name, ["name"], [("too long",)])


def test_wrong_declaration_leaves_the_old_table(spark, table_name):
    create_or_replace_table(spark, table_name, "n INT")
    insert_rows(spark, table_name, ["n"], [(1,)])
    with pytest.raises(Exception):
        create_or_replace_table(spark, table_name, "n NO_SUCH_TYPE")
    assert rows(spark.table(table_name)) == [(1,)]


def landing(spark, folder, data):
    spark.createDataFrame(data, MONTHLY_REVENUE).coalesce(1).write.mode("append").option("header", "true").csv(folder)


def test_bulk_load_goes_by_name(spark, tmp_path, table_name):
    landing(spark, str(tmp_path / "in"), [(2012, 5, 1.5)])
    create_or_replace_table(spark, table_name, "MONTH INT, YEAR INT, REVENUE DOUBLE")
    bulk_load(spark, str(tmp_path / "in"), MONTHLY_REVENUE, table_name)
    assert spark.table(table_name).first().asDict() == {"MONTH": 5, "YEAR": 2012, "REVENUE": 1.5}


def test_load_once_into_a_table(spark, tmp_path, table_name):
    folder = str(tmp_path / "in")
    create_or_replace_table(spark, table_name, "MONTH INT, REVENUE DOUBLE, YEAR INT", str(tmp_path / "t"))

    def load():
        load_table_once(stream_csv(spark, folder, MONTHLY_REVENUE), table_name, str(tmp_path / "checkpoint"))
        spark.catalog.refreshTable(table_name)
        return rows(spark.table(table_name).select("YEAR", "MONTH", "REVENUE"))

    landing(spark, folder, [(2012, 5, 1.5), (2012, 6, 2.5)])
    assert load() == load() == [(2012, 5, 1.5), (2012, 6, 2.5)]
    landing(spark, folder, [(2013, 1, 3.0)])
    assert load() == [(2012, 5, 1.5), (2012, 6, 2.5), (2013, 1, 3.0)]
    create_or_replace_table(spark, table_name + "_x", "YEAR INT, OTHER INT")
    with pytest.raises(ValueError, match="OTHER"):
        load_table_once(stream_csv(spark, folder, MONTHLY_REVENUE), table_name + "_x", str(tmp_path / "c2"))


def test_bad_value_fails_a_load(spark, tmp_path, table_name):
    (tmp_path / "x.csv").write_text("YEAR,MONTH,REVENUE\n2012,5,abc\n")
    create_or_replace_table(spark, table_name, "YEAR INT, MONTH INT, REVENUE DOUBLE")
    with pytest.raises(Exception):
        bulk_load(spark, str(tmp_path), MONTHLY_REVENUE, table_name)
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path), MONTHLY_REVENUE).collect()


@pytest.mark.parametrize("values", [[1.0, 1.0, 1.0], [1.0, 1.0, 1.0, 1.0, 99.0], []])
def test_array_of_another_length_is_an_error(spark, values):
    register_array_function(spark, MODEL, "predict_edges")
    df = spark.createDataFrame([(values,)], "v array<double>")
    with pytest.raises(Exception, match="takes 4 values"):
        df.select(F.call_udf("predict_edges", "v")).collect()


def test_null_and_nan_agree_in_all_ways(spark):
    register_array_function(spark, MODEL, "predict_edges")
    register_batch_function(spark, MODEL, "batch_edges")
    data = [(1.0, 2.0, 3.0, 4.0), (math.nan, 2.0, 3.0, 4.0), (None, 2.0, 3.0, 4.0), (None, math.nan, 3.0, 4.0)]
    df = spark.createDataFrame(data, ", ".join(f"{f} double" for f in FEATURES))
    scored = score(df, MODEL).select(
        "PREDICTED_ROI",
        F.call_udf("predict_edges", F.array(*FEATURES)).alias("by_array"),
        F.call_udf("batch_edges", *FEATURES).alias("by_batch"),
    )
    found = [tuple("nan" if v is not None and math.isnan(v) else v for v in r) for r in scored.collect()]
    assert found == [(30.5,) * 3, ("nan",) * 3, (None,) * 3, (None,) * 3]
    empty = spark.createDataFrame([(None,)], "v array<double>")
    assert empty.select(F.call_udf("predict_edges", "v")).first()[0] is None


def test_number_text_equals_python(spark):
    values = [1.25, 0.125, -3.0, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", T.DoubleType())]))
    found = [r[0] for r in df.select(fixed_decimals(F.col("v"), 2)).collect()]
    assert found == [None if v is None else format(v, ".2f") for v in values]


def test_dates_and_decimals_survive_a_load(spark, tmp_path, table_name):
    schema = T.StructType([T.StructField("D", T.DateType()), T.StructField("X", T.DecimalType(18, 2))])
    data = [(dt.date(2020, 1, 2), Decimal("3.40"))]
    spark.createDataFrame(data, schema).write.option("header", "true").csv(str(tmp_path / "in"))
    create_or_replace_table(spark, table_name, "X DECIMAL(18,2), D DATE")
    load_table_once(stream_csv(spark, str(tmp_path / "in"), schema), table_name, str(tmp_path / "c"))
    spark.catalog.refreshTable(table_name)
    assert spark.table(table_name).select("D", "X").collect() == [data[0]]
