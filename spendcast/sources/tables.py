"""Catalog tables, literal rows and bounded results.

Replacing or overwriting a table writes a new version beside the old one and then
moves the table's location, which is one step in the catalog where the columns stay
the same. A write that fails leaves the old rows, a query may overwrite a table it
reads, and a reader that began before ends on the version it began with: the versions
before the current one stay for ``GRACE`` replacements. Read such a table by its name.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from typing import Any
from uuid import uuid4

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendcast.registry import names_in
from spendcast.workspace import remove_folder

# Versions kept behind the current one.
GRACE = 1
_VERSION = "version-"
LOADS = ".loads"  # beside a version: which files were loaded into it


def run_sql(
    spark: SparkSession,
    text: str,
    args: Mapping[str, Any] | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """Run SQL text. Values are bound as ``:name``, frames are named as ``{name}``."""
    return spark.sql(text, args=dict(args or {}), **frames)


def literal_frame(spark: SparkSession, rows: Sequence[Any], schema: Sequence[str] | T.StructType) -> DataFrame:
    """Rows given in the program as a frame; a bare value is a row of one column."""
    rows = [r if isinstance(r, (tuple, list, dict, Row)) else (r,) for r in rows]
    return spark.createDataFrame(rows, schema if isinstance(schema, T.StructType) else list(schema))


def table_location(spark: SparkSession, name: str) -> str:
    """The folder that holds a table's files now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").select("data_type").collect()
    return rows[-1]["data_type"].rstrip("/")


def declared_columns(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """Names and declared types of a table's columns, declared lengths included."""
    described = {r["col_name"]: r["data_type"] for r in reversed(spark.sql(f"DESCRIBE TABLE {name}").collect())}
    return [(c.name.upper(), described[c.name]) for c in spark.catalog.listColumns(name)]


def refuse_stream_log(spark: SparkSession, name: str) -> None:
    """Raise for a table that a streaming sink owns: its readers go by the sink's log, so other rows would never be seen."""
    if "_spark_metadata" in names_in(spark, table_location(spark, name)):
        raise ValueError(f"table {name} is owned by a streaming sink; rows written beside it would not be seen")


def _new_version(spark: SparkSession, name: str, path: str | None) -> str:
    base = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name.lower()}-versions").rstrip("/")
    return f"{base}/{_VERSION}{time.time_ns():020d}"


def _publish(spark: SparkSession, name: str, columns: str, version: str) -> None:
    """Make a complete version the table's content, and remove versions beyond the grace count."""
    passing = f"{name}_new_{uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {passing} ({columns}) USING parquet LOCATION '{version}'")
    if spark.catalog.tableExists(name) and declared_columns(spark, name) == declared_columns(spark, passing):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.sql(f"DROP TABLE {passing}")  # external: the files stay
    else:
        # Other columns are another table: this takes two steps, and between them there is none of that name.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {passing} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    base, own = version.rsplit("/", 1)
    older = sorted(n for n in names_in(spark, base) if n.startswith(_VERSION) and not n.endswith(LOADS) and n < own)
    for old in older[: len(older) - GRACE]:
        remove_folder(spark, f"{base}/{old}")
        remove_folder(spark, f"{base}/{old}{LOADS}")


def create_or_replace_table(spark: SparkSession, name: str, columns: str, path: str | None = None) -> None:
    """An empty Parquet table with declared columns; an older table of that name goes, with its rows.

    Versions lie below ``path``, or below the warehouse. A wrong declaration leaves
    the old table as it was.
    """
    version = _new_version(spark, name, path)
    probe = f"{name}_new_{uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {probe} ({columns}) USING parquet LOCATION '{version}'")
    try:
        # The table's type holds declared lengths that a frame cannot; its files need none.
        spark.createDataFrame([], spark.table(probe).schema).write.mode("overwrite").parquet(version)
    finally:
        spark.sql(f"DROP TABLE {probe}")
    _publish(spark, name, columns, version)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace the rows and the schema of a table by a query result; the query may read the table."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        refuse_stream_log(spark, name)
    version = _new_version(spark, name, path)
    df.write.parquet(version)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    _publish(spark, name, columns, version)


def append_by_name(df: DataFrame, name: str) -> None:
    """Append rows, matching columns by name in any order and any case.

    A table column the frame lacks is NULL in the new rows; a frame column the
    table lacks is an error.
    """
    refuse_stream_log(df.sparkSession, name)
    target = df.sparkSession.table(name).schema
    known = {f.name.upper() for f in target.fields}
    unknown = [c for c in df.columns if c.upper() not in known]
    if unknown:
        raise ValueError(f"table {name} has no column {', '.join(unknown)}")
    given = {c.upper() for c in df.columns}
    aligned = [
        F.col(f.name) if f.name.upper() in given else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]
    df.select(*aligned).write.insertInto(name)


def insert_rows(spark: SparkSession, name: str, columns: Sequence[str], rows: Sequence[Sequence[Any]]) -> None:
    """Insert literal rows into named columns."""
    types = {f.name.upper(): f.dataType for f in spark.table(name).schema.fields}
    missing = [c for c in columns if c.upper() not in types]
    if missing:
        raise ValueError(f"table {name} has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, types[c.upper()]) for c in columns])
    append_by_name(spark.createDataFrame([tuple(r) for r in rows], schema), name)


def bounded_rows(df: DataFrame, limit: int) -> list[Row]:
    """The first rows of a frame; never more than ``limit`` reach the driver."""
    return df.limit(limit).collect()


def bounded_pandas(df: DataFrame, limit: int) -> pd.DataFrame:
    """A small result as a local frame; an error, not a cut, when it is larger."""
    local = df.limit(limit + 1).toPandas()
    if len(local) > limit:
        raise ValueError(f"result has more than {limit} rows; aggregate or filter it first")
    return local
