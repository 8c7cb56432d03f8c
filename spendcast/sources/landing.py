"""CSV landing folders: read, load in bulk, load new files only."""

from __future__ import annotations

import re
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendcast.registry import move_if_absent, names_in
from spendcast.sources.tables import LOADS, append_by_name, declared_columns, refuse_stream_log, table_location
from spendcast.workspace import remove_folder

# A wrong header name, a missing column or a value of the wrong type fails the load. Values are
# checked in the columns a query reads: every column in a load, fewer where a query selects fewer.
_CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file or folder of CSV files with one header line each."""
    return spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)


def stream_csv(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """New CSV files of a folder as a stream, at most ``max_files`` per batch."""
    reader = spark.readStream.schema(schema).options(**_CSV_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def narrow_counts(df: DataFrame, precision: int = 18) -> DataFrame:
    """Cast whole-number decimals to a precision that fits a long; too large a value fails."""
    narrow = T.DecimalType(precision, 0)
    wide = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0 and f.dataType.precision > precision
    ]
    return df.withColumns({name: F.col(name).cast(narrow) for name in wide}) if wide else df


def bulk_load(spark: SparkSession, path: str, schema: T.StructType, table: str) -> None:
    """Append every row of a landing folder to an existing table, columns matched by name.

    A second call appends the rows again; ``load_table_once`` does not.
    """
    append_by_name(read_csv(spark, path, schema), table)


# What was loaded into a version of a table; a file that was changed since is another file.
_LOADED = T.StructType(
    [
        T.StructField("load_file", T.StringType()),
        T.StructField("load_size", T.LongType()),
        T.StructField("load_time", T.TimestampType()),
        T.StructField("load_batch", T.StringType()),
    ]
)
_FILE = _LOADED.names[:3]
_KEPT_LOGS = 20


def load_table_once(
    source: DataFrame, table: str, checkpoint: str, before_commit: Callable[[int], object] | None = None
) -> None:
    """Append the files of a stream that were not loaded before to a catalog table, columns matched by name.

    The table also takes rows in other ways. Which files it holds is written in a log
    beside it: a batch writes its rows apart, moves the finished files into the table
    under names that tell the batch, and then commits its files to the log. After a
    failure in between, the next load removes what the batch had moved and loads it
    again, so each file counts once, also with another checkpoint. A changed file is
    loaded again; replacing or overwriting the table begins a new log. One load runs at
    a time. ``before_commit`` is called with the number of each batch whose files have
    been moved.
    """
    spark = source.sparkSession
    refuse_stream_log(spark, table)
    target = spark.table(table).schema
    given = {c.upper(): c for c in source.columns}
    missing = [f.name for f in target.fields if f.name.upper() not in given]
    unknown = set(given) - {f.name.upper() for f in target.fields}
    if missing or unknown:
        raise ValueError(f"table {table}: no source for {missing}, no column for {sorted(unknown)}")
    declared = dict(declared_columns(spark, table))
    aligned = [_fitting(F.col(given[f.name.upper()]).cast(f.dataType), declared[f.name.upper()], f.name) for f in target.fields]
    file = [F.col(f"_metadata.{c}").alias(n) for c, n in zip(("file_path", "file_size", "file_modification_time"), _FILE)]
    location = table_location(spark, table)
    _remove_uncommitted(spark, location)
    name = re.sub("[^0-9A-Za-z]", "", checkpoint)[-40:]

    def load(rows: DataFrame, number: int) -> None:
        _load_batch(rows, location, f"{name}-{number}", lambda: before_commit and before_commit(number))

    writer = source.select(*aligned, *file).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    spark.catalog.refreshTable(table)


def _fitting(value: Column, declared: str, name: str) -> Column:
    """Fail for a text that is longer than declared, as an insert does."""
    length = re.fullmatch(r"(?:var)?char\((\d+)\)", declared)
    if length:
        error = F.raise_error(F.lit(f"EXCEED_LIMIT_LENGTH: {name} takes {length[1]} characters")).cast("string")
        value = F.when(F.length(value) > int(length[1]), error).otherwise(value)
    return value.alias(name)


def loaded_files(spark: SparkSession, location: str) -> DataFrame:
    """The log of a table's location: file, size, time of change and batch."""
    if not [n for n in names_in(spark, location + LOADS) if n.startswith("log-")]:
        return spark.createDataFrame([], _LOADED)
    return spark.read.schema(_LOADED).parquet(f"{location}{LOADS}/log-*")


def _remove_uncommitted(spark: SparkSession, location: str) -> None:
    """Remove files that a batch moved and did not commit."""
    moved = {n.split("--")[0].removeprefix("load-") for n in names_in(spark, location) if n.startswith("load-")}
    if moved:
        log = loaded_files(spark, location)
        committed = {r["load_batch"] for r in log.filter(F.col("load_batch").isin(sorted(moved))).select("load_batch").distinct().collect()}
        for batch in moved - committed:
            _remove_moved(spark, location, batch)


def _remove_moved(spark: SparkSession, location: str, batch: str) -> None:
    for name in names_in(spark, location):
        if name.startswith(f"load-{batch}--"):
            remove_folder(spark, f"{location}/{name}")


def _load_batch(rows: DataFrame, location: str, batch: str, before_commit: Callable[[], object]) -> None:
    spark = rows.sparkSession
    log = loaded_files(spark, location)
    if not log.filter(F.col("load_batch") == batch).isEmpty():
        return  # committed before the stream could note it
    fresh = rows.join(log.select(*_FILE), _FILE, "left_anti")
    staging = f"{location}/_staging-{batch}"
    fresh.write.mode("overwrite").parquet(staging)
    written = spark.read.schema(fresh.schema).parquet(f"{location}/_staging-{batch}/*.parquet")
    files = written.select(*_FILE).distinct().withColumn("load_batch", F.lit(batch))
    entry = f"{location}{LOADS}/new-{batch}"
    files.write.mode("overwrite").parquet(entry)
    # The rows' own columns alone go into the table: files keep the others, which its readers leave out.
    _remove_moved(spark, location, batch)
    for name in names_in(spark, staging):
        if name.endswith(".parquet"):
            move_if_absent(spark, f"{staging}/{name}", f"{location}/load-{batch}--{name}")
    before_commit()
    move_if_absent(spark, entry, f"{location}{LOADS}/log-{batch}")
    remove_folder(spark, staging)
    _compact(spark, location)


def _compact(spark: SparkSession, location: str) -> None:
    """Many small logs become one; a failure leaves entries twice, which changes nothing."""
    logs = sorted(n for n in names_in(spark, location + LOADS) if n.startswith("log-"))
    if len(logs) > _KEPT_LOGS:
        merged = f"{location}{LOADS}/new-merged"
        spark.read.schema(_LOADED).parquet(*(f"{location}{LOADS}/{n}" for n in logs)).distinct().write.mode("overwrite").parquet(merged)
        if move_if_absent(spark, merged, f"{location}{LOADS}/log-merged-{uuid4().hex}"):
            for name in logs:
                remove_folder(spark, f"{location}{LOADS}/{name}")


def load_new_files(
    source: DataFrame, table_path: str, checkpoint: str, once: bool = True, interval: str = "1 minute"
) -> StreamingQuery:
    """Append files not loaded before to a Parquet folder.

    The checkpoint records which files were loaded, so a file is loaded once even
    when a run is repeated or an executor is lost half way. With ``once`` the query
    ends after the files present at the start, else it looks again every interval.
    """
    writer = source.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start(table_path)
