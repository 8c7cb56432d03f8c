"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.workspace import new_folder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The whole text; a null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(text: str = "text") -> Column:
    """Tells texts apart when an id is repeated: rows that agree in id and key are copies of one row."""
    return F.md5(whole_text(text))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read again.

    This cuts the lineage: what follows survives a lost executor without
    repeating what came before, and gets the same rows on each reading. The
    driver's heap is collected after it, plans and shuffles it has done with.
    """
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of stages whose results have been stored.

    The context cleaner acts when driver objects have been collected, which on a
    large heap may be long after the next shuffle has filled the disks: first
    the frames that Python still holds in cycles, then what they held in the JVM.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)  # the cleaner works in the background


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sql_strings(values) -> str:
    """A list of SQL string literals."""
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
