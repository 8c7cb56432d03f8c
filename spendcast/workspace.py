"""Where jobs keep files that several executors, or a later attempt, must see."""

from __future__ import annotations

import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="spendcast-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary
    folder. On a cluster such a folder would exist on one machine only.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A folder path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/spendcast-{purpose}-{uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job has made, with all that is in it; none is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession, path: str) -> None:
    """Remove what a job left below the shared folder, when its result has been read or copied.

    Only folders that ``new_folder`` named can be released.
    """
    if not path.startswith(f"{shared_folder(spark)}/spendcast-"):
        raise ValueError(f"{path} is no folder of a job")
    remove_folder(spark, path)
