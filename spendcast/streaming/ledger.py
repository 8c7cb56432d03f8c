"""Rebuild the features when files arrive, are replaced or go.

A stream of files sees each file once, as it was when it came. This refresh compares
the files that lie in the landing folders with a ledger of what it has counted: file,
size and time of change, and for each file its totals by year, month and channel. The
totals of a changed or missing file no longer count and those of a new or changed one
do; only such files are read, and only the months and channels that their totals touch
(the old ones or the new) are summed again, from the ledger. Nothing is subtracted, so
a sum is what a rebuild would give, a total of nulls stays null and a month whose last
row has gone has no row.

A version is complete before it is published, by one commit to the registry that
``current_features`` reads; a run that fails leaves the older version, and the next run
begins from it again. The names of changed files reach the driver, their rows do not.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendcast.registry import names_in
from spendcast.schemas import CHANNEL_COLUMNS
from spendcast.streaming.refresh import (
    TOTAL_KEYS,
    Refresh,
    RefreshMismatch,
    arriving_rows,
    features_from_totals,
    features_path,
    publish,
    published_rows,
    total_sums,
    totals_path,
)
from spendcast.workspace import remove_folder

_FILES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("ledger_file", T.StringType()),  # as rows tell it
        T.StructField("path", T.StringType()),  # as a reader takes it
        T.StructField("size", T.LongType()),
        T.StructField("changed", T.TimestampType()),
        # The part of the ledger that holds the file's totals.
        T.StructField("part", T.LongType()),
    ]
)
_IDENTITY = ["source", "ledger_file", "size", "changed"]
_KEPT_PARTS = 20
# A list of touched years up to this length is a condition that the ledger's files can be skipped by.
_FEW_YEARS = 500


@dataclass
class LedgerRefresh:
    """A refresh of one root folder from two landing folders; run it, or start it by interval.

    ``read_spend`` and ``read_revenue`` take paths and give rows, like
    ``spark.read.schema(s).parquet``. ``retrain`` and ``deploy`` are called as by
    ``Refresh``, and models, errors and features lie where that leaves them.
    """

    spark: SparkSession
    spend_path: str
    revenue_path: str
    read_spend: Callable[..., DataFrame]
    read_revenue: Callable[..., DataFrame]
    root: str
    channels: Mapping[str, str] = field(default_factory=lambda: dict(CHANNEL_COLUMNS))
    retrain: Callable[[DataFrame, str, int], object] | None = None
    deploy: Callable[[SparkSession, str], object] | None = None
    keep: int = 5
    pattern: str = "*"
    query: StreamingQuery | None = None

    def run_once(self) -> bool:
        """Count what has changed since the last run; False if nothing has."""
        spark, own = self.spark, self._trainer()
        own._retry_retrain()
        published = published_rows(spark, self.root)
        if published and published[0]["checkpoint_id"] != "ledger":
            raise RefreshMismatch(f"{self.root} was published by a stream; give the ledger a root of its own")
        if published and published[0]["channels"] != own._channel_text():
            raise RefreshMismatch(f"{self.root} holds totals of {published[0]['channels']}; give other channels another root")
        before = published[0]["version"] if published else None
        version = 0 if before is None else before + 1
        part = 2 * version  # the odd number after it is for a merged part
        known, now = self._files(before), self._listed()
        changes = f"{self.root}/ledger_changes/version={version}"
        arrived = now.join(known, _IDENTITY, "left_anti").withColumns({"part": F.lit(part).cast("long"), "arrived": F.lit(True)})
        left = known.join(now, _IDENTITY, "left_anti").withColumn("arrived", F.lit(False))
        arrived.unionByName(left).write.mode("overwrite").parquet(changes)
        found = spark.read.schema(T.StructType([*_FILES.fields, T.StructField("arrived", T.BooleanType())])).parquet(changes)
        if before is not None and found.isEmpty():
            remove_folder(spark, changes)
            return False
        arrived, left = found.filter("arrived").drop("arrived"), found.filter("not arrived").drop("arrived")
        self._count(arrived, part, whole=before is None)
        live = known.join(left, _IDENTITY, "left_anti").unionByName(arrived)
        merged = self._merge(live, part + 1) if len(self._parts()) > _KEPT_PARTS else None
        if merged is not None:
            live = live.withColumn("part", F.lit(merged).cast("long"))
        live.write.mode("overwrite").parquet(self._files_path(version))
        self._write_totals(left, before, version, part)
        remove_folder(spark, changes)
        totals = spark.read.parquet(totals_path(self.root, version))
        features_from_totals(totals, self.channels).write.mode("overwrite").parquet(features_path(self.root, version))
        row = {"version": version, "lineage": 0, "batch": version, "checkpoint_id": "ledger", "channels": own._channel_text()}
        for old in publish(spark, self.root, row, self.keep):
            remove_folder(spark, self._files_path(old["version"]))
        if merged is not None:  # older versions have their totals; nothing reads their parts again
            for old_part in self._parts():
                if old_part != merged:
                    remove_folder(spark, self._part_path(old_part))
        own._train(spark.read.parquet(features_path(self.root, version)), version)
        return True

    def start(self, interval: str = "1 minute") -> StreamingQuery:
        """Run by interval until ``suspend``; a tick that finds nothing changed does nothing."""
        ticks = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        writer = ticks.writeStream.foreachBatch(lambda rows, batch: self.run_once() and None)
        writer = writer.option("checkpointLocation", f"{self.root}/ticks").trigger(processingTime=interval)
        self.query = writer.start()
        return self.query

    def suspend(self) -> None:
        """Stop; the ledger keeps the position."""
        if self.query is not None:
            self.query.stop()

    def _trainer(self) -> Refresh:
        return Refresh(self.spark, None, None, self.root, self.channels, self.retrain, self.deploy, self.keep)

    def _files_path(self, version: int) -> str:
        return f"{self.root}/ledger_files/version={version}"

    def _part_path(self, part: int) -> str:
        return f"{self.root}/ledger/part={part}"

    def _files(self, version: int | None) -> DataFrame:
        if version is None:
            return self.spark.createDataFrame([], _FILES)
        return self.spark.read.schema(_FILES).parquet(self._files_path(version))

    def _listed(self) -> DataFrame:
        """The files that lie in the folders; none of them is opened."""
        listed = []
        for source, path in (("spend", self.spend_path), ("revenue", self.revenue_path)):
            files = self.spark.read.format("binaryFile").option("pathGlobFilter", self.pattern).load(path)
            listed.append(
                files.select(
                    F.lit(source).alias("source"),
                    F.col("_metadata.file_path").alias("ledger_file"),
                    "path",
                    F.col("_metadata.file_size").alias("size"),
                    F.col("_metadata.file_modification_time").alias("changed"),
                )
            )
        return listed[0].unionByName(listed[1])

    def _count(self, arrived: DataFrame, part: int, whole: bool) -> None:
        """The totals of each new file, as a part of the ledger."""
        kinds = []
        for source, path, read in (
            ("spend", self.spend_path, self.read_spend),
            ("revenue", self.revenue_path, self.read_revenue),
        ):
            # At first every file is new, and the folder itself names them.
            names = [path] if whole else [r["path"] for r in arrived.filter(F.col("source") == source).select("path").collect()]
            rows = read(*(names or [path])).select("*", F.col("_metadata.file_path").alias("ledger_file"))
            # A file that came after the listing is left to the next run.
            rows = rows.join(arrived.select("ledger_file"), "ledger_file", "left_semi") if names else rows.limit(0)
            kinds.append(rows)
        rows = arriving_rows(*kinds, self.channels, more=("ledger_file",))
        total_sums(rows, ("ledger_file",)).write.mode("overwrite").parquet(self._part_path(part))

    def _parts(self) -> list[int]:
        return sorted(int(n.removeprefix("part=")) for n in names_in(self.spark, f"{self.root}/ledger") if n.startswith("part="))

    def _entries(self, files: DataFrame, touched: Column | None = None) -> DataFrame:
        """The ledger's totals of these files."""
        entries = self.spark.read.parquet(f"{self.root}/ledger")
        if touched is not None:
            entries = entries.filter(touched)
        return entries.join(files.select("part", "ledger_file").distinct(), ["part", "ledger_file"], "left_semi")

    def _merge(self, live: DataFrame, part: int) -> int:
        """Many parts as one, with the totals of live files only; the older parts stay in use until it is published."""
        self._entries(live).drop("part").write.mode("overwrite").parquet(self._part_path(part))
        return part

    def _write_totals(self, left: DataFrame, before: int | None, version: int, part: int) -> None:
        """The totals before, with those that a change touches summed again."""
        spark, live = self.spark, self._files(version)
        if before is None:
            totals = total_sums(self._entries(live))
        else:
            new = spark.read.parquet(self._part_path(part))
            touched = f"{self.root}/ledger_touched/version={version}"
            keys = self._entries(left).select(*TOTAL_KEYS).union(new.select(*TOTAL_KEYS)).distinct()
            keys.write.mode("overwrite").parquet(touched)
            keys = spark.read.schema(keys.schema).parquet(touched)
            again = self._entries(live, _years_of(keys))
            again = total_sums(again.join(keys, _same(again, keys), "left_semi"))
            kept = spark.read.parquet(totals_path(self.root, before))
            totals = kept.join(keys, _same(kept, keys), "left_anti").unionByName(again)
        totals.write.mode("overwrite").parquet(totals_path(self.root, version))
        if before is not None:
            remove_folder(spark, touched)


def _same(rows: DataFrame, keys: DataFrame) -> Column:
    """Equal keys; a null is a key like any other."""
    return reduce(lambda a, b: a & b, (rows[k].eqNullSafe(keys[k]) for k in TOTAL_KEYS))


def _years_of(keys: DataFrame) -> Column | None:
    """A condition for the years of the keys that a scan can use, if they are few."""
    years = [r["YEAR"] for r in keys.select("YEAR").distinct().limit(_FEW_YEARS + 1).collect()]
    if len(years) > _FEW_YEARS:
        return None
    known = F.col("YEAR").isin([y for y in years if y is not None])
    return known | F.col("YEAR").isNull() if None in years else known
