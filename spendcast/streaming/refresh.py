"""Rebuild the features when data arrives, then retrain.

Sums add up, so a batch only needs the totals so far and the new rows: the cost of
a refresh follows the new data, and late rows change their month like any others.

A root holds lineages. A lineage is one checkpoint and the versions published from
it, so a batch number has one meaning in it; its channel list is part of its state.
A start that does not fit the lineage (its checkpoint is gone or new, the channels
differ) is refused, and ``rebuild`` begins a new lineage from the sources, which
becomes current when it is complete. Each batch writes its version and publishes it
with one registry snapshot; a batch repeated after a failure finds itself published,
or writes the same version again. Features are committed on their own: a retrain
that fails is recorded and tried again, and the feed goes on.

A root has one writer of features at a time. Registries are snapshot logs of plain
rows, read without a Spark job and once per batch; the last few versions are kept.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendcast.plans.features import month_of
from spendcast.plans.training import TooFewRows, is_trained, record_failed_run, train_revenue_model
from spendcast.registry import SnapshotLog
from spendcast.schemas import CHANNEL_COLUMNS, LABEL, MONTH_KEYS
from spendcast.workspace import remove_folder

_ERRORS = T.StructType([T.StructField("version", T.LongType()), T.StructField("error", T.StringType())])
_KEPT_ERRORS = 100
TOTAL_KEYS = (*MONTH_KEYS, "CHANNEL")
# Versions of two lineages never meet: the lineage stands above the batch number.
_LINEAGE_SHIFT = 40


class RefreshMismatch(RuntimeError):
    """Root, checkpoint and channel list do not belong together; a rebuild brings them together."""


def arriving_rows(
    spend: DataFrame, revenue: DataFrame, channels: Mapping[str, str] = CHANNEL_COLUMNS, more: Sequence[str] = ()
) -> DataFrame:
    """Both sources as one: a spend row has a cost, a revenue row has a revenue; ``more`` columns come along.

    Only listed channels are kept, which bounds the totals by months times channels.
    """
    costs = spend.filter(F.col("CHANNEL").isin(*channels)).select(*month_of("DATE"), "CHANNEL", "TOTAL_COST", *more)
    revenues = revenue.select(*MONTH_KEYS, LABEL, *more)
    return costs.unionByName(revenues, allowMissingColumns=True)


def total_sums(rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Totals per year, month and channel (and ``more`` columns), in types that can be added up for ever."""
    types = {c: rows.schema[c].dataType for c in ("TOTAL_COST", LABEL)}
    sums = [F.sum(c).cast(_total_type(t)).alias(c) for c, t in types.items()]
    return rows.groupBy(*TOTAL_KEYS, *more).agg(*sums)


def add_totals(before: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Totals per year, month and channel after more rows."""
    # New rows are reduced first; only totals meet totals.
    new = total_sums(rows)
    return new if before is None else total_sums(before.unionByName(new))


def _total_type(value: T.DataType) -> T.DataType:
    return T.DecimalType(38, value.scale) if isinstance(value, T.DecimalType) else value


def features_from_totals(totals: DataFrame, channels: Mapping[str, str] = CHANNEL_COLUMNS) -> DataFrame:
    """The feature table from totals that hold both spend and revenue.

    A month lacks a channel or the revenue exactly when its sum is NULL, so dropping
    incomplete rows also does the work of the inner join.
    """
    costs = [F.sum(F.when(F.col("CHANNEL") == F.lit(c), F.col("TOTAL_COST"))).alias(a) for c, a in channels.items()]
    return totals.groupBy(*MONTH_KEYS).agg(*costs, F.sum(LABEL).alias(LABEL)).dropna(how="any")


@dataclass
class Refresh:
    """A refresh of one root folder; start, suspend, resume and rebuild it.

    ``retrain`` is called after each published version, ``deploy`` after a retrain
    that went through, with the session of the refresh and the root, so that scorers
    registered there follow the current model.
    """

    spark: SparkSession
    spend: DataFrame
    revenue: DataFrame
    root: str
    channels: Mapping[str, str] = field(default_factory=lambda: dict(CHANNEL_COLUMNS))
    retrain: Callable[[DataFrame, str, int], object] | None = None
    deploy: Callable[[SparkSession, str], object] | None = None
    keep: int = 5
    query: StreamingQuery | None = None

    def start(self, interval: str | None = "1 minute") -> StreamingQuery:
        """Start, or go on after a suspend. Without an interval: handle what is there and end."""
        lineage = current_lineage(self.spark, self.root)
        self._check(lineage)
        self._retry_retrain()
        self.query = self._stream(lineage, interval)
        return self.query

    def run_once(self) -> None:
        """Handle what has arrived since the last run."""
        self.start(interval=None).awaitTermination()

    def suspend(self) -> None:
        """Stop; the checkpoint keeps the position for the next start."""
        if self.query is not None:
            self.query.stop()

    def resume(self, interval: str | None = "1 minute") -> StreamingQuery:
        """Go on where the last batch ended."""
        return self.start(interval)

    def rebuild(self) -> None:
        """Read the sources again from their beginning, as they are now.

        Corrected or deleted rows count, as do other channels than before. The
        features stay those of the old lineage until the new one is complete.
        """
        lineages = _lineages(self.spark, self.root)
        # The number is taken before the work, so a rebuild that fails half way is not gone on with.
        begun = lineages.commit(lambda rows: [*rows, {"lineage": _last(rows) + 1, "complete": False}])
        lineage = _last(begun)
        self._stream(lineage, None).awaitTermination()
        if not _lineage_rows(self.spark, self.root, lineage):
            # Sources without files have no batch; they have features all the same, without rows. Their first batch is 0.
            self._batch(self._no_rows(), -1, lineage)
        lineages.commit(lambda rows: [{"lineage": lineage, "complete": True}, *(r for r in rows if r["lineage"] > lineage)])
        self._retry_retrain()

    def _no_rows(self) -> DataFrame:
        """The arriving columns without a row."""
        schema = arriving_rows(self.spend, self.revenue, self.channels).schema
        return self.spark.createDataFrame([], schema)

    def _stream(self, lineage: int, interval: str | None) -> StreamingQuery:
        writer = (
            arriving_rows(self.spend, self.revenue, self.channels)
            .writeStream.foreachBatch(lambda rows, batch: self._batch(rows, batch, lineage))
            .option("checkpointLocation", checkpoint_path(self.root, lineage))
        )
        writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
        return writer.start()

    def _check(self, lineage: int) -> None:
        """Refuse a start whose batches would be skipped, counted twice or summed over other channels."""
        published = _lineage_rows(self.spark, self.root, lineage)
        if not published:
            return
        found = checkpoint_id(self.spark, checkpoint_path(self.root, lineage))
        if found != published[0]["checkpoint_id"]:
            raise RefreshMismatch(f"{self.root} was published from another checkpoint than the one there; rebuild it")
        if published[0]["channels"] != self._channel_text():
            raise RefreshMismatch(f"{self.root} holds totals of {published[0]['channels']}; rebuild it for other channels")

    def _channel_text(self) -> str:
        return json.dumps(dict(self.channels), sort_keys=True)

    def _batch(self, rows: DataFrame, batch: int, lineage: int = 0) -> None:
        spark = rows.sparkSession
        version = (lineage << _LINEAGE_SHIFT) + batch
        published = _lineage_rows(spark, self.root, lineage)
        if all(r["version"] != version for r in published):
            before = spark.read.parquet(totals_path(self.root, published[0]["version"])) if published else None
            totals = add_totals(before, rows)
            totals.write.mode("overwrite").parquet(totals_path(self.root, version))
            totals = spark.read.parquet(totals_path(self.root, version))
            features = features_from_totals(totals, self.channels)
            features.write.mode("overwrite").parquet(features_path(self.root, version))
            own = {
                "version": version,
                "lineage": lineage,
                "batch": batch,
                "checkpoint_id": checkpoint_id(spark, checkpoint_path(self.root, lineage)),
                "channels": self._channel_text(),
            }
            publish(spark, self.root, own, self.keep)
        # The dependent step: reached only when the features are published, and no reason to stop the feed.
        self._train(spark.read.parquet(features_path(self.root, version)), version)

    def _train(self, features: DataFrame, version: int) -> None:
        if self.retrain is None:
            return
        try:
            self.retrain(features, self.root, version)
            if self.deploy is not None:
                self.deploy(self.spark, self.root)
        except Exception as error:  # noqa: BLE001 - whatever it is, the features are published and the feed goes on
            text = f"{type(error).__name__}: {error}"[:2000]
            _errors(self.spark, self.root).append({"version": version, "error": text}, _KEPT_ERRORS)

    def _retry_retrain(self) -> None:
        """Train the current version if its retrain failed or never began."""
        versions = published_versions(self.spark, self.root) if self.retrain is not None else []
        if versions:
            if not is_trained(self.spark, self.root, versions[0]):
                self._train(current_features(self.spark, self.root), versions[0])


def checkpoint_path(root: str, lineage: int) -> str:
    return f"{root}/checkpoints/lineage={lineage}"


def totals_path(root: str, version: int) -> str:
    return f"{root}/totals/version={version}"


def features_path(root: str, version: int) -> str:
    return f"{root}/features/version={version}"


def checkpoint_id(spark: SparkSession, path: str) -> str | None:
    """The identity a checkpoint keeps over restarts; None where there is no checkpoint."""
    try:
        row = spark.read.text(f"{path}/metadata").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(row["value"])["id"] if row else None


def _lineages(spark: SparkSession, root: str) -> SnapshotLog:
    return SnapshotLog(spark, f"{root}/lineages")


def _last(rows: list[dict]) -> int:
    return max((r["lineage"] for r in rows), default=0)


def _errors(spark: SparkSession, root: str) -> SnapshotLog:
    return SnapshotLog(spark, f"{root}/retrain_errors")


def published_rows(spark: SparkSession, root: str) -> list[dict]:
    """The versions kept of every lineage, newest first."""
    rows = SnapshotLog(spark, f"{root}/published").rows()
    return sorted(rows, key=lambda r: r["version"], reverse=True)


def publish(spark: SparkSession, root: str, own: dict, keep: int) -> list[dict]:
    """Make a version known; of the versions that this pushes out the folders go, and their rows are returned."""
    gone: list[dict] = []
    current = current_lineage(spark, root)

    def change(rows: list[dict]) -> list[dict]:
        older = sorted(rows, key=lambda r: r["version"], reverse=True)
        mine = [r for r in older if r["lineage"] == own["lineage"] and r["version"] != own["version"]][: keep - 1]
        # Another lineage keeps its versions for as long as it may be the current one.
        others = [r for r in older if r["lineage"] != own["lineage"] and r["lineage"] == current][:keep]
        kept = [own, *mine, *others]
        gone[:] = [r for r in older if r not in kept and r["version"] != own["version"]]
        return kept

    SnapshotLog(spark, f"{root}/published").commit(change)
    for row in gone:
        remove_folder(spark, totals_path(root, row["version"]))
        remove_folder(spark, features_path(root, row["version"]))
    return gone


def _lineage_rows(spark: SparkSession, root: str, lineage: int) -> list[dict]:
    return [r for r in published_rows(spark, root) if r["lineage"] == lineage]


def current_lineage(spark: SparkSession, root: str) -> int:
    """The last lineage that is complete; the first one is lineage 0."""
    return _last([r for r in _lineages(spark, root).rows() if r["complete"]])


def published_versions(spark: SparkSession, root: str) -> list[int]:
    """The versions kept of the current lineage, newest first; one number per refresh that had new rows."""
    return [r["version"] for r in _lineage_rows(spark, root, current_lineage(spark, root))]


def current_features(spark: SparkSession, root: str) -> DataFrame:
    """The features published last."""
    versions = published_versions(spark, root)
    if not versions:
        raise LookupError(f"no features published under {root}")
    return spark.read.parquet(features_path(root, versions[0]))


def retrain_errors(spark: SparkSession, root: str) -> DataFrame:
    """What went wrong in retrains: version and error."""
    rows = _errors(spark, root).rows()
    return spark.createDataFrame([(r["version"], r["error"]) for r in rows], _ERRORS)


def retrain_with(
    folds: int = 10, degree: int = 2, train_threshold: float = 0.85, test_threshold: float = 0.85
) -> Callable[[DataFrame, str, int], None]:
    """The dependent training step; a version that was trained already is left alone.

    Too few rows are a gate that was not passed: a run without scores, no new model.
    """

    def retrain(features: DataFrame, root: str, version: int) -> None:
        spark = features.sparkSession
        if is_trained(spark, root, version):
            return
        try:
            train_revenue_model(features, folds, degree, train_threshold, test_threshold, save_root=root, version=version)
        except TooFewRows:
            record_failed_run(spark, root, train_threshold, test_threshold, version)

    return retrain
