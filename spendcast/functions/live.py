"""Scoring with the model that is current, also in a query that was started before it.

A plan holds the model it was built with. A live scorer asks the registry before each
batch (one small file, no Spark job) and builds the batch's plan with the current
model, which reaches the workers once as a broadcast. A worker process prepares a model
once for each version, whatever number of tasks, batches and columns it serves. Its
cache lives in this module, so the workers need the package.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import asdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendcast.functions.scoring import Polynomial, evaluator
from spendcast.plans.training import current_run, load_model

_KEPT = 2
# Of a worker process: what a model's version was made ready as.
_PREPARED: dict[str, Callable] = {}


def _ready(key: str, shared, loads) -> Callable:
    if key not in _PREPARED:
        while len(_PREPARED) >= _KEPT:
            _PREPARED.pop(next(iter(_PREPARED)))
        _PREPARED[key] = evaluator(Polynomial(**json.loads(shared.value)))
        loads.add(1)
    return _PREPARED[key]


class LiveScorer:
    """Scores frames with the current model below a root.

    ``version`` is that of the run whose model is in use, ``loads`` counts how often a
    worker made a model ready.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.version: int | None = None
        self.model: Polynomial | None = None
        self.loads = spark.sparkContext.accumulator(0)
        self._run_time = None
        self._shared = None
        self._function = None

    def renew(self) -> bool:
        """Take over the current model; False if it is in use already. Raises LookupError before the first one."""
        run = current_run(self.spark, self.root)
        if run is None:
            raise LookupError(f"no model under {self.root} has passed its gate")
        if run["run_time"] == self._run_time:
            return False
        self.model = load_model(self.spark, run["model_path"])
        if self._shared is not None:
            self._shared.unpersist()
        self._shared = self.spark.sparkContext.broadcast(json.dumps(asdict(self.model)))
        self._run_time, self.version = run["run_time"], run["version"]
        self._function = self._built(f"{self.root}:{self._run_time}", self._shared, self.loads)
        return True

    @staticmethod
    def _built(key: str, shared, loads):
        @F.arrow_udf("double")
        def live_predict(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            predictions = _ready(key, shared, loads)
            for columns in batches:
                yield predictions(columns)

        return live_predict

    def score(self, df: DataFrame, inputs: Mapping[str, str] | None = None, output: str = "PREDICTED_ROI") -> DataFrame:
        """Add the prediction of the model in use; a NULL input gives NULL."""
        if self.model is None:
            self.renew()
        names = [(inputs or {}).get(f, f) for f in self.model.features]
        return df.withColumn(output, self._function(*[F.col(n).cast("double") for n in names]))

    def score_stream(
        self,
        rows: DataFrame,
        write: Callable[[DataFrame, int], object],
        checkpoint: str,
        interval: str | None = "1 minute",
        inputs: Mapping[str, str] | None = None,
    ) -> StreamingQuery:
        """Score a stream; each batch goes by the model that is current when it begins.

        ``write`` takes a scored batch and its number; a batch that is repeated after
        a failure has the same number, and may have a newer model. Without an interval
        the query handles what is there and ends.
        """

        def batch(arrived: DataFrame, number: int) -> None:
            self.renew()
            write(self.score(arrived, inputs), number)

        writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
