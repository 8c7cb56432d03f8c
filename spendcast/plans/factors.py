"""Least squares from triangular factors.

Sums of products square the condition number of the terms: with many terms or nearly
collinear channels their digits run out. A QR factor does not. Each task folds its
rows, batch by batch, into one small triangular factor for each side and fold; factors
are stacked and factored again in rounds that leave one for every sixteen, until few
are left for the driver. The factor of several folds is that of their stacked factors,
so every fold is scored from the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendcast.functions.scoring import Polynomial

_AT_ONCE = 16
_FACTOR = "IS_TEST boolean, FOLD int, place long, factor array<double>"


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of some rows; never more rows than columns."""
    return np.linalg.qr(rows, mode="r")


@dataclass(frozen=True)
class Factor:
    """The triangular factor of some rows: terms, the constant first, and the label last."""

    triangle: np.ndarray

    @property
    def count(self) -> int:
        return int(round(self.triangle[0, 0] ** 2))

    def __add__(self, other: Factor) -> Factor:
        return Factor(_triangle(np.vstack([self.triangle, other.triangle])))

    def part(self, terms: Sequence[int]) -> Factor:
        """The factor of some of the terms."""
        return Factor(_triangle(self.triangle[:, [*terms, -1]]))

    def solve(self, penalty: float = 0.0) -> np.ndarray:
        """The weights with the least squared error, plus ``penalty`` times the squared weights without the constant."""
        terms, label = self.triangle[:, :-1], self.triangle[:, -1]
        if penalty:
            added = np.sqrt(penalty) * np.eye(terms.shape[1])
            added[0, 0] = 0.0
            terms, label = np.vstack([terms, added]), np.concatenate([label, np.zeros(len(added))])
        return np.linalg.lstsq(terms, label, rcond=None)[0]

    def r2(self, weights: np.ndarray) -> float | None:
        error = self.triangle @ np.append(weights, -1.0)
        label = self.triangle[:, -1]
        # The first row holds what the constant explains.
        spread = float(label[1:] @ label[1:])
        return 1.0 - float(error @ error) / spread if spread > 1e-12 * float(label @ label) else None


def factors(rows: DataFrame, polynomial: Polynomial, mean: float, spread: float, label: str) -> dict:
    """Factors by (IS_TEST, FOLD) of prepared rows, from one pass."""
    exponents = polynomial.exponents
    centers, scales = np.array(polynomial.centers), np.array(polynomial.scales)
    width = len(exponents) + 2

    def triangle(stacked: np.ndarray) -> np.ndarray:  # a function of its own, as workers may lack this package
        return np.linalg.qr(stacked, mode="r")

    def design(batch: pa.RecordBatch) -> np.ndarray:
        numbers = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, batch.num_columns)]
        inputs = (np.column_stack(numbers[:-1]) - centers) / scales
        out = np.empty((batch.num_rows, width))
        out[:, 0] = 1.0
        for place, powers in enumerate(exponents, 1):
            term = np.ones(batch.num_rows)
            for i, power in enumerate(powers):
                for _ in range(power):
                    term = term * inputs[:, i]
            out[:, place] = term
        out[:, -1] = (numbers[-1] - mean) / spread
        return out

    def frame(found: dict, place: int) -> pa.RecordBatch:
        keys = list(found)
        columns = [
            pa.array([k[0] for k in keys], pa.bool_()),
            pa.array([k[1] for k in keys], pa.int32()),
            pa.array([place] * len(keys), pa.int64()),
            pa.array([found[k].reshape(-1) for k in keys], pa.list_(pa.float64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["IS_TEST", "FOLD", "place", "factor"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            table = design(batch)
            side, folds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            key = np.array([-1 if s else -2 if f is None else f for s, f in zip(side, folds)])
            for value in np.unique(key):
                name = (value == -1, None if value < 0 else int(value))
                mine = table[key == value]
                before = found.get(name)
                found[name] = triangle(mine if before is None else np.vstack([before, mine]))
        yield frame(found, TaskContext.get().partitionId())

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        stacked = np.vstack([np.asarray(f).reshape(-1, width) for f in group["factor"].to_pylist()])
        name = (key[0].as_py(), key[1].as_py())
        return pa.Table.from_batches([frame({name: triangle(stacked)}, key[2].as_py())])

    numbers = [F.col(c).cast("double") for c in (*polynomial.features, label)]
    made = rows.select("IS_TEST", "FOLD", *numbers).mapInArrow(fold, _FACTOR)
    left = rows.rdd.getNumPartitions()
    while left > _AT_ONCE:
        made = made.groupBy("IS_TEST", "FOLD", F.floor(F.col("place") / _AT_ONCE).alias("next")).applyInArrow(merge, _FACTOR)
        left = -(-left // _AT_ONCE)
    parts: dict[tuple, list[np.ndarray]] = {}
    for row in made.collect():  # at most _AT_ONCE factors for each fold
        parts.setdefault((row["IS_TEST"], row["FOLD"]), []).append(np.array(row["factor"]).reshape(-1, width))
    return {name: Factor(_triangle(np.vstack(found))) for name, found in parts.items()}
