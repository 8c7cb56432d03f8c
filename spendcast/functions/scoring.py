"""Scoring budgets with a fitted polynomial.

The default is a native expression: it stays inside whole-stage codegen and no
row leaves the JVM. The same formula is offered as a SQL function over an array
and as a batch function over columns, for callers who use functions by name.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def polynomial_exponents(inputs: int, degree: int) -> tuple[tuple[int, ...], ...]:
    """Exponents of all terms up to a degree without the constant.

    The order is that of ``PolynomialExpansion``: (x, x*x, y, x*y, y*y) for two
    inputs, i.e. by the last input's exponent first.
    """
    terms = (e for e in product(range(degree + 1), repeat=inputs) if 0 < sum(e) <= degree)
    return tuple(sorted(terms, key=lambda e: e[::-1]))


def _number(value: float) -> str:
    """A double literal that reads back to the same value; without an exponent it would be a decimal."""
    text = repr(float(value))
    return f"({text})" if "e" in text else f"({text}E0)"


@dataclass(frozen=True)
class Polynomial:
    """intercept + sum of weight * product of ((x - center) / scale) ** exponent."""

    features: tuple[str, ...]
    exponents: tuple[tuple[int, ...], ...]
    weights: tuple[float, ...]
    intercept: float
    centers: tuple[float, ...]
    scales: tuple[float, ...]

    @classmethod
    def plain(cls, features: Sequence[str], degree: int, weights: Sequence[float], intercept: float) -> Polynomial:
        """A polynomial in the inputs themselves, weights in the order of the expansion."""
        exponents = polynomial_exponents(len(features), degree)
        if len(exponents) != len(weights):
            raise ValueError(f"degree {degree} over {len(features)} inputs takes {len(exponents)} weights")
        ones = tuple(1.0 for _ in features)
        zeros = tuple(0.0 for _ in features)
        return cls(tuple(features), exponents, tuple(map(float, weights)), float(intercept), zeros, ones)

    def sql(self, inputs: Sequence[str]) -> str:
        """The signed prediction as SQL text over the given input expressions."""
        scaled = []
        for text, center, scale in zip(inputs, self.centers, self.scales, strict=True):
            value = f"CAST({text} AS DOUBLE)"
            if center:
                value = f"({value} - {_number(center)})"
            if scale != 1.0:
                value = f"({value} / {_number(scale)})"
            scaled.append(value)
        total = _number(self.intercept)
        for weight, exponents in zip(self.weights, self.exponents, strict=True):
            factors = [scaled[i] for i, e in enumerate(exponents) for _ in range(e)]
            total += " + " + " * ".join([_number(weight), *factors])
        return f"({total})"

    def column(self, inputs: Sequence[str] | None = None) -> Column:
        """The absolute prediction over named columns; NULL if any input is NULL."""
        names = [f"`{name}`" for name in (inputs or self.features)]
        return F.abs(F.expr(self.sql(names)))


def score(
    df: DataFrame,
    model: Polynomial,
    inputs: Mapping[str, str] | None = None,
    output: str = "PREDICTED_ROI",
) -> DataFrame:
    """Add the prediction. ``inputs`` maps a model feature to the column that holds it."""
    inputs = inputs or {}
    return df.withColumn(output, model.column([inputs.get(f, f) for f in model.features]))


def register_array_function(spark: SparkSession, model: Polynomial, name: str = "predict_roi") -> None:
    """Register ``name(array<double>)`` as a SQL function; Spark inlines it into the plan.

    A NULL array gives NULL, an array of another length than the model's inputs is an error.
    """
    size = len(model.features)
    items = [f"budget_allocations[{i}]" for i in range(size)]
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(budget_allocations ARRAY<DOUBLE>) RETURNS DOUBLE RETURN "
        f"CASE WHEN budget_allocations IS NULL THEN NULL WHEN size(budget_allocations) = {size} THEN abs({model.sql(items)}) "
        f"ELSE CAST(raise_error('{name} takes {size} values') AS DOUBLE) END"
    )


def evaluator(model: Polynomial):
    """A function from one Arrow column per feature to the absolute predictions.

    It holds plain numbers only, so it travels to workers that lack this package.
    """
    terms = [(w, [(i, int(e)) for i, e in enumerate(row) if e]) for w, row in zip(model.weights, model.exponents)]
    centers, scales, intercept = model.centers, model.scales, model.intercept

    def predictions(columns: Sequence[pa.Array]) -> pa.Array:
        missing = np.zeros(len(columns[0]), bool)
        scaled = []
        for column, center, scale in zip(columns, centers, scales):
            missing |= column.is_null().to_numpy(zero_copy_only=False)
            values = column.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
            scaled.append((values - center) / scale)
        total = np.full(len(missing), intercept)
        for weight, factors in terms:
            term = weight
            for i, power in factors:
                for _ in range(power):
                    term = term * scaled[i]
            total = total + term
        # NULL and NaN stay apart, as in the native expression.
        return pa.array(np.abs(total), pa.float64(), mask=missing)

    return predictions


def batch_function(model: Polynomial):
    """A vectorised function over one column per feature."""
    predictions = evaluator(model)

    @F.arrow_udf("double")
    def batch_predict(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            yield predictions(columns)

    return batch_predict


def register_batch_function(spark: SparkSession, model: Polynomial, name: str = "batch_predict_roi") -> None:
    """Register the vectorised function for calls by name."""
    spark.udf.register(name, batch_function(model))
