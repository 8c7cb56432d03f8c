from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    """All rows as tuples in an order that does not depend on the plan."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def final_plan(df: DataFrame) -> str:
    """The executed plan after adaptive execution."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]
