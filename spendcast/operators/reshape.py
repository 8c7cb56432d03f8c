"""Pivot, unpivot, recode and ordering helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pivot_wide(
    df: DataFrame,
    name_column: str,
    value_column: str,
    values: Mapping[str, str],
    group_columns: Sequence[str] | None = None,
    fill_zero: bool = False,
) -> DataFrame:
    """One row per group with the summed value of every listed name as a column.

    ``values`` maps a name to its output column. Without ``group_columns`` every
    remaining column is a group key. A name that is not listed adds no column but
    its group keeps its row; a group without a listed name gets NULL there, or 0
    with ``fill_zero``.

    Conditional sums need one aggregation and one exchange, and each task first
    reduces its rows to one per group, however many share a group or a name. With
    few groups and many rows it is cheaper to sum per group and name before.
    """
    if group_columns is None:
        group_columns = [c for c in df.columns if c not in (name_column, value_column)]
    sums = []
    for name, alias in values.items():
        total = F.sum(F.when(F.col(name_column) == F.lit(name), F.col(value_column)))
        sums.append((F.coalesce(total, F.lit(0)) if fill_zero else total).alias(alias))
    return df.groupBy(*group_columns).agg(*sums)


def unpivot_long(
    df: DataFrame,
    value_name: str,
    name_name: str,
    columns: Sequence[str],
    include_nulls: bool = False,
) -> DataFrame:
    """One row per (row, listed column); all other columns are repeated as ids.

    Names come out in upper case. Rows with a NULL value are left out unless
    ``include_nulls`` is set.
    """
    listed = {c.upper() for c in columns}
    ids = [c for c in df.columns if c.upper() not in listed]
    value_name, name_name = value_name.upper(), name_name.upper()
    narrow = df.select(*ids, *[F.col(c).alias(c.upper()) for c in columns])
    long = narrow.unpivot(ids, [c.upper() for c in columns], name_name, value_name)
    return long if include_nulls else long.filter(F.col(value_name).isNotNull())


def recode(df: DataFrame, mapping: Mapping[str, str], columns: Sequence[str] | None = None) -> DataFrame:
    """Replace whole string values; by default in every string column of the frame."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.replace(dict(mapping), subset=list(columns))


# A map of so many codes is broadcast; a larger one is joined.
RECODE_BROADCAST_ROWS = 100_000


def recode_by_table(
    df: DataFrame,
    mapping: DataFrame,
    columns: Sequence[str],
    code: str = "CODE",
    label: str = "LABEL",
    broadcast_rows: int = RECODE_BROADCAST_ROWS,
) -> DataFrame:
    """Replace the codes of several string columns by the labels of one map table; other values stay.

    A code that the map has twice is an error, a code without a label becomes NULL, and
    a NULL in the map is no code. A map of at most ``broadcast_rows`` codes goes to
    every task, and no row is moved. A larger one is joined, one exchange for each
    column: codes that many rows share are few, so their labels are broadcast, and
    their rows are dealt over all tasks instead of meeting in one.
    """
    pairs = mapping.select(F.col(code).cast("string").alias("code"), F.col(label).cast("string").alias("label")).dropna(subset=["code"])
    twice = pairs.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"the map has several labels for {', '.join(r['code'] for r in twice)}")
    # One struct carries the row, so no name of it can clash with those of the map.
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
    values = {c: F.col(f"row.`{c}`") for c in columns}
    if pairs.count() <= broadcast_rows:
        hot = {c: None for c in columns}
    else:
        hot = _hot_codes(rows, values)
    for column, value in values.items():
        rows = _labelled(rows, pairs, value, hot[column], f"new_{column}")
    return rows.select(*((F.col(f"`new_{c}`") if c in values else F.col(f"row.`{c}`")).alias(c) for c in df.columns))


def _hot_codes(rows: DataFrame, values: Mapping[str, Column]) -> dict[str, list[str]]:
    """For each column the codes that hold more than half a task's share of the rows; so there are two for each task at most."""
    each = rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), v.alias("value")) for c, v in values.items()))).alias("e"))
    counts = each.groupBy("e.name", "e.value").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = counts.filter((F.col("n") * F.lit(2 * tasks * len(values)) > F.lit(total)) & F.col("value").isNotNull())
    hot: dict[str, list[str]] = {c: [] for c in values}
    for r in found.select("name", "value").collect():
        hot[r["name"]].append(r["value"])
    return hot


def _labelled(rows: DataFrame, pairs: DataFrame, value: Column, hot: list[str] | None, out: str) -> DataFrame:
    """``rows`` with a column more: the label of a value, or the value."""
    if hot is None:
        found = rows.join(F.broadcast(pairs), value == F.col("code"), "left")
        return found.select("row", *_new_columns(rows), F.when(F.col("code").isNotNull(), F.col("label")).otherwise(value).alias(out))
    few = pairs.filter(F.col("code").isin(hot)).select(F.col("code").alias("hot_code"), F.col("label").alias("hot_label"))
    # Rows of hot codes and of none get a key that no code has and that follows from the whole row.
    dealt = F.concat(F.lit("\0"), F.xxhash64("row").cast("string"))
    keyed = rows.withColumn("key", F.when(value.isNull() | value.isin(hot), dealt).otherwise(value))
    found = keyed.join(pairs.hint("merge"), F.col("key") == F.col("code"), "left").join(F.broadcast(few), value == F.col("hot_code"), "left")
    label = F.when(F.col("hot_code").isNotNull(), F.col("hot_label")).when(F.col("code").isNotNull(), F.col("label")).otherwise(value)
    return found.select("row", *_new_columns(rows), label.alias(out))


def _new_columns(rows: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in rows.columns if c != "row"]


def order_index(column: str | Column, ordered_values: Sequence[str]) -> Column:
    """Position of a value in a fixed list, from 1; NULL for a value not in the list."""
    value = F.col(column) if isinstance(column, str) else column
    positions = F.array(*[F.lit(v) for v in ordered_values])
    return F.nullif(F.array_position(positions, value), F.lit(0)).cast("int")


def sort_by_list(df: DataFrame, column: str, ordered_values: Sequence[str], *then: str) -> DataFrame:
    """Sort by the position in a fixed list, unknown values last, then by further columns.

    A short list gives few distinct keys, and a range sort would send all rows of one
    value to one task. The row hash as last key lets it cut within a value.
    """
    return df.orderBy(order_index(column, ordered_values).asc_nulls_last(), *then, F.xxhash64(*df.columns))


def last_by_order(
    df: DataFrame,
    value_column: str,
    order: Column,
    alias: str,
    group_columns: Sequence[str] = (),
) -> DataFrame:
    """The value of the row with the greatest order, overall or per group.

    ``max_by`` is an ordinary aggregate: partial results are one row per task and
    group, so neither a hot group nor the whole table meets in one task.
    """
    return df.groupBy(*group_columns).agg(F.max_by(value_column, order).alias(alias))


def flag_equal(column: str, value: str) -> Column:
    """True where the column has the value, else False (also for NULL)."""
    return F.when(F.col(column) == F.lit(value), F.lit(True)).otherwise(F.lit(False))
