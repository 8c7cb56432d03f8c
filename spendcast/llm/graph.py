"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendcast.llm.common import release, stored


# What one task of a step takes: a step over fewer edges is one task without an exchange.
EDGES_PER_TASK = 1 << 18


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) for every node of an edge, root being the smallest node that can be reached.

    ``edges`` has long columns a and b. Large-star and small-star steps
    alternate until no edge changes; their number grows with the logarithm of
    the longest chain. A step aggregates before it joins, so a node with very
    many edges costs one row per task in the aggregation, and adaptive
    execution splits its part of the join. The number of tasks that read the
    edges follows their count. Only a count and a checksum reach the driver. An
    empty table of edges gives an empty result.
    """
    now = stored(_clean(edges), purpose)
    state = _state(now)
    while state[0]:
        now, many = _dealt(now, state[0]), state[0] > EDGES_PER_TASK
        now = stored(_star(_star(now, large=True, many=many), large=False, many=many), purpose)
        release(now.sparkSession)
        if (found := _state(_dealt(now, state[0]))) == state:
            break
        state = found
    # At the end every edge leads from a node to its root.
    return _dealt(_both(now, ("a", "b"), ("b", "b")), state[0]).select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()


def _dealt(edges: DataFrame, count: int) -> DataFrame:
    return edges.coalesce(max(1, -(-count // EDGES_PER_TASK)))


def _both(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Several edges for each row: the named columns as a and b."""
    made = F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs))
    return edges.select(F.explode(made).alias("edge")).select("edge.*")


def _clean(edges: DataFrame) -> DataFrame:
    """Each edge once, the larger node first, no loops."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, *, large: bool, many: bool) -> DataFrame:
    """Link the neighbours of every node (the larger ones, or the others) to the smallest of them all.

    No larger neighbour is the smallest of them, so edges that lead from the larger
    to the smaller node settle it as they are. An edge makes one edge: with ``large``
    its larger end goes to the smallest around the other one, else its smaller end to
    the smallest around the larger one, or the larger end where it is that one itself.

    With ``many`` edges the smallest ones are written: the join is then one of two
    plain shuffles, which adaptive execution splits where a node has very many edges.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
    if many:
        least = stored(least, "components-least")
    least = least.hint("merge")
    if large:
        linked = edges.join(least, F.col("b") == F.col("node"), "left")
        return linked.select("a", F.coalesce("m", "b").alias("b")).distinct()
    linked = edges.join(least, F.col("a") == F.col("node"))
    return linked.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
