"""Filter interaction audit: what each filter removes in every order of the filters.

Every document gets a row number, and each filter keeps sorted lists of the
numbers that fail it, one for each part and range of numbers. What a filter
removes after others is the difference of its list and their union; unions and
differences are worked out by galloping merges in one range of one part at a
time, and their sizes add up over the ranges. All orders follow from the sizes
for every filter and every set of filters before it.

Defined results: a null text counts as empty, a null part is the empty part;
rows that repeat an id are documents of their own, judged one by one; a row
without an id is no copy of another and has no label; of conflicting labels 1
counts; a part without failing documents has rows of zeros; an empty table gives
an empty result. Only the columns named here are read, so further columns of any
name change nothing. Texts of any length are judged whole.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_left
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendcast.llm.common import shuffle_partitions, stored, whole_text

RANGE_BITS = 14  # numbers of one range: what a task holds at once
_SPACE = "[\\x20\\x09-\\x0D]+"


def gallop(ids: Sequence[int], least: int, start: int) -> int:
    """The first place from ``start`` on whose id is not below ``least``: steps that double, then a binary search."""
    stop, step = start, 1
    while stop < len(ids) and ids[stop] < least:
        start, stop, step = stop + 1, stop + step, 2 * step
    return bisect_left(ids, least, start, min(stop, len(ids)))


def union(lists: Sequence[Sequence[int]]) -> list[int]:
    """One sorted list of what is in any of some sorted lists, whole runs at a time."""
    out: list[int] = []
    rest = [(ids, 0) for ids in lists if ids]
    while len(rest) > 1:
        rest.sort(key=lambda r: r[0][r[1]])
        (ids, at), others = rest[0], rest[1:]
        if others[0][0][others[0][1]] == ids[at]:  # the same id in another list
            other, where = others[0]
            others[0] = (other, where + 1)
        else:
            stop = gallop(ids, others[0][0][others[0][1]], at + 1)
            out += ids[at:stop]
            at = stop
        rest = [(i, a) for i, a in ((ids, at), *others) if a < len(i)]
    return out + list(rest[0][0][rest[0][1] :]) if rest else out


def difference_size(ids: Sequence[int], gone: Sequence[int]) -> int:
    """How many ids of a sorted list are not in another one."""
    at = where = count = 0
    while at < len(ids):
        where = gallop(gone, ids[at], where)
        if where == len(gone):
            return count + len(ids) - at
        if gone[where] == ids[at]:
            at += 1
        else:
            stop = gallop(ids, gone[where], at + 1)
            count, at = count + stop - at, stop
    return count


def posting_lists(verdicts: DataFrame, filters: Sequence[str], subsets: Sequence[str] = ()) -> DataFrame:
    """part, range, filter, subset and ids: the sorted numbers of the documents that fail a filter.

    ``verdicts`` has the column part and a boolean for each filter and subset.
    Filters are counted from 0; subset 0 are all documents, then those named.
    """
    numbered = verdicts.select("part", *filters, *subsets, F.monotonically_increasing_id().alias("id"))
    member = [F.lit(True), *(F.col(s) for s in subsets)]
    lists = [
        F.struct(
            F.lit(f).alias("filter"),
            F.lit(s).alias("subset"),
            F.sort_array(F.collect_list(F.when(F.col(name) & inside, F.col("id")))).alias("ids"),
        )
        for f, name in enumerate(filters)
        for s, inside in enumerate(member)
    ]
    wide = numbered.groupBy("part", F.shiftright("id", RANGE_BITS).alias("range")).agg(F.array(*lists).alias("lists"))
    return wide.select("part", "range", F.explode("lists").alias("list")).select("part", "range", "list.*").where("size(ids) > 0")


def set_sizes(postings: DataFrame, filters: int, subsets: int = 0) -> DataFrame:
    """part, filter, before (a bit for each earlier filter) and one size for each subset: what the filter removes after them."""
    names = [f"n{s}" for s in range(subsets + 1)]
    schema = ", ".join(["part string", "filter int", "before int", *(f"{n} long" for n in names)])
    plan = [(before, [f for f in range(filters) if not before >> f & 1]) for before in range((1 << filters) - 1)]

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        lists = {(f, s): ids for f, s, ids in zip(*(rows[c].to_pylist() for c in ("filter", "subset", "ids")))}
        found: list[list] = [[] for _ in names]
        for s, sizes in enumerate(found):
            for before, after in plan:
                gone = union([lists.get((f, s), []) for f in range(filters) if before >> f & 1])
                sizes += [difference_size(lists.get((f, s), []), gone) for f in after]
        pairs = [(f, before) for before, after in plan for f in after]
        columns = [
            pa.array([key[0].as_py()] * len(pairs), pa.string()),
            pa.array([f for f, _ in pairs], pa.int32()),
            pa.array([b for _, b in pairs], pa.int32()),
        ]
        return pa.table([*columns, *(pa.array(sizes, pa.int64()) for sizes in found)], ["part", "filter", "before", *names])

    # Lists are small for the work they take, so their tasks go by the session's count and not by size.
    dealt = postings.repartition(shuffle_partitions(postings.sparkSession), "part", "range")
    sizes = dealt.groupBy("part", "range").applyInArrow(work, schema)
    return sizes.groupBy("part", "filter", "before").agg(*(F.sum(n).alias(n) for n in names))


def interactions(verdicts: DataFrame, filters: Sequence[str], subsets: Sequence[str] = ()) -> DataFrame:
    """A row for each part, order of the filters and step.

    part, filter_order, step, kept, removed, redundant, unique_fails, shapley
    and ``<subset>_lost`` for each subset. All orders are listed, so filters are few.
    """
    verdicts = stored(verdicts.select(F.coalesce("part", F.lit("")).alias("part"), *filters, *subsets), "filter-verdicts")
    postings = stored(posting_lists(verdicts, filters, subsets), "filter-postings")
    sizes = stored(set_sizes(postings, len(filters), len(subsets)), "filter-sizes")
    k = len(filters)
    orders = []
    for order in itertools.permutations(range(k)):
        for step, f in enumerate(order):
            before = sum(1 << g for g in order[:step])
            orders.append(f"struct('{''.join(filters[g] for g in order)}' as filter_order, {step + 1} as step, {f} as filter, {before} as before)")
    steps = (
        verdicts.groupBy("part")
        .agg(F.count("*").alias("documents"))
        .select("part", "documents", F.explode(F.expr(f"array({', '.join(orders)})")).alias("o"))
        .select("part", "documents", "o.*")
    )
    weight = F.expr("case bit_count(before) " + " ".join(f"when {n} then {math.factorial(n) * math.factorial(k - 1 - n)}" for n in range(k)) + " end")
    everyone_else = F.expr(f"{(1 << k) - 1} - shiftleft(1, filter)")
    of_filter = sizes.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("n0"))).alias("fails"),
        F.sum(F.when(F.col("before") == everyone_else, F.col("n0"))).alias("alone"),
        F.sum(F.col("n0") * weight).alias("shapley"),
    )
    found = steps.join(sizes, ["part", "filter", "before"], "left").join(of_filter, ["part", "filter"], "left")

    def number(column) -> Column:
        return F.coalesce(column, F.lit(0)).cast("long")

    # What is left after a step: the documents without those that it and the steps before it removed.
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    gone = F.sum(number(F.col("n0"))).over(so_far)
    return found.select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - gone).alias("kept"),
        number(F.col("n0")).alias("removed"),
        (number(F.col("fails")) - number(F.col("n0"))).alias("redundant"),
        number(F.col("alone")).alias("unique_fails"),
        *(number(F.col(f"n{s}")).alias(f"{name}_lost") for s, name in enumerate(subsets, 1)),
        number(F.col("shapley")).alias("shapley"),
    )


def document_verdicts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, the verdicts A to E of each document and whether it is labelled good or toxic.

    A: under 100 words. B: fewer distinct words than 80 % of the words. C: capitals A to Z are more than
    10 % of the characters. D: one of # $ % & * and | occurs. E: a document with a smaller id has the same text.
    """
    text = F.col("t")
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    judged = (
        documents.select("doc_id", F.col("lang").alias("part"), whole_text().alias("t"))
        .select("doc_id", "part", "t", words.alias("words"))
        .select(
            "doc_id",
            "part",
            F.md5("t").alias("key"),
            (F.size("words") < 100).alias("A"),
            (F.lit(100).cast("long") * F.size(F.array_distinct("words")) < F.lit(80).cast("long") * F.size("words")).alias("B"),
            (
                F.lit(100).cast("long") * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", "")))
                > F.lit(10).cast("long") * F.length(text)
            ).alias("C"),
            text.rlike("[#$%&*|]").alias("D"),
        )
    )
    judged = stored(judged, "filter-texts")  # what follows carries no text
    # Written, so that both sides of the join are plain shuffles, which adaptive execution splits where a text is common.
    copies = judged.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = stored(copies.select("key", "first"), "filter-copies")
    marks = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    joined = judged.join(copies, "key", "left").join(marks, "doc_id", "left")
    return joined.select(
        "part",
        *"ABCD",
        F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"),
    )
