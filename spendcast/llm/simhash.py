"""SimHash near-duplicates by a grid over segment popcounts.

A fingerprint is cut into 32 segments of two bits. The vector of the segments'
bit counts is an embedding whose Manhattan distance never exceeds the Hamming
distance. Fingerprints meet in grid cells: the segments form ``max_bits`` + 2
bands, and a distance of ``max_bits`` leaves at least two bands untouched, so
each pair of bands is one grid and the exact coordinates in it are the cell.
Pairs of a cell pass the Manhattan bound first, then the exact bit distance.

Equal fingerprints are one node. Fingerprints that differ inside one window of
``max_bits`` bits only are linked to the smallest of them beforehand, and pairs
that are connected already are not produced again, so a dense group of copies
gives few links and not all pairs.

Defined results: a null text counts as empty; texts without words have
fingerprint zero and are linked like any other; repeated rows share their
fingerprint and component and are all returned; a row without an id is returned
too, and its component is the smallest id of the group, null if there is none;
an empty table gives an empty result. Texts of any length are read whole.
Other columns of any name are left out of a result of fingerprints and kept as
they are, whatever their names, where documents are dropped.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendcast.llm.common import release, row_key, stored, whole_text
from spendcast.llm.graph import components

SEGMENTS = 32
LOW_BITS = 0x5555555555555555
_BLOCK = 1 << 15
# Entropy of the bit count of two random bits, and how many tests of pairs a row in one more grid is worth.
_SEGMENT_BITS = 1.5
_ROW_COST = 10


def fingerprint_of(text: str | None, shingle: int = 4) -> int:
    """The 64 bits of one text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    count = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, count, _BLOCK):  # bounded memory for a text of any length
        stop = min(count, start + _BLOCK)
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(start, stop)], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """The fingerprint of a text column as a long."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], np.uint64).view(np.int64))

    return simhash(text)


def popcounts(bits: str) -> Column:
    """The embedding, each count 0, 1, 2 written as 00, 01, 11: the Manhattan distance is the bit distance of two codes."""
    return F.expr(
        f"(({bits} | shiftrightunsigned({bits}, 1)) & {LOW_BITS}L)"
        f" | shiftleft({bits} & shiftrightunsigned({bits}, 1) & {LOW_BITS}L, 1)"
    )


def _band_masks(bands: int) -> list[int]:
    masks = []
    for band in range(bands):
        segments = range(band * SEGMENTS // bands, (band + 1) * SEGMENTS // bands)
        masks.append(sum(3 << (2 * s) for s in segments))
    return masks


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def untouched_bands(count: int, max_bits: int) -> int:
    """r: how many bands a cell is keyed by, with the least work for so many fingerprints."""

    def work(r: int) -> float:
        bands = max_bits + r
        return math.comb(bands, r) * (_ROW_COST + count / 2 ** (_SEGMENT_BITS * SEGMENTS * r / bands))

    return min(range(2, SEGMENTS - max_bits + 1), key=work, default=1)


def links(nodes: DataFrame, max_bits: int = 4, bands: int | None = None) -> DataFrame:
    """(a, b) fingerprints that connect all groups: every pair within ``max_bits`` bits is joined by a path of links.

    ``nodes`` has the long column fp, each value once. ``bands`` is the number of
    bands of a cell, by default what suits the number of nodes; it changes no group.
    """
    windows = [((1 << max_bits) - 1) << start for start in range(0, 64, max_bits)] if max_bits else []
    masks = ", ".join(f"{_signed(~w & (1 << 64) - 1)}L" for w in windows)
    pairs = nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    if not windows:
        return pairs.where("false")
    window = nodes.select("fp", F.posexplode(F.expr(f"transform(array({masks}), m -> fp & m)")).alias("w", "rest"))
    first = window.groupBy("w", "rest").agg(F.min("fp").alias("first"), F.count("*").alias("n")).where("n > 1")
    near = stored(
        window.join(first, ["w", "rest"]).where("fp <> first").select(F.col("fp").alias("a"), F.col("first").alias("b")).distinct(),
        "simhash-window",
    )
    roots = components(near, "simhash-window-roots")
    known = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))

    bands = bands or untouched_bands(nodes.count(), max_bits)
    grids = [reduce(or_, chosen) for chosen in combinations(_band_masks(max_bits + bands), bands)]
    cells = known.withColumn("code", popcounts("fp")).select(
        "fp", "root", "code", F.posexplode(F.expr(f"transform(array({', '.join(f'{_signed(g)}L' for g in grids)}), m -> code & m)")).alias("grid", "cell")
    )
    x, y = cells.alias("x"), cells.alias("y")
    found = x.join(
        y,
        F.expr(
            "x.grid = y.grid and x.cell = y.cell and x.fp < y.fp and x.root <> y.root"
            f" and bit_count(x.code ^ y.code) <= {max_bits}"
            f" and bit_count(x.fp ^ y.fp) <= {max_bits}"
        ),
    ).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    return near.union(stored(found.distinct(), "simhash-pairs"))


def _grouped(documents: DataFrame, shingle: int, max_bits: int, *more: Column) -> DataFrame:
    """doc_id, fp, further columns, component_id and root of every row; root alone tells apart groups whose smallest id is the same."""
    prints = stored(documents.select("doc_id", fingerprint(whole_text(), shingle).alias("fp"), *more), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = stored(components(links(nodes.select("fp"), max_bits), "simhash-roots"), "simhash-components")
    release(documents.sparkSession)
    grouped = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = grouped.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp")


def near_duplicates(documents: DataFrame, *, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    found = _grouped(documents, shingle, max_bits)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(documents: DataFrame, *, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each group stays, the one with the smallest id and then text hash; columns are those given.

    Rows that repeat an id with different texts are different documents: each
    can be the one of its group that stays. Of rows that agree in id and text
    one stays, the first by a hash of all its columns. Rows without an id
    cannot be told apart and all stay.
    """
    found = _grouped(documents, shingle, max_bits, row_key().alias("key")).where("doc_id is not null")
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("llm_kept"), F.col("first.key").alias("llm_kept_key"))
    carried = documents.select(F.struct("*").alias("llm_row"), F.col("doc_id").alias("llm_id"), row_key().alias("llm_key"))
    named = carried.join(kept, F.expr("llm_id = llm_kept and llm_key = llm_kept_key"), "left_semi")
    order = Window.partitionBy("llm_id", "llm_key").orderBy(F.xxhash64("llm_row"))
    once = named.withColumn("llm_nth", F.row_number().over(order)).where("llm_nth = 1")
    rest = carried.where("llm_id is null")
    return once.select("llm_row.*").unionByName(rest.select("llm_row.*"))
