"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact similarity.

Windows have the length of an item in words and start where one of the item's
shingles puts its beginning; a window that shares no shingle with an item of
its length has similarity 0 with it. Window and item fingerprints are compared
through blocks: a distance of at most ``max_bits`` over b blocks leaves one
block with at most ``max_bits // b`` differing bits, so each item is entered
under every value of each block within that distance, and a window meets all
items within ``max_bits`` on equality of length, block and value. Candidates
then need a weighted Jaccard similarity of their shingles (each weighted by its
number of occurrences) of at least ``min_similarity``.

Words are runs of letters and digits in lower case. Items shorter than the
shingle length are one shingle of all their words.

Defined results: null texts count as empty and match nothing, as do items
without words; rows that repeat id and text give one result; a row without an
id takes part like any other; repeated items each give their result; empty
tables give an empty result. Texts and items of any length are read whole. Only
ids and texts are read; where documents are dropped, the others keep all columns,
whatever their names.
Of several equally similar places of an item in a document the first counts.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendcast.llm.common import release, stored, whole_text

# Rows of the shingle table of all items up to which it is sent to every executor; some 40 bytes each.
BROADCAST_ROWS = 500_000


def _words(column: str) -> Column:
    return F.filter(F.split(F.lower(whole_text(column)), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _shingles(words: str, size: str | int) -> Column:
    """Hashes of all runs of ``size`` words."""
    if isinstance(size, int):
        run = ", ".join(f"{words}[i + {j}]" for j in range(size))
        hashed = f"xxhash64({run})"
    else:
        hashed = f"xxhash64(slice({words}, i + 1, {size}))"
    return F.expr(
        f"if(size({words}) >= {size}, transform(sequence(0, size({words}) - {size}), i -> {hashed}), array())"
    ).cast("array<bigint>")


def simhash(shingles: str) -> Column:
    """64 bits, each set where more than half of the shingles have it; every long counts two bits, 32 apart."""
    counts = (
        f"aggregate({shingles}, array_repeat(0L, 32), (acc, h) ->"
        " transform(acc, (c, j) -> c + (shiftrightunsigned(h, j) & 4294967297L)))"
    )
    return F.expr(
        f"aggregate(transform({counts}, (c, j) ->"
        f" if((c & 4294967295L) * 2 > size({shingles}), shiftleft(1L, j), 0L)"
        f" | if(shiftrightunsigned(c, 32) * 2 > size({shingles}), shiftleft(1L, j + 32), 0L)), 0L, (a, b) -> a | b)"
    )


def _numbered(shingles: str) -> str:
    """The multiset as a set: a repeat is replaced by a hash of shingle and count, so set operations weigh occurrences."""
    return (
        f"if(size(array_distinct({shingles})) = size({shingles}), {shingles}, transform({shingles}, (h, i) ->"
        f" if(array_position({shingles}, h) = i + 1, h, xxhash64(h, size(filter(slice({shingles}, 1, i + 1), x -> x = h))))))"
    )


def _blocks(max_bits: int, blocks: int) -> list[tuple[int, int, list[int]]]:
    """Shift, mask and the differences to try for each block."""
    out = []
    for b in range(blocks):
        low, high = b * 64 // blocks, (b + 1) * 64 // blocks
        flips = [sum(1 << i for i in c) for r in range(max_bits // blocks + 1) for c in combinations(range(high - low), r)]
        out.append((low, (1 << (high - low)) - 1, flips))
    return out


def _items(benchmark: DataFrame, shingle: int) -> DataFrame:
    return (
        benchmark.select("item_id", _words("text").alias("words"))
        .withColumn("n", F.size("words"))
        .where("n > 0")
        .withColumn("size", F.least("n", F.lit(shingle)))
    )


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    shingle: int = 5,
    min_similarity: float = 0.8,
    max_bits: int = 23,
    blocks: int = 6,
) -> DataFrame:
    """(doc_id, text_key, item_id, similarity, start_word): each item found in each document, at its best place."""
    items = _items(benchmark, shingle)
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most ``shingle`` values
    if not sizes:
        sizes = [shingle]
    parts = [items.where(F.col("size") == s).withColumn("shingles", _shingles("words", s)).drop("words") for s in sizes]
    known = parts[0]
    for more in parts[1:]:
        known = known.unionByName(more)
    known = stored(known.withColumn("fp", simhash("shingles")), "items")
    places = known.select("size", "n", F.posexplode("shingles").alias("offset", "shingle")).distinct()
    if places.count() <= BROADCAST_ROWS:
        places = F.broadcast(places)

    texts = documents.select(F.col("doc_id").alias("d"), F.xxhash64(whole_text()).alias("k"), _words("text").alias("words"))
    found = None
    for s in sizes:
        at = texts.select("d", "k", F.size("words").alias("total"), F.posexplode(_shingles("words", s)).alias("p", "shingle"))
        # An aligned start, moved so that the window lies in the text where the text is long enough.
        start = F.greatest(F.least(F.col("p") - F.col("offset"), F.col("total") - F.col("n")), F.lit(0))
        hit = at.withColumn("size", F.lit(s)).join(places, ["size", "shingle"]).select("d", "k", "size", "n", start.alias("start"))
        found = hit if found is None else found.unionByName(hit)
    per_text = stored(
        found.groupBy("d", "k").agg(F.collect_set(F.struct("size", "n", "start")).alias("starts")), "windows-at"
    )
    joined = documents.select(F.col("doc_id").alias("d"), F.xxhash64(whole_text()).alias("k"), whole_text().alias("t")).alias("x")
    joined = joined.join(per_text.alias("y"), F.expr("x.d <=> y.d and x.k = y.k"))
    cut = joined.select("x.d", "x.k", _words("t").alias("words"), "y.starts")
    windows = None
    for s in sizes:
        own = cut.select("d", "k", _shingles("words", s).alias("all"), F.expr(f"filter(starts, x -> x.size = {s})").alias("starts"))
        own = own.select("d", "k", "all", F.explode("starts").alias("w")).select(
            "d", "k", "w.n", "w.start", F.expr(f"slice(all, w.start + 1, w.n - {s} + 1)").alias("shingles")
        )
        windows = own if windows is None else windows.unionByName(own)
    # Rows that repeat id and text give equal windows.
    windows = stored(
        windows.dropDuplicates(["d", "k", "n", "start"]).where("size(shingles) > 0").withColumn("fp", simhash("shingles")), "windows"
    )
    release(documents.sparkSession)

    cuts = _blocks(max_bits, blocks)

    def block(b: int) -> str:
        shift, mask, _ = cuts[b]
        return f"shiftrightunsigned(fp, {shift}) & {mask}L"

    entered = ", ".join(
        f"transform(array({', '.join(map(str, cuts[b][2]))}), f -> struct({b} as b, (({block(b)}) ^ f) as v))" for b in range(blocks)
    )
    index = known.select("item_id", "n", "fp", F.expr(f"explode(concat({entered}))").alias("e")).select("item_id", "n", "fp", "e.b", "e.v")
    asked = ", ".join(f"struct({b} as b, {block(b)} as v)" for b in range(blocks))
    asking = windows.select("d", "k", "n", "start", "fp", F.expr(f"explode(array({asked}))").alias("e")).select("d", "k", "n", "start", "fp", "e.b", "e.v")
    candidates = (
        asking.alias("w")
        .join(index.alias("i"), F.expr(f"w.n = i.n and w.b = i.b and w.v = i.v and bit_count(w.fp ^ i.fp) <= {max_bits}"))
        .select("w.d", "w.k", "w.n", "w.start", "i.item_id")
        .distinct()
    )
    a, b = _numbered("shingles"), _numbered("item_shingles")
    verified = (
        candidates.alias("c")
        .join(windows.alias("w"), F.expr("c.d <=> w.d and c.k = w.k and c.n = w.n and c.start = w.start"))
        .select("c.*", "w.shingles")
        .join(known.groupBy("item_id", "n", F.col("shingles").alias("item_shingles")).agg(F.count("*").alias("copies")), ["item_id", "n"])
        .withColumn("a", F.expr(a))
        .withColumn("b", F.expr(b))
        .withColumn("similarity", F.expr("size(array_intersect(a, b)) / size(array_union(a, b))"))
        .where(F.col("similarity") >= min_similarity)
    )
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start"))
    return verified.groupBy("d", "k", "item_id").agg(best.alias("best")).select(
        F.col("d").alias("doc_id"),
        F.col("k").alias("text_key"),
        "item_id",
        (-F.col("best.s")).alias("similarity"),
        F.col("best.start").alias("start_word"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents in which no item was found, with the columns they had."""
    found = stored(contaminated(documents, benchmark, **settings).select("doc_id", "text_key").distinct(), "contaminated")
    rows = documents.select(F.struct("*").alias("llm_row"), F.col("doc_id").alias("d"), F.xxhash64(whole_text()).alias("k"))
    kept = rows.alias("x").join(found.alias("y"), F.expr("x.d <=> y.doc_id and x.k = y.text_key"), "left_anti")
    return kept.select("llm_row.*")
