"""N-gram Jaccard join by prefix trees: which documents hold nearly the same set of word n-grams.

A document is the set of its distinct n-grams, and equal sets are one class. Two
classes link when their Jaccard similarity reaches ``percent``. A class takes
part only as long as enough of its n-grams occur in other classes; the first
slice of all n-grams settles that for most. N-grams are ordered globally by the
number of classes that hold them. Classes that share an n-gram among the rarest
ones, of which similar sets always share one, form a cluster; a link never
leaves a cluster.

A cluster is joined in blocks of bounded size. The ordered sets of a block are
stored in a trie, the most frequent n-grams first, so that similar sets share
their paths, and one walk for each set shares the overlap counted on a path by
all sets below it. A subtree is left when what remains of the set and of the
longest set below cannot bring the overlap to what is needed, when no set below
has a fitting length, or when all sets below are connected with the set already.
So a dense group of copies gives few links and not all pairs.

A cluster larger than a block is cut by length and hash. First each block is
joined with itself and some common members, then what has not come together with
the largest component meets all blocks of fitting length. That is exact whatever
the first step finds.

Defined results: a null text counts as empty; a document without words has an
empty set and is linked with nothing, other empty ones included; fewer words than
an n-gram has are one n-gram; repeated rows share their component and are all
returned; a row without an id is returned too, and its component is the smallest
id of the group, null if there is none; an empty table gives an empty result.
Only doc_id and text are read, so further columns of any name change nothing.
Texts of any length are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendcast.llm.common import release, stored, whole_text
from spendcast.llm.graph import components

_PART = 1 << 15
_LINKS = "a long, b long"


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes; A-Z count as a-z, words end at ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.int64)
    size = min(size, len(words))
    lengths = np.array([len(w) for w in words], np.int64)
    joined = b" ".join(words)
    stops = np.cumsum(lengths + 1) - 1
    starts, stops = (stops - lengths)[: len(words) - size + 1], stops[size - 1 :]
    found = []
    for i in range(0, len(starts), _PART):  # bounded memory for a text of any length
        part = zip(starts[i : i + _PART].tolist(), stops[i : i + _PART].tolist())
        found.append(np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b]) for a, b in part], np.uint64)))
    return np.unique(np.concatenate(found)).view(np.int64)


def _shingles(text: Column, size: int) -> Column:
    @F.arrow_udf("array<long>")
    def shingle_sets(texts: pa.Array) -> pa.Array:
        sets = [shingle_hashes(t.as_py(), size) for t in texts]
        offsets = np.cumsum([0, *(len(s) for s in sets)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))

    return shingle_sets(text.cast("binary"))


def needed(percent: int, a, b):
    """The least overlap of two sets of these sizes that makes a link."""
    return -(-percent * (a + b) // (100 + percent))


class PrefixTree:
    """A trie of ordered sets with whole runs of n-grams as edges, its nodes level by level."""

    def __init__(self, lists: list[np.ndarray], sizes: np.ndarray, percent: int) -> None:
        """``lists`` are ascending ranks (the n-grams that others have, too), ``sizes`` count every n-gram of a set."""
        self.percent = percent
        self.order = np.array(sorted(range(len(lists)), key=lambda i: lists[i].astype(">u4").tobytes()), np.int64)
        ordered = [lists[i] for i in self.order]
        self.lengths = np.array([len(s) for s in ordered], np.int64)
        self.sizes = np.asarray(sizes, np.int64)[self.order]
        shared = [0] + [_shared(a, b) for a, b in zip(ordered, ordered[1:])]
        self.levels = []
        runs, stop = [], 0
        waiting = [(0, len(ordered), 0, 0)]  # sets from, to, n-grams so far, parent
        while waiting:
            nodes, following = [], []
            for low, high, depth, parent in waiting:
                while low < high and self.lengths[low] == depth:  # ends at the parent
                    low += 1
                cuts = [low, *(i for i in range(low + 1, high) if shared[i] <= depth), high] if low < high else []
                for a, b in zip(cuts, cuts[1:]):
                    reach = min(shared[a + 1 : b]) if b - a > 1 else int(self.lengths[a])
                    runs.append(ordered[a][depth:reach])
                    ends = a
                    while ends < b and self.lengths[ends] == reach:
                        ends += 1
                    rest = int(self.lengths[a:b].max()) - reach
                    small, large = int(self.sizes[a:b].min()), int(self.sizes[a:b].max())
                    nodes.append((parent, stop, reach - depth, a, b, ends, rest, small, large, int(ordered[a][reach - 1])))
                    stop += reach - depth
                    if ends < b:
                        following.append((a, b, reach, len(nodes) - 1))
            if nodes:
                self.levels.append(np.array(nodes, np.int64).T)
            waiting = following
        self.tokens = np.concatenate(runs) if runs else np.empty(0, np.int64)

    def linked(self, ranks: np.ndarray, size: int, held: np.ndarray, other: np.ndarray):
        """The sets (by their given place) that link with this one, of those marked in ``other``.

        ``held`` has a true value at each rank of the set.
        """
        marked = np.concatenate([[0], np.cumsum(other[self.order])])
        overlap = np.zeros(1, np.int64)
        alive = np.ones(1, bool)
        shortest = -(-self.percent * size // 100)
        for parent, start, count, low, high, ends, rest, small, large, last in self.levels:
            at = np.flatnonzero(
                alive[parent] & (marked[high] > marked[low]) & (large >= shortest) & (self.percent * small <= 100 * size)
            )
            if not len(at):
                return
            counts = count[at]
            first = np.cumsum(counts) - counts
            places = np.repeat(start[at] - first, counts) + np.arange(counts.sum())
            found = overlap[parent[at]] + np.add.reduceat(held[self.tokens[places]].astype(np.int64), first)
            left = len(ranks) - np.searchsorted(ranks, last[at], "right")
            enough = found + np.minimum(left, rest[at]) >= needed(self.percent, size, np.maximum(small[at], shortest))
            overlap, alive = np.zeros(len(parent), np.int64), np.zeros(len(parent), bool)
            overlap[at], alive[at] = found, enough
            for node in at[enough & (ends[at] > low[at])]:
                for place in range(low[node], ends[node]):
                    if other[self.order[place]] and overlap[node] >= needed(self.percent, size, self.sizes[place]):
                        yield int(self.order[place])


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many n-grams two ordered sets begin with in common."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def block_links(block: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is similar in a block: rows of side 0 are in the trie, those of side 1 (all, if there are none) walk it.

    The block has row, n, grams (hashes with their frequencies, dfs), side and label; equal labels are connected already.
    """
    grams, dfs = block["grams"].combine_chunks(), block["dfs"].combine_chunks()
    starts = grams.offsets.to_numpy() - grams.offsets[0].as_py()
    values, counts = grams.flatten().to_numpy(), dfs.flatten().to_numpy()
    distinct, first, which = np.unique(values, return_index=True, return_inverse=True)
    rank = np.empty(len(distinct), np.int64)
    rank[np.lexsort((distinct, -counts[first]))] = np.arange(len(distinct))  # the global order: frequent ones first
    lists = [np.sort(rank[which[a:b]]) for a, b in zip(starts, starts[1:])]
    rows, sizes, side = (block[c].to_numpy() for c in ("row", "n", "side"))
    label = np.unique(block["label"].to_numpy(), return_inverse=True)[1]
    stored_at = np.flatnonzero(side == 0)
    walkers = np.flatnonzero(side == 1) if (side == 1).any() else stored_at
    tree = PrefixTree([lists[i] for i in stored_at], sizes[stored_at], percent)
    held = np.zeros(len(distinct), bool)
    links = []
    for i in walkers:
        held[lists[i]] = True
        for j in tree.linked(lists[i], int(sizes[i]), held, label[stored_at] != label[i]):
            j = stored_at[j]
            if label[i] != label[j]:
                links.append((int(rows[i]), int(rows[j])))
                label[label == label[j]] = label[i]
        held[lists[i]] = False
    return links


def _joined(blocks: DataFrame, keys: list[str], percent: int) -> DataFrame:
    def work(block: pa.Table) -> pa.Table:
        links = block_links(block, percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return blocks.select(*keys, "row", "n", "grams", "dfs", "side", "label").groupBy(*keys).applyInArrow(work, _LINKS)


def _sets(documents: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n, grams, two hashes of the set (d, e) and a number for each row."""
    sets = documents.select("doc_id", _shingles(whole_text(), shingle).alias("grams"))
    hashed = sets.select("doc_id", F.size("grams").cast("long").alias("n"), F.xxhash64("grams").alias("d"), F.xxhash64(F.lit(1), "grams").alias("e"), "grams")
    return stored(hashed.withColumn("row", F.monotonically_increasing_id()), "ngram-sets")


def _ordered_lists(sets: DataFrame, classes: DataFrame, percent: int, slices: int) -> DataFrame:
    """row, n and the n-grams that other classes have, too (grams, with dfs), of classes that may have a link.

    The most frequent n-gram stands first. A class can do without at most 100 - percent of its n-grams.
    """
    enough = F.expr(f"100 * (n - coalesce(lone, 0)) >= {percent} * n")
    part = sets.where("n > 0").select("d", F.explode(F.expr(f"filter(grams, g -> pmod(g, {slices}) = 0)")).alias("g"))
    # An n-gram that one set alone has: equal sets have equal d.
    alone = part.groupBy("g").agg(F.min("d").alias("d"), F.max("d").alias("last")).where("d = last")
    lone = alone.groupBy("d").agg(F.count("*").alias("lone"))
    open_classes = stored(classes.join(lone, "d", "left").where(enough).select("row"), "ngram-open")
    release(sets.sparkSession)
    kept = stored(sets.join(open_classes, "row", "left_semi").select("row", "n", "grams"), "ngram-open-sets")
    release(sets.sparkSession)
    each = kept.select("row", "n", F.explode("grams").alias("g"))
    frequent = stored(each.groupBy("g").agg(F.count("*").cast("int").alias("df")).where("df > 1"), "ngram-frequencies")
    lists = each.join(frequent, "g").groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("df", "g")), False).alias("list"))
    lists = lists.withColumn("lone", F.col("n") - F.size("list")).where(enough)
    return stored(lists.select("row", "n", "lone", F.col("list.g").alias("grams"), F.col("list.df").alias("dfs")), "ngram-lists")


def _clusters(lists: DataFrame, percent: int) -> DataFrame:
    """(node, root): classes that share an n-gram among their rarest ones, directly or through others."""
    count = F.expr(f"greatest(0, least(size(grams), n - ({percent} * n + 99) div 100 + 1 - lone))").cast("int")
    rarest = F.slice("grams", F.size("grams") - count + 1, count)
    entries = stored(lists.where(count > 0).select("row", F.explode(rarest).alias("g")), "ngram-prefixes")
    leads = entries.groupBy("g").agg(F.min("row").alias("lead"), F.max("row").alias("last")).where("lead <> last")
    leads = stored(leads, "ngram-leads")  # as a plain shuffle its join is split where an n-gram is common
    edges = entries.join(leads, "g").where("row <> lead").select(F.col("row").alias("a"), F.col("lead").alias("b"))
    return components(edges, "ngram-clusters")


def _count(rows: Column, grams: Column, block_rows: int, block_grams: int) -> Column:
    return F.greatest(F.ceil(rows / block_rows), F.ceil(grams / block_grams), F.lit(1)).cast("int")


def _links(members: DataFrame, percent: int, block_rows: int, block_grams: int, shared_rows: int) -> DataFrame:
    """(a, b): links that connect the similar classes of each cluster."""
    by_length = members.groupBy("cluster", "bucket").agg(F.count("*").alias("rows"), F.sum(F.size("grams")).alias("total"))
    whole = by_length.groupBy("cluster").agg(F.sum("rows").alias("all_rows"), F.sum("total").alias("all_total"))
    plan = by_length.join(whole, "cluster").select(
        "cluster",
        "bucket",
        "rows",
        ((F.col("all_rows") <= block_rows) & (F.col("all_total") <= block_grams)).alias("small"),
        _count(F.col("rows"), F.col("total"), block_rows, block_grams).alias("slots"),
    )
    plan = stored(plan, "ngram-blocks")
    placed = members.join(plan, ["cluster", "bucket"]).withColumn("slot", F.expr("pmod(xxhash64(row), slots)"))
    # A small cluster is one block. Of a large one some members are in every block of their length, so that blocks come together.
    share = F.expr(f"pmod(xxhash64(row, 7), greatest(1, rows div {shared_rows})) = 0")
    slots = F.when(share, F.expr("sequence(0, slots - 1)")).otherwise(F.array(F.col("slot").cast("int")))
    inside = placed.select(
        "cluster",
        F.when(F.col("small"), F.lit(-1)).otherwise(F.col("bucket")).alias("length"),
        F.explode(F.when(F.col("small"), F.array(F.lit(0))).otherwise(slots)).alias("part"),
        "row", "n", "grams", "dfs", F.lit(0).alias("side"), F.col("row").alias("label"),
    )
    near = stored(_joined(inside, ["cluster", "length", "part"], percent), "ngram-links")
    large = plan.where("not small")
    if large.isEmpty():
        return near
    roots = components(near, "ngram-inner")
    labelled = placed.where("not small").join(roots, F.col("row") == F.col("node"), "left")
    labelled = stored(labelled.withColumn("label", F.coalesce("root", "row")).drop("node", "root", "rows", "small"), "ngram-labelled")
    counted = labelled.groupBy("cluster", "label").agg(F.count("*").alias("k"))
    main = counted.groupBy("cluster").agg(F.max_by("label", F.struct("k", "label")).alias("main"))
    apart = labelled.join(main, "cluster").where("label <> main").drop("main", "slot", "slots")
    sizes = apart.groupBy("cluster", "bucket").agg(F.count("*").alias("rows"), F.sum(F.size("grams")).alias("total"))
    sizes = sizes.select("cluster", "bucket", _count(F.col("rows"), F.col("total"), block_rows, block_grams).alias("groups"))
    # Each group of rows that are apart meets every block of its length and the lengths beside it.
    tasks = (
        sizes.join(large.select("cluster", F.col("bucket").alias("length"), "slots"), "cluster")
        .where("abs(bucket - length) <= 1")
        .withColumn("group", F.explode(F.expr("sequence(0, groups - 1)")))
        .withColumn("slot", F.explode(F.expr("sequence(0, slots - 1)")))
    )
    tasks = stored(tasks.select("cluster", "bucket", "group", "length", "slot"), "ngram-tasks")
    columns = ["cluster", "bucket", "group", "length", "slot", "row", "n", "grams", "dfs", "label"]
    walkers = apart.join(sizes, ["cluster", "bucket"]).withColumn("group", F.expr("pmod(xxhash64(row, 3), groups)").cast("int"))
    walkers = walkers.join(tasks, ["cluster", "bucket", "group"]).select(*columns, F.lit(1).alias("side"))
    trees = labelled.withColumn("slot", F.col("slot").cast("int")).withColumnRenamed("bucket", "length")
    trees = trees.join(tasks, ["cluster", "length", "slot"]).select(*columns, F.lit(0).alias("side"))
    far = _joined(walkers.unionByName(trees), columns[:5], percent)
    return near.union(stored(far, "ngram-far-links"))


def similar_groups(
    documents: DataFrame,
    *,
    shingle: int = 4,
    percent: int = 85,
    slices: int = 4,
    block_rows: int = 1024,
    block_grams: int = 1 << 20,
    shared_rows: int = 64,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    ``block_rows`` and ``block_grams`` bound what a task holds, ``slices`` is the
    share of n-grams (one in so many) that the first step looks at, and
    ``shared_rows`` the members that blocks of a large cluster have in common.
    None of them changes a result.
    """
    sets = _sets(documents, shingle)
    classes = sets.where("n > 0").groupBy("d", "e", "n").agg(F.min("row").alias("row"), F.min("doc_id").alias("first"))
    classes = stored(classes, "ngram-classes")
    lists = _ordered_lists(sets, classes, percent, slices)
    clusters = _clusters(lists, percent)
    # Sets that link are in the same bucket of lengths or in two beside each other.
    bucket = F.floor(F.log("n") / (1.001 * math.log(100 / percent))) if percent < 100 else F.col("n")
    members = lists.join(clusters, F.col("row") == F.col("node")).select(
        F.col("root").alias("cluster"), bucket.cast("long").alias("bucket"), "row", "n", "grams", "dfs"
    )
    members = stored(members, "ngram-members")
    release(documents.sparkSession)
    roots = stored(components(_links(members, percent, block_rows, block_grams, shared_rows), "ngram-roots"), "ngram-components")
    linked = classes.join(roots, F.col("row") == F.col("node"), "left").withColumn("root", F.coalesce("root", "row"))
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    found = linked.join(smallest, "root").select("d", "e", "component_id")
    rows = sets.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "d", "e")
    joined = rows.join(found, ["d", "e"], "left")
    # An empty set is of no class.
    return joined.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
