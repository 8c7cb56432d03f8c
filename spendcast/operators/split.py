"""Train/test split and folds that depend on row keys only.

A seeded random draw changes with partitioning and row order, so a retried task
or another cluster size would move rows between the sets. A hash of the key does
not, and needs neither a shuffle nor a sort.

``with_split`` takes sides by the digits of the hash, so their sizes are about
what was asked for. ``exact_split`` takes them by the rank of the hash: sizes are
exact, and still no row is moved. The cuts between sides and folds are found by
counting prefixes of the hash and counting again inside the few prefixes that hold
a cut, so each pass returns a bounded number of counts however many rows there are.
Where few hashes are left in them the whole ones are counted, so two passes settle the
cuts of a table of some 400 million rows, whether keys repeat or not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NULL_KEY = "null"


def key_digest(keys: Sequence[str], seed: int) -> Column:
    """md5 of the key values and the seed, joined by colons."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit(_NULL_KEY)) for k in keys]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def digest_number(digest: Column) -> Column:
    """The first eight hex digits of a digest as a whole number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def with_split(
    df: DataFrame,
    keys: Sequence[str],
    seed: int = 42,
    test_tenths: int = 2,
    folds: int = 0,
) -> DataFrame:
    """Add IS_TEST, and FOLD (0 to folds - 1) when ``folds`` is given.

    The last decimal digit of the hash decides the side of the split and the digits
    before it the fold, so the fold of a row says nothing about its side.
    """
    number = digest_number(key_digest(keys, seed))
    columns = {"IS_TEST": number % F.lit(10) < F.lit(test_tenths)}
    if folds:
        columns["FOLD"] = (F.floor(number / F.lit(10)) % F.lit(folds)).cast("int")
    return df.withColumns(columns)


_FIRST = 4  # hexadecimal digits told apart by the first pass: 65,536 counts at most
_STEP = 3  # and by a later one: 4,096 counts at most for each open prefix
_FEW = 1 << 16  # digests that a pass may count whole
_DIGITS = 32
_ABOVE = "g"  # greater than any hexadecimal digit
_PASSED = "split_cuts_passed"


def rank_cuts(digests: DataFrame, ranks_of: Callable[[int], Sequence[int]]) -> tuple[int, list[str]]:
    """The number of rows, and for each rank a text that is greater than that many digests and no more.

    ``digests`` has the column digest; ``ranks_of`` takes the number of rows. Equal
    digests cannot be cut apart: they go with the first of them, below the cut.

    A pass counts longer prefixes inside the open ones, or whole digests where at most
    ``_FEW`` rows are left; rows of a prefix that agree in their digest, as the least and
    the greatest of a hash tell, are one for that. Repeated keys would else keep a prefix
    open until its last digit.
    """
    total = None
    cuts: dict[int, str] = {}
    # Open ranks by prefix, each with the number of smaller digests outside the prefix.
    waiting: dict[str, list[int]] = {}
    below: dict[str, int] = {"": 0}
    rows, length, left = digests, 0, 0
    while total is None or waiting:
        if waiting:
            rows = digests.filter(F.substring("digest", 1, length).isin(sorted(waiting)))
            length = _DIGITS if left <= _FEW else min(length + _STEP, _DIGITS)
        else:
            length = _FIRST
        hashed = F.xxhash64("digest")
        counted = rows.groupBy(F.substring("digest", 1, length).alias("prefix")).agg(
            F.count(F.lit(1)).alias("n"), (F.min(hashed) == F.max(hashed)).alias("alike")
        )
        found = counted.collect()
        counts = sorted((r["prefix"], r["n"]) for r in found)
        distinct = {r["prefix"]: 1 if r["alike"] else r["n"] for r in found}
        if total is None:
            total = sum(n for _, n in counts)
            waiting = {"": sorted(set(ranks_of(total)))}
        opened: dict[str, list[int]] = {}
        starts: dict[str, int] = {}
        for start, ranks in waiting.items():
            before = below[start]
            inside = [(p, n) for p, n in counts if p.startswith(start)]
            places = iter(inside)
            prefix, n = next(places, (_ABOVE, 0))
            for rank in ranks:
                while before + n <= rank and prefix != _ABOVE:
                    before += n
                    prefix, n = next(places, (_ABOVE, 0))
                if before == rank or prefix == _ABOVE:
                    cuts[rank] = prefix if prefix != _ABOVE else start + _ABOVE
                elif length >= _DIGITS:
                    cuts[rank] = prefix + _ABOVE
                else:
                    opened.setdefault(prefix, []).append(rank)
                    starts[prefix] = before
        waiting, below = opened, starts
        left = sum(distinct[prefix] for prefix in waiting)
    return total, [cuts[r] for r in ranks_of(total)]


def exact_split(
    df: DataFrame,
    keys: Sequence[str],
    seed: int = 42,
    test_tenths: int = 2,
    folds: int = 0,
) -> DataFrame:
    """Add IS_TEST with exactly that share of the rows, rounded up, and FOLD for the others.

    Rows are ranked by the hash of their keys. The first are the test side; the
    others are dealt to folds whose sizes differ by one at most (the first folds are
    the larger ones), and a test row has no fold. Rows with equal keys stay together.
    """
    digest = key_digest(keys, seed)

    def ranks_of(total: int) -> list[int]:
        test = -(-total * test_tenths // 10)
        size, larger = divmod(total - test, folds) if folds else (0, 0)
        return [test, *(test + f * size + min(f, larger) for f in range(1, folds))]

    _, cuts = rank_cuts(df.select(digest.alias("digest")), ranks_of)
    # How many cuts a row has passed, as one sum, so that its digest is worked out once: none on the test side.
    passed = sum(((digest >= F.lit(c)).cast("int") for c in cuts[1:]), (digest >= F.lit(cuts[0])).cast("int"))
    placed = df.withColumn(_PASSED, passed)
    columns = {"IS_TEST": F.col(_PASSED) == 0}
    if folds:
        columns["FOLD"] = F.when(F.col(_PASSED) > 0, F.col(_PASSED) - 1)
    return placed.withColumns(columns).drop(_PASSED)
