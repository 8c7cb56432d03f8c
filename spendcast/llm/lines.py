"""Line dedup: a suffix array over sequences of line ids, built by prefix doubling.

The non-blank lines of a document are a sequence of ids, and the suffixes of
all sequences are ranked by their first 1, 2, 4, ... lines: the rank at twice
the depth is the rank of the pair (rank here, rank that many lines further on).
Ranks of pairs come from a range sort of the distinct pairs, so they keep the
order of a suffix array. Suffixes of equal rank share their first lines; they
are an interval of the array whose longest common prefix reaches the depth. A
suffix alone in its interval repeats nothing deeper and leaves the rounds, so
the rounds work on repeated lines only and end when no suffix can go deeper.

Which lines go is settled at a depth of ``min_lines``: a longer run is covered
by its parts of that length, each of them repeated. Deeper rounds tell how long
the repeated runs are; they are made where a report asks for that.

Of each repeated run of at least ``min_lines`` lines, or of a single line of at
least ``min_words`` words, the first copy stays, by doc_id and position, and
later copies are deleted. Runs are judged on the input, overlaps included, so
a maximal run is deleted as a whole.

Defined results: a null text counts as empty; blank lines are no part of a run
and go only between two deleted lines of one run; rows that agree in id and
text are one document and all keep the same lines; rows with one id and
different texts are ordered by a hash of the text; rows without an id are left
as they are and are no source of copies; an empty table gives an empty result.
Texts and lines of any length are read whole. ``n_chars`` follows the text,
every other column stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendcast.llm.common import release, stored, whole_text

_WORD = "[^\\\\x20\\\\x09-\\\\x0D]+"


def _lines(documents: DataFrame, min_words: int) -> DataFrame:
    """A row for each non-blank line: document (d, k), place s, lines from here on m, id and whether it is long."""
    return (
        documents.where("doc_id is not null")
        .select(F.col("doc_id").alias("d"), whole_text().alias("t"))
        .select("d", F.xxhash64("t").alias("k"), F.expr("filter(split(t, '\\n'), l -> trim(l) != '')").alias("lines"))
        .select("d", "k", F.size("lines").alias("n"), F.posexplode("lines").alias("s", "line"))
        .select(
            "d",
            "k",
            "s",
            (F.col("n") - F.col("s")).alias("m"),
            F.unhex(F.md5("line")).alias("id"),
            F.expr(f"length(line) >= {2 * min_words - 1} and regexp_count(line, '{_WORD}') >= {min_words}").alias("long"),
        )
    )


def _ranked(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur at least twice, with the rank r of the keys and whether an earlier row has them."""
    place = F.struct("d", "k", "s")
    # One row for each key and task before the shuffle, so a very common line is one row there.
    repeated = suffixes.groupBy(*keys).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    # Range partitions in order, sorted inside: the row id grows with the keys.
    ranks = repeated.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        *keys, "first", (F.monotonically_increasing_id() + 1).alias("rank")
    )
    ranks = stored(ranks, "line-ranks")
    return (
        suffixes.join(ranks, keys)
        .select("d", "k", "s", "m", "long", F.col("rank").alias("r"), (F.col("first") < place).alias("later"))
        .distinct()
    )


def repeated_runs(documents: DataFrame, *, min_lines: int = 2, min_words: int = 50, deep: bool = False) -> DataFrame:
    """(d, k, s, e, longest): the runs of lines s to e to delete from the document with id d and text hash k.

    ``longest`` is the longest common prefix found of a suffix that begins in the
    run and an earlier one: a power of two, or fewer lines where both texts end.
    Without ``deep`` it goes no further than ``min_lines``; the runs are the same.
    """
    if min_lines < 2:
        raise ValueError("a run has at least two lines; single lines are governed by min_words")
    now = stored(_ranked(stored(_lines(documents, min_words), "lines"), ["id"]), "line-suffixes")
    found = [now.where("later and long").select("d", "k", "s", F.lit(1).alias("n"))]
    depth = 1
    while (deep or depth < min_lines) and now.where(F.col("m") > depth).limit(1).count():
        step = min(depth, min_lines - depth) if depth < min_lines else depth
        ahead = Window.partitionBy("d", "k").orderBy("s").rangeBetween(step, step)
        # 0 past the end of a document; null where the suffix further on is alone, and so is this one then.
        then = F.when(F.col("m") <= step, F.lit(0)).otherwise(F.first("r").over(ahead))
        pairs = now.withColumn("then", then).where("then is not null")
        now = stored(_ranked(pairs, ["r", "then"]), "line-suffixes")
        depth += step
        if depth >= min_lines:
            found.append(
                now.where(f"later and m >= {min_lines}").select("d", "k", "s", F.least("m", F.lit(depth)).alias("n"))
            )
    covered = found[0]
    for more in found[1:]:
        covered = covered.unionByName(more)
    release(documents.sparkSession)
    ends = covered.groupBy("d", "k", "s").agg(F.max(F.col("s") + F.col("n")).alias("e"), F.max("n").alias("n"))
    order = Window.partitionBy("d", "k").orderBy("s")
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        ends.withColumn("new", (F.coalesce(before, F.lit(-1)) < F.col("s")).cast("int"))
        .withColumn("run", F.sum("new").over(order))
        .groupBy("d", "k", "run")
        .agg(F.min("s").alias("s"), (F.max("e") - 1).alias("e"), F.max("n").alias("longest"))
        .select("d", "k", "s", "e", "longest")
    )


def dedup_lines(documents: DataFrame, *, min_lines: int = 2, min_words: int = 50, report: bool = False) -> DataFrame:
    """The documents without later copies of repeated runs.

    With ``report``, n_lines, n_removed, n_runs and n_longest (see ``repeated_runs``)
    as well, instead of columns of these names.
    """
    runs = stored(repeated_runs(documents, min_lines=min_lines, min_words=min_words, deep=report), "line-runs")
    runs = runs.groupBy("d", "k").agg(
        F.array_sort(F.collect_list(F.struct("s", "e"))).alias("runs"), F.max("longest").alias("longest")
    )
    carried = documents.select(F.struct("*").alias("llm_row"), F.col("doc_id").alias("d"), F.xxhash64(whole_text()).alias("k"))
    # A sort-merge join at every size: the runs of a large table are nothing to broadcast.
    joined = carried.join(runs.hint("merge"), ["d", "k"], "left").withColumn("t", F.coalesce("llm_row.text", F.lit("")))
    places = "filter(sequence(0, size(lines) - 1), i -> trim(element_at(lines, i + 1)) != '')"
    cut = (
        joined.withColumn("lines", F.expr("if(runs is null, null, split(t, '\\n'))"))
        .withColumn("places", F.expr(f"if(runs is null, null, {places})"))
        .withColumn("spans", F.expr("transform(runs, r -> struct(places[r.s] as s, places[r.e] as e))"))
        # What lies before the first span, between two of them and after the last.
        .withColumn("starts", F.expr("concat(array(0), transform(spans, x -> x.e + 1))"))
        .withColumn("stops", F.expr("concat(transform(spans, x -> x.s), array(size(lines)))"))
        .withColumn("kept", F.expr("flatten(zip_with(starts, stops, (a, b) -> slice(lines, a + 1, b - a)))"))
        .withColumn("new_text", F.expr("if(runs is null, t, array_join(kept, '\\n'))"))
    )
    changed = {"text": F.when(F.col("runs").isNull(), F.col("llm_row.text")).otherwise(F.col("new_text"))}
    if "n_chars" in documents.columns:
        length = F.length("new_text").cast(documents.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("runs").isNull(), F.col("llm_row.n_chars")).otherwise(length)
    out = [changed.get(c, F.col(f"llm_row.`{c}`")).alias(c) for c in documents.columns]
    if report:
        out = [c for c, name in zip(out, documents.columns) if name not in ("n_lines", "n_removed", "n_runs", "n_longest")]
        out += [
            F.expr("size(split(t, '\\n'))").alias("n_lines"),
            F.expr("coalesce(size(lines) - size(kept), 0)").alias("n_removed"),
            F.expr("coalesce(size(runs), 0)").alias("n_runs"),
            F.expr("coalesce(longest, 0)").alias("n_longest"),
        ]
    return cut.select(*out)
