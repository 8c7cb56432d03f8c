"""SpotSigs fingerprints: chains of content words that follow common words.

Every occurrence of a common word (an anchor) starts a chain of the next
content words; anchor and chain are one signature, and a document is the set of
its signatures. Two documents are as alike as the Jaccard similarity of their
sets, which cannot exceed the ratio of the set sizes, so sets are compared only
within partitions of similar size and only where they share a signature of
their prefixes.

Defined results: a null text counts as empty. Where no anchor has a full chain,
every word is an anchor; a text with fewer words than a chain has one signature
of all its words, one without words a signature of its characters, an empty one
none. Two empty sets are alike (1.0), an empty and another are not (0.0). Rows
without an id count as having the smallest id of all; rows that repeat an id
are ordered by text, the larger first; an empty table gives an empty result.
Only doc_id and text are read, so further columns of any name change nothing.
Texts of any length are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendcast.llm.common import shuffle_partitions, sql_strings, stored, whole_text

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "been", "but", "by", "can", "could", "did", "do", "for", "from",
    "had", "has", "have", "he", "her", "his", "if", "in", "is", "it", "its", "not", "of", "on", "or", "she",
    "that", "the", "their", "there", "they", "this", "to", "was", "were", "which", "will", "with", "would", "you",
    "au", "aux", "avec", "ce", "ces", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le",
    "les", "leur", "mais", "ne", "ou", "par", "pas", "pour", "qui", "sa", "se", "son", "sont", "sur", "un", "une",
    "als", "auch", "auf", "aus", "bei", "das", "dem", "den", "der", "die", "ein", "eine", "einen", "er", "für",
    "ich", "ist", "mit", "nicht", "oder", "sich", "sie", "sind", "so", "und", "von", "war", "wie", "zu", "zum",
    "al", "como", "con", "del", "el", "ella", "era", "es", "fue", "las", "lo", "los", "más", "no", "para", "pero",
    "por", "que", "su", "sus", "y", "ya",
)


def signatures(df: DataFrame, text: str, out: str, *, chain: int = 2) -> DataFrame:
    """``df`` with the distinct signatures of a text column as a sorted array of long, instead of that column."""
    common = f"w in ({sql_strings(ANCHORS)})"
    rest = [c for c in df.columns if c != text]
    words = df.select(
        *rest,
        F.col(text).alias("sig_text"),
        F.expr(f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w != '')").alias("sig_words"),
    )
    # The k-th anchor (from 0), at place p, has p - k content words before it; its chain starts there.
    placed = words.select(
        *rest,
        "sig_text",
        "sig_words",
        F.expr(f"filter(transform(sig_words, (w, i) -> if({common}, i, -1)), i -> i >= 0)").alias("sig_at"),
        F.expr(f"filter(sig_words, w -> not ({common}))").alias("sig_content"),
    )
    following = ", ".join(f"get(sig_content, p - k + {j})" for j in range(chain))
    chains = (
        f"transform(filter(sig_at, (p, k) -> p - k + {chain} <= size(sig_content)),"
        f" (p, k) -> xxhash64(sig_words[p], {following}))"
    )
    every = ", ".join(f"get(sig_words, i + {j})" for j in range(chain))
    plain = (
        f"case when size(sig_words) >= {chain} then transform(sequence(0, size(sig_words) - {chain}), i -> xxhash64({every}))"
        " when size(sig_words) > 0 then array(xxhash64(sig_words))"
        " when sig_text != '' then array(xxhash64(sig_text))"
        " else cast(array() as array<bigint>) end"
    )
    return placed.select(*rest, F.expr(chains).alias("sig_chains"), F.expr(f"if(size({chains}) = 0, {plain}, null)").alias("sig_plain")).select(
        *rest, F.expr("array_sort(array_distinct(if(size(sig_chains) > 0, sig_chains, sig_plain)))").alias(out)
    )


def fingerprint(signature_set: str) -> Column:
    """The sorted set of signatures as text, 16 hexadecimal digits each: equal sets have equal fingerprints, and their likeness follows from them."""
    return F.array_join(F.transform(F.col(signature_set), lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), "")


def fingerprint_likeness(a: str, b: str) -> float:
    """The Jaccard similarity of the sets that two fingerprints hold."""
    x, y = ({f[i : i + 16] for i in range(0, len(f), 16)} for f in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


def likeness(a: str, b: str, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 where their sizes alone keep it under ``at_least``."""
    bound = f"least(size({a}), size({b})) / greatest(size({a}), size({b}))"
    return F.expr(
        f"case when size({a}) = 0 and size({b}) = 0 then 1.0D"
        f" when least(size({a}), size({b})) = 0 or {bound} < {at_least} then 0.0D"
        f" else size(array_intersect({a}, {b})) / size(array_union({a}, {b})) end"
    )


def near_pairs(documents: DataFrame, *, min_likeness: float = 0.8, chain: int = 2) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes (a, b, likeness, a_set, b_set) that reach ``min_likeness``, and membership (doc_id, class, set).

    A class holds the documents with one set of signatures, so a group of copies
    is one class and not all its pairs. Its key is a digest of the set; it is also
    named by its smallest id, which another class can share where rows repeat an
    id. Rows without an id are left out. Sets
    are put into bands of sizes that grow by 1 / min_likeness: partners lie in
    one band or in two adjacent ones. A partner shares one of the first
    ``n - ceil(min_likeness * n) + 1`` signatures of the sorted set.
    """
    sets = documents.where("doc_id is not null").select("doc_id", whole_text().alias("sig_whole"))
    signed = signatures(sets, "sig_whole", "sigs", chain=chain).withColumn("set", F.md5(fingerprint("sigs")))
    signed = stored(signed, "spotsigs")
    named = signed.groupBy("set").agg(F.min("doc_id").alias("class"))
    members = signed.select("doc_id", "set").join(named, "set").select("doc_id", "class", "set").distinct()
    own = signed.where("size(sigs) > 0").join(named.withColumnRenamed("class", "doc_id"), ["doc_id", "set"], "left_semi")
    first = stored(own.dropDuplicates(["set"]).select(F.col("doc_id").alias("class"), "set", "sigs"), "spotsigs-classes")
    grow = -math.log(min_likeness) if min_likeness < 1 else 1.0
    banded = first.select(
        "set",
        F.size("sigs").alias("n"),
        F.floor(F.log(F.size("sigs").cast("double")) / F.lit(grow)).alias("band"),
        F.expr(f"explode(slice(sigs, 1, size(sigs) - cast(ceil({min_likeness} * size(sigs) - 1e-9) as int) + 1))").alias("sig"),
    )
    # The larger set of a pair looks into its own band and the one below (and one more, for rounding).
    asking = banded.withColumn("to", F.explode(F.expr("array(band, band - 1, band - 2)"))).alias("x")
    found = (
        asking.join(
            banded.alias("y"),
            F.expr(
                "x.sig = y.sig and x.to = y.band and (y.n < x.n or (y.n = x.n and y.set < x.set))"
                f" and y.n >= {min_likeness} * x.n - 1e-9"
            ),
        )
        .select(F.col("x.set").alias("c"), F.col("y.set").alias("d"))
        .distinct()
    )
    compared = (
        found.join(first.select(F.col("set").alias("c"), F.col("class").alias("i"), F.col("sigs").alias("s")), "c")
        .join(first.select(F.col("set").alias("d"), F.col("class").alias("j"), F.col("sigs").alias("t")), "d")
        .withColumn("likeness", likeness("s", "t", min_likeness))
        .where(F.col("likeness") >= min_likeness)
    )
    # The class with the smaller id (then key) stands first.
    ends = [F.struct(F.col(i).alias("id"), F.col(s).alias("set")) for i, s in (("i", "c"), ("j", "d"))]
    placed = compared.select(F.least(*ends).alias("low"), F.greatest(*ends).alias("high"), "likeness")
    columns = [F.col("low.id").alias("a"), F.col("high.id").alias("b"), "likeness", F.col("low.set").alias("a_set"), F.col("high.set").alias("b_set")]
    return placed.select(*columns), members


def _with_next(documents: DataFrame, parts: int) -> DataFrame:
    """(doc_id, text, part, last, o) for every row, and beside it the first row that follows its part (``last`` = 1).

    Parts are ranges of ids. The first row of each part also goes, marked, into
    the part before it, so a window over a part always finds the next document;
    the first row of all goes into the last part.
    """
    rows = documents.select(
        "doc_id", whole_text().alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("o")
    )
    shares = [i / parts for i in range(1, parts)]
    limits = rows.agg(F.percentile_approx("o", shares or [0.5], 100_000)).first()[0] or []
    limits = sorted(set(limits)) if parts > 1 else []
    part = F.lit(0)
    if limits:
        part = F.size(F.filter(F.array(*(F.lit(v) for v in limits)), lambda v: v < F.col("o")))
    placed = rows.withColumn("part", part)
    heads = placed.groupBy("part").agg(F.max("o").alias("head")).orderBy("part").collect()  # one row for each part
    # The first row of a part follows the last one of the part above it in order of ids.
    follows = [(r["head"], heads[(i + 1) % len(heads)]["part"]) for i, r in enumerate(heads)]
    spark = documents.sparkSession
    marks = F.broadcast(spark.createDataFrame(follows, "o long, into int"))
    both = placed.join(marks, "o", "left").withColumn(
        "e", F.explode(F.expr("if(into is null, array(struct(part as part, 0 as last)), array(struct(part as part, 0 as last), struct(into as part, 1 as last)))"))
    )
    return both.select("doc_id", "text", "o", F.col("e.part").alias("part"), F.col("e.last").alias("last"))


def compare_with_edits(documents: DataFrame, *, chain: int = 2, parts: int | None = None) -> DataFrame:
    """Every document against an edited text of its own and against the next document in descending order of ids.

    The edited text has the last third of its characters replaced by as many
    (or all) first characters of the next document; the last document is
    followed by the first.
    """
    parts = parts or 2 * shuffle_partitions(documents.sparkSession)
    order = Window.partitionBy("part").orderBy("last", F.desc("o"), F.desc("text"))
    rows = _with_next(documents, parts).withColumn("next", F.lead("text").over(order))
    n = "length(text)"
    edited = F.expr(f"concat(substring(text, 1, {n} - {n} div 3), substring(coalesce(next, ''), 1, cast({n} div 3 as int)))")
    # The order of equal ids must outlive the text.
    rows = rows.withColumn("nth", F.row_number().over(order)).select(
        "doc_id", "part", "last", "nth", F.expr(f"cast({n} as bigint)").alias("n_chars"), "text", edited.alias("edited")
    )
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = signatures(signatures(rows, "text", "sigs", chain=chain), "edited", "edited_sigs", chain=chain)
    rows = rows.withColumn("next_sigs", F.lead("sigs").over(Window.partitionBy("part").orderBy("nth"))).where("last = 0")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint("sigs").alias("fingerprint"),
        fingerprint("edited_sigs").alias("edited_fingerprint"),
        likeness("sigs", "edited_sigs").alias("near_edited"),
        likeness("sigs", "next_sigs").alias("near_next"),
    )
