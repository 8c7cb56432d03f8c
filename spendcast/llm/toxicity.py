"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression.

The features of a text are densities of a lexicon (fixed words, and words and
word stems learned from labelled rows), lexicon words near a second person,
capitals, punctuation and obfuscated spellings. Labels, language, source and
id are never features.

Defined results: a null text counts as empty; an empty text has all features 0
and gets the score of such texts; repeated rows are scored alike and all kept;
rows without an id are scored and never trained on; an empty table gives an
empty result; where the labelled rows hold fewer than two classes the score is
the share of label 1 (0 without any label). A text of any length is read whole.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendcast.llm.common import release, sql_strings, stored, whole_text

# Insults that are known without labels.
INSULTS = (
    "asshole", "bastard", "bitch", "cabrón", "clown", "connard", "crap", "cretin", "damn", "disgusting",
    "dumb", "estúpido", "fool", "freak", "fuck", "garbage", "hate", "idiot", "idiota", "idiote", "imbecile",
    "imbécil", "jerk", "kill", "liar", "loser", "moron", "pathetic", "pig", "scum", "shit", "shut", "stupid",
    "stupide", "trash", "ugly", "vermin", "worthless",
)
# Words of the second person.
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "ur", "u", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
    "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes", "vosotros",
)
# Characters that stand for letters, and the letters.
LOOKALIKES = ("013457@$", "oieastas")

STEMS = (4, 5, 6)
FEATURES = (
    "fixed_density", "learned_density", "learned_hits", "second_density", "near_second", "capitals",
    "capital_words", "punctuation", "exclamations", "obfuscated", "repeats", "log_words",
)


class ToxicityModel(NamedTuple):
    """What a fit gives: the lexicon, the trees and the calibration, or only a base rate."""

    words: tuple[str, ...]
    stems: dict[int, tuple[str, ...]]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base_rate: float


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that a fit never sees: crc32 of the id as text leaves 1 by 3. A row without an id is one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _words(text: Column) -> Column:
    """Lower-case words with lookalike characters read as the letters they stand for."""
    return F.split(F.translate(F.lower(text), *LOOKALIKES), "[^\\p{L}]+")


def _in(word: str, values) -> str:
    return f"{word} in ({sql_strings(values)})" if values else "false"


def _features(df: DataFrame, words: tuple[str, ...], stems: dict[int, tuple[str, ...]]) -> DataFrame:
    """Every feature as a double column beside ``tox_text``."""
    tests = [_in("w", words)] + [f"({_in(f'substring(w, 1, {n})', stems[n])})" for n in sorted(stems) if stems[n]]
    learned = " or ".join(tests)
    near = _in("v", SECOND_PERSON)
    counted = df.withColumn("tox_words", _words(F.col("tox_text"))).select(
        *df.columns,
        F.expr("size(filter(tox_words, w -> w != ''))").alias("tox_n"),
        F.expr(f"size(filter(tox_words, w -> {_in('w', INSULTS)}))").alias("tox_fixed"),
        F.expr(f"size(filter(tox_words, w -> {_in('w', SECOND_PERSON)}))").alias("tox_second"),
        F.expr(
            f"filter(transform(tox_words, (w, i) -> if({_in('w', INSULTS)} or {learned}, i, -1)), i -> i >= 0)"
        ).alias("tox_hits"),
        F.col("tox_words"),
        F.length("tox_text").alias("tox_chars"),
        F.expr("regexp_count(tox_text, '\\\\p{Lu}')").alias("tox_capitals"),
        F.expr("regexp_count(tox_text, '\\\\p{Lu}{3,}')").alias("tox_capital_words"),
        F.expr("regexp_count(tox_text, '\\\\p{P}')").alias("tox_punctuation"),
        F.expr("tox_chars - length(replace(tox_text, '!', ''))").alias("tox_exclamations"),
        F.expr("regexp_count(tox_text, '\\\\p{L}[0-9@$*]+\\\\p{L}')").alias("tox_obfuscated"),
        F.expr("regexp_count(tox_text, '(\\\\p{L})\\\\1{2,}')").alias("tox_repeats"),
    )
    near_second = F.expr(f"size(filter(tox_hits, i -> exists(slice(tox_words, greatest(i - 2, 1), 7), v -> {near})))")
    n = F.greatest(F.col("tox_n"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("tox_chars"), F.lit(1)).cast("double")
    values = (
        F.col("tox_fixed") / n, F.size("tox_hits") / n, F.size("tox_hits").cast("double"), F.col("tox_second") / n,
        near_second / n, F.col("tox_capitals") / chars, F.col("tox_capital_words") / n,
        F.col("tox_punctuation") / chars, F.col("tox_exclamations") / chars, F.col("tox_obfuscated") / n,
        F.col("tox_repeats") / n, F.log1p(F.col("tox_n").cast("double")),
    )
    return counted.select(*df.columns, F.array(*values).alias("tox_values")).select(
        *df.columns, *(F.col("tox_values")[i].alias(f"tox_{name}") for i, name in enumerate(FEATURES))
    )


def _lexicon(sample: DataFrame, min_docs: int, min_log_odds: float, size: int):
    """Words and stems that are far more frequent in documents of label 1; at most ``size`` of each length."""
    classes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    stemmed = [f"transform(filter(tox_words, w -> length(w) > {n}), w -> concat('{n}', substring(w, 1, {n})))" for n in STEMS]
    pieces = F.expr(f"array_distinct(concat(transform(tox_words, w -> concat('0', w)), {', '.join(stemmed)}))")
    found = (
        sample.select("label", F.array_distinct(_words(F.col("tox_text"))).alias("tox_words"))
        .select("label", F.explode(pieces).alias("piece"))
        .groupBy("piece")
        .agg(F.sum(F.col("label").cast("long")).alias("toxic"), F.sum(F.lit(1) - F.col("label")).alias("clean"))
        .where((F.col("toxic") >= min_docs) & (F.length("piece") > 3))
        .withColumn(
            "odds",
            F.log((F.col("toxic") + 0.5) / (classes.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (classes.get(0, 0) + 1)),
        )
        .where(F.col("odds") >= min_log_odds)
        .orderBy(F.desc("odds"), "piece")
        .limit(size)
        .collect()
    )
    stems = {n: tuple(sorted(r["piece"][1:] for r in found if r["piece"][0] == str(n))) for n in STEMS}
    return tuple(sorted(r["piece"][1:] for r in found if r["piece"][0] == "0")), stems


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    max_training_rows: int = 20_000,
    min_docs: int = 3,
    min_log_odds: float = 3.0,
    lexicon_size: int = 400,
    rounds: int = 15,
    depth: int = 4,
) -> ToxicityModel:
    """Fit on labelled rows that are not held out.

    max_training_rows bounds the labelled rows that are used; they are the
    first by a hash of the id, so the choice does not depend on partitions.
    Trees and calibration see each half of them through a lexicon learned from
    the other half, so no density is judged on the rows that chose the lexicon;
    scoring uses the lexicon of all. A document with conflicting labels is toxic.
    """
    chosen = (
        labels.where(~held_out() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("tox_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
        .orderBy(F.xxhash64("tox_id"), "tox_id")
        .limit(max_training_rows)
    )
    sample = stored(
        documents.select(F.col("doc_id").alias("tox_id"), whole_text().alias("tox_text"))
        .join(F.broadcast(chosen), "tox_id")
        .select("label", "tox_text", (F.pmod(F.xxhash64("tox_id", F.lit(7)), F.lit(6))).alias("fold"))
        .repartition(8),
        "toxicity-sample",
    )
    counts = sample.agg(F.count("*").alias("n"), F.avg("label").alias("rate"), F.countDistinct("label").alias("k")).first()
    if counts["k"] != 2:
        return ToxicityModel((), {}, None, None, float(counts["rate"] or 0.0))
    lexicon = (min_docs, min_log_odds, lexicon_size)
    halves = [sample.where("fold < 3"), sample.where("fold >= 3")]
    crossed = [_features(half, *_lexicon(other, *lexicon)) for half, other in (halves, halves[::-1])]
    words, stems = _lexicon(sample, *lexicon)
    vectors = VectorAssembler(inputCols=[f"tox_{f}" for f in FEATURES], outputCol="tox_vector")
    rest = stored(crossed[0].unionByName(crossed[1]).drop("tox_text").coalesce(4), "toxicity-features")
    table = vectors.transform(rest)
    trained, calibrated = table.where("fold not in (2, 5)"), table.where("fold in (2, 5)")
    if trained.select("label").distinct().count() < 2 or calibrated.select("label").distinct().count() < 2:
        trained = calibrated = table
    if trained.select("label").distinct().count() < 2:
        return ToxicityModel((), {}, None, None, float(counts["rate"]))
    trees = GBTClassifier(
        featuresCol="tox_vector", labelCol="label", predictionCol="tox_class",
        maxIter=rounds, maxDepth=depth, stepSize=0.3, maxBins=64, seed=7,
    )
    trees = trees.setProbabilityCol("tox_probability").setRawPredictionCol("tox_margin").fit(trained)
    margins = trees.transform(calibrated).select(_margin().alias("tox_x"), F.col("label").cast("double").alias("label"))
    calibration = IsotonicRegression(featuresCol="tox_x", labelCol="label", predictionCol="tox_score").fit(margins)
    release(documents.sparkSession)  # the fit runs many small jobs
    return ToxicityModel(words, stems, trees, calibration, float(counts["rate"]))


def _margin() -> Column:
    return vector_to_array("tox_probability")[1]


def score_toxicity(documents: DataFrame, model: ToxicityModel, score: str = "score") -> DataFrame:
    """Every column of ``documents`` and the calibrated score, 0 to 1; a column of that name is replaced."""
    # One struct carries the given columns, so no name of theirs can clash with a feature.
    kept = [c for c in documents.columns if c != score]
    carried = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("tox_row") if kept else F.lit(None).alias("tox_row"),
        whole_text().alias("tox_text"),
    )
    out = [F.col(f"tox_row.`{c}`").alias(c) for c in kept]
    if model.trees is None:
        return carried.select(*out, F.lit(model.base_rate).alias(score))
    table = _features(carried, model.words, model.stems).drop("tox_text")
    vectors = VectorAssembler(inputCols=[f"tox_{f}" for f in FEATURES], outputCol="tox_vector")
    margins = model.trees.transform(vectors.transform(table)).withColumn("tox_x", _margin())
    scored = model.calibration.transform(margins)
    return scored.select(*out, F.least(F.greatest(F.col("tox_score"), F.lit(0.0)), F.lit(1.0)).alias(score))


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """Documents whose score is below the threshold, with the columns they had."""
    scored = score_toxicity(documents, fit_toxicity(documents, labels, **settings), "tox_result")
    return scored.where(F.col("tox_result") < threshold).select(*(F.col(f"`{c}`") for c in documents.columns))
