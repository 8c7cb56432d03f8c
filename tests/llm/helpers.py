from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra=""):
    """Documents with ids from 0; a pair gives its own id. ``extra`` adds columns whose names operators might use."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOCUMENTS)
    names = ("d", "k", "t", "runs", "lines", "fp", "root", "part", "words", "llm_row", "tox_text", "score", "kept", "o")
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(n) for n in names}) if extra else df


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Invented words, some of them common."""
    rnd = random.Random(seed)
    common = ["the", "of", "and", "to", "is", "for"]
    return " ".join(rnd.choice(common) if rnd.random() < 0.3 else f"w{rnd.randrange(vocabulary)}x" for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    rnd = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return " ".join(words)
