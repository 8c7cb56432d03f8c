"""Chat formatting: roles and turns of raw transcripts by a hidden Markov model, rendered in one form.

A transcript is lines in order. Hidden states are the first line of a turn or a
further one, for each role; each line shows a speaker marker (or none), its
length, whether it ends as a question and whether a blank line came before.
Probabilities are counts over transcripts whose roles are known. Viterbi finds
the states: a block of turns is first summed up by a matrix (the best score
from each state before it to each state at its end), the matrices of a
conversation are scanned in order, and then each block is decoded between the
two states the scan has chosen. So a very long conversation is many blocks of
bounded size, and only its small matrices meet in one task.

Blank lines are no observations, but are put back where a turn is assembled. A
marker is taken off a first line only where it names a known speaker.

Defined results: null lines and texts are blank; blank lines belong to the turn
before them and are trimmed at its ends; a null conv_id is one conversation, a
null turn comes before all others; identical rows count once, rows that repeat
a turn with other text are turns that follow each other; conversations of blank
lines only have no turns; an empty table gives an empty result, as does a model
fitted on nothing, whose states are all alike. Texts of any length are whole.
Further columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spendcast.llm.common import shuffle_partitions, stored

ROLES = ("system", "user", "assistant")
# Names of speakers.
SPEAKERS = {
    "system": ("system", "sys", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "prompt", "me", "client"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "gpt", "model", "agent", "response"),
}
TURNS_PER_BLOCK = 64
_STATES = 2 * len(ROLES)  # 2 * role for a first line, 2 * role + 1 for a further one
_VALUES = (5, 4, 2, 2)  # values of the features marker, length, question, gap

# A speaker's name with brackets, hashes, stars or bars around it, and a colon unless it is bracketed.
_NAME = "[\\p{L}][\\p{L} ]{0,20}?"
MARKER = f"^\\s*(?:<\\|({_NAME})\\|>|\\[({_NAME})\\]:?|(?:#+\\s*|\\*\\*|>\\s*)?({_NAME})(?:\\*\\*)?\\s*:)(?:\\*\\*)?\\s*"


class ChatModel(NamedTuple):
    """Logarithms of probabilities: of the first state, of the next state, and of feature values by state."""

    start: np.ndarray
    move: np.ndarray
    shows: tuple[np.ndarray, ...]


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """Raw transcripts written from (conv_id, turn, role, text), with the true role and first lines beside them.

    A conversation is written in one of six styles, and one turn in eight has
    lost its marker; both follow from hashes of the ids.
    """
    turns = conversations.select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("part"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).dropDuplicates()
    style = F.pmod(F.xxhash64("conv_id"), F.lit(6))
    name = F.initcap("role")
    other = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise("System")
    letter = F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise("Context")
    marker = (
        F.when(style == 0, F.concat(name, F.lit(": ")))
        .when(style == 1, F.concat(F.lit("### "), other, F.lit(":\n")))
        .when(style == 2, F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n")))
        .when(style == 3, F.concat(letter, F.lit(": ")))
        .when(style == 4, F.concat(F.lit("**"), name, F.lit("**: ")))
        .otherwise(F.concat(F.lit("["), F.lower(other), F.lit("] ")))
    )
    lost = F.pmod(F.xxhash64("conv_id", "part", F.lit(1)), F.lit(8)) == 0
    gap = F.when((style % 2 == 1) & (F.col("part") > 0), F.lit("\n")).otherwise(F.lit(""))
    written = F.concat(gap, F.when(lost, F.lit("")).otherwise(marker), F.col("text"))
    lines = turns.select(
        "conv_id", "part", F.xxhash64("role", "text").alias("tie"), "role", F.posexplode(F.split(written, "\n")).alias("sub", "line")
    )
    shown = lines.where(F.trim("line") != "").groupBy("conv_id", "part", "tie").agg(F.min("sub").alias("head"))
    x, y = lines.alias("x"), shown.alias("y")
    joined = x.join(y, F.expr("x.conv_id <=> y.conv_id and x.part = y.part and x.tie = y.tie"), "left")
    return joined.select("x.*", (F.col("sub") == F.col("head")).alias("first"))


def _speaker() -> Column:
    found = F.lower(F.trim(F.concat(*(F.regexp_extract("line", MARKER, g) for g in (1, 2, 3)))))
    out = F.when(found == "", 0)
    for i, role in enumerate(ROLES):
        out = out.when(found.isin(*SPEAKERS[role]), i + 1)
    return out.otherwise(4)


def _observed(lines: DataFrame, *more: str) -> DataFrame:
    """The lines with their features, in blocks of turns; blank ones are marked. ``gap`` looks back within the block."""
    line = F.coalesce(F.col("line"), F.lit(""))
    order = Window.partitionBy("conv", "block").orderBy("part", "tie", "sub")
    text = F.trim("line")
    rows = lines.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        "conv_id", F.floor(F.col("part") / TURNS_PER_BLOCK).alias("block"), "part", "tie", "sub", line.alias("line"), *more,
    )
    length = F.length(text)
    return (
        rows.withColumn("gap", F.coalesce(F.lag(text == "").over(order), F.lit(False)).cast("int"))
        .withColumn("blank", text == "")
        .withColumn("marker", _speaker().cast("int"))
        .withColumn("size", F.when(length < 20, 0).when(length < 80, 1).when(length < 300, 2).otherwise(3).cast("int"))
        .withColumn("asks", text.endswith("?").cast("int"))
    )


def fit_chat_model(lines: DataFrame) -> ChatModel:
    """Counts, each one more than seen, over lines with the columns role and first. Reads all; the driver gets some 400 rows at most."""
    state = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") * 2 - 2 + (~F.col("first")).cast("int")
    rows = _observed(lines, "role", "first").where(~F.col("blank") & F.col("role").isin(*ROLES) & F.col("first").isNotNull())
    order = Window.partitionBy("conv", "block").orderBy("part", "tie", "sub")
    seen = rows.withColumn("state", state).withColumn("from", F.lag("state").over(order)).withColumn("nth", F.row_number().over(order))
    counts = seen.groupBy("state", "from", "marker", "size", "asks", "gap", (F.col("nth") == 1).alias("head"), (F.col("block") <= 0).alias("top"))
    start, move = np.ones(_STATES), np.ones((_STATES, _STATES))
    shows = [np.ones((_STATES, n)) for n in _VALUES]
    for r in counts.agg(F.count("*").alias("n")).collect():
        if r["from"] is not None:
            move[r["from"], r["state"]] += r["n"]
        elif r["head"] and r["top"]:
            start[r["state"]] += r["n"]
        for table, name in zip(shows, ("marker", "size", "asks", "gap")):
            table[r["state"], r[name]] += r["n"]
    scaled = [np.log(t / t.sum(axis=-1, keepdims=True)) for t in (start, move, *shows)]
    return ChatModel(scaled[0], scaled[1], tuple(scaled[2:]))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of equal conv and block, which lie side by side."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["conv"], row["block"]) != (held[0]["conv"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _scores(model: ChatModel, rows: list[dict]) -> np.ndarray:
    return sum(t[:, [r[n] for r in rows]].T for t, n in zip(model.shows, ("marker", "size", "asks", "gap")))


def _sum_up(model: ChatModel, shows: np.ndarray, first: bool) -> np.ndarray:
    """Best score from each state before the block (all alike in the first block) to each state at its end."""
    best = np.tile(model.start, (_STATES, 1)) if first else model.move.copy()
    best = best + shows[0]
    for show in shows[1:]:
        best = (best[:, :, None] + model.move[None]).max(axis=1) + show
    return best


def _decode(model: ChatModel, shows: np.ndarray, before: int | None, end: int) -> list[int]:
    """The best states between two known ones."""
    best = (model.start if before is None else model.move[before]) + shows[0]
    back = []
    for show in shows[1:]:
        step = best[:, None] + model.move
        back.append(step.argmax(axis=0))
        best = step.max(axis=0) + show
    path = [end]
    for came in reversed(back):
        path.append(int(came[path[-1]]))
    return path[::-1]


def parse_transcripts(lines: DataFrame, model: ChatModel) -> DataFrame:
    """(conv_id, turn_no, role, text) of every recovered turn; ``lines`` has conv_id, part, tie, sub and line."""
    parts = 2 * shuffle_partitions(lines.sparkSession)
    seen = stored(_observed(lines), "chat-lines")
    features = seen.where(~F.col("blank")).select("conv", "block", "part", "tie", "sub", "marker", "size", "asks", "gap")

    def ordered(df: DataFrame) -> DataFrame:
        return df.repartition(parts, "conv", "block").sortWithinPartitions("conv", "block", "part", "tie", "sub")

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows in _groups(batches):
            matrix = _sum_up(model, _scores(model, rows), rows[0]["block"] == rows[0]["least"])
            yield {"conv": rows[0]["conv"], "block": rows[0]["block"], "matrix": matrix.ravel().tolist()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, blocks in groupby((row for batch in batches for row in batch.to_pylist()), lambda row: row["conv"]):
            blocks = list(blocks)
            matrices = [np.array(b["matrix"]).reshape(_STATES, _STATES) for b in blocks]
            best, back = matrices[0][0], []
            for matrix in matrices[1:]:
                step = best[:, None] + matrix
                back.append(step.argmax(axis=0))
                best = step.max(axis=0)
            ends = [int(best.argmax())]
            for came in reversed(back):
                ends.append(int(came[ends[-1]]))
            for b, before, end in zip(blocks, [-1, *ends[:0:-1]], ends[::-1]):
                yield {"conv": b["conv"], "block": b["block"], "before": before, "end": end}

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ("conv", "block", "part", "tie", "sub")
        for rows in _groups(batches):
            before = rows[0]["before"]
            path = _decode(model, _scores(model, rows), None if before < 0 else before, rows[0]["end"])
            yield from ({n: r[n] for n in names} | {"state": s} for r, s in zip(rows, path))

    def mapped(df: DataFrame, work, schema: str) -> DataFrame:
        arrow = to_arrow_schema(StructType.fromDDL(schema))
        return df.mapInArrow(lambda batches: _batched(work(batches), arrow), schema)

    least = features.groupBy("conv").agg(F.min("block").alias("least"))
    matrices = mapped(ordered(features.join(least, "conv")), sum_up, "conv string, block long, matrix array<double>")
    by_conv = matrices.repartition(parts, "conv").sortWithinPartitions("conv", "block")
    bounds = stored(mapped(by_conv, scan, "conv string, block long, before int, end int"), "chat-bounds")
    bounded = ordered(features.join(bounds, ["conv", "block"]))
    states = stored(mapped(bounded, decode, "conv string, block long, part long, tie long, sub int, state int"), "chat-states")

    # Turns are numbered inside a block first, then by what the blocks before hold; a blank line has the number before it.
    keys = ["conv", "block", "part", "tie", "sub"]
    order = Window.partitionBy("conv", "block").orderBy("part", "tie", "sub")
    starts = F.coalesce((F.col("state") % 2 == 0).cast("int"), F.lit(0))
    inner = seen.join(states, keys, "left").withColumn("nth", F.sum(starts).over(order))
    held = inner.groupBy("conv", "block").agg(F.max("nth").alias("held"))
    past = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("conv", "block", F.coalesce(F.sum("held").over(past), F.lit(0)).alias("offset"))
    numbered = inner.join(offsets, ["conv", "block"]).withColumn("turn_no", F.col("offset") + F.col("nth"))
    named = (F.col("state") % 2 == 0) & F.col("marker").between(1, len(ROLES))
    text = F.when(named, F.regexp_replace("line", MARKER, "")).otherwise(F.col("line"))
    turns = (
        numbered.withColumn("x", F.struct("part", "tie", "sub", text.alias("text"), "state"))
        .groupBy("conv", "conv_id", "turn_no")
        .agg(F.array_sort(F.collect_list("x")).alias("lines"), F.count("state").alias("shown"))
        .where("shown > 0")
    )
    # From the first line that is not blank to the last one.
    full = "transform(lines, l -> trim(l.text) <> '')"
    first, after = f"array_position({full}, true)", f"array_position(reverse({full}), true)"
    whole = f"if({first} = 0, '', array_join(slice(lines.text, int({first}), int(size(lines) + 2 - {first} - {after})), '\\n'))"
    state = "filter(lines, l -> l.state is not null)[0].state"
    role = F.element_at(F.array(*map(F.lit, ROLES)), (F.floor(F.expr(state) / 2) + 1).cast("int"))
    return turns.select("conv_id", "turn_no", role.alias("role"), F.expr(whole).alias("text"))


def render(turns: DataFrame) -> DataFrame:
    """The turns with a column rendered: role and text in the canonical form."""
    return turns.withColumn("rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n")))
