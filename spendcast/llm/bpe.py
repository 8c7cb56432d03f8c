"""Byte-level BPE with the ranks of a public tokenizer.

A text is split by a pattern, and each match is encoded by itself: its bytes
are pieces, and the adjacent pair of lowest rank is merged, the leftmost first,
until no pair has a rank. The distinct words of the table are counted, and for
the most frequent of them Spark's higher-order functions fold the merges over
an array of byte pieces, looking ranks up in a literal map (split into buckets
by a checksum, because a lookup in a map scans it). Texts are then put together
from that dictionary, where whole portions of texts are cut into words and put into
ids by vector operations. Its size is bounded, as is what is broadcast; words beyond
it, and words longer than ``LONGEST``, are merged by the same rule where they
occur, so the bound has no effect on results.

Token ids are bytes, four for each id, the lowest first. Decoding concatenates
the binary pieces of the ids.

Defined results: a null text counts as empty; an empty text has no tokens;
repeated rows are all encoded; other columns stay, whatever their names (but
the one asked for); empty tables give an empty result. Texts are encoded whole,
a word of any length in time n log n. An id without a piece is an error.
Letters, numbers and white space are those of the Unicode tables in use.
"""

from __future__ import annotations

import base64
import heapq
import json
import sys
import zlib
from collections.abc import Iterator
from functools import cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendcast.llm.common import stored, whole_text

LONGEST = 48  # bytes of a word in the dictionary
BUCKETS = 8192
_NO_RANK = 2**31 - 1
_PLAN_TEXT = "spark.sql.maxPlanStringLength"


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with one base64 piece and one rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in file if line.strip())}


def _literal_ranks(ranks: dict[bytes, int]) -> Column:
    """The ranks by hexadecimal piece, as a literal array of small maps."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex()
        buckets[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold_merges(word: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of one word (hexadecimal bytes, lower case), as an array."""

    def ids(literal: Column) -> Column:
        def rank(piece: Column) -> Column:
            bucket = F.get(literal, F.pmod(F.crc32(piece.cast("binary")), F.lit(BUCKETS)).cast("int"))
            return F.coalesce(F.try_element_at(bucket, piece), F.lit(_NO_RANK))

        def step(pieces: Column, _) -> Column:
            def merged(pairs: Column) -> Column:
                least = F.array_min(pairs)
                at = F.array_position(pairs, least).cast("int")  # the leftmost, counted from 1
                joined = F.array(F.concat(F.get(pieces, at - 1), F.get(pieces, at)))
                return F.when(
                    least < _NO_RANK,
                    F.concat(F.slice(pieces, F.lit(1), at - 1), joined, F.slice(pieces, at + 2, F.size(pieces))),
                ).otherwise(pieces)

            firsts = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
            return _let(F.transform(firsts, lambda a, i: rank(F.concat(a, F.get(pieces, i + 1)))), merged)

        length = (F.length(word) / 2).cast("int")
        start = F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.substring(word, 2 * i + 1, F.lit(2)))
        folded = F.aggregate(F.sequence(F.lit(1), length), start, step)
        whole = rank(word)
        return F.when(whole < _NO_RANK, F.array(whole)).otherwise(F.transform(folded, rank))

    return _let(_literal_ranks(ranks), ids)  # the plan holds the ranks once


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word by the same merges, for words that are not in a dictionary."""
    if word in ranks:
        return [ranks[word]]
    if len(word) <= 64:
        pieces = [word[i : i + 1] for i in range(len(word))]
        while len(pieces) > 1:
            pairs = [ranks.get(a + b, _NO_RANK) for a, b in zip(pieces, pieces[1:])]
            least = min(pairs)
            if least == _NO_RANK:
                break
            at = pairs.index(least)
            pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        return [ranks[p] for p in pieces]
    # A long word: a heap of pairs over a linked list of pieces, each known by where it starts and ends.
    end, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap = [(r, i, i + 1, i + 2) for i in range(len(word) - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\x01") * len(word)
    while heap:
        _, a, b, stop = heapq.heappop(heap)
        if not alive[a] or end[a] != b or not alive[b] or end[b] != stop:
            continue  # one of the two has been merged meanwhile
        end[a], alive[b] = stop, 0
        if stop < len(word):
            before[stop] = a
            if (r := ranks.get(word[a : end[stop]])) is not None:
                heapq.heappush(heap, (r, a, stop, end[stop]))
        if (left := before[a]) >= 0 and (r := ranks.get(word[left:stop])) is not None:
            heapq.heappush(heap, (r, left, a, stop))
    out, at = [], 0
    while at < len(word):
        out.append(ranks[word[at : end[at]]])
        at = end[at]
    return out


# Fixed value: the pattern that is split by vector operations; any other goes through a regular expression.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER, _LETTER, _NUMBER, _WHITE = range(4)
CHUNK = 1 << 20  # bytes of texts that are worked on at once


@cache
def _kinds() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    kinds = np.zeros(sys.maxunicode + 1, np.uint8)
    every = "".join(map(chr, (i for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)))
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_WHITE, r"\s")):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return kinds


def split_texts(texts: list[bytes], pattern: str) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts in order, and where in them each text begins (and the last one ends)."""
    if pattern != SPLIT:
        found = [[w.encode("utf-8") for w in regex.findall(pattern, t.decode("utf-8"))] for t in texts]
        return pa.array([w for words in found for w in words], pa.binary()), np.cumsum([0, *map(len, found)])
    data = b"".join(texts)
    starts_at = np.cumsum([0, *map(len, texts)])
    if not data:
        return pa.array([], pa.binary()), np.zeros(len(starts_at), np.int64)
    byte_of = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # where each character begins
    code = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), "<u4")
    kind = _kinds()[code]
    text_at = np.searchsorted(byte_of, starts_at)
    new_text = np.zeros(len(code) + 4, bool)
    new_text[text_at] = True
    new_text[len(code) :] = True
    begins = new_text[: len(code)].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # The last white space before a word stands alone, or goes with the word if it is a space.
    last = np.flatnonzero((kind[:-1] == _WHITE) & (kind[1:] != _WHITE) & ~new_text[1 : len(code)])
    begins[last] = True
    begins[last[code[last] == 32] + 1] = False
    # An apostrophe that begins a word takes one or two of the letters that follow.
    mark = np.flatnonzero((code == 39) & begins)
    padded = np.append(code, [0, 0, 0])
    one, two = padded[mark + 1], padded[mark + 2]
    one[new_text[mark + 1]] = 0
    two[new_text[mark + 1] | new_text[mark + 2]] = 0
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    begins = np.append(begins, [True, True, True])
    for taken, size in ((mark[short], 1), (mark[long], 2)):
        for i in range(1, size + 1):
            begins[taken + i] = False
        begins[taken + size + 1] = True
    word_at = np.flatnonzero(begins[: len(code)])
    offsets = np.append(byte_of[word_at], len(data)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(word_at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, np.searchsorted(word_at, text_at)


def _chunks(texts: pa.Array) -> Iterator[list[bytes]]:
    """Whole texts in portions of about CHUNK bytes."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
        size += len(held[-1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches flat[start : start + size], one after the other."""
    stop = np.cumsum(size)
    return flat[np.repeat(start - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]


def frequent_words(documents: DataFrame, text: str, pattern: str, size: int) -> DataFrame:
    """At most ``size`` words (hexadecimal), the most frequent ones of all texts.

    Words are taken by steps of a logarithmic scale of their counts, down to
    the last step that fits, so no sort of all words and no single task is needed.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _chunks(batch.column(0)):
                found = split_texts(texts, pattern)[0].value_counts()
                words = found.field("values").cast(pa.binary())
                yield pa.RecordBatch.from_arrays([words, found.field("counts")], names=["word", "n"])

    counted = stored(
        documents.select(whole_text(text).cast("binary").alias("data"))
        .mapInArrow(count, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.length("word").between(1, LONGEST))
        .select(F.lower(F.hex("word")).alias("word"), F.floor(F.log2("n") * 16).cast("int").alias("step")),
        "words",
    )
    total, least = 0, None
    for row in counted.groupBy("step").agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():  # some 1000 rows at most
        total += row["n"]
        if total > size:
            break
        least = row["step"]
    return counted.where(F.col("step") >= least) if least is not None else counted.where("false")


_LOADED: dict[str, tuple] = {}


def _tables(name: str, shared) -> tuple:
    """Of a worker process: ranks and dictionary, read from the broadcast once for all tasks it runs."""
    if name not in _LOADED:
        ranks, words = shared.value
        table = pa.ipc.open_stream(words).read_all()
        found = dict(zip(map(bytes.fromhex, table["word"].to_pylist()), table["ids"].to_pylist()))
        _LOADED.clear()
        _LOADED[name] = (ranks, found)
    return _LOADED[name]


def encode(
    documents: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    *,
    text: str = "text",
    out: str = "token_bytes",
    decoded: str | None = None,
    dictionary_size: int = 1 << 18,
) -> DataFrame:
    """The given columns and the token ids of the whole text.

    ``decoded`` names a column for the bytes that the ids decode to, in the same pass.
    """
    spark = documents.sparkSession
    words = frequent_words(documents, text, pattern, dictionary_size)
    little = F.transform(
        fold_merges(F.col("word"), ranks), lambda i: F.concat(*(F.substring(F.hex(i + (1 << 32)), p, 2) for p in (8, 6, 4, 2)))
    )
    # Bounded: dictionary_size words of at most LONGEST bytes, each byte at most one id.
    longest = spark.conf.get(_PLAN_TEXT)
    spark.conf.set(_PLAN_TEXT, "20000")  # the plan holds all ranks; its text, which the driver keeps, need not
    try:
        table = stored(words.select("word", F.unhex(F.array_join(little, "")).alias("ids")), "word-ids").toArrow()
    finally:
        spark.conf.set(_PLAN_TEXT, longest)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    shared = spark.sparkContext.broadcast((ranks, sink.getvalue().to_pybytes()))
    del table, sink
    pa.default_memory_pool().release_unused()
    name = uuid4().hex

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_ranks, known = _tables(name, shared)
        for batch in batches:
            done = 0
            # Small portions go back as they are made: ids and bytes of a whole batch would be several times its size.
            for texts in _chunks(batch.column(batch.num_columns - 1)):
                tokens = _encode(texts, pattern, known_ranks, known)
                added = [pa.array(tokens, pa.binary())]
                if decoded:
                    added.append(pa.array(_decode(tokens, name, known_ranks), pa.binary()))
                kept = batch.slice(done, len(texts)).columns[:-1]
                done += len(texts)
                yield pa.RecordBatch.from_arrays([*kept, *added], names=names)

    rest = [c for c in documents.columns if c not in (out, decoded)]
    names = [*rest, out, *([decoded] if decoded else [])]
    schema = StructType([documents.schema[c] for c in rest])
    for added in names[len(rest) :]:
        schema = schema.add(added, "binary")
    carried = documents.select(*(F.col(f"`{c}`") for c in rest), whole_text(text).cast("binary").alias("bpe_text"))
    return carried.mapInArrow(work, schema)


def _encode(texts: list[bytes], pattern: str, ranks: dict[bytes, int], known: dict[bytes, bytes]) -> list[bytes]:
    """The token ids of each text; every distinct word is looked up once."""
    words, text_at = split_texts(texts, pattern)
    coded = words.dictionary_encode()
    which = coded.indices.to_numpy()
    ids = [
        known.get(word) or np.array(merge_word(word, ranks), "<u4").tobytes() for word in coded.dictionary.to_pylist()
    ]
    size = np.array([len(i) // 4 for i in ids], np.int64)
    start = np.cumsum(size) - size
    tokens = _gather(np.frombuffer(b"".join(ids), "<u4"), start[which], size[which])
    ends = np.append(0, np.cumsum(size[which]))[text_at]
    return [tokens[a:b].tobytes() for a, b in zip(ends, ends[1:])]


def _decode(tokens: list[bytes], name: str, ranks: dict[bytes, int]) -> list[bytes]:
    """The pieces of the ids, concatenated for each text."""
    start, size, flat = _pieces(name, ranks)
    ids = np.frombuffer(b"".join(tokens), "<u4")
    if len(ids) and (ids.max() >= len(size) or not size[ids].all()):
        raise ValueError("an id has no piece")
    data = _gather(flat, start[ids], size[ids]).tobytes()
    ends = np.append(0, np.cumsum(size[ids]))[np.cumsum([0, *(len(t) // 4 for t in tokens)])]
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def decode(token_bytes: Column, ranks: dict[bytes, int], spark: SparkSession) -> Column:
    """The bytes that the ids stand for; null for null."""
    shared = spark.sparkContext.broadcast(ranks)
    name = uuid4().hex

    @F.arrow_udf("binary")
    def bpe_decode(column: pa.Array) -> pa.Array:
        out = [data for part in _chunks(column) for data in _decode(part, name, shared.value)]
        nulls = column.is_null().to_numpy(zero_copy_only=False)
        return pa.array([None if n else o for n, o in zip(nulls, out)], pa.binary())

    return bpe_decode(token_bytes)


_PIECES: dict[str, tuple] = {}


def _pieces(name: str, ranks: dict[bytes, int]) -> tuple:
    """Of a worker process: start, size and bytes of the piece of every id."""
    if name not in _PIECES:
        pieces = {rank: piece for piece, rank in ranks.items()}
        every = [pieces.get(i, b"") for i in range(max(pieces, default=-1) + 1)]
        size = np.array([len(p) for p in every], np.int64)
        _PIECES.clear()
        _PIECES[name] = (np.cumsum(size) - size, size, np.frombuffer(b"".join(every), np.uint8))
    return _PIECES[name]


def token_ids(token_bytes: Column) -> Column:
    """The ids as an array of int, for further work in Spark."""

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        found = [np.frombuffer(b.as_buffer(), "<i4") if b.is_valid else None for b in column]
        return pa.array(found, pa.list_(pa.int32()))

    return ids(token_bytes)
