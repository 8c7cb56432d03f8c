"""Token counts of documents in flat token files, found by their separators.

A token file is a sequence of fixed-width ids with a separator id after each
document, without an index. Files are cut into blocks of equal size; a task
finds the separators of a block in one vector comparison. What a block does not
know, how many documents and which separator came before it, is a prefix scan
over the blocks (sums of counts, maxima of places) in two levels: over the
blocks of a stretch, and over the stretches of a file. With both, the document
that a block boundary cuts is stitched together without reading anything twice.

Defined results: an empty document has 0 tokens; a file without any separator,
or what follows the last one, is one document that is marked as not ended; an
empty file has no documents; a file that holds part of an id is an error. In
writing, a null text is an empty document, repeated rows and rows without an id
are documents like any other, and an empty table gives no files. Documents of
any length may span any number of blocks. Only doc_id and text are read, so
further columns of any name change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendcast.llm.common import shuffle_partitions, stored
from spendcast.workspace import new_folder

BLOCK_BYTES = 1 << 20
STRETCH = 1024  # blocks that one window of the first level scans
FILE_BYTES = 64 << 20

_BUILT: dict[str, tiktoken.Encoding] = {}


class BpeEncoder:
    """Ids of a text by a rank file; each worker process builds its tables once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern, self.name = ranks, pattern, uuid4().hex

    def __call__(self, text: str) -> list[int]:
        if self.name not in _BUILT:
            _BUILT[self.name] = tiktoken.Encoding(
                self.name, pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={}
            )
        return _BUILT[self.name].encode_ordinary(text)


def _dtype(width: int) -> str:
    return {2: "<u2", 4: "<u4"}[width]


def write_token_files(
    documents: DataFrame, encoder: Callable[[str], list[int]], separator: int, *, width: int = 2, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write the documents to flat files in the shared folder and return (file, ordinal, doc_id).

    A task writes files of its own; they count only if they are named in what
    is returned, so files of tasks that were lost or repeated do not matter.
    """
    spark = documents.sparkSession
    folder = new_folder(spark, "tokens")
    kind = _dtype(width)
    shared = spark.sparkContext.broadcast(encoder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = pafs.FileSystem.from_uri(folder)
        encode, sink, path, held, size = None, None, "", [], 0
        for batch in batches:
            encode = encode or shared.value
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if sink is None:
                    path = f"{base}/{uuid4().hex}.bin"
                    where.create_dir(base, recursive=True)
                    sink, size = where.open_output_stream(path), 0
                data = np.array([*encode(text.as_py() or ""), separator], kind).tobytes()
                sink.write(data)
                held.append(doc_id)
                size += len(data)
                if size >= file_bytes:
                    sink.close()
                    sink = None
                    yield _listed(path, held)
                    held = []
        if sink is not None:
            sink.close()
            yield _listed(path, held)

    written = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    listed = stored(written.mapInArrow(work, "file string, ordinal long, doc_id long"), "token-manifest")
    return listed.select(F.concat(F.lit(folder + "/"), F.element_at(F.split("file", "/"), -1)).alias("file"), "ordinal", "doc_id")


def _listed(path: str, ids: list) -> pa.RecordBatch:
    arrays = [pa.array([path] * len(ids), pa.string()), pa.array(range(len(ids)), pa.int64()), pa.array(ids, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["file", "ordinal", "doc_id"])


def count_tokens(files: DataFrame, separator: int, *, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended): every document of the files, (file, length) with paths and bytes."""
    spark = files.sparkSession
    kind, step = _dtype(width), block_bytes - block_bytes % width

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["length"] % width:
                    raise ValueError(f"{row['file']} holds part of an id")
                where, path = pafs.FileSystem.from_uri(row["file"])
                with where.open_input_file(path) as source:
                    data = source.read_at(min(step, row["length"] - row["at"]), row["at"])
                places = np.flatnonzero(np.frombuffer(data, kind) == separator) + row["at"] // width
                arrays = [
                    pa.array([row["file"]]), pa.array([row["block"]], pa.int64()), pa.array([row["length"] // width], pa.int64()),
                    pa.array([places], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["file", "block", "tokens", "places"])

    cut = files.where("length > 0").select(
        "file", "length", F.posexplode(F.expr(f"sequence(0L, length - 1, {step}L)")).alias("block", "at")
    )
    cut = cut.select("file", "length", F.col("block").cast("long").alias("block"), "at")
    cut = cut.repartition(4 * shuffle_partitions(spark), "file", "block")
    blocks = stored(cut.mapInArrow(work, "file string, block long, tokens long, places array<bigint>"), "separators")

    sums = blocks.select(
        "file", "block", "tokens", F.floor(F.col("block") / STRETCH).alias("stretch"),
        F.size("places").cast("long").alias("n"), F.try_element_at("places", F.lit(-1)).alias("last"),
    )
    inside = Window.partitionBy("file", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.groupBy("file", "stretch").agg(F.sum("n").alias("n"), F.max("last").alias("last")).select(
        "file", "stretch", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("n0"), F.max("last").over(across).alias("last0")
    )
    before = (
        sums.withColumn("n1", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .withColumn("last1", F.max("last").over(inside))
        .join(totals, ["file", "stretch"])
        .select("file", "block", (F.col("n0") + F.col("n1")).alias("base"), F.coalesce("last1", "last0", F.lit(-1)).alias("prior"))
    )
    found = (
        blocks.join(before, ["file", "block"])
        .select("file", "base", F.posexplode(F.expr("transform(places, (p, j) -> struct(if(j = 0, prior, places[j - 1]) + 1 as start, p as stop))")).alias("j", "x"))
        .select("file", (F.col("base") + F.col("j")).alias("ordinal"), "x.start", (F.col("x.stop") - F.col("x.start")).alias("n_tokens"), F.lit(True).alias("ended"))
    )
    rest = (
        sums.groupBy("file")
        .agg(F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"), F.max("tokens").alias("tokens"))
        .where("tokens > start")
        .select("file", "ordinal", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    )
    return found.unionByName(rest)


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, length) of the files of a folder; their contents are not read."""
    return spark.read.format("binaryFile").load(folder).select(F.col("path").alias("file"), "length")


def document_token_counts(documents: DataFrame, encoder: Callable[[str], list[int]], separator: int, **settings) -> DataFrame:
    """(doc_id, n_tokens) of every row: written to flat files, then counted from these alone."""
    spark = documents.sparkSession
    listed = write_token_files(documents, encoder, separator, width=settings.get("width", 2))
    names = listed.select("file").distinct().alias("l")
    first = listed.select("file").first()
    if first is None:
        return listed.select("doc_id", F.col("ordinal").alias("n_tokens"))
    name = F.element_at(F.split("file", "/"), -1)
    present = token_files(spark, first["file"].rsplit("/", 1)[0]).withColumn("name", name)
    present = present.join(names.select(F.element_at(F.split("l.file", "/"), -1).alias("name")), "name")
    counted = count_tokens(present.select("file", "length"), separator, **settings).withColumn("name", name)
    ids = listed.select(name.alias("name"), "ordinal", "doc_id")
    return ids.join(counted.select("name", "ordinal", "n_tokens"), ["name", "ordinal"], "left").select(
        "doc_id", "n_tokens"
    )
