"""Token counts of documents in flat token files that hold nothing but ids and separators.

A file is a run of fixed-size little-endian ids; each document ends with the
end-of-document id. Files have no index, so they are read in blocks: one vectorised
search finds the separators of a block. A block knows how many documents end in it and
where, but not how many ended before it nor where its first one began. Both come from a
prefix scan over the block summaries (a sum and a maximum), in two levels: within groups
of ``GROUP`` blocks, then over the groups of a file; so a file that holds a third of all
tokens spreads over many tasks in every step.

:func:`write` makes such files from texts, one a task, under names of its own attempt in
the shared folder; only files in the table of documents, which Spark commits, are read.

Results in special cases: null and empty texts have 0 tokens and still a separator; the
separator's string in a text is ordinary text and never its id; texts are encoded whole;
tokens behind the last separator of a file are a document that has not ``ended``; a file
without tokens has no documents; a file whose size is no multiple of the id size raises
an error; repeated rows are documents of their own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callgrid.llm.common import located, scratch, written
from callgrid.llm.warc import _storage

#: End-of-document id: the free id behind the ranks of the vocabulary.
SEPARATOR = 50256
ID_TYPE = "<u2"
#: Bytes of a block, and blocks of a group of the prefix scan.
BLOCK_BYTES, GROUP = 4 << 20, 1024

_ENCODINGS: dict = {}


def encoding(path: str, pattern: str):
    """Byte-level BPE of a rank file, built once a Python worker."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def write(docs: DataFrame, folder: str, ranks: str, pattern: str) -> DataFrame:
    """Write token files below ``folder``; the committed table of documents: file, ordinal in it and doc_id."""
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, name, out, ordinal = encoding(ranks, pattern).encode_ordinary, f"tokens-{uuid.uuid4().hex}.bin", None, 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                if out is None:
                    storage, path = _storage(folder)
                    storage.create_dir(path, recursive=True)
                    out = storage.open_output_stream(f"{path}/{name}", compression=None)
                for text in b.column("text").to_pylist():
                    out.write(np.array([*encode(text or ""), SEPARATOR], ID_TYPE).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([name] * b.num_rows), pa.array(np.arange(ordinal, ordinal + b.num_rows)), b.column("doc_id")],
                                                 names=["file", "ordinal", "doc_id"])
                ordinal += b.num_rows
        if out is not None:
            out.close()

    return written(docs.mapInArrow(run, f"file string, ordinal long, doc_id {docs.schema['doc_id'].dataType.simpleString()}"), "token-documents")


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes) of the files of a folder; their contents are not read."""
    listed = spark.read.format("binaryFile").load(folder).select("path", "length")
    return listed.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))


def scan(files: DataFrame, folder: str, separator: int = SEPARATOR, id_type: str = ID_TYPE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file, ordinal, start, n_tokens and ended of every document of ``files`` (file, bytes) below ``folder``."""
    width = np.dtype(id_type).itemsize
    per_block = block_bytes // width
    sized = files.select("file", F.when(F.col("bytes") % width == 0, F.floor(F.col("bytes") / width)).otherwise(
        F.raise_error(F.concat(F.lit("not a whole number of ids: "), "file")).cast("long")).alias("tokens"))
    blocks = sized.where("tokens > 0").select("file", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / per_block))).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, path = _storage(folder)
        for b in batches:
            for file, block, tokens in zip(*(b.column(c).to_pylist() for c in ("file", "block", "tokens"))):
                begin = block * per_block
                n = min(per_block, tokens - begin)
                with storage.open_input_file(f"{path}/{file}") as f:
                    ids = np.frombuffer(f.read_at(n * width, begin * width), id_type)
                ends = begin + np.flatnonzero(ids == separator)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block]), pa.array([len(ends)], pa.int64()), pa.array([int(ends[-1]) if len(ends) else None], pa.int64()),
                     pa.array([ends], pa.list_(pa.int64()))], names=["file", "block", "n_ends", "last_end", "ends"])

    found = blocks.repartition("file", "block").mapInArrow(run, "file string, block long, n_ends long, last_end long, ends array<long>")
    found = written(found.withColumn("group", F.floor(F.col("block") / GROUP)), "token-blocks")
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    groups = found.groupBy("file", "group").agg(F.sum("n_ends").alias("n"), F.max("last_end").alias("last"))
    above = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("file", "group", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"), F.max("last").over(above).alias("last_above"))
    scanned = found.withColumns({"n_before": F.coalesce(F.sum("n_ends").over(inside), F.lit(0)), "last_before": F.max("last_end").over(inside)})
    stitched = scanned.join(groups, ["file", "group"]).select(
        "file", "ends", (F.col("n_above") + F.col("n_before")).alias("first"), (F.coalesce("last_before", "last_above", F.lit(-1)) + 1).alias("begin"))
    ended = stitched.select("file", "first", "begin", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("begin")).otherwise(F.get("ends", F.col("i") - 1) + 1)
    ended = ended.select("file", (F.col("first") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("ended"))
    total = found.groupBy("file").agg(F.sum("n_ends").alias("ordinal"), (F.coalesce(F.max("last_end"), F.lit(-1)) + 1).alias("start"))
    open_ended = sized.join(total, "file").where(F.col("tokens") > F.col("start")).select(
        "file", "ordinal", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.union(open_ended)


def count(docs: DataFrame, ranks: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id and n_tokens of every document, counted in the token files that its text was written to."""
    spark = docs.sparkSession
    folder = located(spark, scratch(spark, "tokens"))
    named = write(docs, folder, ranks, pattern)
    if named.isEmpty():
        return named.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    committed = files_in(spark, folder).join(named.select("file").distinct(), "file")
    return named.join(scan(committed, folder, block_bytes=block_bytes), ["file", "ordinal"]).select("doc_id", "n_tokens")
