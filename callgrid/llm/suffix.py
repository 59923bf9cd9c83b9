"""Repeated passages by a sparse suffix array over words.

A window of 50 words is repeated when the same 50 words start at an earlier place: in a
document with a smaller doc_id, or further left in the same one. All words of repeated
windows are removed; the first place of each passage stays.

1. Of each document, only the suffixes at minimiser positions are retained: in each
   window, the place among its first 26 whose 8-word hash is smallest. The choice depends
   on content alone, so equal windows retain suffixes at equal offsets, and one suffix in
   about 13 is kept. Each is keyed by its next 25 words, which lie inside the window.
2. The suffixes are range-partitioned and sorted by key and place, and each is compared
   with its neighbours. Ties are parted by place, so a passage that a third of all
   documents share spreads over many partitions; runs cut by a partition's edge are
   joined by comparing the edges. Suffixes unlike both neighbours are dropped.
3. Matches are extended to the left and right: every window around a suffix that is left
   is hashed over its full 50 words (96 bits); the earliest place of each is found by a
   partial aggregate, and all other places are repeats. Runs of them merge into spans.

Equal texts are collapsed beforehand: all words of later copies are repeats.

Results in special cases: null texts have no words; texts of fewer than 50 words have no
window and stay as they are; texts are read whole; rows that repeat both doc_id and text
count as one document and all stay; rows that share a doc_id but not the text are ordered
by text digest; a null doc_id comes last; an empty table gives an empty result. Extra
columns are ignored (:func:`repeats`) or handed through (:func:`without_repeats`).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrid.llm.common import WORD, passing, sifted, written
from callgrid.llm.neardup import ngram_hashes, word_hashes

#: Words of a window.
WINDOW = 50
#: Words of a minimiser's hash, and places among which each window chooses.
GRAM, PLACES = 8, 26
#: Words of a suffix's key: the rest of the window behind its last place.
PREFIX = WINDOW - PLACES + 1

_U = np.uint64
_OTHER = _U(0xD6E8FEB86659FD93)
_WORDS = re.compile(WORD)


def digest(text: str | None) -> bytes:
    return hashlib.md5((text or "").encode("utf-8")).digest()


def _text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def retained(words: np.ndarray) -> np.ndarray:
    """For each window, the place of its minimiser."""
    grams = ngram_hashes(words, GRAM)
    views = np.lib.stride_tricks.sliding_window_view(grams, PLACES)[: len(words) - WINDOW + 1]
    return np.arange(len(views)) + views.argmin(1)


def suffixes(docs: DataFrame) -> DataFrame:
    """doc_id, digest, n_words and the retained suffixes (key, pos) of every document."""
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                digests, n_words, keys, places = [], [], [], []
                for text in batch.column("text").to_pylist():
                    words = word_hashes(text, lower=False)
                    digests.append(digest(text))
                    n_words.append(len(words))
                    pos = np.unique(retained(words)) if len(words) >= WINDOW else np.empty(0, np.int64)
                    keys.append(ngram_hashes(words, PREFIX)[pos].view(np.int64) if len(pos) else np.empty(0, np.int64))
                    places.append(pos.astype(np.int32))
                pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(places))], names=["key", "pos"])
                found = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, places)]), pa.int32()), pairs)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(n_words, pa.int64()), found],
                                                 names=["doc_id", "digest", "n_words", "suffixes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, digest binary, n_words long, suffixes array<struct<key:long,pos:int>>")


def _like_neighbours(ordered: DataFrame) -> DataFrame:
    """Of rows (key, tid, pos) in order, those whose key a neighbour in the partition has, and the first and last row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first = TaskContext.get().partitionId(), None, True

        def told(rows: np.ndarray, like: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
            out = like | edge
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[0][out]), pa.array(rows[1][out]), pa.array(rows[2][out].astype(np.int32)), pa.array(like[out]),
                 pa.array(np.where(edge[out], part, -1).astype(np.int32))], names=["key", "tid", "pos", "repeated", "edge"])

        for b in batches:
            if not b.num_rows:
                continue
            rows = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("key", "tid", "pos")])
            before = False
            if held is not None:  # the last row so far, and whether it is like the one before it
                rows, before = np.concatenate([held[0], rows], axis=1), held[1]
            same = rows[0][1:] == rows[0][:-1]
            like = np.r_[before, same] | np.r_[same, False]
            edge = np.zeros(len(like), bool)
            edge[0] = first
            first = first and len(like) == 1
            yield told(rows[:, :-1], like[:-1], edge[:-1])
            held = rows[:, -1:], bool(like[-1])
        if held is not None:
            yield told(held[0], np.array([held[1]]), np.array([True]))

    return ordered.mapInArrow(run, "key long, tid long, pos int, repeated boolean, edge int")


def _windows(texts: DataFrame) -> DataFrame:
    """Hash and place of each window of texts (tid, digest, text, places) whose own retained suffix is in ``places``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # rows that repeat a document
        for batch in batches:
            for tid, own, text, places in zip(*(batch.column(c).to_pylist() for c in ("tid", "digest", "text", "places"))):
                if tid in seen or digest(text) != own:
                    continue
                seen.add(tid)
                words = word_hashes(text, lower=False)
                chosen = retained(words)
                start = np.flatnonzero(np.isin(chosen, places))
                if not len(start):
                    continue
                half = ngram_hashes(words, PREFIX)
                one, two = half[start], half[start + WINDOW - PREFIX]
                n = len(start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ngram_hashes_pair(one, two).view(np.int64)), pa.array((((one * _OTHER) ^ (two + _OTHER)) * _OTHER >> _U(32)).astype(np.uint32).view(np.int32)),
                     pa.array(np.full(n, tid, np.int64)), pa.array(start.astype(np.int32))], names=["h", "h2", "tid", "pos"])

    return texts.mapInArrow(run, "h long, h2 int, tid long, pos int")


def ngram_hashes_pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    x = one * _U(0x9E3779B97F4A7C15) + two
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def find(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): doc_id, digest, n_words, tid and is_first of every document; and for each
    distinct text with repeats its tid and starts, the sorted starts of repeated windows with the tid of their first place."""
    with passing("suffix-documents", "suffix-spans"):
        with passing("suffix-documents", "suffix-places"):
            with passing("suffix-documents", "suffix-texts"):
                found = written(suffixes(docs), "suffix-rows")
                distinct = found.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.first("suffixes").alias("suffixes"))
                # ids that rise with doc_id, so that an earlier place is a smaller (tid, pos)
                distinct = distinct.repartitionByRange(F.col("first_id").asc_nulls_last(), "digest").sortWithinPartitions(F.col("first_id").asc_nulls_last(), "digest")
                distinct = written(distinct.withColumn("tid", F.monotonically_increasing_id()), "suffix-texts")
                names = distinct.select(F.col("digest").alias("own"), "tid", "first_id")
                rows = found.select("doc_id", "digest", "n_words")
                rows = rows.join(names, rows["digest"] == names["own"]).select("doc_id", "digest", "n_words", "tid", F.col("doc_id").eqNullSafe(F.col("first_id")).alias("is_first"))
                rows = written(rows, "suffix-documents")
            array = distinct.select("tid", F.explode("suffixes").alias("s")).select("s.key", "tid", "s.pos")
            ordered = array.repartitionByRange("key", "tid", "pos").sortWithinPartitions("key", "tid", "pos")
            near = written(_like_neighbours(ordered), "suffix-neighbours")
            cut = near.where("edge >= 0").groupBy("key").agg(F.count_distinct("edge").alias("parts")).where("parts > 1").select("key")
            runs = near.where("repeated").select("tid", "pos").union(near.where("NOT repeated").join(cut, "key").select("tid", "pos"))
            places = runs.groupBy("tid").agg(F.collect_set("pos").alias("places"))  # at most the places of one text
            wanted = written(places.join(distinct.select("tid", "digest", "first_id"), "tid"), "suffix-places")
        texts = docs.select(F.col("doc_id").alias("own_id"), "text")
        texts = sifted(texts, [F.col("own_id"), _text_digest(F.col("text"))], wanted.select("first_id", "digest"))[0]
        texts = texts.join(wanted, texts["own_id"].eqNullSafe(wanted["first_id"])).select("tid", "digest", "text", "places")
        windows = written(_windows(texts), "suffix-windows")
        firsts = windows.groupBy("h", "h2").agg(F.min(F.struct("tid", "pos")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        # a table of its own: the join then deals both sides out itself, and the session can split a passage that many share
        firsts = written(firsts, "suffix-firsts")
        later = windows.join(firsts, ["h", "h2"]).where(F.struct("tid", "pos") != F.col("first"))
        starts = F.sort_array(F.collect_list(F.struct("pos", F.col("first.tid").alias("source")))).alias("starts")
        spans = written(later.groupBy("tid").agg(starts), "suffix-spans")  # at most the windows of one text
    return rows, spans


def _spans(starts) -> Column:
    """Merged word spans [start, end) of sorted starts of windows, and the text in which the span's first window comes first."""
    opens = F.filter(starts, lambda s, i: (i == 0) | (s["pos"] - F.get(starts, i - 1)["pos"] > WINDOW))
    closes = F.filter(starts, lambda s, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1)["pos"] - s["pos"] > WINDOW))
    return F.zip_with(opens, closes, lambda a, b: F.struct(a["pos"].alias("start"), (b["pos"] + WINDOW).alias("end"), a["source"].alias("source")))


def _repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with spans, names of the texts that the spans' sources are)."""
    rows, starts = find(docs)
    merged = starts.select("tid", _spans(F.col("starts")).alias("merged"), F.get("starts", F.lit(0)).alias("opening"))
    source = F.when(F.col("opening.pos") == 0, F.col("opening.source")).otherwise(F.col("tid"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"), source.alias("source")))
    none = F.array().cast("array<struct<start:int,end:int,source:long>>")
    spans = F.when(F.col("is_first"), F.coalesce("merged", none)).when(F.col("n_words") >= WINDOW, whole).otherwise(none)
    out = rows.join(merged, "tid", "left").select("doc_id", "digest", "n_words", spans.alias("spans"))
    out = out.withColumn("repeated_words", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]))
    return out, rows.where("is_first").select(F.col("tid").alias("source"), F.col("doc_id").alias("first_doc_id")).distinct()


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, digest, n_words, spans (words [start, end) that repeat an earlier place) and repeated_words of every document."""
    return _repeats(docs)[0]


def passages(docs: DataFrame) -> DataFrame:
    """One row a repeated span: doc_id, first_doc_id (the document in which the span's first window comes first),
    start and end (words). Documents without a repeat have no row of their own."""
    out, names = _repeats(docs)
    each = out.select("doc_id", F.inline("spans"))
    return each.join(names, "source").select("doc_id", "first_doc_id", "start", "end")


def cut(text: str, spans) -> str:
    """``text`` without the words of the spans and what lies between them."""
    words = [m.span() for m in _WORDS.finditer(text)]
    out, at = [], 0
    for s in spans:
        out.append(text[at : words[s["start"]][0]])
        at = words[s["end"] - 1][1]
    return "".join([*out, text[at:]])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, and ``n_chars``, if there is one, counted anew."""
    with passing("suffix-cuts"):
        found = repeats(docs).where("repeated_words > 0").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("spans").alias("__spans"))
        found = written(found.distinct(), "suffix-cuts")
    maybe, rest = sifted(docs, [F.col("doc_id"), _text_digest(F.col("text"))], found.select("__id", "__digest"))
    same = maybe["doc_id"].eqNullSafe(found["__id"]) & (_text_digest(maybe["text"]) == found["__digest"])
    joined = rest.withColumn("__spans", F.lit(None).cast(found.schema["__spans"].dataType)).union(maybe.join(found, same, "left").drop("__id", "__digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [cut(t, s) if s else t for t, s in zip(b.column("text").to_pylist(), b.column("__spans").to_pylist())]
            columns = dict(zip(b.schema.names, b.columns)) | {"text": pa.array(texts, b.schema.field("text").type)}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], b.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    names = docs.columns
    return joined.mapInArrow(run, docs.schema)
