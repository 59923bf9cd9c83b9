"""Line dedup with levelled sorted runs of line hashes. DataFrame functions only.

A line's key is the line stripped of ASCII white space, with A-Z lower-cased. Keys of at least
:data:`MIN_CHARS` code points that :data:`MIN_DOCS` documents hold lose their lines in all
documents but the one of the largest doc_id.

1. One scan writes a row for each place of a long line: doc_id, a digest of the text, the place and
   128 bits of the key's hash, dealt to batches by a hash of doc_id. Texts are not shuffled here.
2. :class:`Runs` takes the batches one by one. A batch is reduced to a row a key (documents, largest
   doc_id) by partial aggregates, so that a line which a third of all documents share is one row a
   task. It is merge-anti-joined with every run: keys that a run already decides (documents
   enough, and a doc_id at least as large) add nothing. The rest is written as a run of its
   own, bucketed and sorted by the hash, so that neither anti-join nor compaction shuffles a run.
   :data:`FANOUT` runs of a level are compacted into one of the next, so a table of n batches has
   about FANOUT x log n runs at any time.
3. The last compaction gives the decided keys; places of their lines meet them by the hash
   (a hot key is one row on that side, so the session can split the other), and each text
   gets its dropped places back. The texts are shuffled once, for this.

Results in special cases: a null or empty text is one empty line, which stays; null doc_ids count
as one document, smaller than all others, and rows of one doc_id as one document; a line that
stands twice in the document that keeps it stays twice; lines of white space alone have empty keys and
stay; texts of any length are read whole; an empty table gives an empty result. Extra columns
are ignored by :func:`report` and handed through by :func:`without_repeats`.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrid.llm.common import let, scratch, written

MIN_CHARS = 20
MIN_DOCS = 3
#: Batches that a whole table is fed in.
BATCHES = 4
#: Runs of a level that are compacted into one.
FANOUT = 2
SPACES = " \t\n\x0b\x0c\r"

_KEY = ["h1", "h2"]
_TEXT = ["doc_id", "t1", "t2"]


def _hash(value: Column) -> list[Column]:
    """128 bits as two columns' worth of expressions."""
    return [F.xxhash64(value), F.xxhash64(F.lit(2), value)]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), string.ascii_uppercase, string.ascii_lowercase)


def places(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, t1, t2, place, h1, h2): a row for each line whose key is long enough; t1, t2 tell the texts of one id apart."""
    # the text is hashed below the explode: above it, each line would hash the whole text again
    texts = docs.select("doc_id", *(h.alias(n) for h, n in zip(_hash(F.col("text")), _TEXT[1:])), F.transform(lines_of(F.col("text")), key_of).alias("keys"))
    rows = texts.select(*_TEXT, F.posexplode("keys").alias("place", "key"))
    return rows.where(F.length("key") >= min_chars).select(*_TEXT, "place", *(h.alias(n) for h, n in zip(_hash(F.col("key")), _KEY)))


class Runs:
    """Levelled sorted runs of (h1, h2, docs, top): a key's documents and the largest doc_id among them.

    A document must come in one batch only. Runs are bucketed tables of files in the shared
    folder; their names leave the catalogue with :meth:`close`.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.repartition(self.buckets, *_KEY).write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY)
         .option("path", scratch(self.spark, name)).saveAsTable(name))
        return name

    def _all(self) -> list[str]:
        return [n for level in self.levels for n in level]

    def add(self, batch: DataFrame) -> None:
        """A batch of (doc_id, h1, h2), any number of rows a line."""
        new = batch.groupBy(*_KEY).agg(F.count_distinct(F.struct("doc_id")).alias("docs"), F.max("doc_id").alias("top"))
        for name in self._all():
            run = self.spark.table(name).where(F.col("docs") >= self.min_docs).select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), F.col("top").alias("run_top"))
            decided = (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & (F.col("top").isNull() | (F.col("run_top") >= F.col("top")))
            new = new.join(run, decided, "left_anti")
        self._insert(0, self._write(new))

    def _insert(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(self._merged(self.levels[level]))
            self._forget(self.levels[level])
            self.levels[level] = []
            self._insert(level + 1, merged)

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs merged by their keys; two runs meet bucket by bucket. (A union would need an exchange: Spark 4.1 takes one of
        bucketed tables for bucketed and leaves it out.)"""
        rows = self.spark.table(names[0])
        for n in names[1:]:
            other = self.spark.table(n).withColumnsRenamed({"docs": "more", "top": "other"})
            rows = rows.join(other, _KEY, "full_outer").select(
                *_KEY, (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"), F.greatest("top", "other").alias("top"))
        return rows

    def decided(self) -> DataFrame:
        """(h1, h2, top) of the keys that enough documents hold, as a table of its own."""
        return written(self._merged(self._all()).where(F.col("docs") >= self.min_docs).select(*_KEY, "top"), "lines-decided")

    def _forget(self, names: list[str]) -> None:
        for n in names:
            self.spark.sql(f"DROP TABLE {n}")

    def close(self) -> None:
        self._forget(self._all())
        self.levels = []


def dropped(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, t1, t2, gone): the places of the lines that each text loses; texts that lose none are left out."""
    spark = docs.sparkSession
    rows = places(docs, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)))
    folder = scratch(spark, "line-places")
    rows.write.partitionBy("batch").parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    runs = Runs(spark, min_docs, fanout)
    for k in range(batches):
        runs.add(rows.where(F.col("batch") == k).select("doc_id", *_KEY))
    keys = runs.decided()
    runs.close()
    lost = rows.join(keys, _KEY).where(~F.col("doc_id").eqNullSafe(F.col("top")))
    return lost.groupBy(*_TEXT).agg(F.collect_set("place").alias("gone"))


def _marked(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with ``__gone``, the places of the lines to drop (null: none)."""
    gone = written(dropped(docs.select("doc_id", "text"), **how), "lines-gone").select(*(F.col(n).alias(f"__{n}") for n in [*_TEXT, "gone"]))
    t1, t2 = _hash(F.col("text"))
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (t1 == F.col("__t1")) & (t2 == F.col("__t2")), "left").drop("__doc_id", "__t1", "__t2")


def _kept(text: Column, gone: Column) -> Column:
    def left(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    return F.when(gone.isNull(), F.coalesce(text, F.lit(""))).otherwise(let(lines_of(text), left))


def without_repeats(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with the repeated lines cut from ``text``."""
    marked = _marked(docs, **how)
    return marked.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(_kept(F.col("text"), F.col("__gone")))).select(*docs.columns)


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what each text keeps."""
    marked = _marked(docs.select("doc_id", "text"), **how)
    return marked.select("doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
                         F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
                         F.sha2(_kept(F.col("text"), F.col("__gone")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (SELECT rowid AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
e AS (SELECT r, doc_id, unnest(w) AS line, unnest(range(len(w))) AS p FROM l),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
s AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'null')) >= 3),
m AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.top AS gone FROM k LEFT JOIN s ON s.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
