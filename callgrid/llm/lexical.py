"""Ranked lexical search: an Aho-Corasick scan of the documents for all terms of the items.

There is no index of the documents. The items' terms, each guarded by a space on both sides, make
one automaton a task; a text is brought to its terms with single spaces' worth of guards by one
byte table (A-Z lower-cased, every other byte that is no term character to a space), and each output of the automaton
is one occurrence of one term. Postings map a term to the items that hold it.

1. The first scan counts documents, their terms, and the documents of each term; a task
   returns one row a term, and Spark sums them.
2. The weights follow on the driver, a number a term.
3. The second scan scores whole texts and keeps the best :data:`TOP` of each item in each task;
   a window over these ranks them.

The items are a stated query set, read in blocks of at most :data:`BLOCK_TERMS` distinct terms and
:data:`BLOCK_ITEMS` items (or one item): that bounds what is sent to tasks and what they hold, however many items there
are. A task holds a block's automaton, TOP rows an item, and one text at a time beside its batch.

Results in special cases: a null text, or one without terms, is no document to the counts and is
never found; an item without terms finds nothing; equal items each get their list; rows that
repeat a doc_id count and rank as documents of their own; a null doc_id comes after all others of
its score; documents with equal scores are cut at the last rank by doc_id; empty tables give an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOP = 50
BLOCK_TERMS = 200_000
BLOCK_ITEMS = 2_000
#: Of what a matrix of scores holds at a time, and of candidates before a task cuts them to the best.
CELLS, PENDING = 1 << 19, 1 << 18

_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Byte for byte: term characters (UTF-8's upper half among them) stay, A-Z are lower-cased, the rest are spaces.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text, in order."""
    return (text or "").encode("utf-8").translate(_BYTES).split()


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """(item number, item_id, distinct terms) of every item, in blocks; items come one partition at a time."""
    block, held = [], set()
    for n, row in enumerate(items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator()):
        terms = sorted(set(terms_of(row.text)))
        if block and (len(block) >= BLOCK_ITEMS or len(held | set(terms)) > BLOCK_TERMS):
            yield block
            block, held = [], set()
        block.append((n, row.item_id, terms))
        held.update(terms)
    if block:
        yield block


class _Automaton:
    """Outputs are numbers of terms. Bytes stand as Latin-1 characters, so that a text is never decoded twice."""

    def __init__(self, terms: list[bytes]):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for n, t in enumerate(terms):
            self.machine.add_word(f" {t.decode('latin-1')} ", n)
        self.machine.make_automaton()

    def count(self, text: str | None) -> tuple[int, list[int]]:
        """Terms of the text with repeats, and the number of each found term, once an occurrence."""
        guarded = b" %b " % (text or "").encode("utf-8").translate(_BYTES)
        return len(guarded.split()), [n for _, n in self.machine.iter(guarded.decode("latin-1"))]


def _totals(docs: DataFrame, terms) -> tuple[int, int, list[int]]:
    """Documents with a term, all their terms, and the documents of each term of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        known = terms.value
        automaton = _Automaton(known)
        sums = np.zeros(len(known) + 2, np.int64)
        for b in batches:
            for t in b.column("text"):
                n, found = automaton.count(t.as_py())
                if n:
                    sums[-2:] += (1, n)
                    sums[list(set(found))] += 1
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["term", "n"])

    got = dict(docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    size = len(terms.value)
    return got.get(size, 0), got.get(size + 1, 0), [got.get(n, 0) for n in range(size)]


def _best(rows: list, top: int) -> list:
    """Columns (item, score, no id, doc_id) cut to the ``top`` best rows of each item."""
    import numpy as np

    item, score, null, doc = (np.concatenate(c) for c in zip(*rows, strict=True))
    order = np.lexsort((doc, null, -score, item))
    item = item[order]
    first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.empty(0, np.int64)
    rank = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
    order = order[rank < top]
    return [(item[rank < top], score[order], null[order], doc[order])]


def _scored(docs: DataFrame, model, top: int) -> DataFrame:
    """(item, doc_id, score) of the best ``top`` documents of each item in each task."""
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        terms, weights, postings, n_docs, n_terms, n_items = model.value
        automaton, weights = _Automaton(terms), np.array(weights, np.int64)
        postings = [np.array(p, np.int64) for p in postings]
        lengths = np.array([len(p) for p in postings])
        step = max(1, CELLS // n_items)
        least = np.ones(n_items, np.int64)  # a score must reach it to be among the best
        held, pending = [], 0
        for b in batches:
            ids = b.column("doc_id")
            null = np.array(ids.is_null())
            ids = np.array(ids.fill_null(0))
            for start in range(0, b.num_rows, step):
                part = b.column("text").slice(start, step)
                scores = np.zeros((len(part), n_items), np.int64)
                for d, t in enumerate(part):
                    n, found = automaton.count(t.as_py())
                    if not found:
                        continue
                    at, tf = np.unique(found, return_counts=True)
                    m = 100 - 50 + (50 * n * n_docs) // n_terms
                    value = weights[at] * ((1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 20 * m))
                    np.add.at(scores[d], np.concatenate([postings[x] for x in at]), np.repeat(value, lengths[at]))
                d, item = np.nonzero(scores >= least)
                held.append((item, scores[d, item], null[start + d], ids[start + d]))
                pending += len(d)
                if pending > PENDING:
                    held = _best(held, top)
                    item, score = held[0][:2]
                    full = np.bincount(item, minlength=n_items) >= top
                    low = np.full(n_items, np.iinfo(np.int64).max)
                    np.minimum.at(low, item, score)
                    least = np.where(full, low, 1)
                    pending = 0
        if held:
            item, score, null, ids = _best(held, top)[0]
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=null), pa.array(score)], names=schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def weight(n_docs: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * with_term + 1)))


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of every item."""
    spark: SparkSession = docs.sparkSession
    found = None
    for block in _blocks(items):
        terms = sorted({t for _, _, own in block for t in own})
        if not terms:
            continue
        n_docs, n_terms, with_term = _totals(docs, spark.sparkContext.broadcast(terms))
        if not n_docs:
            continue
        number = {t: n for n, t in enumerate(terms)}
        postings: list[list[int]] = [[] for _ in terms]
        for k, (_, _, own) in enumerate(block):
            for t in own:
                postings[number[t]].append(k)
        model = spark.sparkContext.broadcast((terms, [weight(n_docs, x) for x in with_term], postings, n_docs, n_terms, len(block)))
        best = _scored(docs, model, top)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, i) for k, (_, i, _) in enumerate(block)], T.StructType([T.StructField("k", T.LongType()), T.StructField("item_id", items.schema["item_id"].dataType)]))
        best = best.join(names, best["item"] == names["k"]).select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.union(best)
    if found is None:
        found = spark.createDataFrame([], T.StructType([T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("rank", T.IntegerType()),
                                                        T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return found


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM t WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS i, item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
f AS (SELECT d, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM t)
      WHERE term IN (SELECT term FROM i) GROUP BY ALL),
g AS (SELECT term, count(*) AS df FROM f GROUP BY term),
v AS (SELECT d, doc_id, f.term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l)))) AS s
      FROM f JOIN g USING (term), c),
p AS (SELECT i, item_id, d, doc_id, CAST(sum(s) AS BIGINT) AS score FROM v JOIN i USING (term) GROUP BY ALL HAVING sum(s) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p) WHERE rank <= 50
"""
