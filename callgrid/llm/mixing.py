"""Mixing sources to target weights by capped water-filling, with seeded repetitions.

1. Words are counted for each (source, bucket), where a bucket is the prefix of a seeded
   hash of doc_id; partial sums leave each task, so a hot source costs one row a bucket.
2. Water-filling over one row a source: sources are taken in order of cap / weight; each
   is clamped at ``max_epochs`` times its size while its cap lies below the level that the
   rest would get, and what is left is shared by weight among the others.
3. A source's target is some whole repetitions of all its documents and a fraction of one
   more. The fraction goes to the documents first in hash order: running sums over the
   bucket totals find the bucket in which the fraction ends, and only that bucket's
   documents are ordered to find the last hash that is still taken.
4. Each document then decides by itself from its source's row; no text is shuffled.

Results in special cases: a null source is a source of its own, last in order; null or
empty texts have size 0 and are taken as often as their source's whole repetitions; rows
that repeat a doc_id (or have none) share a hash and are taken alike; a source without
words has target 0 and nothing of it is taken; an empty table gives an empty result.
Extra columns are handed through by :func:`mix` and ignored by :func:`plan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callgrid.llm.common import words_of, written

#: The mix holds this share of all words.
SHARE = 1.5
#: No source is repeated more often than this.
MAX_EPOCHS = 2
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SEED = "mix"
#: Hex digits of the hash that name a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3

_KEY = ("__no_source", "__source")


def _keyed(df: DataFrame) -> DataFrame:
    """Non-null join keys for the source, so that a null source joins like any other."""
    return df.withColumns({"__no_source": F.col("source").isNull(), "__source": F.coalesce("source", F.lit(""))})


def order_hash(doc_id: Column, seed: str = SEED) -> Column:
    """Seeded hash that orders the documents of a source."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` with a weight: the given ones in turn, in code point order, null last. One row a source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))


def fill(sources: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight) with ``target``: weighted shares of ``share`` times all words, clamped at
    ``max_epochs`` times the source's size. The windows run over one row a source."""
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, onwards = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    capped = sources.withColumn("cap", F.lit(max_epochs) * F.col("source_size")).withColumn(
        "ratio", F.col("cap").cast("double") / F.col("weight"))
    leveled = capped.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything)).withColumn(
        "level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onwards))
    clamped = leveled.withColumn("clamped", F.col("ratio") <= F.col("level"))
    rest = F.col("budget") - F.sum(F.when(F.col("clamped"), F.col("cap")).otherwise(0)).over(everything)
    free = F.sum(F.when(F.col("clamped"), 0).otherwise(F.col("weight"))).over(everything)
    return clamped.withColumns({"rest": rest, "free": free}).select(
        "source", "source_size", "weight",
        F.when(F.col("clamped"), F.col("cap").cast("double"))
        .otherwise(F.col("rest") / F.when(F.col("free") > 0, F.col("free")) * F.col("weight")).alias("target"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
         seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(sized, sources): doc_id, source, size and hash of every document; and for each source its size,
    target, whole repetitions and the last hash of the fractional one (null: none). Both are written tables."""
    sized = written(docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"),
                                order_hash(F.col("doc_id"), seed).alias("hash")), "mix-sizes")
    bucket = F.substring("hash", 1, BUCKET_DIGITS).alias("bucket")
    totals = written(sized.groupBy("source", bucket).agg(F.sum("size").alias("words")), "mix-buckets")
    sources = totals.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = fill(cyclic_weights(sources, weights), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    sources = written(_keyed(sources.withColumn("whole", whole)).withColumn(
        "extra", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")

    # the first bucket whose running sum goes beyond the fraction
    key = list(_KEY)
    running = Window.partitionBy(*key).orderBy("bucket")
    scan = _keyed(totals).withColumn("end", F.sum("words").over(running)).withColumn("start", F.col("end") - F.col("words"))
    reach = sources.select(*key, "extra")
    scan = scan.join(reach, key).withColumn("over", F.col("end") > F.col("extra"))
    last = scan.where("over").groupBy(*key, "extra").agg(F.min(F.struct("bucket", "start")).alias("cut"))
    last = written(last.select(*key, "extra", "cut.bucket", "cut.start"), "mix-cuts")
    # within it, documents are taken while more than half of them lies below the fraction
    own = _keyed(sized.withColumn("bucket", bucket)).join(last, [*key, "bucket"]).groupBy(*key, "bucket", "start", "extra", "hash").agg(
        F.sum("size").alias("words"))
    inside = own.withColumn("end", F.col("start") + F.sum("words").over(Window.partitionBy(*key).orderBy("hash")))
    taken = inside.where(2 * F.col("end") - F.col("words") <= 2 * F.col("extra")).groupBy(*key).agg(F.max("hash").alias("last_hash"))
    cuts = last.join(taken, key, "left").select(*key, F.lit(True).alias("has_cut"), "bucket", "last_hash")
    out = sources.join(cuts, key, "left")
    # buckets before the cut are taken whole; a source without a cut bucket has its fraction beyond its last word
    until = F.when(F.col("extra") <= 0, None).when(F.col("has_cut").isNull(), F.lit("~")).otherwise(F.coalesce("last_hash", "bucket"))
    return sized, written(out.select(*key, "source_size", "weight", "target", "whole", until.alias("last_hash")), "mix-sources")


def _repeats(doc_hash: Column) -> Column:
    # a bucket's prefix sorts before all hashes in it, so it takes the earlier buckets alone
    return F.col("whole") + F.coalesce((doc_hash <= F.col("last_hash")).cast("int"), F.lit(0))


def allot(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, repeats and taken (size times repeats) of every document."""
    sized, sources = plan(docs, **how)
    # one row a source: broadcast only if the written table is below the session's threshold
    out = _keyed(sized).join(sources, list(_KEY)).withColumn("repeats", _repeats(F.col("hash")))
    return out.select("doc_id", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: each document as often as the mix repeats it, with its columns as they came."""
    _, sources = plan(docs, **how)
    keys = {"__no_source": F.col("source").isNull(), "__source": F.coalesce("source", F.lit(""))}
    repeats = sources.select(*_KEY, F.struct("whole", "last_hash").alias("__mix"))
    joined = docs.withColumns(keys).join(repeats, list(_KEY))
    taken = F.col("__mix.whole") + F.coalesce((order_hash(docs["doc_id"], how.get("seed", SEED)) <= F.col("__mix.last_hash")).cast("int"), F.lit(0))
    return joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), taken))).drop("__copy", "__mix", *_KEY)


ORACLE = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k FROM d GROUP BY source),
w AS (SELECT *, CASE k WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap,
             CAST(2 * source_size AS DOUBLE) / (CASE k WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END) AS ratio FROM s),
b AS (SELECT *, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget,
             CAST(coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before,
             CAST(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS onwards FROM w),
c AS (SELECT *, ratio <= (budget - before) / onwards AS clamped FROM b),
f AS (SELECT *, budget - CAST(sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER () AS DOUBLE) AS rest,
             CAST(sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER () AS DOUBLE) AS free FROM c),
t AS (SELECT source, source_size, CASE WHEN clamped THEN CAST(cap AS DOUBLE) ELSE rest / free * weight END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
g AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
r AS (SELECT source, h, words, sum(words) OVER (PARTITION BY source ORDER BY h) AS run FROM g),
x AS (SELECT r.source, r.h, CAST(2 * run - words AS DOUBLE) <= 2 * (e.target - CAST(e.whole * e.source_size AS DOUBLE))
             AND e.target - CAST(e.whole * e.source_size AS DOUBLE) > 0 AS extra
      FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source)
SELECT d.doc_id, d.size, e.source_size, e.target, CAST(e.whole + CAST(x.extra AS INT) AS INT) AS repeats,
       CAST(d.size * (e.whole + CAST(x.extra AS INT)) AS BIGINT) AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h
"""
