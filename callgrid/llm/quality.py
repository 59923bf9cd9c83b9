"""Quality rules: base counts of a text, and a hashed n-gram likelihood ratio against trusted text.

Everything is DataFrame functions; a row is judged by itself, so only text hashes, the
n-gram counts (one row a bucket) and texts that have copies are shuffled, each text once a task.

The ratio compares two multinomials over hashed word 1- and 2-grams: ``target``, from a
bounded sample of documents that ``labels.quality`` marks 1, and ``raw``, from every
document; both count a text once, however many copies it has. A text's ratio is the mean
over its n-grams of log(target / raw): near 0 for text like the trusted one, far below
for text whose n-grams occur only outside it.

Results in special cases: null or empty texts have 0 words and fail the base rules; a
text of any length is read whole; equal texts get equal results whatever their ids;
an empty table gives an empty result; without trusted rows every ratio is 0 and the base
rules alone decide. Only the columns named are read, extra ones are ignored (or, in
:func:`keep_good`, handed through).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrid.llm.common import WORD, let, words_of, written

#: Least size of the hashed n-gram space.
BUCKETS = 1 << 16
#: The space grows with the trusted sample, to a power of 2: at most so many of its n-grams a bucket on average.
GRAMS_A_BUCKET = 32
#: At most so many trusted documents are counted for the target (those first by hash of doc_id).
TARGET_ROWS = 20_000
#: Texts with a mean log ratio below this (in nats an n-gram) are rejected.
THRESHOLD = -0.1
#: Weights are kept as whole micro-nats: sums are exact in any order.
MICRO = 1_000_000
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8  # 1, 2, 4, 8: hashes of two halves are joined
#: Weights are put in order in blocks of so many buckets; the one row of all of them is joined from whole blocks.
BLOCK = 4096
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class RatioModel:
    """Log ratio of each bucket in micro-nats: ``table`` has one row with the array ``weights`` (ints, in order of bucket)."""
    table: DataFrame
    buckets: int

    @property
    def weights(self) -> str:
        """All weights as one comma-separated text, brought to the driver; for looking at small models."""
        return ",".join(map(str, self.table.first()["weights"]))


def _joined(hashes: Column, step: int) -> Column:
    """Hash of each element and the one ``step`` further on."""
    return F.zip_with(hashes, F.slice(hashes, F.lit(step + 1), F.greatest(F.size(hashes) - step, F.lit(0))),
                      lambda a, b: F.xxhash64(a, b))


def _whole(hashes: Column, length: int) -> Column:
    """The hashes of n-grams that lie inside the text (zip_with pads the last ones with nulls)."""
    return F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - length + 1, F.lit(0)))


def _space(n_grams: int) -> int:
    """Buckets for a target of so many n-grams: a large table fills the space no more than a small one."""
    return max(BUCKETS, 1 << max(0, -(-n_grams // GRAMS_A_BUCKET) - 1).bit_length())


def _once(seen: DataFrame) -> DataFrame:
    """(text, is_target) of each distinct text. Texts without a copy, told by their hash, stay where they are."""
    copied = seen.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    # a table of its own: its real size tells the planner whether the texts need a shuffle
    copied = written(copied, "quality-copied")
    single = seen.join(copied, "h", "left_anti").select("text", "is_target")
    return single.union(seen.join(copied, "h", "left_semi").groupBy("text").agg(F.max("is_target").alias("is_target")))


def fit_ratio(docs: DataFrame, labels: DataFrame, buckets: int | None = None, target_rows: int = TARGET_ROWS) -> RatioModel:
    """Count n-grams of all distinct texts and of the trusted ones in one pass, a row a bucket; the weights become a written table.

    ``labels`` has (doc_id, quality). Only the trusted sample is bounded, by
    ``target_rows``; its ids are broadcast. Without ``buckets`` the space follows the
    n-grams of the trusted sample, counted beforehand.
    """
    trusted = (labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
               .orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows))
    trusted = trusted.select(F.col("doc_id").alias("trusted_id"))
    seen = docs.select("doc_id", "text").join(F.broadcast(trusted), F.col("doc_id") == F.col("trusted_id"), "left")
    seen = seen.select("text", F.xxhash64("text").alias("h"), F.col("trusted_id").isNotNull().cast("long").alias("is_target"))
    if buckets is None:
        n = F.greatest(2 * F.size(words_of(F.col("text"))) - 1, F.lit(0))
        sizes = seen.where("is_target = 1").select("h", n.alias("n")).distinct()
        buckets = _space(sizes.agg(F.sum("n")).first()[0] or 0)
    hashes = let(F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)),
                 lambda one: F.concat(one, _whole(_joined(one, 1), 2)))
    grams = _once(seen).select(F.explode(hashes).alias("gram"), "is_target")
    grams = grams.select(F.pmod("gram", F.lit(buckets)).alias("bucket"), "is_target")
    counts = written(grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("is_target").alias("t")), "quality-counts")
    total = counts.agg(F.sum("n").alias("n"), F.sum("t").alias("t")).first()
    if not total["t"]:
        weight = F.lit(0)
    else:  # every bucket counts once more than it was found
        share = lambda found, of: F.ln((F.coalesce(F.col(found), F.lit(0)) + 1) / F.lit(float(of + buckets)))
        weight = F.round(MICRO * (share("t", total["t"]) - share("n", total["n"])))
    every = docs.sparkSession.range(buckets).join(counts, F.col("id") == F.col("bucket"), "left")
    every = every.select("id", F.floor(F.col("id") / BLOCK).alias("block"), weight.cast("int").alias("weight"))
    in_order = lambda at, value: F.transform(F.sort_array(F.collect_list(F.struct(at, value))), lambda x: x[value])
    blocks = every.groupBy("block").agg(in_order("id", "weight").alias("weights"))
    return RatioModel(written(blocks.agg(F.flatten(in_order("block", "weights")).alias("weights")), "quality-weights"), buckets)


def _repeated_words(windows: Column) -> Column:
    """Words that lie in windows of 8 words found twice or more, given the hash of each window."""

    def covered(at: Column) -> Column:
        own = F.transform(at, lambda p, i: F.when(i + 1 < F.size(at), F.least(F.lit(REPEAT_WINDOW), F.get(at, i + 1) - p))
                          .otherwise(F.lit(REPEAT_WINDOW)))
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(by_hash: Column) -> Column:
        twice = F.filter(by_hash, lambda x, i: ((i > 0) & (F.get(by_hash, i - 1)["h"] == x["h"]))
                         | ((i + 1 < F.size(by_hash)) & (F.get(by_hash, i + 1)["h"] == x["h"])))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def of(hashes: Column) -> Column:
        sort = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # most texts repeat nothing: the sort is only for those that do
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(sort, repeated))

    return let(windows, of)


def quality(text: Column, weights: Column, buckets: int, threshold: float = THRESHOLD) -> Column:
    """Struct of the base counts, ``base_failed``, ``ratio`` and ``kept`` of one text, by the array of weights of that many buckets."""
    return let(weights, lambda given: _judge(F.coalesce(text, F.lit("")), given, buckets, threshold))


def _judge(text: Column, weights: Column, buckets: int, threshold: float) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    zero = F.lit(0).cast("long")

    def judged(words: Column) -> Column:
        return let(F.transform(words, lambda w: F.xxhash64(w)), lambda one: let(_joined(one, 1), lambda two: of(words, one, two)))

    def of(words: Column, one: Column, two: Column) -> Column:
        n = F.size(words).cast("long")
        weigh = lambda grams: F.aggregate(grams, zero, lambda a, h: a + F.get(weights, F.pmod(h, F.lit(buckets)).cast("int")))
        counts = F.struct(
            n.alias("n_words"),
            F.aggregate(words, zero, lambda a, w: a + F.length(w)).alias("word_chars"),
            F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            _repeated_words(_whole(let(_joined(two, 2), lambda four: _joined(four, 4)), REPEAT_WINDOW)).alias("n_repeat_words"),
            (weigh(F.concat(one, _whole(two, 2))) / (F.lit(MICRO) * F.greatest(2 * n - 1, F.lit(1)))).alias("ratio"))
        return let(counts, verdict)

    def verdict(c: Column) -> Column:
        failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEATED_PERCENT * c["n_words"])
        return F.struct(c["n_words"].alias("n_words"), c["word_chars"].alias("word_chars"), c["n_symbols"].alias("n_symbols"),
                        c["n_dup_lines"].alias("n_dup_lines"), c["n_repeat_words"].alias("n_repeat_words"),
                        failed.alias("base_failed"), c["ratio"].alias("ratio"),
                        (~failed & (c["ratio"] >= threshold)).alias("kept"))

    return let(words_of(text), judged)


def _with_quality(docs: DataFrame, model: RatioModel) -> tuple[DataFrame, str]:
    """``docs`` and :func:`quality` of each row, in a column of the name returned.

    The weights are the result of a subquery, which goes to the tasks as it is; a literal would be copied and printed
    in each form of the plan. Functions with lambdas take no subquery, so it is a column first. That column is named once,
    so the optimiser puts the subquery in its place and no row carries the weights.
    """
    weights, judged = f"weights_{uuid.uuid4().hex}", f"quality_{uuid.uuid4().hex}"
    found = docs.withColumn(weights, model.table.scalar())
    return found.withColumn(judged, quality(F.col("text"), F.col(weights), model.buckets)).drop(weights), judged


def score(docs: DataFrame, labels: DataFrame, **fit) -> DataFrame:
    """doc_id, the base counts, ``base_failed``, ``ratio`` and ``kept`` of every document."""
    found, judged = _with_quality(docs.select("doc_id", "text"), fit_ratio(docs, labels, **fit))
    return found.select("doc_id", F.col(judged).alias("q")).select("doc_id", "q.*")


def keep_good(docs: DataFrame, labels: DataFrame, **fit) -> DataFrame:
    """The documents that pass, with their columns as they came."""
    found, judged = _with_quality(docs, fit_ratio(docs, labels, **fit))
    return found.where(F.col(judged)["kept"]).drop(judged)
