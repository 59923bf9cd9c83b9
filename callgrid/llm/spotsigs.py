"""SpotSigs fingerprints: chains of content words behind common-word anchors.

A text's words are its lower-cased runs of letters and digits. Each common word (an
anchor) opens a signature: the anchor and the next two content words (words that are not
common) among the twelve that follow; near the end of a text a chain may be shorter, but
holds one content word at least. The fingerprint is the set of the signatures' hashes in
order, as hexadecimal text; a text without any signature has one of all its words, and a
text without words has an empty fingerprint. Equal texts have equal fingerprints.

Two fingerprints are compared by the Jaccard likeness of their sets. The smaller set's
length over the larger's bounds it, so lengths are looked at first: in
:func:`similar_pairs` sets are partitioned by length and meet only where that bound
reaches the limit, through the signatures that are rarest over all documents.

Everything is DataFrame functions. Results in special cases: a null text is an empty one;
two empty fingerprints have likeness 1, an empty and another one 0; texts are read whole;
rows that repeat a doc_id follow each other by text; a null doc_id comes last; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callgrid.llm.common import let, written

#: The common words of four languages that serve as anchors.
ANCHORS = (
    "a an and are as at be but by for from had has have he in is it its not of on or she that the their this to was were which with you",
    "au aux avec ce dans des du elle en est et il la le les par pas pour qui que sur un une",
    "als auch auf aus bei das dem den der des die ein eine er es für im ist mit nicht sich sie und von zu",
    "al como con de del el ella en es esta la las lo los no para por que se su un una y",
)
COMMON = sorted({w for line in ANCHORS for w in line.split()})
#: Content words in a chain, and words behind the anchor that are searched for them.
CHAIN, REACH = 2, 12
#: Hex digits of a signature's hash.
DIGITS = 12
#: About so many documents share a bucket of neighbours; at most so many buckets.
BUCKET_ROWS, MAX_BUCKETS = 2000, 1000


def signatures(text: Column) -> Column:
    """Sorted distinct signature hashes of a text, as fixed-length hex strings."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))

    def of(ws: Column) -> Column:
        def chain(w: Column, i: Column) -> Column:
            content = F.slice(F.filter(F.slice(ws, i + 2, F.lit(REACH)), lambda x: ~x.isin(COMMON)), 1, CHAIN)
            return F.when(w.isin(COMMON), let(content, lambda c: F.when(F.size(c) > 0, F.concat_ws(" ", w, c))))

        return let(F.filter(F.transform(ws, chain), lambda x: x.isNotNull()), lambda found: (
            F.when(F.size(found) > 0, found).when(F.size(ws) > 0, F.array(F.concat(F.lit("all "), F.concat_ws(" ", ws))))
            .otherwise(F.array().cast("array<string>"))))

    return F.sort_array(F.array_distinct(F.transform(let(words, of), lambda s: F.substring(F.md5(s), 1, DIGITS))))


def fingerprint(sigs: Column) -> Column:
    """One text of a sorted signature set."""
    return F.array_join(sigs, "")


def likeness(a: Column, b: Column, prune_below: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets; where their lengths bound it below ``prune_below``, 0 without a comparison."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    exact = F.when(long == 0, F.lit(1.0)).when(short == 0, F.lit(0.0)).otherwise(common / (short + long - common))
    return F.when(short < F.lit(prune_below) * long, F.lit(0.0)).otherwise(exact)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text: the text of the next document in descending doc_id, and after the last that of the first.

    Documents are dealt to buckets of neighbouring ids, split at quantiles, in one shuffle.
    The first document of each bucket is dealt to the bucket above as well, where it
    follows the last one; the highest of all follows the lowest.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # one row; the number of split points is bounded
    count = docs.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("ids")).first()
    buckets = max(1, min(MAX_BUCKETS, count["ids"] // BUCKET_ROWS))
    splits = docs.agg(F.approx_percentile("doc_id", F.array(*[F.lit((i + 1) / buckets) for i in range(buckets - 1)]), F.lit(100 * buckets)).alias("s")).first()["s"] if buckets > 1 else []
    splits = sorted({s for s in splits or [] if s is not None})
    # bucket 0 has the highest ids; documents without an id come last
    number = F.when(F.col("doc_id").isNull(), F.lit(len(splits) + 1)).otherwise(
        F.lit(len(splits)) - (F.size(F.filter(F.array(*map(F.lit, splits)), lambda s: s < F.col("doc_id"))) if splits else F.lit(0)))
    order = F.struct(F.col("doc_id").isNotNull().alias("a"), "doc_id", F.xxhash64("text").alias("h"), F.md5("text").alias("t"))
    placed = docs.withColumns({"bucket": number, "place": order})
    heads = written(placed.groupBy("bucket").agg(F.max("place").alias("head")), "spot-heads")
    around = Window.orderBy("bucket")  # one row a bucket
    heads = heads.withColumn("above", F.lag("bucket").over(around)).withColumn("last", F.max("bucket").over(Window.partitionBy()))
    heads = heads.select(F.col("bucket").alias("own"), "head", F.coalesce("above", "last").alias("above"))
    heads = written(heads, "spot-bounds")
    dealt = placed.join(F.broadcast(heads), placed["bucket"] == heads["own"])  # MAX_BUCKETS + 1 rows at most
    extra = F.when(F.col("place") == F.col("head"), F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("guest")),
                                                          F.struct(F.col("above").alias("b"), F.lit(True).alias("guest"))))
    extra = extra.otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("guest"))))
    dealt = dealt.withColumn("to", F.explode(extra)).select("doc_id", "text", "place", "to.b", "to.guest")
    # a guest closes its bucket; of rows that are equal in all, each brings a guest, and the first serves
    following = F.lead("text").over(Window.partitionBy("b").orderBy("guest", F.col("place").desc()))
    return dealt.withColumn("next_text", following).where(~F.col("guest")).select("doc_id", "text", "next_text")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last half of code points replaced by the first as many of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(following, half))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness to each other and to the next text's."""
    rows = with_next(docs)
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "text", "next_text", edited(F.col("text"), F.col("next_text")).alias("edited"))
    sets = F.transform(F.array("text", "edited", "next_text"), lambda t: signatures(t))
    told = let(sets, lambda s: F.struct(
        fingerprint(F.get(s, F.lit(0))).alias("fingerprint"), fingerprint(F.get(s, F.lit(1))).alias("edited_fingerprint"),
        likeness(F.get(s, F.lit(0)), F.get(s, F.lit(1))).alias("near_edited"), likeness(F.get(s, F.lit(0)), F.get(s, F.lit(2))).alias("near_next")))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), told.alias("t")).select(
        "doc_id", "n_chars", "edited_sha256", "t.*")


def similar_pairs(docs: DataFrame, limit: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): doc_id and its class, equal fingerprints being one class; and pairs of classes (u, v, near) with
    likeness of ``limit`` or more.

    Two sets that alike share one of the rarest |set| - ceil(limit * |set|) + 1 signatures of each, so only those are
    joined on, and only within a length partition or between neighbouring ones: lengths of
    a pair differ at most by the factor ``limit``, and partition bounds grow by it.
    """
    sigs = docs.select("doc_id", signatures(F.col("text")).alias("sigs")).withColumn("class", F.sha2(fingerprint(F.col("sigs")), 256))
    members = written(sigs.select("doc_id", "class"), "spot-members")
    sets = written(sigs.where(F.size("sigs") > 0).groupBy("class").agg(F.first("sigs").alias("sigs")), "spot-sets")
    one = sets.select("class", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    counted = one.join(one.groupBy("sig").agg(F.count(F.lit(1)).alias("seen")), "sig").where("seen > 1")
    ranked = counted.withColumn("k", F.row_number().over(Window.partitionBy("class").orderBy("seen", "sig")))
    # signatures seen once are the rarest of all and match nothing: they fill the front of the prefix
    alone = sets.select("class", F.size("sigs").alias("all")).join(counted.groupBy("class").agg(F.count(F.lit(1)).alias("shared")), "class")
    prefix = ranked.join(alone, "class").where(F.col("k") + F.col("all") - F.col("shared") <= F.col("n") - F.ceil(F.lit(limit) * F.col("n")) + 1)
    part = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / limit)))
    left = prefix.select(F.col("class").alias("u"), F.col("n").alias("nu"), "sig", F.explode(F.array(part, part + 1)).alias("part"))
    right = prefix.select(F.col("class").alias("v"), F.col("n").alias("nv"), "sig", part.alias("part"))
    fits = (F.col("nu") <= F.col("nv")) & (F.col("nu") >= F.lit(limit) * F.col("nv")) & ((F.col("nu") < F.col("nv")) | (F.col("u") < F.col("v")))
    found = left.join(right, ["sig", "part"]).where(fits).select("u", "v").distinct()
    su, sv = sets.select(F.col("class").alias("u"), F.col("sigs").alias("su")), sets.select(F.col("class").alias("v"), F.col("sigs").alias("sv"))
    near = found.join(su, "u").join(sv, "v").select("u", "v", likeness(F.col("su"), F.col("sv"), limit).alias("near")).where(F.col("near") >= limit)
    return members, near
