"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

from callgrid.llm import bpe, htmltext, mixing, neardup, quality, spotsigs, suffix, tokencount, toxicity, warc
from callgrid.llm.common import ship_code

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words long"
LONG = " ".join(f"w{i % 977} x{i % 31} y{i}" for i in range(12_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 1, None, 7), (2, None, "en", None, None, None, None), (3, "", None, "a", 0, True, 0),
    (4, LONG, "en", "b", 2, None, None), (5, LONG, "en", "b", 2, None, None), (6, " \n\t ", "en", "b", 4, None, None),
    (7, "alpha beta gamma delta epsilon zeta", "en", "a", 1, None, 7), (7, "alpha beta gamma delta epsilon zeta", "en", "a", 1, None, 7),
    (None, "no id here at all in this row", "en", "a", 1, None, 7), (8, "Ünï cödé " * 40, "de", "c", 1, None, 7),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship_code(spark)
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (8, 1, 0), (4, 0, 1), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_quality(spark, docs, labels):
    got = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert got[2].n_words == got[3].n_words == got[6].n_words == 0 and got[2].base_failed and not got[3].kept
    assert got[4].n_words == 36_000 and (got[4].n_words, got[4].ratio) == (got[5].n_words, got[5].ratio)
    assert got[8].n_repeat_words == 80 and got[8].base_failed
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert quality.score(docs.limit(0), labels).count() == 0
    assert all(r.ratio == 0 for r in quality.score(docs, labels.limit(0)).collect())


def test_weights_are_in_no_plan_and_no_row(spark, docs, labels, capsys):
    for found in (quality.score(docs, labels), quality.keep_good(docs, labels)):
        found.explain(True)  # one weight for each of 65,536 buckets
        plans = capsys.readouterr().out
        assert "ubquery" in plans and len(plans) < quality.BUCKETS
        assert "AS weights_" in plans and "AS weights_" not in plans.partition("== Optimized Logical Plan ==")[2]


def test_junk_is_rejected_however_large_the_table(spark):
    junk = F.pmod("doc_id", F.lit(20)) == 0
    word = lambda j: F.concat(F.pmod(F.xxhash64("doc_id", j), F.lit(50_000)).cast("string"), F.when(junk, "%%%").otherwise("ab"))
    large = spark.range(6000).withColumnRenamed("id", "doc_id").withColumn("text", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200)), word), " "))
    for docs in (large.where("doc_id < 300"), large):
        labels = docs.where(~junk).select("doc_id", F.lit(1).alias("quality"))
        got = quality.score(docs, labels).groupBy(junk.alias("junk"), "kept").count().collect()
        assert {(r.junk, r.kept) for r in got if r["count"] > 0.05 * docs.count()} == {(False, True)}
        assert not any(r.kept for r in got if r.junk)


def test_verdict_does_not_follow_copies(spark):
    junk = F.pmod("doc_id", F.lit(20)) == 0
    word = lambda j: F.concat(F.pmod(F.xxhash64("doc_id", j), F.lit(2000)).cast("string"), F.when(junk & (j % 2 == 0), "%%%").otherwise("ab"))
    docs = spark.range(600).withColumnRenamed("id", "doc_id").withColumn("text", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200)), word), " "))
    labels = docs.where(~junk & (F.col("doc_id") % 2 == 0)).select("doc_id", F.lit(1).alias("quality"))
    ratio = lambda table: {r.doc_id: (r.kept, r.ratio) for r in quality.score(table, labels).where("doc_id >= 0").collect()}
    want = ratio(docs)
    assert not any(k for i, (k, _) in want.items() if i % 20 == 0)
    for copied in (0, 1):  # a junk text, and a clean one without a label
        copies = spark.range(300).select((-1 - F.col("id")).alias("doc_id")).crossJoin(docs.where(F.col("doc_id") == copied).select("text"))
        assert ratio(docs.unionByName(copies)) == want


def test_near_duplicates(spark, docs):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.classes(docs).collect()]
    by = {r[0]: r for r in got}
    assert by[1] == (1, 2, 1, True) and got.count((7, 2, 1, False)) == 2
    assert by[4][2:] == (4, True) and by[5][2:] == (4, False)
    assert by[2] == (2, 0, 2, True) and by[6] == (6, 0, 6, True) and by[None][1] == 4
    left = neardup.keep_first(docs)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 6, 8]
    assert neardup.classes(docs.limit(0)).count() == 0
    # ids that are missing or repeated by other texts: each row stays or goes with its own class
    odd = spark.createDataFrame([(1, "one two three four five six"), (None, "one two three four five six"), (None, "seven eight nine ten eleven"),
                                 (5, "One two three FOUR five six"), (5, "twelve words that are like nothing else in this table at all")], "doc_id long, text string")
    assert sorted(str(r.doc_id) + r.text[:3] for r in neardup.keep_first(odd).collect()) == ["1one", "5twe", "Nonesev"]


def test_repeated_passages(spark, docs):
    got = {r.doc_id: r for r in suffix.repeats(docs).collect()}
    assert got[4].repeated_words == 0 and got[5].repeated_words == got[5].n_words == 36_000
    assert got[7].repeated_words == 0 and got[2].n_words == 0  # too short for a window
    assert got[8].n_words == 80 and [(s.start, s.end) for s in got[8].spans] == [(2, 80)]  # a text may repeat itself
    cut = {r.doc_id: r for r in suffix.without_repeats(docs).collect()}
    assert cut[5].text == "" and cut[5].n_chars == 0 and cut[4].text == LONG and cut[2].text is None
    assert cut[8].text.split() == ["Ünï", "cödé"] and cut[8].n_words == 7
    assert suffix.repeats(docs.limit(0)).count() == 0


def test_mixing(spark, docs):
    got = mixing.allot(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert {r.size for r in got if r.doc_id in (2, 3, 6)} == {0}
    assert len({r.taken for r in got if r.doc_id == 7}) == 1  # repeated rows are taken alike
    again = mixing.allot(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.repeats for r in got)
    assert mixing.allot(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_bpe(spark, docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    texts = {r[0]: r[1] or "" for r in ROWS}
    for r in bpe.encode(docs, WORDS).select("doc_id", "ids").collect():
        assert list(r.ids) == tok.encode(texts[r.doc_id], add_special_tokens=False).ids
    back = bpe.decode(bpe.encode(docs, WORDS), WORDS)
    assert {r.doc_id: r.decoded for r in back.collect()} == {i: tok.decode(tok.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for i, t in texts.items()}
    assert bpe.round_trip(docs.limit(0), WORDS).count() == 0


def test_token_counts(spark, docs):
    import tiktoken  # noqa: F401
    enc = tokencount.encoding(RANKS, public_tokenizers.PATTERN)
    want = sorted((r[0] or 0, len(enc.encode_ordinary(r[1] or ""))) for r in ROWS)
    for block in (1 << 20, 64):
        got = tokencount.count(docs, RANKS, public_tokenizers.PATTERN, block_bytes=block).collect()
        assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == want
    assert tokencount.count(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_files_without_a_last_separator(spark, tmp_path):
    import numpy as np
    sep = tokencount.SEPARATOR
    np.array([1, 2, sep, sep, 3, 4, 5, sep, 6], "<u2").tofile(tmp_path / "a.bin")
    np.array([7] * 9, "<u2").tofile(tmp_path / "b.bin")
    (tmp_path / "c.bin").write_bytes(b"")
    files = tokencount.files_in(spark, str(tmp_path))
    for block in (2, 4, 6, 1 << 20):
        got = sorted((r.file, r.ordinal, r.start, r.n_tokens, r.ended) for r in tokencount.scan(files, str(tmp_path), block_bytes=block).collect())
        assert got == [("a.bin", 0, 0, 2, True), ("a.bin", 1, 3, 0, True), ("a.bin", 2, 4, 3, True), ("a.bin", 3, 8, 1, False), ("b.bin", 0, 0, 9, False)]
    (tmp_path / "d.bin").write_bytes(b"xyz")
    with pytest.raises(Exception, match="whole number of ids"):
        tokencount.scan(tokencount.files_in(spark, str(tmp_path)), str(tmp_path)).collect()


def test_spot_signatures(spark, docs):
    got = spotsigs.compare_edits(docs.where("doc_id IS NOT NULL")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 9 and by[2].fingerprint == "" and by[4].fingerprint == by[5].fingerprint
    assert by[3].near_next == 1.0  # the next document is null: both are empty
    assert by[5].near_next == 1.0 and by[4].n_chars == len(LONG)
    assert spotsigs.compare_edits(docs.limit(0)).count() == 0


def test_spot_pairs_agree_with_brute_force(spark):
    base = "the quick fox of winter was seen by the river and the old mill in a quiet town on the hill with no light"
    texts = [base, base + " at night", base.replace("fox", "cat"), "the sea and the wind of the north", None, base]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members, pairs = spotsigs.similar_pairs(docs, 0.6)
    name = {r["class"]: r.doc_id for r in members.orderBy(F.desc("doc_id")).collect()}
    sigs = {r.doc_id: set(r.s) for r in docs.select("doc_id", spotsigs.signatures(F.col("text")).alias("s")).collect()}
    want = {(a, b) for a in range(5) for b in range(a + 1, 5) if sigs[a] and sigs[b] and len(sigs[a] & sigs[b]) >= 0.6 * len(sigs[a] | sigs[b])}
    assert {tuple(sorted((name[r.u], name[r.v]))) for r in pairs.collect()} == want and want


def test_toxicity(spark, docs, labels):
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert got[2].score == got[3].score == got[6].score and got[4].score == got[5].score
    assert not got[None].held_out and all(0 <= r.score <= 1 for r in got.values())
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_pages(spark):
    ship_code(spark)
    html = "<html><body><nav><a href=x>Menu &amp; more</a></nav><article><h1>T&eacute;st</h1><p>One  two\n three.<p>Four <b>fi</b>ve</article><footer>End"
    rows = [(1, "http://a.b/c", html, "x"), (2, None, None, "x"), (3, "http://a.b/d", "", "x"), (4, "http://a.b/e", html, "x"), (4, "http://a.b/e", html, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = htmltext.extract(pages).collect()
    assert {(r.page_id, r.text, r.n_chars) for r in got if r.page_id != 1 and not r.text} == {(2, "", 0), (3, "", 0)}
    assert len(got) == 5 and {r.text for r in got if r.page_id in (1, 4)} == {"Tést One two three. Four five"}
    assert htmltext.extract(pages.limit(0)).count() == 0
    back = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to or 0) for r in warc.round_trip(pages).collect())
    n = len(html.encode())
    assert back == [(1, n, "response", 0), (2, 0, "response", 0), (3, 0, "response", 0), (4, n, "revisit", 1), (4, n, "revisit", 1)]
    _, directory = warc.archive(pages)
    (head, payload), = warc.lookup(directory, ["HTTP://www.a.b/c#top"])
    assert payload.decode() == html and head["WARC-Type"] == "response"
    assert warc.lookup(directory, ["http://nowhere.example/"]) == [] and warc.round_trip(pages.limit(0)).count() == 0
