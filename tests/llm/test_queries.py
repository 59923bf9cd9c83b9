"""The registered corpus queries on the smallest given tables, against SQL, brute force, the library or held-out labels."""

import collections
import hashlib
import re

import duckdb
import pytest

import corpus_pipeline
from callgrid.llm import htmltext, mixing, neardup, quality, queries, suffix
from callgrid.llm.common import table

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(sql):
    return dict(sql.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_agrees_with_sql(spark, sql, name):
    want = sql.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    assert rows(queries.QUERIES[name](spark, SF)) == sorted(tuple(str(r[i]) for i in order) for r in want.fetchall())


def near_classes(texts):
    """Brute force: all pairs of shingle sets."""
    sets = {}
    for i, t in texts.items():
        w = [re.sub("[A-Z]+", lambda m: m[0].lower(), x) for x in WORD.findall(t)]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    smallest = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    linked = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
              if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in linked:
            low = min(smallest[a], smallest[b])
            if {smallest[a], smallest[b]} != {low}:
                smallest[a] = smallest[b] = low
                changed = True
    return sets, smallest


def test_near_duplicates_agree_with_brute_force(spark, texts):
    sets, smallest = near_classes(texts)
    got = queries.QUERIES["op2_near_dedup"](spark, SF).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, len(sets[i]), smallest[i], smallest[i] == i) for i in texts}


def test_hub_blind_links_are_found(spark):
    """A family in which the hub is like some members only: chains of edits still form one class each, as by brute force."""
    import random
    rng = random.Random(5)
    base = [f"t{k}" for k in range(120)]
    family = {}
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 12)):
            w[rng.randrange(120)] = f"e{rng.randrange(4000)}"
        family[i] = " ".join(w)
    old, neardup.BLOCK = neardup.BLOCK, 8  # several blocks a bucket
    try:
        got = {r.doc_id: r.component_id for r in neardup.classes(spark.createDataFrame(list(family.items()), "doc_id long, text string")).collect()}
    finally:
        neardup.BLOCK = old
    assert got == near_classes(family)[1]


def test_links_grow_with_the_members(spark, monkeypatch):
    """A family of which many pairs are alike by about the limit: no table has more rows than its members have places in
    shared buckets, and these grow like the members."""
    import random
    rows = {}
    real = neardup.written
    for n in (60, 120):
        rng, sizes = random.Random(9), {}
        words = [f"w{k}" for k in range(200)]
        texts = []
        for i in range(n):
            w = list(words)
            for _ in range(5):
                w[rng.randrange(200)] = f"e{rng.randrange(9999)}"
            texts.append((i, " ".join(w)))

        def kept(df, name, sizes=sizes):
            out = real(df, name)
            sizes[name] = max(sizes.get(name, 0), out.count())
            return out

        monkeypatch.setattr(neardup, "written", kept)
        neardup.classes(spark.createDataFrame(texts, "doc_id long, text string")).count()
        rows[n] = sizes
    assert all(size <= of["near-members"] for of in rows.values() for size in of.values()), str(rows)
    assert rows[120]["near-members"] <= 3 * rows[60]["near-members"] and rows[120]["near-links"] <= 240, str(rows)


def test_quality_agrees_with_brute_force(spark, texts):
    got = queries.QUERIES["op8_quality"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id]
        words = WORD.findall(text)
        at = collections.defaultdict(list)
        for i in range(len(words) - 7):
            at[tuple(words[i : i + 8])].append(i)
        covered = {k for places in at.values() if len(places) > 1 for i in places for k in range(i, i + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        assert r.base_failed == failed and r.kept == (not failed and r.ratio >= quality.THRESHOLD)


def test_ratio_agrees_with_brute_force(spark):
    import math
    import struct

    import xxhash

    def grams(text):
        one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text)]
        packed = [struct.pack("<Q", h) for h in one]
        two = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(packed, packed[1:])]
        return [(h - (1 << 64) if h >> 63 else h) % 64 for h in one + two]

    docs = [(1, "a b c a"), (2, "d e f"), (3, "a d"), (4, "")]
    raw, target = collections.Counter(g for _, t in docs for g in grams(t)), collections.Counter(grams(docs[0][1]))
    n_raw, n_target = sum(raw.values()) + 64, sum(target.values()) + 64
    want = [round(quality.MICRO * (math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw))) for b in range(64)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    model = quality.fit_ratio(df, labels, buckets=64)
    assert list(map(int, model.weights.split(","))) == want
    for r in quality.score(df, labels, buckets=64).collect():
        own = grams(dict(docs)[r.doc_id])
        assert abs(r.ratio - sum(want[g] for g in own) / quality.MICRO / max(1, len(own))) < 1e-9


def test_token_ids_agree_with_the_library(spark, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in queries.QUERIES["op9_bpe"](spark, SF).collect():
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = tok.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_main_text_is_the_article(spark, sql):
    pages = dict(sql.execute("SELECT page_id, html FROM pages").fetchall())
    got = {r.page_id: r for r in queries.QUERIES["op7_html_text"](spark, SF).collect()}
    want = {i: " ".join(b.text for b in htmltext.blocks(h) if "article" in b.path) for i, h in pages.items()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    got = [(r.predicted, labels[r.doc_id]) for r in queries.QUERIES["op10_toxicity"](spark, sf).where("held_out").collect() if r.doc_id in labels]
    assert len(got) > 50 and sum(p == y for p, y in got) >= 0.9 * len(got)


def test_pipeline_stage_by_stage(spark, texts):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    kept = {r.doc_id for r in quality.score(docs, labels).where("kept").collect()}
    one = corpus_pipeline.STAGES[0][1](spark, docs, SF).cache()
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == kept
    _, smallest = near_classes({i: texts[i] for i in kept})
    two = corpus_pipeline.STAGES[1][1](spark, one, SF).cache()
    left = {r.doc_id: r.text for r in two.collect()}
    assert two.columns == docs.columns and set(left) == {i for i in kept if smallest[i] == i}
    three = corpus_pipeline.STAGES[2][1](spark, two, SF).cache()
    seen, want = set(), {}
    for i in sorted(left):  # brute force: every window of 50 words that an earlier place has
        w, gone = WORD.findall(left[i]), set()
        for k in range(len(w) - 49):
            window = tuple(w[k : k + 50])
            if window in seen:
                gone.update(range(k, k + 50))
            seen.add(window)
        want[i] = [x for k, x in enumerate(w) if k not in gone]
    assert {r.doc_id: WORD.findall(r.text) for r in three.collect()} == want
    assert all(r.n_chars == len(r.text) for r in three.collect())
    four = corpus_pipeline.STAGES[3][1](spark, three, SF)
    counts = collections.Counter(r.doc_id for r in four.collect())
    assert four.columns == docs.columns and counts == {r.doc_id: r.repeats for r in mixing.allot(three).collect() if r.repeats}
    out = corpus_pipeline.STAGES[4][1](spark, four, SF)
    assert collections.Counter(r.doc_id for r in out.collect()) == counts


def test_spans_cut_whole_words():
    text = "  a b\tc d\ne  "
    assert suffix.cut(text, [{"start": 1, "end": 3}]) == "  a  d\ne  "
    assert suffix.cut(text, []) == text
