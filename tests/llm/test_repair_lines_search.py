"""Conversation repair, line dedup and lexical search on small tables, against plain versions in Python."""

import hashlib
import itertools
import math
import random
import re
import zlib

import pytest

from callgrid.llm import convrepair, lexical, linedup
from callgrid.llm.common import ship_code

GRAMMAR = re.compile("(s?(ua)+)?")
CONV = "conv_id long, turn long, role string, text string, audit string, h1 long"


def cheapest(rows):
    """All edits of up to four rows, by trying them: (cost, audit)."""
    found = []

    def go(i, cost, audit, roles, inserts):
        if i == len(rows):
            if GRAMMAR.fullmatch(roles):
                found.append((cost, audit))
        else:
            initial, forced, extra = rows[i]
            go(i + 1, cost + 4 * max(forced, 1), audit + "D" * max(forced, 1), roles, inserts)
            if not forced:
                if initial:
                    go(i + 1, cost + extra, audit + "K", roles + initial, inserts)
                for r in "ua":
                    go(i + 1, cost + 3 + extra, audit + "R", roles + r, inserts)
        if inserts < 4:
            for r in "ua":
                go(i, cost + 3, audit + "I", roles + r, inserts + 1)

    go(0, 0, "", "", 0)
    return min(found)


def random_rows(rng, n):
    return [(rng.choice("suuaax") if rng.random() > 0.05 else "", rng.choice([0, 0, 0, 0, 1, 2]), rng.choice([0, 0, 3])) for _ in range(n)]


def test_search_finds_the_cheapest_edits():
    rng = random.Random(5)
    for n in (0, 1, 2, 3):
        for _ in range(60):
            rows = random_rows(rng, n)
            cost, _, audit, _ = convrepair.search(rows, [(0, 0)], (0, 3), True)
            assert (cost, audit.decode()) == cheapest(rows), rows


def test_chunks_give_what_one_search_gives():
    rng = random.Random(6)
    for n in (1, 2, 5, 9, 40, 333):
        rows = random_rows(rng, n)
        cost, _, audit, _ = convrepair.search(rows, [(0, 0)], (0, 3), True)
        for chunk in (1, 2, 7, 64):
            one = convrepair._Audit(chunk)
            for k, r in enumerate(rows):
                one.add((k, "", b""), r)
            got, pieces = one.end()
            assert (got, "".join(p for _, p in pieces)) == (cost, audit.decode())
            assert len(pieces) == -(-n // chunk)


def plain_repair(table):
    """conv_id -> all result columns, by a table of the least (cost, audit, turns) of each state."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns = {r[0] for r in rows} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults, seen = [], set()
        for _, role, text in rows:
            body = text.strip(convrepair.SPACES)
            faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
            seen.add((role, text))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
        best = {"": (0, "", ())}

        def better(table, q, x):
            if q not in table or x[:2] < table[q][:2]:
                table[q] = x

        def insert(table):
            for _ in range(3):
                for q, (c, a, t) in list(table.items()):
                    r = "a" if q == "u" else "u"
                    better(table, r, (c + 3, a + "I", (*t, ({"u": "user", "a": "assistant"}[r], ""))))

        insert(best)
        for (_, role, text), fault in zip(rows, faults):
            after, extra = {}, 3 if fault == "t" else 0
            for q, (c, a, t) in best.items():
                better(after, q, (c + 4, a + "D", t))
                if fault in ("", "t"):
                    if (q, role[:1]) in step:
                        better(after, step[q, role[:1]], (c + extra, a + "K", (*t, (role, text))))
                    r = "a" if q == "u" else "u"
                    better(after, r, (c + 3 + extra, a + "R", (*t, ({"u": "user", "a": "assistant"}[r], text))))
            best = after
            insert(best)
        cost, audit, made = min(best[q] for q in ("", "a") if q in best)
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, made,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(7)
    roles, texts = ["user", "assistant", "system", "tool", "unknown", "", None], ["Hi.", "Hi.", "no end", "", None, " \n", "Well!\t", "ünd?", "x" * 90_000 + "."]
    rows = [(c, rng.choice([t, t, None]) if c == 3 else t, rng.choice(roles[: 2 if c and c % 3 else 7]), rng.choice(texts)) for c in [*range(40), None] for t in range(rng.randint(1, 9))]
    rows += [(100, t % 4, "user", f"same turn {t}.") for t in range(30)] + [(101, 5, "user", "copy.")] * 20
    dropped = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(dropped, 0, "user", "Gone.")], dropped


@pytest.mark.parametrize("chunk", [2, 1024])
def test_repair_agrees_with_a_plain_version(spark, talks, chunk):
    ship_code(spark)
    rows, dropped = talks
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONV).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in convrepair.report(convrepair.damage(df), chunk).collect()}
    want = plain_repair(rows)
    assert got == {c: (*w[:7], w[8]) for c, w in want.items()}
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = {}
    for r in convrepair.repaired(convrepair.damage(df), chunk).orderBy("conv_id", "place").collect():
        assert r.place == len(turns.setdefault(r.conv_id, []))
        turns[r.conv_id].append((r.role, r.text))
    assert {c: tuple(t) for c, t in turns.items()} == {c: w[7] for c, w in want.items() if w[7]}
    assert convrepair.report(convrepair.damage(df.limit(0))).count() == 0


DOCS = "doc_id long, text string, place long, h1 long, item_id long, score string"
SHARED, OTHER = "  This line is SHARED by many documents.\t", "another line that three documents hold"


@pytest.fixture(scope="module")
def docs():
    rows = [(k, f"own line of the document number {k}\n{SHARED}\nshort\nshort", 0, 1, 2, "x") for k in range(40)]
    rows += [(50, f"{OTHER}\n{OTHER}\n\n" + SHARED.lower(), 0, 1, 2, "x"), (51, OTHER + "\nend", 0, 1, 2, "x"), (52, OTHER.upper(), 0, 1, 2, "x"),
             (53, f"{SHARED}\ntwice in two documents only\n", 0, 1, 2, "x"), (54, "twice in two documents only\n\ntwice in two documents only", 0, 1, 2, "x"),
             (55, None, 0, 1, 2, "x"), (56, "", 0, 1, 2, "x"), (57, " \n\t\n" + " " * 40, 0, 1, 2, "x"),
             (58, "\n".join(f"line number {i % 700} of a very long text" for i in range(30_000)), 0, 1, 2, "x"),
             (None, f"{SHARED}\nno id here, and nothing else", 0, 1, 2, "x"), (None, f"no id here either\n{SHARED}", 0, 1, 2, "x")]
    return rows + [(60, "repeated row with a line of its own\n" + OTHER, 0, 1, 2, "x")] * 3


def plain_lines(rows):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(linedup.SPACES))
    holders = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    gone = {k: max(s, key=lambda i: -1 if i is None else i) for k, s in holders.items() if len(k) >= 20 and len(s) >= 3}
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) in gone and gone[key(x)] != i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (4, 2), (5, 3)])
def test_line_dedup_agrees_with_a_plain_version(spark, docs, batches, fanout):
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    before = {t.name for t in spark.catalog.listTables()}
    want = sorted(plain_lines(docs), key=str)
    got = linedup.report(df, batches=batches, fanout=fanout).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in want), key=str)
    assert {t.name for t in spark.catalog.listTables()} == before
    left = linedup.without_repeats(df, batches=batches, fanout=fanout)
    assert left.columns == df.columns
    assert sorted([(r.doc_id, r.text or "") for r in left.collect()], key=str) == sorted([(i, t) for i, _, _, t in want], key=str)


def test_line_dedup_of_an_empty_table(spark, docs):
    assert linedup.report(spark.createDataFrame(docs, DOCS).limit(0)).count() == 0


def test_a_run_settles_its_keys(spark):
    """A later batch adds only keys that the runs do not decide yet."""
    runs = linedup.Runs(spark, buckets=4)
    batch = spark.createDataFrame([(9, 1, 1), (8, 1, 1), (8, 1, 1), (7, 1, 1), (7, 2, 2)], "doc_id long, h1 long, h2 long")
    runs.add(batch)
    runs.add(spark.createDataFrame([(5, 1, 1), (6, 2, 2), (4, 2, 2)], "doc_id long, h1 long, h2 long"))
    assert [len(x) for x in runs.levels] == [0, 1]
    rows = {(r.h1, r.docs, r.top) for r in spark.table(runs.levels[1][0]).collect()}
    assert rows == {(1, 3, 9), (2, 3, 7)}
    runs.add(spark.createDataFrame([(99, 1, 1), (3, 2, 2)], "doc_id long, h1 long, h2 long"))
    assert {(r.h1, r.docs, r.top) for r in spark.table(runs.levels[0][0]).collect()} == {(1, 1, 99)}
    assert {(r.h1, r.top) for r in runs.decided().collect()} == {(1, 99), (2, 7)}
    runs.close()


def plain_search(rows, items, top):
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    of = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in term.findall(t or "")]
    texts = [(i, of(t)) for i, t, *_ in rows]
    big_n, big_l = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    out = []
    for item, text in items:
        scores = []
        for i, w in texts:
            m = 100 - 50 + (50 * len(w) * big_n) // big_l
            s = 0
            for t in set(of(text)):
                df = sum(t in x for _, x in texts)
                s += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 20 * m))
            scores.append((i, s))
        best = sorted((x for x in scores if x[1] > 0), key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:top]
        out += [(item, k + 1, i, s) for k, (i, s) in enumerate(best)]
    return sorted(out, key=str)


ITEMS = [(1, "Shared LINE of document"), (2, None), (3, "--- !"), (4, "ünïcödé Ünïcödé x-y 700 twice"), (4, "no id, either"), (None, "documents"), (5, "absent words only")]


@pytest.mark.parametrize(("top", "terms", "cells", "pending"), [(50, 200_000, 1 << 19, 1 << 18), (3, 3, 7, 4)])
def test_search_agrees_with_a_plain_version(spark, docs, monkeypatch, top, terms, cells, pending):
    """Also in blocks of a few terms, with small matrices and few pending candidates."""
    ship_code(spark)
    for name, value in (("BLOCK_TERMS", terms), ("CELLS", cells), ("PENDING", pending)):
        monkeypatch.setattr(lexical, name, value)
    more = [*docs, (70, "Ünïcödé ünïcödé x\x7fy\x85 YX 700", 0, 1, 2, "x")]
    df = spark.createDataFrame(more, DOCS).repartition(3)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, score string")
    got = lexical.search(df, items, top)
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(more, ITEMS, top)
    for d, i in ((df.limit(0), items), (df, items.limit(0))):
        assert lexical.search(d, i).count() == 0 and lexical.search(d, i).columns == ["item_id", "rank", "doc_id", "score"]
