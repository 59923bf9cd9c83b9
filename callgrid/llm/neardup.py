"""Near-duplicate documents: SetSketch registers, banded, estimated jointly, then verified on full sets.

A document's set holds the 64-bit hashes of its distinct 5-word shingles (A-Z lower-cased;
with fewer words, the whole sequence). Two documents are linked when 100 * intersection
>= 75 * union of their sets; a component is a class.

1. Each document gets a SetSketch: register i is floor(1 - log_b x) of the smallest of its
   elements' i-th exponential hash x, cut to 0..255. Registers of parts merge by maximum.
   Documents of equal sets share one sketch from here on, so exact copies cost one row.
2. Bands of 5 registers name buckets (48 bands: two sets of likeness 0.75 share none with
   a probability below 1e-6). Buckets of one member vanish after a partial count.
3. Each bucket has a hub, the member that shares most buckets. Every member is compared with
   the one hub that shares most of all, then with its other hubs as far as these stand in
   another component: pairs grow with the members, not with their square. Pairs whose
   likelihood, given all registers and both set sizes, peaks well below 0.75 are left out, the
   others verified on the full sets.
4. What the hubs cannot tell is told exactly: buckets that still hold members of different
   components are compared member by member, in blocks of bounded size that several
   tasks share, by registers first, then on the full sets of those that pass. What comes out are
   links that join a block's components, at most one fewer than these, so no link between
   components is lost behind a hub and no table holds a row a pair.

Results in special cases: null, empty and blank texts have no set, are linked with
nothing and stay; rows that repeat a doc_id count as documents of that id; a null doc_id
never is the smallest of its class, and a row without one stays only if its class has no
id; whole texts are read; an empty table gives an empty result; extra columns are ignored
(:func:`classes`) or handed through (:func:`keep_first`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrid.llm.common import passing, sifted, written
from callgrid.llm.components import components

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
REGISTERS = 768
BASE = 1.1
BAND, BANDS = 5, 48
#: Pairs whose estimated likeness is this far (4.5 standard deviations of 768 registers) below the limit are left out.
MARGIN = 0.07
#: Share of equal registers to expect at the limit, at least (sets of any two sizes).
EQUAL_AT_LIMIT = 0.7587
#: Members compared with each other in one block; larger buckets are split.
BLOCK = 1024

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(2024))
_BYTES = _RNG.integers(0, 2**64, 256, dtype=_U)
_FACTOR = _RNG.integers(0, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_OFFSET = _RNG.integers(0, 2**32, REGISTERS, dtype=np.uint32)
_STEP = _U(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: The six white-space bytes that part words.
WHITE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def word_hashes(text: str | None, lower: bool = True, parting: np.ndarray = WHITE, prefix: int = 0) -> np.ndarray:
    """64-bit hashes of a text's words, of all bytes at once.

    ``parting`` marks the bytes that part words; with ``prefix``, only the first so many
    code points of each word count.
    """
    raw = (text or "").encode("utf-8")
    b = np.frombuffer(raw.lower() if lower else raw, np.uint8)
    blank = parting[b]
    first = np.flatnonzero(~blank & np.r_[True, blank[:-1]]) if len(b) else np.empty(0, np.int64)
    if not len(first):
        return np.empty(0, _U)
    start = np.zeros(len(b), np.int64)
    start[first] = first
    start = np.maximum.accumulate(start)
    offset = np.arange(len(b)) - start
    powers = np.cumprod(np.full(int(offset.max()) + 1, _STEP))
    value = _BYTES[b] * powers[offset]
    value[blank] = 0
    if prefix:
        points = np.cumsum((b & 0xC0) != 0x80)
        value[points - points[start] >= prefix] = 0
    return _mixed(np.add.reduceat(value, first))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n words in a row."""
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = out * _STEP + words[k : len(words) - n + 1 + k]
    return _mixed(out)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < SHINGLE:
        return _mixed(ngram_hashes(words, len(words)) + _U(len(words)))
    return np.unique(ngram_hashes(words, SHINGLE))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a set, one byte each."""
    h = (shingles >> _U(32)).astype(np.uint32)
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 1024):
        np.minimum(low, (h[i : i + 1024, None] * _FACTOR + _OFFSET).min(axis=0), out=low)
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32)  # exponentially distributed minima
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 255).astype(np.uint8)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard likeness of each pair of rows of registers, given the sets' sizes."""
    up, down = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - up - down
    grid = np.linspace(0, 1, 201)[None, :]
    size_a, size_b = size_a[:, None].astype(float), size_b[:, None].astype(float)
    union = (size_a + size_b) / (1 + grid)
    only_a, only_b = (union - size_b) / union, (union - size_a) / union
    prob = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
    p, q = prob(only_a), prob(only_b)
    fit = up * np.log(p) + down * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))
    fit[(only_a < -1e-9) | (only_b < -1e-9)] = -np.inf  # no such likeness for these sizes
    return grid[0][fit.argmax(1)]


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, REGISTERS)


def _text_id(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_id (digest of the text), set_id (128-bit digest of the set; null without one), n_shingles and
    registers of every document."""
    docs = docs.select("doc_id", _text_id(F.col("text")).alias("text_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                ids, sizes, regs = [], [], []
                for text in batch.column("text").to_pylist():
                    s = shingle_set(text)
                    sizes.append(len(s))
                    ids.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                    regs.append(sketch(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_id"), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(regs, pa.binary())],
                    names=["doc_id", "text_id", "set_id", "n_shingles", "registers"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_id string, set_id binary, n_shingles long, registers binary")


def _likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that the registers do not rule out."""
    sets = sifted(sets, [F.col("node")], pairs.select("u").union(pairs.select("v")).distinct())[0]
    one = sets.select(F.col("node").alias("u"), F.col("registers").alias("ru"), F.col("n_shingles").alias("nu"))
    two = sets.select(F.col("node").alias("v"), F.col("registers").alias("rv"), F.col("n_shingles").alias("nv"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                j = estimate(_registers(b.column("ru")), _registers(b.column("rv")), b.column("nu").to_numpy(), b.column("nv").to_numpy())
                yield b.select(["u", "v"]).filter(pa.array(j >= PERCENT / 100 - MARGIN))

    fits = F.lit(100) * F.least("nu", "nv") >= F.lit(PERCENT) * F.greatest("nu", "nv")
    both = pairs.join(one, "u").join(two, "v").where(fits)
    return both.select("u", "v", "ru", "rv", "nu", "nv").mapInArrow(run, "u long, v long")


def _verified(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs whose full sets are alike."""
    one = full.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    two = full.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column("su"), b.column("sv")):
                s, t = np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U)
                common = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(100 * common >= PERCENT * (len(s) + len(t) - common))
            yield b.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    return pairs.join(one, "u").join(two, "v").select("u", "v", "su", "sv").mapInArrow(run, "u long, v long")


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted sets, from the texts of the documents that stand for them (told by id and text)."""
    texts = docs.select(F.col("doc_id").alias("first_id"), _text_id(F.col("text")).alias("first_text"), "text")
    texts = sifted(texts, [F.col("first_id"), F.col("first_text")], wanted.select("rep_id", "text_id"))[0]
    rows = texts.join(wanted, texts["first_id"].eqNullSafe(wanted["rep_id"]) & (texts["first_text"] == wanted["text_id"])).select("node", "set_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # rows that repeat a document
        for b in batches:
            nodes, sets = [], []
            for node, set_id, text in zip(*(b.column(c).to_pylist() for c in ("node", "set_id", "text"))):
                if node not in seen and hashlib.md5((s := shingle_set(text).tobytes())).digest() == set_id:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return rows.mapInArrow(run, "node long, shingles binary")


def _passing(regs: np.ndarray, node: np.ndarray, comp: np.ndarray, size: np.ndarray, part: np.ndarray, band: int, same_part: bool) -> Iterator[tuple[int, np.ndarray]]:
    """For each member of a block, the later ones of other components that the registers do not rule out. A pair is
    told in the first band that its nodes share."""
    for x in range(len(node) - 1):
        y = np.arange(x + 1, len(node))
        y = y[(comp[y] != comp[x]) & ((part[y] != part[x]) | same_part)]
        y = y[100 * np.minimum(size[y], size[x]) >= PERCENT * np.maximum(size[y], size[x])]
        same = regs[y] == regs[x]
        ok = same.mean(1) >= EQUAL_AT_LIMIT - MARGIN
        y, same = y[ok], same[ok]
        if len(y):
            earlier = same[:, : band * BAND].reshape(len(y), band, BAND).all(2).any(1)
            y = y[~earlier]
        if len(y):
            y = y[estimate(np.broadcast_to(regs[x], (len(y), REGISTERS)), regs[y], np.full(len(y), size[x]), size[y]) >= PERCENT / 100 - MARGIN]
        if len(y):
            yield x, y


def _hopeful(members: pa.Table, pairs: Iterator[tuple[int, np.ndarray]]) -> pa.Table:
    """The members of a block that are in any passing pair: no more rows than members, however many pairs."""
    found = np.zeros(members.num_rows, bool)
    for x, y in pairs:
        found[x] = True
        found[y] = True
    return members.filter(pa.array(found)).drop_columns("registers")


def _joined(members: pa.Table, pairs: Iterator[tuple[int, np.ndarray]]) -> pa.Table:
    """Verified links of a block that join its components: at most one fewer than these, however many pairs are linked."""
    node, comp = members.column("node").to_pylist(), members.column("component").to_pylist()
    sets = [np.frombuffer(x.as_buffer(), _U) for x in members.column("shingles")]
    above = {c: c for c in comp}

    def root(c: int) -> int:
        while above[c] != c:
            above[c] = c = above[above[c]]
        return c

    out = []
    for x, ys in pairs:
        for y in ys:
            if root(comp[x]) != root(comp[y]):
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * common >= PERCENT * (len(sets[x]) + len(sets[y]) - common):
                    above[root(comp[x])] = root(comp[y])
                    out.append((node[x], node[y]))
    u, v = zip(*out) if out else ((), ())
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


_BLOCKED = ["key", "i", "j"]


def _by_block(rows: DataFrame, what: Callable[[pa.Table, Iterator], pa.Table], schema: str) -> DataFrame:
    """``what(members, passing pairs)`` of each block (key, i, j); a task holds one block beside its batch."""
    rows = rows.repartition(*_BLOCKED).sortWithinPartitions(*_BLOCKED)

    def block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        values = (rows.column(c).to_numpy() for c in ("node", "component", "n_shingles", "part"))
        band, i, j = (rows.column(c)[0].as_py() for c in ("band", "i", "j"))
        yield from what(rows, _passing(_registers(rows.column("registers")), *values, band, i == j)).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the block that the last batch ended in
        for b in batches:
            t = pa.Table.from_batches([b])
            if held is not None:
                t = pa.concat_tables([held, t])
            if not t.num_rows:
                continue
            names = [t.column(c).to_numpy() for c in _BLOCKED]
            cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
            for start, end in zip([0, *cuts[:-1]], cuts):
                yield from block(t.slice(start, end - start).combine_chunks())
            held = t.slice(cuts[-1] if len(cuts) else 0)
        if held is not None and held.num_rows:
            yield from block(held.combine_chunks())

    return rows.mapInArrow(run, schema)


def _across(members: DataFrame, sets: DataFrame, full: DataFrame) -> DataFrame:
    """Verified links that join the components of members (key, band, node, component, n of the bucket) which share a bucket.

    A bucket of more than ``BLOCK`` members is cut into parts by hash, and each two parts meet in a block of their own. The
    registers first tell the members that pass with any other; only these get their full sets, and are verified where
    they meet, so neither step gives a row a pair.
    """
    parts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("node", "key"), parts).cast("int")
    rows = members.withColumn("part", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.select("key", "band", "node", "component", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    registers = sets.select("node", "registers", "n_shingles")
    hopeful = _by_block(rows.join(registers, "node").select("key", "band", "node", "component", "part", "i", "j", "registers", "n_shingles"), _hopeful,
                        "key long, band int, node long, component long, part int, i int, j int, n_shingles long")
    hopeful = written(hopeful, "near-hopeful")
    whole = hopeful.join(registers.drop("n_shingles"), "node").join(full, "node")
    return _by_block(whole, _joined, "u long, v long").distinct()


def links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links (u, v) that join all classes of sets (node, rep_id, set_id, n_shingles, registers)."""
    bands = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                                     lambda i: F.xxhash64(F.substring(F.col("registers"), i * BAND + 1, F.lit(BAND)), i))).alias("band", "key")
    banded = sets.select("node", bands)
    # a table of its own: the join then deals both sides out itself, and the session can split a bucket that many share
    shared = written(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-shared")
    members = written(banded.join(shared, "key").select("key", "band", "node", "n"), "near-members")
    degree = members.groupBy("node").agg(F.sum("n").alias("degree"))
    hub = F.max(F.struct("degree", "node"))
    hubs = members.join(degree, "node").groupBy("key").agg(hub["node"].alias("hub"), hub["degree"].alias("hub_degree"))
    hubs = written(hubs, "near-hubs")
    around = written(members.join(hubs, "key").where(F.col("node") != F.col("hub")), "near-around")
    # first each node with the one hub that shares most, and the two of each bucket of two
    nearest = around.groupBy("node").agg(F.max(F.struct("hub_degree", "hub"))["hub"].alias("v"))
    pairs = written(nearest.union(around.where("n = 2").select("node", "hub")).toDF("u", "v").distinct(), "near-pairs")
    stars = written(_likely(pairs, sets), "near-stars")
    # full sets of all that may be compared: ends of the stars, and members of buckets that have more than a hub and one
    crowd = around.where("n > 2")
    ends = stars.select(F.col("u").alias("node")).union(stars.select("v")).union(crowd.select("node")).union(crowd.select("hub")).distinct()
    ends = written(ends, "near-ends")
    sets = written(ends.join(sifted(sets, [F.col("node")], ends)[0], "node"), "near-compared")  # all that the steps below name
    full = written(_full_sets(docs, sets.select("node", "rep_id", "text_id", "set_id")), "near-sets")
    found = written(_verified(stars, full), "near-links")
    # then with the other hubs, where these still stand in another component
    known = written(components(found), "near-components")
    of_hub = known.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    apart = crowd.join(known, "node", "left").join(of_hub, "hub", "left").where(F.coalesce("component", "node") != F.coalesce("hub_component", "hub"))
    more = written(apart.select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct(), "near-apart")
    more = _likely(more, sets)
    found = written(found.union(_verified(more, full)), "near-links")
    known = written(components(found), "near-components")
    everyone = crowd.select("key", "band", "node", "n").union(crowd.groupBy("key").agg(F.first("band").alias("band"), F.first("hub").alias("node"), F.first("n").alias("n")))
    rest = everyone.join(known, "node", "left").select("key", "band", "node", "n", F.coalesce("component", "node").alias("component"))
    mixed = rest.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("key")
    return found.union(_across(rest.join(mixed, "key"), sets, full))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    return _classes(docs).drop("text_id")


def _classes(docs: DataFrame) -> DataFrame:
    with passing("near-documents", "near-named"):
        with passing("near-documents", "near-distinct"):  # of the documents' registers, those of distinct sets are left
            sketched = written(sketches(docs), "near-sketches")
            sets = sketched.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
                F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")).alias("rep"),
                F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
            sets = sets.select("set_id", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_id").alias("text_id"), "n_shingles", "registers")
            sets = written(sets.withColumn("node", F.monotonically_increasing_id()), "near-distinct")
            sketched = written(sketched.drop("registers"), "near-documents")
        found = components(links(docs, sets))
        named = sets.select("set_id", "node", "rep_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        named = written(named.select("set_id", "component", "rep_id"), "near-named")
    smallest = named.groupBy("component").agg(F.min("rep_id").alias("component_id"))
    of_set = named.join(smallest, "component").select(F.col("set_id").alias("own_set"), "component_id")
    out = sketched.select("doc_id", "text_id", "set_id", "n_shingles").join(of_set, F.col("set_id") == F.col("own_set"), "left")
    component_id = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_id", "n_shingles", component_id.alias("component_id"), component_id.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class: the one with the smallest doc_id; columns as they came.

    Rows that repeat both the kept doc_id and its text stay with it.
    """
    with passing("near-gone"):
        gone = _classes(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__gone"), F.col("text_id").alias("__text"))
        gone = written(gone.distinct(), "near-gone")
    maybe, rest = sifted(docs, [F.col("doc_id"), _text_id(F.col("text"))], gone)
    return rest.union(maybe.join(gone, maybe["doc_id"].eqNullSafe(gone["__gone"]) & (_text_id(maybe["text"]) == gone["__text"]), "left_anti"))
