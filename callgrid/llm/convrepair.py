"""Conversation structure repair by depth-first branch-and-bound.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. Rows may be
kept (0), given the role that the place asks for (3) or deleted (4), and empty turns may be
inserted (3); a blank or repeated row must go, a truncated one that stays adds 3. The repair is
the cheapest list of edits; of equally cheap ones, that whose initials (the audit) are
ASCII-least.

1. Spark reduces each row to what the search needs (role, digest of the text, blank, truncated),
   combines equal rows of a turn, and finds later repeats by the first turn of each
   (conversation, role, text); no text is shuffled for this.
2. A task reads these rows ordered by conversation and turn, as a stream, and searches
   :data:`CHUNK` rows at a time: an explicit stack, the least edit first; a lower bound of what
   the remaining rows cost from each state; the incumbent (cost, audit); and for each node
   (row, state) the best prefix that has reached it. A prefix goes when its bound or its audit
   cannot beat the incumbent, or when the node was reached better. The search ends with an empty
   stack, which proves the incumbent. Between chunks the best prefix of every state goes on, so
   a conversation of any length costs memory in proportion to its audit, which is a result.
3. The audits, in pieces, meet the texts in a second ordered stream that makes the repaired turns.
   SHA-256 of a conversation is sequential by nature: one task reads it, but never holds it.

Results in special cases: null roles and texts count as one space; a role without any character
has no initial, so its row cannot be kept as it is; rows of one turn go by role, then by the digest
of the text, and equal rows of a turn lie side by side, all but the first as duplicates; null
turns come first and are left out of gaps; rows with a null conv_id form one conversation; a
conversation without rows has costs and counts 0, an empty audit and no turns; an empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows searched at a time.
CHUNK = 1024
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"

#: States of the grammar: nothing yet, after a system turn, after a user's, after the assistant's.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STEP = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
#: The state that an inserted or rerolled turn leads to.
_MADE = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_ENDS = (_START, _ASSISTANT)
_LEGAL = {"su", "ua", "au"}
_NEVER = 1 << 60

_LIGHT = ["conv_id", "turn", "role", "text_id", "blank", "truncated", "copies", "later"]
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage that CRC-32 of ``conv_id:turn`` deals; a dropped row
    stays with 0 copies, so that its conversation is not forgotten."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))), F.lit(20))
    rows = conversations.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def light(rows: DataFrame) -> DataFrame:
    """Rows without their texts, equal ones of a turn combined; ``later``: role and text were seen in an earlier turn."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    there = F.col("copies") > 0
    rows = rows.select("conv_id", "turn", F.when(there, F.col("role")).alias("role"), F.when(there, F.unhex(F.md5("text"))).alias("text_id"),
                       (end == "").alias("blank"), ((end != "") & ~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"), "copies")
    rows = rows.groupBy("conv_id", F.when(F.col("copies") > 0, F.col("turn")).alias("turn"), "role", "text_id",
                        (F.col("blank") & there).alias("blank"), (F.col("truncated") & there).alias("truncated")).agg(F.sum("copies").alias("copies"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = (rows.where(there).groupBy("conv_id", "role", "text_id").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("turns"))
             .where("turns > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_id").alias("t"), "first"))
    joined = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text_id") == F.col("t")), "left")
    return joined.withColumn("later", F.coalesce(when > F.col("first"), F.lit(False))).select(*_LIGHT)


def _bounds(rows: list[tuple], ends: tuple[int, ...], last: bool) -> list[list[int]]:
    """Least cost of the rows from each place on, by state, to end in one of ``ends``; after the last row of a
    conversation turns may still be inserted."""
    def inserted(c: list[int]) -> list[int]:
        for _ in range(2):
            for q in range(4):
                c[q] = min(c[q], INSERT + c[_MADE[q]])
        return c

    below = [0 if q in ends else _NEVER for q in range(4)]
    out = [inserted(below) if last else below]
    for initial, forced, extra in reversed(rows):
        if forced:
            out.append([c + forced * DELETE for c in out[-1]])
            continue
        c = [DELETE + x for x in out[-1]]
        for q in range(4):
            to = _STEP[q].get(initial)
            c[q] = min(c[q], REROLE + extra + out[-1][_MADE[q]], _NEVER if to is None else KEEP + extra + out[-1][to])
        out.append(inserted(c))
    return out[::-1]


def search(rows: list[tuple], begins: list[tuple[int, int]], ends: tuple[int, ...], last: bool) -> tuple[int, int, bytes, int] | None:
    """The cheapest way over ``rows``, ties ASCII-least: (cost, index of its begin, audit, end state).

    ``rows``: (role initial, deletions forced or 0, extra cost of staying). ``begins``: (state, cost so far), ordered
    by their audits. Depth-first with an explicit stack; see the module for what is cut off.
    """
    bound = _bounds(rows, ends, last)
    best_cost = min((c + bound[0][q] for q, c in begins), default=_NEVER)
    if best_cost >= _NEVER:
        return None
    incumbent: tuple[int, bytes] | None = None
    found, reached = None, {}
    stack = [(0, q, c, k, b"") for k, (q, c) in reversed(list(enumerate(begins)))]
    while stack:
        i, q, cost, k, audit = stack.pop()
        if cost + bound[i][q] > best_cost:
            continue
        if incumbent is not None and (k, audit) > (incumbent[0], incumbent[1][:len(audit)]):
            continue  # as cheap at best, and its audit is already the larger one
        if reached.get((i, q), (_NEVER,)) <= (cost, k, audit):
            continue
        reached[i, q] = (cost, k, audit)
        if i == len(rows) and q in ends:
            if incumbent is None or (cost, k, audit) < (best_cost, *incumbent):
                best_cost, incumbent = cost, (k, audit)
                found = (cost, k, audit, q)
            continue
        edits = []
        if i < len(rows):
            initial, forced, extra = rows[i]
            if forced:
                stack.append((i + 1, q, cost + forced * DELETE, k, audit + b"D" * forced))
                continue
            edits.append((i + 1, q, cost + DELETE, k, audit + b"D"))
            to = _STEP[q].get(initial)
            if to is not None:
                edits.append((i + 1, to, cost + KEEP + extra, k, audit + b"K"))
            if to != _MADE[q]:
                edits.append((i + 1, _MADE[q], cost + REROLE + extra, k, audit + b"R"))
        if i < len(rows) or last:
            edits.append((i, _MADE[q], cost + INSERT, k, audit + b"I"))
        stack += sorted(edits, key=lambda e: e[4], reverse=True)
    return found


class _Audit:
    """Search over one conversation, fed row by row."""

    def __init__(self, chunk: int) -> None:
        self.chunk = chunk
        self.rows: list[tuple] = []
        self.begins = [(_START, 0, None, b"")]  # state, cost, begin in the chunk before, audit of the chunk before
        self.chunks: list[list[tuple]] = []
        self.keys: list[tuple] = []

    def add(self, key: tuple, *rows: tuple) -> None:
        if len(self.rows) >= self.chunk:
            self._close()
        if not self.rows:
            self.keys.append(key)
        self.rows += rows

    def _close(self) -> None:
        at = [(q, c) for q, c, _, _ in self.begins]
        found = [(q, x) for q in range(4) if (x := search(self.rows, at, (q,), False))]
        self.chunks.append(self.begins)
        # in the order of their audits, of which none begins another: all end with an edit of the same row
        self.begins = [(q, x[0], x[1], x[2]) for q, x in sorted(found, key=lambda f: f[1][1:3])]
        self.rows = []

    def end(self) -> tuple[int, list[tuple[tuple, str]]]:
        """Cost, and (key of its first row, audit) of each chunk."""
        cost, k, audit, _ = search(self.rows, [(q, c) for q, c, _, _ in self.begins], _ENDS, True)
        audits, begins = [audit], self.begins
        for before in reversed(self.chunks):
            audits.append(begins[k][3])
            k, begins = begins[k][2], before
        return cost, list(zip(self.keys or [(None, None, None)], [a.decode("ascii") for a in reversed(audits)], strict=True))


def _runs(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length and text."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, str))
        if len(held) >= 4096 or size >= 1 << 23:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _audited(rows: Iterator[tuple], chunk: int) -> Iterator[tuple]:
    """Rows of one task, ordered by conversation, to one row a chunk; the counts stand in the last chunk's."""
    open_, now = False, None

    def ended() -> Iterator[tuple]:
        cost, chunks = audit.end()
        gaps = high - low + 1 - turns if turns else 0
        for n, ((turn, role, text_id), piece) in enumerate(chunks):
            own = (gaps, blank, duplicate, truncated, illegal, cost) if n == len(chunks) - 1 else (0,) * 6
            yield (now, turn, role, text_id, n, piece, *own)

    for conv, turn, role, text_id, is_blank, is_truncated, copies, later in rows:
        if not open_ or conv != now:
            if open_:
                yield from ended()
            open_, now, audit = True, conv, _Audit(chunk)
            low = high = before = None
            turns = blank = duplicate = truncated = illegal = 0
        if not copies:
            continue
        if turn is not None:
            low = turn if low is None else low
            turns += turn != high
            high = turn
        initial = role[:1]
        illegal += (before is not None and before + initial not in _LEGAL) + (copies - 1)
        before = initial
        key = (turn, role, text_id)
        if is_blank or later:
            blank += copies if is_blank else 0
            duplicate += 0 if is_blank else copies
            audit.add(key, (initial, copies, 0))
        else:
            truncated += is_truncated
            duplicate += copies - 1
            audit.add(key, (initial, 0, UNFINISHED if is_truncated else 0), *[(initial, copies - 1, 0)][: copies > 1])
    if open_:
        yield from ended()


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _ordered(df: DataFrame, *more: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text_id").asc_nulls_first(), *more)


def audits(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, turn, role, text_id, chunk, audit, counts) of every conversation in ``rows`` (conv_id, turn, role, text,
    copies): its audit in pieces, each with the key of the first row that it covers."""
    source = light(rows)
    schema = T.StructType([*(T.StructField(n, source.schema[n].dataType) for n in ("conv_id", "turn", "role", "text_id")),
                           T.StructField("chunk", T.LongType()), T.StructField("audit", T.StringType()), *(T.StructField(n, T.LongType()) for n in _COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_audited(_runs(batches, _LIGHT), chunk), _arrow(schema))

    return _ordered(source).mapInArrow(run, schema)


def _merged(rows: DataFrame, chunk: int) -> DataFrame:
    """The pieces of the audits and the texts, in the order in which they are read together."""
    pieces = audits(rows, chunk).withColumns({"text": F.lit(None).cast("string"), "copies": F.lit(0)})
    texts = rows.where("copies > 0").withColumn("text_id", F.unhex(F.md5("text")))
    texts = texts.select("*", F.lit(1 << 62).alias("chunk"), F.lit(None).cast("string").alias("audit"), *(F.lit(None).cast("long").alias(n) for n in _COUNTS))
    return _ordered(pieces.unionByName(texts), "chunk")


_READ = ["conv_id", "audit", "role", "text", "copies", *_COUNTS]


def _turns(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conversation, new piece's (audit, counts) or None, edit, role, text) in order; edits D included."""
    state, edits, conv, open_ = _START, iter(()), None, False

    def made() -> tuple:
        nonlocal state
        state = _MADE[state]
        return (conv, None, "I", _ROLE[state], "")

    for now, audit, role, text, copies, *counts in rows:
        if audit is not None:
            for _ in edits:  # what is left of the piece before are turns inserted behind its last row
                yield made()
            if not open_ or now != conv:
                open_, conv, state = True, now, _START
            edits = iter(audit)
            yield (conv, (audit, counts), None, None, None)
            continue
        for _ in range(copies):
            edit = next(edits)
            while edit == "I":
                yield made()
                edit = next(edits)
            if edit == "R":
                state = _MADE[state]
                yield (conv, None, edit, _ROLE[state], text)
            else:
                state = _STEP[state][role[:1]] if edit == "K" else state
                yield (conv, None, edit, role, text)
    for _ in edits:
        yield made()


def repaired(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, place, edit, role, text) of every turn of the repaired conversations, places from 0."""
    merged = _merged(rows, chunk)
    schema = T.StructType([T.StructField("conv_id", merged.schema["conv_id"].dataType), T.StructField("place", T.LongType()),
                           T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def placed(rows: Iterator[tuple]) -> Iterator[tuple]:
        place, now, any_ = 0, None, False
        for conv, piece, edit, role, text in _turns(rows):
            if not any_ or conv != now:
                any_, now, place = True, conv, 0
            if piece is None and edit != "D":
                yield (conv, place, edit, role, text)
                place += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(placed(_runs(batches, _READ)), _arrow(schema))

    return merged.mapInArrow(run, schema)


def report(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row a conversation: gaps, faults, illegal neighbours, cost, audit and the SHA-256 of the repaired turns."""
    merged = _merged(rows, chunk)
    schema = T.StructType([T.StructField("conv_id", merged.schema["conv_id"].dataType), *(T.StructField(n, T.LongType()) for n in _COUNTS),
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def digested(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, any_ = None, False
        for conv, piece, edit, role, text in _turns(rows):
            if not any_ or conv != now:
                if any_:
                    yield (now, *sums, "".join(audit), sha.hexdigest())
                any_, now, sums, audit, sha, empty = True, conv, [0] * len(_COUNTS), [], hashlib.sha256(), True
            if piece is not None:
                audit.append(piece[0])
                sums = [a + b for a, b in zip(sums, piece[1], strict=True)]
            elif edit != "D":
                sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
        if any_:
            yield (now, *sums, "".join(audit), sha.hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(digested(_runs(batches, _READ)), _arrow(schema))

    return merged.mapInArrow(run, schema)


#: DuckDB: the least (cost, audit) of each state, row by row, as text of a padded cost and the audit.
ORACLE = r"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)),
        lambda c, b: list_reduce(CAST(range(8) AS BIGINT[]), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
        4294967295::BIGINT), 4294967295) % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM c WHERE kind > 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, left(role, 1) AS f,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM d),
r AS (SELECT *, CASE WHEN t = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(t, 1) IN ('.', '!', '?') THEN '' ELSE 't' END AS fault,
             lag(f) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
n AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
             count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || f NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
s AS (SELECT conv_id, 0::BIGINT AS i, repeat('0', 12) AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM n
      UNION ALL
      SELECT conv_id, i, n0, n1, n2, n3 FROM (
        SELECT y.conv_id, y.i, add0 AS n0, least(add1, CASE WHEN ok AND f = 's' THEN k0 END) AS n1,
               least(add2, CASE WHEN ok AND f = 'u' THEN ku END, CASE WHEN ok THEN ru END) AS n2,
               least(add3, CASE WHEN ok AND f = 'a' THEN ka END, CASE WHEN ok THEN ra END) AS n3
        FROM (SELECT x.*, lpad(CAST(CAST(left(s0, 12) AS BIGINT) + 4 AS VARCHAR), 12, '0') || substr(s0, 13) || 'D' AS add0,
                lpad(CAST(CAST(left(s1, 12) AS BIGINT) + 4 AS VARCHAR), 12, '0') || substr(s1, 13) || 'D' AS add1,
                lpad(CAST(CAST(left(p2, 12) AS BIGINT) + 4 AS VARCHAR), 12, '0') || substr(p2, 13) || 'D' AS add2,
                lpad(CAST(CAST(left(p3, 12) AS BIGINT) + 4 AS VARCHAR), 12, '0') || substr(p3, 13) || 'D' AS add3,
                lpad(CAST(CAST(left(s0, 12) AS BIGINT) + e AS VARCHAR), 12, '0') || substr(s0, 13) || 'K' AS k0,
                lpad(CAST(CAST(left(least(s0, s1, p3), 12) AS BIGINT) + e AS VARCHAR), 12, '0') || substr(least(s0, s1, p3), 13) || 'K' AS ku,
                lpad(CAST(CAST(left(p2, 12) AS BIGINT) + e AS VARCHAR), 12, '0') || substr(p2, 13) || 'K' AS ka,
                lpad(CAST(CAST(left(least(s0, s1, p3), 12) AS BIGINT) + e + 3 AS VARCHAR), 12, '0') || substr(least(s0, s1, p3), 13) || 'R' AS ru,
                lpad(CAST(CAST(left(p2, 12) AS BIGINT) + e + 3 AS VARCHAR), 12, '0') || substr(p2, 13) || 'R' AS ra
              FROM (SELECT w.*, least(s3, lpad(CAST(CAST(left(p2, 12) AS BIGINT) + 3 AS VARCHAR), 12, '0') || substr(p2, 13) || 'I') AS p3
                    FROM (SELECT s.conv_id, r.i, s0, s1, s3, f, fault IN ('', 't') AS ok, CASE fault WHEN 't' THEN 3 ELSE 0 END AS e,
                            least(s2, lpad(CAST(CAST(left(least(s0, s1, s3), 12) AS BIGINT) + 3 AS VARCHAR), 12, '0') || substr(least(s0, s1, s3), 13) || 'I') AS p2
                          FROM s JOIN r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1) w) x) y)),
z AS (SELECT conv_id, least(s0, s3, lpad(CAST(CAST(left(p2, 12) AS BIGINT) + 3 AS VARCHAR), 12, '0') || substr(p2, 13) || 'I') AS best, n.*
      FROM (SELECT s.*, least(s2, lpad(CAST(CAST(left(s1, 12) AS BIGINT) + 3 AS VARCHAR), 12, '0') || substr(s1, 13) || 'I') AS p2 FROM s) s
      JOIN (SELECT conv_id AS nc, * EXCLUDE conv_id FROM n) n ON s.conv_id IS NOT DISTINCT FROM nc AND s.i = n),
e AS (SELECT conv_id, substr(best, 13) AS audit, unnest(range(1, len(best) - 11)) AS pos FROM z),
p AS (SELECT conv_id, pos, audit[pos] AS edit, count(*) FILTER (audit[pos] <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS i FROM e),
q AS (SELECT p.conv_id, pos, edit, role, text, f, row_number() OVER (PARTITION BY p.conv_id ORDER BY pos) AS k
      FROM p LEFT JOIN r ON p.edit <> 'I' AND r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i WHERE edit <> 'D'),
m AS (SELECT *, bool_or(k = 1 AND edit = 'K' AND f = 's') OVER (PARTITION BY conv_id) AS sys FROM q),
t AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE CASE WHEN (k + CAST(sys AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END END
             || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS body FROM m GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, CAST(coalesce(left(best, 12), '0') AS BIGINT) AS cost,
       coalesce(substr(best, 13), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM a.conv_id
"""
