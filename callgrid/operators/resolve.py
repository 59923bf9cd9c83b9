"""Queue resolution for nested records: exact candidates (J-1), fallback over any field
whose path names a queue (J-2), and dimension enrichment (J-3).

The queue dimension is configuration (a handful of rows), so it is used as literal
maps / CASE chains inside expressions: no join against raw records is needed for J-1.
J-2 flattens only the records that J-1 could not resolve.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrid.functions.exprs import clean_text
from callgrid.operators.flatten import flatten_paths, leaf_text, path_column, shred
from callgrid.schemas import Queue
from callgrid.session import materialize

# Candidate paths that may carry the queue, in priority order.
QUEUE_FIELD_CANDIDATES = (
    "by.user", "by.username", "by.value",
    "call_queue.id", "call_queue.queue", "call_queue.number", "call_queue.extension",
    "queue.id", "queue.queue", "queue.number", "queue.extension",
    "to.call_queue.id", "to.call_queue.queue", "to.queue.id", "to.queue",
)


def _id_map(queues: tuple[Queue, ...]) -> Column:
    return F.create_map(*[x for q in queues for x in (F.lit(q.queue_id), F.lit(q.queue_id))])


def _name_map(queues: tuple[Queue, ...]) -> Column:
    return F.create_map(*[x for q in queues for x in (F.lit(q.name.lower()), F.lit(q.queue_id))])


def match_exact(text: Column, queues: tuple[Queue, ...]) -> Column:
    """A tracked id, or a queue name compared case-insensitively."""
    return F.coalesce(F.try_element_at(_id_map(queues), text), F.try_element_at(_name_map(queues), F.lower(text)))


def match_loose(text: Column, queues: tuple[Queue, ...]) -> Column:
    """A tracked id, else the first queue (dimension order) whose name the text contains."""
    contains = None
    for q in queues:
        cond = F.lower(text).contains(q.name.lower())
        contains = F.when(cond, F.lit(q.queue_id)) if contains is None else contains.when(cond, F.lit(q.queue_id))
    return F.coalesce(F.try_element_at(_id_map(queues), text), contains)


def exact_queue(queues: tuple[Queue, ...]) -> Column:
    """J-1 over the cleaned candidate columns: the first one whose text is a tracked id or name (an unmatched
    earlier path does not block a later one). One match over the array of candidates: a match a column would
    outgrow the method that whole-stage code compiles to."""
    texts = F.array(*[F.col(path_column(p)) for p in QUEUE_FIELD_CANDIDATES])
    return F.get(F.filter(F.transform(F.array_compact(texts), lambda t: match_exact(t, queues)), lambda q: q.isNotNull()), 0)


def with_exact_queue(records: DataFrame, queues: tuple[Queue, ...], rec: str = "rec", out: str = "_q1") -> DataFrame:
    """``records`` with J-1's result as a column."""
    return shred(records, cleaned=QUEUE_FIELD_CANDIDATES, rec=rec).select(*records.columns, exact_queue(queues).alias(out))


def open_records(records: DataFrame, queues: tuple[Queue, ...], id_col: str = "rec_no", rec: str = "rec") -> DataFrame:
    """``(id, rec)`` of the records that J-1 leaves open, read from a table written once: a filter on J-1's result itself
    would be moved below the extraction and repeat it, and whatever builds the record, for each candidate path."""
    left = with_exact_queue(records.select(id_col, rec), queues, rec).select(
        id_col, F.when(F.col("_q1").isNull(), F.col(rec)).alias(rec))
    return materialize(left, "open-records").where(F.col(rec).isNotNull())


def resolve_fallback(unresolved: DataFrame, queues: tuple[Queue, ...], id_col: str = "rec_no",
                     rec: str = "rec") -> DataFrame:
    """J-2: ``(id, fallback_queue_id)`` for the records it resolves: the first field (path order) whose path contains
    "queue" and whose value names a tracked queue."""
    named = flatten_paths(unresolved, [id_col], rec).where(F.lower("path").contains("queue"))
    matched = named.select(id_col, "path", match_loose(clean_text(leaf_text()), queues).alias("queue"))
    first = F.min(F.struct("path", "queue"))["queue"]
    return matched.where(F.col("queue").isNotNull()).groupBy(id_col).agg(first.alias("fallback_queue_id"))
