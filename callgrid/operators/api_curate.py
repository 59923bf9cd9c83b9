"""Curation of nested API records: required-field gate (P-11), global
keep-last (W-2), period filter after dedup (P-2), queue resolution (J-1…J-3), the
curated projection (P-13), ignored-row accounting (P-18) and run counts (A-18).

Every record is read once: one typed extraction gives the keys, J-1's queue and the first present
text of each curated field, and only these go through the dedup exchange; the record itself goes
along only where J-1 found no queue. The survivors are written once, with the stage that each
reached; curated calls, unmapped rows and the counts are all read from that table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrid.functions import exprs as X
from callgrid.operators.dedup import dedup_api
from callgrid.operators.flatten import path_column, scalar_text, shred, sub
from callgrid.operators.resolve import QUEUE_FIELD_CANDIDATES, exact_queue, resolve_fallback
from callgrid.schemas import CURATED_COLUMNS, DEFAULT_QUEUES, Queue, queue_dim
from callgrid.session import materialize

# Candidate paths per curated field, in priority order.
CALL_ID_FIELD = "from.call_id"
START_TIME_FIELD = "start_time"
SORT_FIELD = "to.call_id"
CALLER_FIELD_CANDIDATES = ("from.number", "from.user.number", "from.uri", "from.user", "caller.number",
                           "caller_number")
DNIS_FIELD_CANDIDATES = ("dnis", "dialled_number", "dialed_number", "to.number", "to.uri")
AGENT_NAME_FIELD_CANDIDATES = ("agent.name", "to.user.name", "to.name", "to.user", "user.name",
                               "answered_by.name", "to.username")
AGENT_EXTENSION_FIELD_CANDIDATES = ("agent.extension", "to.user.extension", "to.user", "user.extension",
                                    "to.extension")
AGENT_PHONE_FIELD_CANDIDATES = ("agent.phone", "to.user.phone", "user.phone", "to.number")
ANSWER_TIME_FIELD_CANDIDATES = ("answer_time", "answered_at")
QUEUE_SECONDS_FIELD_CANDIDATES = ("queue_time", "wait_time", "time_in_queue", "queue_duration")
AGENT_SECONDS_FIELD_CANDIDATES = ("agent_time", "talk_time", "duration", "call_duration")
HOLD_SECONDS_FIELD_CANDIDATES = ("hold_time", "hold_duration")
RELEASE_REASON_FIELD_CANDIDATES = ("queue_release_reason", "release_reason", "disposition", "termination_reason")
AGENT_RELEASE_REASON_FIELD_CANDIDATES = ("agent_release_reason", "release_reason", "disposition",
                                         "termination_reason")
API_SOURCE_FILE = "api_records"
PRESENCE_HEAD = 100  # records looked at before the whole table is
MISSING_API_FIELDS = "missing_api_fields"
UNMAPPED_QUEUE = "unmapped_queue"
MISSING_FIELDS_MESSAGE = "Missing required API fields: {fields}"
UNMAPPED_MESSAGE = "{n} API CDR rows could not be mapped to tracked queue IDs."
DEFAULT_TIMEZONE = "America/Toronto"

# an offset stands behind a time of day; the end of a bare date is none
_TIME_OFFSET = r"([T ][0-9]{2}:[0-9]{2}[0-9:.,]*)\s*(Z|[+-][0-9]{2}(?::?[0-9]{2})?)$"


def _first(paths: tuple[str, ...]) -> Column:
    """F-6 over the cleaned candidate columns."""
    return F.coalesce(*[F.col(path_column(p)) for p in paths])


def _first_number_flag(paths: tuple[str, ...]) -> Column:
    """Whether the first present candidate is a number."""
    flags = [F.when(F.col(path_column(p)).isNotNull(), F.col(path_column(p) + "_num")) for p in paths]
    return F.coalesce(*flags, F.lit(False))


def api_wall_clock(text: str | Column, tz: str = DEFAULT_TIMEZONE) -> Column:
    """F-10 / T7: ISO text -> wall-clock TIMESTAMP_NTZ in ``tz``.

    With an offset the instant is converted to ``tz``; without one the text already is
    ``tz`` wall-clock. The offset is detected first because parsing would drop it.
    """
    t = F.col(text) if isinstance(text, str) else text
    off = F.regexp_extract(t, _TIME_OFFSET, 2)
    minutes = F.when(F.length(off) > 3, F.right(off, F.lit(2))).otherwise(F.lit("00"))
    src = F.when(off == "", F.lit(tz)).when(off == "Z", F.lit("UTC")).otherwise(
        F.concat(F.left(off, F.lit(3)), F.lit(":"), minutes))
    naive = F.to_timestamp_ntz(F.regexp_replace(F.regexp_replace(t, _TIME_OFFSET, "$1"), " ", "T"))
    return F.convert_timezone(src, F.lit(tz), naive)


#: Each curated field's candidates; seconds also keep whether the value was a number.
_TEXTS = {"caller": CALLER_FIELD_CANDIDATES, "dnis": DNIS_FIELD_CANDIDATES, "agent": AGENT_NAME_FIELD_CANDIDATES,
          "extension": AGENT_EXTENSION_FIELD_CANDIDATES, "phone": AGENT_PHONE_FIELD_CANDIDATES,
          "answer": ANSWER_TIME_FIELD_CANDIDATES, "queue_reason": RELEASE_REASON_FIELD_CANDIDATES,
          "agent_reason": AGENT_RELEASE_REASON_FIELD_CANDIDATES}
_SECONDS = {"queue_sec": QUEUE_SECONDS_FIELD_CANDIDATES, "agent_sec": AGENT_SECONDS_FIELD_CANDIDATES,
            "hold_sec": HOLD_SECONDS_FIELD_CANDIDATES}
CALLER_NAME_FIELD = "from.name"
#: Lineage columns behind the curated ones (P-13).
SOURCE_COLUMNS = ("source_queue_id", "Orig CallID", "source_file")

OUT_OF_PERIOD, UNMAPPED, CURATED = "out_of_period", "unmapped", "curated"


@dataclass(frozen=True)
class FieldPresence:
    call_id: bool
    start_time: bool
    sort_field: bool
    records: int

    @property
    def missing(self) -> list[str]:
        return [f for f, ok in ((CALL_ID_FIELD, self.call_id), (START_TIME_FIELD, self.start_time)) if not ok]


def field_presence(records: DataFrame, rec: str = "rec") -> FieldPresence:
    """P-11 gate: which key fields exist in any record, and the number of records.

    Fields that are found in the first records exist; where one is not, all records are read.
    """
    head = records.select(*[sub(rec, p).isNotNull() for p in (CALL_ID_FIELD, START_TIME_FIELD, SORT_FIELD)]).take(PRESENCE_HEAD)
    if head and all(map(any, zip(*head))):
        return FieldPresence(True, True, True, records.count())
    row = records.agg(*[F.max(sub(rec, p).isNotNull()).alias(a) for p, a in
                        ((CALL_ID_FIELD, "c"), (START_TIME_FIELD, "s"), (SORT_FIELD, "o"))],
                      F.count(F.lit(1)).alias("n")).first()
    return FieldPresence(bool(row["c"]), bool(row["s"]), bool(row["o"]), row["n"])


def keyed_records(records: DataFrame, presence: FieldPresence, rec: str = "rec") -> DataFrame:
    """Records with the dedup key and the keep-last sort key (to.call_id, else start_time)."""
    sort_path = SORT_FIELD if presence.sort_field else START_TIME_FIELD
    return records.withColumns({
        "call_key": scalar_text(rec, CALL_ID_FIELD),
        "sort_key": scalar_text(rec, sort_path),
    })


def extract(records: DataFrame, presence: FieldPresence, queues: tuple[Queue, ...] = DEFAULT_QUEUES,
            rec: str = "rec") -> DataFrame:
    """Keys, J-1's queue and the first present text of each curated field, from one reading of the record."""
    fields = _TEXTS | _SECONDS | {"name": (CALLER_NAME_FIELD,)}
    candidates = [p for paths in fields.values() for p in paths]
    numeric = list(dict.fromkeys(p for paths in _SECONDS.values() for p in paths))
    staged = shred(records.select("rec_no", rec), (CALL_ID_FIELD, START_TIME_FIELD, SORT_FIELD),
                   list(dict.fromkeys([*candidates, *QUEUE_FIELD_CANDIDATES])), numeric, rec)
    text = lambda p: F.col(path_column(p))
    staged = staged.select(
        "rec_no", rec, text(CALL_ID_FIELD).alias("call_key"), text(SORT_FIELD if presence.sort_field else START_TIME_FIELD).alias("sort_key"),
        text(START_TIME_FIELD).alias("call_time"), exact_queue(queues).alias("exact_id"),
        *[_first(paths).alias(n) for n, paths in fields.items()], *[_first_number_flag(paths).alias(n + "_num") for n, paths in _SECONDS.items()])
    return staged.withColumn("open_rec", F.when(F.col("exact_id").isNull(), F.col(rec))).drop(rec)


def stage(records: DataFrame, presence: FieldPresence, queues: tuple[Queue, ...] = DEFAULT_QUEUES,
          tz: str = DEFAULT_TIMEZONE, start: str | None = None, end: str | None = None, rec: str = "rec") -> DataFrame:
    """W-2 -> P-2 -> J-1/J-2: the last record of each call with its queue and the ``stage`` it reached.

    The survivors are written once to the shared folder; J-2 flattens those of the period that are still open.
    """
    last = dedup_api(extract(records, presence, queues, rec), key="call_key", sort_key="sort_key", ordinal="rec_no")
    dated = last.withColumn("call_datetime", api_wall_clock("call_time", tz))
    day, inside = F.to_date("call_datetime"), F.lit(True)
    if start is not None:
        inside = inside & (day >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (day <= F.lit(end).cast("date"))
    dated = materialize(dated.withColumn("in_period", F.coalesce(inside, F.lit(False))), "api-calls")
    still_open = dated.where(F.col("in_period") & F.col("open_rec").isNotNull())
    fallback = resolve_fallback(still_open, queues, rec="open_rec").withColumnRenamed("rec_no", "resolved_no")
    found = dated.drop("open_rec").join(fallback, F.col("rec_no") == F.col("resolved_no"), "left")
    queue = F.coalesce("exact_id", "fallback_queue_id")
    reached = (F.when(~F.col("in_period"), OUT_OF_PERIOD).when(queue.isNull(), UNMAPPED).otherwise(CURATED))
    return found.select("*", queue.alias("queue_id"), reached.alias("stage")).drop(
        "exact_id", "resolved_no", "fallback_queue_id", "in_period")


def curated_calls(staged: DataFrame, queues: tuple[Queue, ...] = DEFAULT_QUEUES) -> DataFrame:
    """P-13: the curated columns, lineage and the metrics' handled flag of the calls that reached a queue."""
    dim = queue_dim(staged.sparkSession, queues).drop("queue_pos")
    calls = staged.where(F.col("stage") == CURATED).join(F.broadcast(dim), "queue_id")
    caller = X.sip_number("caller")
    ts = F.col("call_datetime")
    calls = calls.withColumn("caller_number", caller).withColumnRenamed("agent", "agent_name")
    seconds = {n: X.coerce_seconds(F.col(n), F.col(n + "_num")) for n in _SECONDS}
    out = calls.select(
        "queue_id", "queue_name", "language", "role", F.col("call_key").alias("call_id"), "call_time",
        "call_datetime", F.to_date(ts).alias("date"), F.hour(ts).alias("hour"), X.day_name(ts).alias("dow"),
        F.col("name").alias("caller_name"), "caller_number",
        X.normalize_caller("caller_number", "call_key").alias("caller_number_norm"),
        "dnis", F.col("extension").alias("agent_extension"), F.col("phone").alias("agent_phone"), "agent_name",
        *[c.alias(n) for n, c in seconds.items()],
        F.col("agent_reason").alias("agent_release_reason"), F.col("queue_reason").alias("queue_release_reason"),
        F.when(F.col("answer").isNotNull() | F.col("agent_name").isNotNull(), F.lit(X.HANDLED)).otherwise(F.lit(X.NO_AGENT))
         .alias("handled_flag"),
        F.col("queue_id").alias("source_queue_id"), F.col("call_key").alias("Orig CallID"),
        F.lit(API_SOURCE_FILE).alias("source_file"))
    # T5: the metrics' handled predicate is agent_sec > 0, independent of handled_flag
    return out.withColumn("is_handled", X.answered(["agent_sec"])).select(*CURATED_COLUMNS, *SOURCE_COLUMNS, "is_handled")


def unmapped_rows(staged: DataFrame) -> DataFrame:
    """P-18: in-period records that no queue matched."""
    return staged.where(F.col("stage") == UNMAPPED)


def api_pipeline(records: DataFrame, queues: tuple[Queue, ...] = DEFAULT_QUEUES, tz: str = DEFAULT_TIMEZONE,
                 start: str | None = None, end: str | None = None, presence: FieldPresence | None = None,
                 rec: str = "rec") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records ``(rec_no, rec VARIANT)`` -> ``(curated, unmapped, counts)``, all from one dedup of one reading.

    Raises when a required field is absent from every record (the caller writes the gap).
    """
    presence = presence or field_presence(records, rec)
    if presence.missing:
        raise ValueError(MISSING_FIELDS_MESSAGE.format(fields=", ".join(presence.missing)))
    staged = stage(records, presence, queues, tz, start, end, rec)
    return curated_calls(staged, queues), unmapped_rows(staged), curation_counts(staged, presence)


def curation_counts(staged: DataFrame, presence: FieldPresence) -> DataFrame:
    """A-18 / P-18: record, deduped, curated and ignored-unmapped counts by one aggregate over the stages; a source gap
    when rows were ignored and nothing was curated."""
    reached = lambda s: F.count_if(F.col("stage") == s)
    one = staged.agg(F.count(F.lit(1)).alias("deduped_count"), reached(CURATED).alias("curated_count"),
                     reached(UNMAPPED).alias("ignored_unmapped_queue_rows"))
    gap = (F.col("ignored_unmapped_queue_rows") > 0) & (F.col("curated_count") == 0)
    return one.select(F.lit(presence.records).cast("bigint").alias("record_count"), "deduped_count", "curated_count",
                      "ignored_unmapped_queue_rows", F.when(gap, F.lit("source_gap")).otherwise(F.lit("success")).alias("status"))
