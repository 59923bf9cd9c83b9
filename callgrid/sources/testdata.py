"""Adapters from the driver's tables to call legs / API records.

Everything here is a deterministic projection of ``events`` or ``lineitem`` so
the DuckDB oracle can rebuild the same rows; the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrid.operators.resolve import QUEUE_FIELD_CANDIDATES
from callgrid.schemas import DEFAULT_QUEUES, RAW_LEG_COLUMNS, Queue, queue_dim
from callgrid.session import spread, table_path

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def _padded(number: Column, width: int) -> Column:
    """Decimal text with leading zeros up to ``width``; longer numbers keep all digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _mmss(total: Column) -> Column:
    return F.concat(_padded((total / 60).cast("bigint"), 2), F.lit(":"), _padded(total % 60, 2))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "events")).select(*EVENT_COLUMNS)


def events_base(events: DataFrame) -> DataFrame:
    """Events with the two derived integers ``k`` (from props) and ``v`` (floor of value)."""
    return events.select(
        "event_id", "ts", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.floor("value").cast("bigint").alias("v"),
    )


def _queue_of(k: Column, user_id: Column, queues: tuple[Queue, ...]) -> Column:
    # primary queue by language below k=70, overflow otherwise (language = user parity)
    by = {(q.language, q.role): q.queue_id for q in queues}
    even = (user_id % 2) == 0
    primary = F.when(even, F.lit(by[("English", "primary")])).otherwise(F.lit(by[("French", "primary")]))
    overflow = F.when(even, F.lit(by[("English", "overflow")])).otherwise(F.lit(by[("French", "overflow")]))
    return F.when(k < 70, primary).otherwise(overflow)


def events_to_legs(events: DataFrame, spark: SparkSession,
                   queues: tuple[Queue, ...] = DEFAULT_QUEUES) -> DataFrame:
    """Raw CSV-style call legs (all text) with lineage columns and a file-order ordinal ``leg_no``.

    Built as SQL expressions (one plan node).
    """
    by = {(q.language, q.role): q.queue_id for q in queues}
    qid = (f"CASE WHEN k < 70 THEN (CASE WHEN user_id % 2 = 0 THEN '{by[('English', 'primary')]}' "
           f"ELSE '{by[('French', 'primary')]}' END) ELSE (CASE WHEN user_id % 2 = 0 "
           f"THEN '{by[('English', 'overflow')]}' ELSE '{by[('French', 'overflow')]}' END) END")
    legs = events_base(events).selectExpr(
        "event_id AS leg_no", f"{qid} AS queue_id", "k", "k % 12 AS slot",
        "concat('c', CAST(user_id * 1000 + dayofyear(ts) AS STRING)) AS orig_call_id",
        "date_format(ts, 'MM/dd/yyyy h:mm a') AS call_time",
        "CASE WHEN user_id % 13 <> 1 THEN concat('Caller ', CAST(user_id AS STRING)) END AS caller_name",
        "CASE WHEN user_id % 13 = 0 THEN 'Restricted' WHEN user_id % 13 = 1 THEN CAST(NULL AS STRING) "
        "ELSE concat('+1 (613) 555-', lpad(CAST(user_id AS STRING), greatest(4, length(CAST(user_id AS STRING))), '0')) "
        "END AS caller_number",
        "'6135550100' AS dnis",
        "CASE WHEN k % 12 <> 0 THEN CAST(k % 12 + 100 AS STRING) END AS agent_extension",
        "CASE WHEN k % 12 = 4 THEN '613-555-0199' END AS agent_phone",
        "concat('00:', lpad(CAST(k % 60 AS STRING), 2, '0')) AS time_in_queue",
        "CASE WHEN k = 5 THEN '53ms' WHEN event_type IN ('error', 'signup') THEN '00:00' "
        "ELSE concat(lpad(CAST(v DIV 60 AS STRING), greatest(2, length(CAST(v DIV 60 AS STRING))), '0'), ':', "
        "lpad(CAST(v % 60 AS STRING), 2, '0')) END "
        "AS agent_time",
        "CASE WHEN k % 4 = 0 THEN concat('00:', lpad(CAST(k % 60 AS STRING), 2, '0')) ELSE '00:00' END AS hold_time",
        "CASE WHEN event_type = 'error' THEN 'No Answer' WHEN event_type = 'signup' THEN ' Abandoned ' "
        "WHEN event_type = 'view' THEN 'Orig: Bye' WHEN event_type = 'click' THEN 'Term: Bye' "
        "ELSE (CASE WHEN k % 2 = 1 THEN '' END) END AS queue_release_reason",
        "CASE WHEN event_type = 'error' THEN 'No Answer' WHEN event_type = 'signup' THEN 'Abandoned' "
        "WHEN event_type = 'view' THEN 'Term: Bye' WHEN event_type = 'click' THEN 'Orig: Bye' "
        "ELSE (CASE WHEN k % 3 = 0 THEN ' null ' ELSE 'Term: 503' END) END AS agent_release_reason",
    )
    legs = legs.selectExpr(
        "*", "CASE WHEN slot = 0 THEN CAST(NULL AS STRING) WHEN slot = 1 THEN 'IVR System' "
        "WHEN slot = 2 THEN ' null ' "
        f"WHEN queue_id = '{queues[3].queue_id}' AND slot <> 3 THEN 'Agent 7' "
        "ELSE concat('Agent ', CAST(slot AS STRING)) END AS agent_name",
        "concat('calls_', queue_id, '_2024-01.csv') AS source_file").drop("k", "slot")
    dim = queue_dim(spark, queues).drop("queue_pos")
    legs = legs.join(F.broadcast(dim), "queue_id", "inner")
    return legs.select(*RAW_LEG_COLUMNS)


def legs_from_tables(spark: SparkSession, sf_dir: str,
                     queues: tuple[Queue, ...] = DEFAULT_QUEUES) -> DataFrame:
    return events_to_legs(read_events(spark, sf_dir), spark, queues)


# --- lineitem as a large leg source (bench) ---------------------------------------------

LINEITEM_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def lineitem_to_legs(spark: SparkSession, sf_dir: str,
                     queues: tuple[Queue, ...] = DEFAULT_QUEUES) -> DataFrame:
    """Call legs from ``lineitem``: call key ``l_orderkey``; daily grain only (no time of day).

    ``leg_no`` is the full ordering list as a struct, so keep-last is deterministic even
    though ``(l_orderkey, l_linenumber)`` is not unique.
    """
    li = spark.read.parquet(table_path(sf_dir, "lineitem"))
    qid = F.element_at(F.array(*[F.lit(q.queue_id) for q in queues]),
                       (F.col("l_suppkey") % len(queues) + 1).cast("int"))
    secs = (F.col("l_quantity") * 7).cast("bigint")
    legs = li.select(
        qid.alias("queue_id"),
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("orig_call_id"),
        F.date_format("l_shipdate", "MM/dd/yyyy h:mm a").alias("call_time"),
        F.lit(None).cast("string").alias("caller_name"),
        F.when(F.col("l_partkey") % 17 == 0, F.lit("Restricted"))
         .otherwise(F.concat(F.lit("+1 (416) 55"), _padded(F.col("l_partkey"), 5)))
         .alias("caller_number"),
        F.lit(None).cast("string").alias("dnis"),
        F.lit(None).cast("string").alias("agent_extension"),
        F.lit(None).cast("string").alias("agent_phone"),
        F.concat(F.lit("00:"), F.lpad((F.col("l_linenumber") * 7 % 60).cast("string"), 2, "0")).alias("time_in_queue"),
        F.when(F.col("l_returnflag") == "R", F.lit("00:00")).otherwise(_mmss(secs)).alias("agent_time"),
        F.when(F.col("l_discount") > 0.05, F.lit("00:30")).otherwise(F.lit("00:00")).alias("hold_time"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Agent "), (F.col("l_suppkey") % 40).cast("string"))).alias("agent_name"),
        F.when(F.col("l_returnflag") == "R", F.lit("No Answer")).otherwise(F.lit("Term: Bye")).alias("queue_release_reason"),
        F.when(F.col("l_linestatus") == "O", F.lit("Orig: Bye")).otherwise(F.lit("Term: Bye")).alias("agent_release_reason"),
        *[F.col(c) for c in LINEITEM_ORDER],
        "l_orderkey",
    )
    # file-order stand-in: the full ordering list as one comparable struct (no duplicate full rows)
    legs = legs.withColumn("leg_no", F.struct(*[F.col(c) for c in LINEITEM_ORDER]))
    dim = queue_dim(spark, queues).drop("queue_pos")
    legs = legs.join(F.broadcast(dim), "queue_id").withColumn(
        "source_file", F.concat(F.lit("lineitem_"), F.col("queue_id"), F.lit(".csv")))
    return legs.select(*RAW_LEG_COLUMNS)


# --- events as nested API records (JSON Lines) -----------------------------------------

def events_to_api_records(events: DataFrame, queues: tuple[Queue, ...] = DEFAULT_QUEUES) -> DataFrame:
    """One JSON record per event: ``(rec_no, value)`` with the shapes the API path must handle.

    ``to.user`` and ``to.queue`` are text in some records and objects in others (T6); the queue stands, as id or
    name, at each of J-1's paths in turn, behind an unmatched ``by.user`` at the last one, or only in a free-text
    ``queue_label`` (J-2) or not at all (unmapped); start
    times are naive wall-clock (also with a space, a fraction or as a bare date) or have
    an offset (``Z``, ``+0530``, ``-03:00``; T7); durations are numbers, numeric
    text or ``53ms``; unanswered errors may still carry a duration (T5).
    """
    e = events_base(events)
    k, uid, et, v = F.col("k"), F.col("user_id"), F.col("event_type"), F.col("v")
    slot = k % 12
    qid = _queue_of(k, uid, queues)
    names = F.create_map(*[x for q in queues for x in (F.lit(q.queue_id), F.lit(q.name))])
    agent = (F.when(slot == 0, F.lit(None).cast("string"))
             .when(slot == 1, F.lit("IVR System"))
             .when(slot == 2, F.lit(" null "))
             .when((qid == queues[3].queue_id) & (slot != 3), F.lit("Agent 7"))
             .otherwise(F.concat(F.lit("Agent "), slot.cast("string"))))
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_id") % 20
    start = (F.when(kind == 4, F.date_format("ts", "yyyy-MM-dd"))
             .when(kind == 8, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
             .when(kind == 12, F.concat(local, F.lit(".250")))
             .when(kind == 7, F.concat(local, F.lit("+0530")))
             .when(kind == 13, F.concat(local, F.lit("-03:00")))
             .when(kind % 2 == 0, local).otherwise(F.concat(local, F.lit("Z"))))
    number = (F.when(uid % 13 == 0, F.lit("Restricted"))
              .when(uid % 13 == 1, F.lit(None).cast("string"))
              .when(uid % 13 == 2, F.concat(F.lit("sip:+1613555"), _padded(uid, 4),
                                            F.lit("@pbx.example.net;user=phone")))
              .otherwise(F.concat(F.lit("+1 (613) 555-"), _padded(uid, 4))))
    frm = F.to_json(F.struct(
        F.concat(F.lit("c"), (uid * 1000 + F.dayofyear("ts")).cast("string")).alias("call_id"),
        number.alias("number"), F.concat(F.lit("Caller "), uid.cast("string")).alias("name")))
    # J-1: the queue's id, or its name in other letters, at one of the candidate paths (``_ref``)
    at, last = F.col("_at"), len(QUEUE_FIELD_CANDIDATES) - 1
    e = e.withColumns({"_qid": qid, "_at": F.col("event_id") % len(QUEUE_FIELD_CANDIDATES)}).withColumn("_ref", F.when(k % 7 != 0, F.when(
        at % 2 == 1, F.upper(F.try_element_at(names, F.col("_qid")))).otherwise(F.col("_qid"))))
    qid, ref = F.col("_qid"), F.col("_ref")

    def carried(prefix: str) -> Column:
        """The object at ``prefix``: the queue in the field whose turn it is."""
        own = {p.removeprefix(prefix + "."): n for n, p in enumerate(QUEUE_FIELD_CANDIDATES) if p.startswith(prefix + ".")}
        fields = {f: F.when(at == n, ref) for f, n in own.items()}
        turns = [*own.values()]
        if prefix == "by":  # an unmatched path in front of the last one
            fields["user"], turns = F.when(at == last, "Lobby").otherwise(fields["user"]), [*turns, last]
        return F.when(ref.isNotNull() & at.isin(*turns), F.struct(*[c.alias(f) for f, c in fields.items()]))

    to_call = F.when(k % 10 != 0, F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("-"),
                                          F.col("event_id").cast("string")))
    to_str = F.to_json(F.struct(to_call.alias("call_id"), agent.alias("user")))
    to_obj = F.to_json(F.struct(to_call.alias("call_id"), F.when(agent.isNotNull(), F.struct(
        agent.alias("name"), (slot + 100).cast("string").alias("extension"))).alias("user")))
    to_json = F.when(k % 3 == 0, to_str).otherwise(to_obj)
    field = lambda name, value: F.concat(F.lit(f'"{name}":'), value)
    to_queue = F.coalesce(F.to_json(carried("to.queue")), F.when(at == last, F.concat(F.lit('"'), ref, F.lit('"'))))
    duration = (F.when(k == 5, F.to_json(F.struct(F.lit("53ms").alias("d"))))
                .when(et.isin("error", "signup"),
                      F.to_json(F.struct(F.when(k % 5 == 1, F.lit(12)).otherwise(F.lit(0)).alias("d"))))
                .when(k % 9 == 0, F.to_json(F.struct(v.cast("string").alias("d"))))
                .otherwise(F.to_json(F.struct(v.alias("d")))))
    rest = F.to_json(F.struct(
        start.alias("start_time"),
        F.when(et.isin("view", "click"), start).alias("answer_time"),
        F.concat(F.lit("00:"), F.lpad((k % 60).cast("string"), 2, "0")).alias("queue_time"),
        F.when(k % 4 == 0, k % 60).otherwise(F.lit(0)).alias("hold_time"),
        F.when(et == "error", F.lit("No Answer")).when(et == "signup", F.lit("Abandoned"))
         .when(et == "view", F.lit("Orig: Bye")).when(et == "click", F.lit("Term: Bye")).alias("release_reason"),
        *[carried(p).alias(p) for p in ("by", "call_queue", "queue")],
        # a field that the source only sends from the middle of the month on
        F.when(F.dayofmonth("ts") > 15, F.concat(F.lit("61355570"), _padded(k % 100, 2))).alias("dialled_number"),
        F.when((k % 7 == 0) & (k % 14 != 0), F.try_element_at(names, qid))
         .when(k % 14 == 0, F.lit("Main Line")).alias("queue_label"),
    ))
    # splice: {"from":…,"to":…,"duration":…, <rest without its braces>}
    inner = F.when(F.col("_to") != "{}", F.expr("substring(_to, 2, length(_to) - 2)"))
    to = F.concat(F.lit("{"), F.concat_ws(",", inner, field("call_queue", F.to_json(carried("to.call_queue"))), field("queue", to_queue)), F.lit("}"))
    body = F.concat(F.lit('{"from":'), F.col("_from"), F.lit(',"to":'), to, F.lit(',"duration":'),
                    F.regexp_extract("_duration", r'^\{"d":(.*)\}$', 1), F.lit(","), F.expr("substring(_rest, 2)"))
    return (e.withColumns({"_from": frm, "_to": to_json, "_duration": duration, "_rest": rest})
            .select(F.col("event_id").alias("rec_no"), body.alias("value")))


def api_records_from_tables(spark: SparkSession, sf_dir: str,
                            queues: tuple[Queue, ...] = DEFAULT_QUEUES) -> DataFrame:
    """Landed-record stand-in: ``(rec_no, rec VARIANT)`` parsed from the JSON text (S-3).

    The events are spread first: building and reading a record costs far more than shuffling its event.
    """
    recs = events_to_api_records(spread(read_events(spark, sf_dir), "event_id"), queues)
    return recs.select("rec_no", F.parse_json("value").alias("rec"))
