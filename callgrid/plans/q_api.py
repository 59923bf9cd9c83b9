"""Query family: the nested API path (VARIANT records built from ``events``).

S-3, F-6, F-9…F-13, W-2, P-2, P-11, J-1…J-3, P-13, P-18, A-18.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from callgrid import oracle as O
from callgrid.functions import exprs as X
from callgrid.operators import api_curate as A
from callgrid.operators.dedup import dedup_api
from callgrid.operators.flatten import field_inventory as inventory
from callgrid.operators.flatten import path_column, shred
from callgrid.operators.resolve import open_records, resolve_fallback, with_exact_queue
from callgrid.plans import context as ctx
from callgrid.plans.catalog import register
from callgrid.plans.q_core import CURATED_SELECT
from callgrid.schemas import DEFAULT_QUEUES
from callgrid.sources.testdata import api_records_from_tables

TZ = "America/Toronto"

API_BASE = f"""WITH {O.LEGS.split('legs0 AS')[0].rstrip().rstrip(',')},
api0 AS (
  SELECT event_id AS rec_no, k, v, event_type, user_id, k % 12 AS slot,
    CASE WHEN k < 70 THEN (CASE WHEN user_id % 2 = 0 THEN '8020' ELSE '8021' END)
         ELSE (CASE WHEN user_id % 2 = 0 THEN '8030' ELSE '8031' END) END AS qid,
    'c' || CAST(user_id * 1000 + dayofyear(ts) AS VARCHAR) AS call_key,
    CASE WHEN k % 10 <> 0 THEN strftime(ts, '%Y%m%d%H%M%S') || '-' || CAST(event_id AS VARCHAR) END AS sort_key,
    CASE WHEN day(ts) > 15 THEN '61355570' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') END AS dialled,
    CASE event_id % 20 WHEN 4 THEN strftime(ts, '%Y-%m-%d') WHEN 8 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 20 = 12 THEN '.250' WHEN event_id % 20 = 7 THEN '+0530'
        WHEN event_id % 20 = 13 THEN '-03:00' WHEN event_id % 2 = 0 THEN '' ELSE 'Z' END END AS start_time,
    CASE WHEN event_id % 20 = 4 THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
         WHEN event_id % 20 = 12 THEN date_trunc('second', ts) + INTERVAL 250 MILLISECOND
         WHEN event_id % 20 = 7 THEN timezone('{TZ}', timezone('UTC', date_trunc('second', ts) - INTERVAL 330 MINUTE))
         WHEN event_id % 20 = 13 THEN timezone('{TZ}', timezone('UTC', date_trunc('second', ts) + INTERVAL 180 MINUTE))
         WHEN event_id % 2 = 0 THEN date_trunc('second', ts)
         ELSE timezone('{TZ}', timezone('UTC', date_trunc('second', ts))) END AS call_datetime,
    CASE WHEN user_id % 13 = 0 THEN 'Restricted' WHEN user_id % 13 = 1 THEN NULL
         WHEN user_id % 13 = 2 THEN 'sip:+1613555' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(4, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') || '@pbx.example.net;user=phone'
         ELSE '+1 (613) 555-' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(4, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') END AS from_number,
    CASE WHEN k = 5 THEN NULL WHEN event_type IN ('error', 'signup') THEN (CASE WHEN k % 5 = 1 THEN 12.0 ELSE 0.0 END)
         ELSE CAST(v AS DOUBLE) END AS agent_sec,
    CASE WHEN event_type = 'error' THEN 'No Answer' WHEN event_type = 'signup' THEN 'Abandoned'
         WHEN event_type = 'view' THEN 'Orig: Bye' WHEN event_type = 'click' THEN 'Term: Bye' END AS reason,
    event_type IN ('view', 'click') AS answered_at
  FROM ev),
api1 AS (
  SELECT *, CASE WHEN slot = 0 THEN NULL WHEN slot = 1 THEN 'IVR System' WHEN slot = 2 THEN ' null '
      WHEN qid = '8031' AND slot <> 3 THEN 'Agent 7' ELSE 'Agent ' || CAST(slot AS VARCHAR) END AS agent_raw,
    CASE WHEN k % 7 <> 0 THEN qid END AS exact_q,
    CASE WHEN k % 7 <> 0 THEN qid WHEN k % 14 <> 0 THEN qid END AS resolved_q,
    CASE WHEN regexp_matches({O.clean_text('from_number')}, '(?i)sip:([^@;>]+)')
         THEN regexp_extract({O.clean_text('from_number')}, '(?i)sip:([^@;>]+)', 1)
         ELSE {O.clean_text('from_number')} END AS caller_number
  FROM api0)"""

API_CURATED_CTES = API_BASE + f""",
deduped AS (SELECT * FROM api1
  QUALIFY row_number() OVER (PARTITION BY call_key ORDER BY sort_key DESC NULLS FIRST, rec_no DESC) = 1),
in_period AS (SELECT * FROM deduped WHERE CAST(call_datetime AS DATE) BETWEEN DATE '{O.PERIOD_START}' AND DATE '{O.PERIOD_END}'),
api_curated AS (
  SELECT d.queue_id, d.queue_name, d.language, d.role, p.call_key AS call_id, p.start_time AS call_time,
    p.call_datetime, CAST(p.call_datetime AS DATE) AS date, CAST(hour(p.call_datetime) AS INTEGER) AS hour,
    strftime(p.call_datetime, '%A') AS dow, 'Caller ' || CAST(p.user_id AS VARCHAR) AS caller_name,
    p.caller_number, {O.normalize_caller('p.caller_number', 'p.call_key')} AS caller_number_norm,
    p.dialled AS dnis,
    CASE WHEN p.slot = 0 THEN NULL WHEN p.k % 3 <> 0 THEN CAST(p.slot + 100 AS VARCHAR)
         ELSE {O.clean_text('p.agent_raw')} END AS agent_extension,
    CAST(NULL AS VARCHAR) AS agent_phone, {O.clean_text('p.agent_raw')} AS agent_name,
    CAST(p.k % 60 AS DOUBLE) AS queue_sec, p.agent_sec,
    CAST(CASE WHEN p.k % 4 = 0 THEN p.k % 60 ELSE 0 END AS DOUBLE) AS hold_sec,
    p.reason AS agent_release_reason, p.reason AS queue_release_reason,
    CASE WHEN p.answered_at OR {O.clean_text('p.agent_raw')} IS NOT NULL THEN 'Handled' ELSE 'No Agent' END AS handled_flag,
    d.queue_id AS source_queue_id, p.call_key AS "Orig CallID", '{A.API_SOURCE_FILE}' AS source_file
  FROM in_period p JOIN {O.DIM} d ON d.queue_id = p.resolved_q)"""


def _records(spark, sf_dir):
    return api_records_from_tables(spark, sf_dir)


def _pipeline(spark, sf_dir, start=ctx.PERIOD_START, end=ctx.PERIOD_END):
    return A.api_pipeline(_records(spark, sf_dir), DEFAULT_QUEUES, TZ, start, end)


@register("api_queue_resolution", API_BASE + "\nSELECT rec_no, exact_q AS queue_id FROM api1")
def api_queue_resolution(spark, sf_dir):
    """J-1: first candidate path whose value is a tracked id or queue name (null if none)."""
    return with_exact_queue(_records(spark, sf_dir), DEFAULT_QUEUES, out="queue_id").select("rec_no", "queue_id")


@register("api_queue_fallback", API_BASE + """
SELECT rec_no, qid AS fallback_queue_id FROM api1 WHERE exact_q IS NULL AND k % 14 <> 0""")
def api_queue_fallback(spark, sf_dir):
    """J-2: records J-1 missed, resolved through any field whose path names a queue."""
    return resolve_fallback(open_records(_records(spark, sf_dir), DEFAULT_QUEUES), DEFAULT_QUEUES)


@register("dedup_by_sort_key", API_BASE + """
SELECT call_key, rec_no, sort_key FROM api1
QUALIFY row_number() OVER (PARTITION BY call_key ORDER BY sort_key DESC NULLS FIRST, rec_no DESC) = 1""")
def dedup_by_sort_key(spark, sf_dir):
    """W-2: global keep-last after a stable sort on to.call_id (null sorts last and wins)."""
    recs = _records(spark, sf_dir)
    keyed = A.keyed_records(recs, A.field_presence(recs))
    return dedup_api(keyed, key="call_key", sort_key="sort_key", ordinal="rec_no").select(
        "call_key", "rec_no", "sort_key")


@register("sip_numbers", API_BASE + "\nSELECT rec_no, caller_number FROM api1")
def sip_numbers(spark, sf_dir):
    """F-6 + F-9: first present caller candidate, SIP URI reduced to its user part."""
    recs = shred(_records(spark, sf_dir), cleaned=A.CALLER_FIELD_CANDIDATES)
    return recs.select("rec_no", X.sip_number(F.coalesce(*map(path_column, A.CALLER_FIELD_CANDIDATES))).alias("caller_number"))


@register("api_wall_clock", API_BASE + "\nSELECT rec_no, start_time, call_datetime FROM api1")
def api_wall_clock(spark, sf_dir):
    """F-10 / T7: offset-bearing times converted to the reporting zone, naive ones kept."""
    from callgrid.operators.flatten import scalar_text
    recs = _records(spark, sf_dir)
    st = scalar_text("rec", A.START_TIME_FIELD)
    return recs.select("rec_no", st.alias("start_time"), A.api_wall_clock(st, TZ).alias("call_datetime"))


@register("api_curated", API_CURATED_CTES + f'\nSELECT {CURATED_SELECT}, source_queue_id, "Orig CallID", source_file FROM api_curated', dates=("date",))
def api_curated(spark, sf_dir):
    """P-13: all 26 columns of the curated calls from nested records (dedup before the period filter, T3)."""
    return _pipeline(spark, sf_dir)[0].drop("is_handled")


@register("extract_roundtrip", API_CURATED_CTES + f'\nSELECT {CURATED_SELECT}, source_queue_id, "Orig CallID", source_file FROM api_curated', dates=("date",))
def extract_roundtrip(spark, sf_dir):
    """SNK-1 / S-4 / S-6 / S-3: the records landed as an extract with its manifest, then curated from the landed files."""
    from callgrid.operators.stats import stats_document_from_legs
    from callgrid.plans import context as ctx
    from callgrid.session import ensure_checkpoint_dir
    from callgrid.sinks.landing import choose_extract, land_extract, snapshot_path
    from callgrid.sources.api_records import read_records
    from callgrid.sources.testdata import events_to_api_records, read_events
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/extract-{uuid.uuid4().hex}"
    period = (ctx.PERIOD_START, ctx.PERIOD_END)
    land_extract(events_to_api_records(read_events(spark, sf_dir)), stats_document_from_legs(ctx.legs(spark, sf_dir)),
                 root, "month", *period, order_by="rec_no")
    if choose_extract(spark, root, *period) != "reuse":
        raise ValueError("the landed extract is not complete")
    landed = read_records(spark, f"{snapshot_path(spark, root, *period)}/records")
    return A.api_pipeline(landed, start=period[0], end=period[1])[0].drop("is_handled")


@register("unmapped_rows", API_CURATED_CTES + "\nSELECT rec_no, call_key FROM in_period WHERE resolved_q IS NULL")
def unmapped_rows(spark, sf_dir):
    """P-18: in-period records that map to no tracked queue."""
    return _pipeline(spark, sf_dir)[1].select("rec_no", "call_key")


@register("api_counts", API_CURATED_CTES + """
SELECT (SELECT count(*) FROM api1) AS record_count, (SELECT count(*) FROM deduped) AS deduped_count,
  (SELECT count(*) FROM api_curated) AS curated_count,
  (SELECT count(*) FROM in_period WHERE resolved_q IS NULL) AS ignored_unmapped_queue_rows,
  'success' AS status""")
def api_counts(spark, sf_dir):
    """A-18: record, deduped, curated and ignored counts of an API run."""
    recs = _records(spark, sf_dir)
    return A.api_pipeline(recs, DEFAULT_QUEUES, TZ, ctx.PERIOD_START, ctx.PERIOD_END)[2]


FIELD_INVENTORY_SQL = f"""WITH {O.LEGS.split('legs0 AS')[0].rstrip().rstrip(',')},
p AS (
  SELECT 'from.call_id' AS path FROM ev UNION SELECT 'from.name' FROM ev
  UNION SELECT 'from.number' FROM ev WHERE user_id % 13 <> 1
  UNION SELECT 'to.call_id' FROM ev WHERE k % 10 <> 0
  UNION SELECT 'to.user' FROM ev WHERE k % 3 = 0 AND k % 12 <> 0
  UNION SELECT 'to.user.name' FROM ev WHERE k % 3 <> 0 AND k % 12 <> 0
  UNION SELECT 'to.user.extension' FROM ev WHERE k % 3 <> 0 AND k % 12 <> 0
  UNION SELECT 'duration' FROM ev UNION SELECT 'start_time' FROM ev
  UNION SELECT 'queue_time' FROM ev UNION SELECT 'hold_time' FROM ev
  UNION SELECT 'answer_time' FROM ev WHERE event_type IN ('view', 'click')
  UNION SELECT 'release_reason' FROM ev WHERE event_type <> 'purchase'
  {" ".join(f"UNION SELECT '{path}' FROM ev WHERE {cond}" for path, cond in O.queue_paths())}
  UNION SELECT 'queue_label' FROM ev WHERE k % 7 = 0
  UNION SELECT 'dialled_number' FROM ev WHERE day(ts) > 15)
SELECT path FROM p"""


@register("field_inventory", FIELD_INVENTORY_SQL)
def field_inventory(spark, sf_dir):
    """F-12 + F-13: distinct dotted paths over all records (objects flattened, arrays are values)."""
    return inventory(_records(spark, sf_dir))
