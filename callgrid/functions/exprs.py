"""Scalar Column expressions (parsing, cleaning, predicates).

Every function takes column names or Columns and returns a Column, so all of
it stays inside whole-stage codegen: no Python UDF anywhere.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The results depend on these exact texts.
# ---------------------------------------------------------------------------
RESTRICTED_PREFIX = "__restricted__:"
HANDLED = "Handled"
NO_AGENT = "No Agent"
NO_AGENT_RELEASE_REASONS = ("abandoned", "no answer", "not available")
NON_HUMAN_AGENT_TERMS = ("auto attendant", "builds", "csh - builds", "ivr", "queue",
                         "system", "voicemail")
CSV_CALL_TIME_FORMAT = "M/d/yyyy h:mm a"
SIP_URI_PATTERN = r"(?i)sip:([^@;>]+)"
# pandas' default missing-value tokens (the CSV reader of the reference maps these to null)
CSV_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                 "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                 "nan", "null")

_WS_EDGES = r"(?U)^\s+|\s+$"
_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL_TEXT = r"^[0-9]+(\.[0-9]+)?$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _q(name: str) -> str:
    """Quoted column reference for SQL-text expressions."""
    return "`" + name.replace("`", "``") + "`"


# SQL-text forms of the hottest helpers: one expression parsed on the JVM instead of dozens
# of py4j calls per Column node (same Catalyst expression, cheaper plan construction).
_WS_SQL = "regexp_replace(CAST({x} AS STRING), '(?U)^\\\\s+|\\\\s+$', '')"


def _ws_sql(x: str) -> str:
    return _WS_SQL.format(x=x)


def _to_seconds_sql(x: str) -> str:
    s = _ws_sql(x)
    p = f"split({s}, ':')"
    ok = lambda i: f"coalesce(get({p}, {i}) RLIKE '^\\\\s*[+-]?[0-9]+\\\\s*$', false)"
    num = lambda i: f"try_cast({_ws_sql(f'get({p}, {i})')} AS BIGINT)"
    # most texts are plain MM:SS: read without the splits and trims of the general form
    return (f"CAST(CASE WHEN CAST({x} AS STRING) RLIKE '^[0-9]{{1,9}}:[0-9]{{1,9}}\\\\z' "
            f"THEN CAST(substring_index({x}, ':', 1) AS BIGINT) * 60 + CAST(substring_index({x}, ':', -1) AS BIGINT) "
            f"WHEN endswith({s}, 'ms') THEN NULL "
            f"WHEN size({p}) = 2 AND {ok(0)} AND {ok(1)} THEN {num(0)} * 60 + {num(1)} "
            f"WHEN size({p}) = 3 AND {ok(0)} AND {ok(1)} AND {ok(2)} "
            f"THEN {num(0)} * 3600 + {num(1)} * 60 + {num(2)} END AS DOUBLE)")


# --- text --------------------------------------------------------------------------------

def ws_trim(col: str | Column) -> Column:
    """Strip all leading/trailing whitespace (``trim`` only strips spaces)."""
    if isinstance(col, str):
        return F.expr(_ws_sql(_q(col)))
    return F.regexp_replace(col.cast("string"), _WS_EDGES, "")


def _has_value_sql(x: str) -> str:
    t = _ws_sql(x)
    return f"({x} IS NOT NULL AND {t} <> '' AND lower({t}) <> 'null')"


def has_value(col: str | Column) -> Column:
    """F-7: not null, not blank, not the text "null" (case-insensitive)."""
    if isinstance(col, str):
        return F.expr(_has_value_sql(_q(col)))
    t = ws_trim(col)
    return _c(col).isNotNull() & (t != F.lit("")) & (F.lower(t) != F.lit("null"))


def clean_text(col: str | Column) -> Column:
    """F-8: trimmed text, or null when it carries no value."""
    if isinstance(col, str):
        return F.expr(f"CASE WHEN {_has_value_sql(_q(col))} THEN {_ws_sql(_q(col))} END")
    return F.when(has_value(col), ws_trim(col))


def na_to_null(col: str | Column) -> Column:
    """Map the CSV missing-value tokens to null (T1)."""
    return F.when(~_c(col).isin(*CSV_NA_TOKENS), _c(col))


def first_present(*cols: str | Column) -> Column:
    """F-6: first candidate that has a value (raw text, untrimmed)."""
    return F.coalesce(*[F.when(has_value(c), _c(c).cast("string")) for c in cols])


# --- numbers -----------------------------------------------------------------------------

def to_seconds(col: str | Column) -> Column:
    """F-1: ``MM:SS`` or ``HH:MM:SS`` to seconds (double); anything else null."""
    if isinstance(col, str):
        return F.expr(_to_seconds_sql(_q(col)))
    s = ws_trim(col)
    parts = F.split(s, ":")
    n = F.size(parts)

    def ok(i: int) -> Column:
        return F.coalesce(F.get(parts, i).rlike(_INT_TEXT), F.lit(False))

    def num(i: int) -> Column:
        return ws_trim(F.get(parts, i)).try_cast("bigint")

    two = (n == 2) & ok(0) & ok(1)
    three = (n == 3) & ok(0) & ok(1) & ok(2)
    return (F.when(s.endswith("ms"), F.lit(None))
            .when(two, num(0) * 60 + num(1))
            .when(three, num(0) * 3600 + num(1) * 60 + num(2))
            .cast("double"))


def coerce_seconds(text: str | Column, is_number: Column | None = None) -> Column:
    """F-11: number, numeric text, or clock text; booleans are not numbers.

    ``is_number`` marks values that were typed numbers in the source (VARIANT);
    they are taken as they are, sign included.
    """
    t = clean_text(text)
    numeric_text = t.rlike(_DECIMAL_TEXT)
    out = F.when(numeric_text, t.try_cast("double")).otherwise(to_seconds(t))
    if is_number is not None:
        out = F.when(is_number & t.isNotNull(), t.try_cast("double")).otherwise(out)
    return out


def loose_int(col: str | Column) -> Column:
    """F-14: integer from a loose value; null -> 0, numeric text truncated."""
    return F.coalesce(_c(col).cast("string").try_cast("double").cast("bigint"), F.lit(0).cast("bigint"))


def loose_float(col: str | Column) -> Column:
    """F-15: float from a loose value; anything unparsable -> 0.0."""
    return F.coalesce(_c(col).cast("string").try_cast("double"), F.lit(0.0))


def json_number(col: str | Column) -> Column:
    """F-16: NaN and +-inf become null so they never reach a JSON document."""
    x = _c(col).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """F-20 / T17: ratio with division by zero guarded to 0.0."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(0.0))


# --- dates -------------------------------------------------------------------------------

def parse_call_time(col: str | Column) -> Column:
    """F-2: CSV call time -> TIMESTAMP_NTZ; ANSI mode makes bad text fail the run."""
    return F.to_timestamp_ntz(_c(col), F.lit(CSV_CALL_TIME_FORMAT))


def day_name(col: str | Column) -> Column:
    """English full day name (F-5)."""
    return F.date_format(_c(col), "EEEE")


def week_start(date_col: str | Column) -> Column:
    """Monday of the week (T16)."""
    return F.to_date(F.date_trunc("week", _c(date_col)))


# --- callers -----------------------------------------------------------------------------

def restricted_sentinel(row_key: str | Column) -> Column:
    """F-4: ``__restricted__:<row key>`` (unique per call, never aggregates)."""
    return F.concat(F.lit(RESTRICTED_PREFIX), _c(row_key).cast("string"))


def normalize_caller(col: str | Column, row_key: str | Column) -> Column:
    """F-3: digits only; null / blank / "restricted" / digit-free -> sentinel."""
    if isinstance(col, str) and isinstance(row_key, str):
        x, t = _q(col), _ws_sql(_q(col))
        digits = f"regexp_replace({t}, '(?U)\\\\D+', '')"
        return F.expr(f"CASE WHEN {x} IS NULL OR {t} = '' OR lower({t}) = 'restricted' OR {digits} = '' "
                      f"THEN concat('{RESTRICTED_PREFIX}', CAST({_q(row_key)} AS STRING)) ELSE {digits} END")
    t = ws_trim(col)
    digits = F.regexp_replace(t, r"(?U)\D+", "")
    missing = _c(col).isNull() | (t == "") | (F.lower(t) == "restricted") | (digits == "")
    return F.when(missing, restricted_sentinel(row_key)).otherwise(digits)


def is_restricted(col: str | Column) -> Column:
    """P-9 helper: true for sentinel callers."""
    return _c(col).startswith(RESTRICTED_PREFIX)


def sip_number(col: str | Column) -> Column:
    """F-9: user part of a SIP URI, else the cleaned text."""
    t = clean_text(col)
    return F.when(t.rlike(SIP_URI_PATTERN), F.regexp_extract(t, SIP_URI_PATTERN, 1)).otherwise(t)


# --- predicates --------------------------------------------------------------------------

def valid_agent_name(col: str | Column = "agent_name") -> Column:
    """P-6: not null, not blank, not "null"."""
    return F.coalesce(has_value(col), F.lit(False))


def no_agent_release(*cols: str | Column) -> Column:
    """P-7: any release reason (trimmed, lower-cased) names a no-agent outcome."""
    cols = cols or ("queue_release_reason", "agent_release_reason")
    hits = [F.lower(ws_trim(F.coalesce(_c(c), F.lit("")))).isin(*NO_AGENT_RELEASE_REASONS) for c in cols]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out


def answered(columns: list[str] | tuple[str, ...]) -> Column:
    """P-5 / P-8: the metrics' handled predicate, chosen by the columns present.

    ``agent_sec > 0`` when that column exists, else a valid agent name without a
    no-agent release reason, else ``handled_flag = 'Handled'``, else false.
    """
    cols = set(columns)
    if "agent_sec" in cols:
        return F.coalesce(F.col("agent_sec").try_cast("double"), F.lit(0.0)) > 0
    if "agent_name" in cols:
        reasons = [c for c in ("queue_release_reason", "agent_release_reason") if c in cols]
        pred = valid_agent_name("agent_name")
        if reasons:
            pred = pred & ~no_agent_release(*reasons)
        return pred
    if "handled_flag" in cols:
        return F.coalesce(F.col("handled_flag") == HANDLED, F.lit(False))
    return F.lit(False)


def non_human_agent(col: str | Column = "agent_name") -> Column:
    """F-19: agent name contains one of the system terms (case-insensitive)."""
    pattern = "|".join(re.escape(t) for t in NON_HUMAN_AGENT_TERMS)
    return F.lower(_c(col)).rlike(pattern)
