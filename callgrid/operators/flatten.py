"""Nested records as VARIANT: typed extraction of many paths at once (F-6, T6), flattening to
dotted paths (F-12) and the field inventory (F-13, U-2).

:func:`shred` reads all wanted paths of a record in one typed cast. Flattening goes level by
level: a lateral ``variant_explode`` opens what is still an object, the rest are leaves
(arrays and nulls too, as in the source's own flattening; empty objects vanish). A level's entries
are written once, and its objects are the input of the next. It stops when no object is left,
so records of any depth are flattened without knowing it beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from callgrid.functions.exprs import ws_trim
from callgrid.session import materialize


def sub(rec: str | Column, path: str) -> Column:
    """The VARIANT at a dotted path (SQL null when absent)."""
    return F.try_variant_get(F.col(rec) if isinstance(rec, str) else rec, "$." + path, "variant")


def is_object(v: Column) -> Column:
    """Cheap object test: only objects cast to the empty struct type."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def _ref(rec: str, path: str) -> tuple[str, str]:
    if not all(ch.isalnum() or ch in "._" for ch in path):
        raise ValueError(f"unsupported path {path!r}")
    return "`" + rec.replace("`", "``") + "`", "$." + path


def scalar_text(rec: str | Column, path: str) -> Column:
    """Text of a scalar at ``path``; null when absent, JSON null, or an object (T6)."""
    if isinstance(rec, str):  # one SQL expression: far fewer plan-building calls
        r, p = _ref(rec, path)
        return F.expr(f"CASE WHEN try_variant_get({r}, '{p}', 'struct<>') IS NULL "
                      f"THEN try_variant_get({r}, '{p}', 'string') END")
    v = sub(rec, path)
    return F.when(~is_object(v), F.try_variant_get(v, "$", "string"))


_NUMBER = "^(BIGINT|DOUBLE|FLOAT|INT|SMALLINT|TINYINT|DECIMAL)"


def path_column(path: str) -> str:
    """Name of the text column that :func:`shred` gives a path."""
    return "_p_" + path.replace(".", "__")


def _tree(paths: Sequence[str]) -> dict:
    tree: dict = {}
    for path in paths:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})
    return tree


def _typed(tree: dict, wanted: set[str], prefix: str = "") -> str:
    """Struct type of the paths; a path that is wanted itself stays VARIANT, whatever lies below it."""
    fields = []
    for name, below in tree.items():
        path = f"{prefix}{name}"
        kind = "variant" if path in wanted or not below else _typed(below, wanted, f"{path}.")
        fields.append(f"`{name}`: {kind}")
    return f"struct<{', '.join(fields)}>"


def _below(path: str, wanted: set[str]) -> str:
    """SQL of the VARIANT at ``path`` inside the typed record ``_s``."""
    parts = path.split(".")
    for n in range(1, len(parts)):
        if ".".join(parts[:n]) in wanted:  # text in some records, an object in others
            top = "_s." + ".".join(f"`{x}`" for x in parts[:n])
            return f"try_variant_get({top}, '$.{'.'.join(parts[n:])}', 'variant')"
    return "_s." + ".".join(f"`{x}`" for x in parts)


def shred(df: DataFrame, raw: Sequence[str] = (), cleaned: Sequence[str] = (), numeric: Sequence[str] = (), rec: str = "rec") -> DataFrame:
    """``df`` with a text column for each path, read by one cast of the record to a struct of all of them.

    Objects and JSON null count as absent (T6). ``raw`` texts are as they stand; ``cleaned`` ones are trimmed, and null
    when they carry no value (F-8). For ``numeric`` paths a column ``…_num`` tells whether the value is a JSON number.
    """
    paths = list(dict.fromkeys([*raw, *cleaned]))
    for p in paths:
        _ref(rec, p)
    wanted = set(paths)
    typed = df.withColumn("_s", F.try_variant_get(rec, "$", _typed(_tree(paths), wanted)))
    values = typed.select(*df.columns, *[F.expr(f"{_below(p, wanted)} AS {path_column(p)}") for p in paths])
    # one expression over the array of values: one a column would outgrow the method that whole-stage code compiles to
    at = {p: n for n, p in enumerate(paths)}
    texts = F.transform(F.array(*map(path_column, paths)), lambda v: F.when(~is_object(v), F.try_variant_get(v, "$", "string")))
    kinds = F.transform(F.array(*map(path_column, numeric)), lambda v: F.coalesce(F.schema_of_variant(v).rlike(_NUMBER), F.lit(False)))
    values = values.select(*df.columns, texts.alias("_texts"), *([kinds.alias("_kinds")] if numeric else []))
    clean = F.transform("_texts", lambda t: F.transform(F.array(ws_trim(t)), lambda x: F.when((x != "") & (F.lower(x) != "null"), x))[0])
    values = values.withColumn("_clean", clean)
    return values.select(*df.columns, *[F.get("_texts", F.lit(at[p])).alias(path_column(p)) for p in raw if p not in set(cleaned)],
                         *[F.get("_clean", F.lit(at[p])).alias(path_column(p)) for p in cleaned],
                         *[F.get("_kinds", F.lit(n)).alias(path_column(p) + "_num") for n, p in enumerate(numeric)])


def _opened(df: DataFrame, id_cols: Sequence[str], rec: str, values: bool) -> DataFrame:
    """(ids…, path, value, branch) of every entry at every level; ``branch`` marks objects, whose entries follow."""
    spark = df.sparkSession
    above = df.select(*id_cols, F.lit(None).cast("string").alias("_above"), F.col(rec).alias("_object"))
    found = None
    while True:
        entries = above.lateralJoin(spark.tvf.variant_explode(F.col("_object").outer()))
        # an array's elements have no key; a filter on the record itself would build the record a second time
        entries = entries.where(F.col("key").isNotNull()).select(*id_cols, F.concat_ws(".", "_above", "key").alias("path"), "value", is_object(F.col("value")).alias("branch"))
        if not values:
            entries = entries.withColumn("value", F.when(F.col("branch"), F.col("value")))
        seen = Observation()  # counted while writing; a repeated task can only make it too large
        level = materialize(entries.observe(seen, F.count_if("branch").alias("branches")), "entries")
        found = level if found is None else found.union(level)
        if not seen.get["branches"]:
            return found
        above = level.where("branch").select(*id_cols, F.col("path").alias("_above"), F.col("value").alias("_object"))


def flatten_paths(df: DataFrame, id_cols: Sequence[str], rec: str = "rec") -> DataFrame:
    """F-12: one row per leaf ``(ids…, path, value)``; ``value`` stays VARIANT.

    VARIANT keeps object keys sorted, so "record order" of fields is path order. Each level is one job over the
    objects of the level above; the records themselves are read once.
    """
    return _opened(df, id_cols, rec, True).where(~F.col("branch")).drop("branch")


def leaf_text(value: str | Column = "value") -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.try_variant_get(v, "$", "string")


def field_inventory(df: DataFrame, rec: str = "rec", by: Sequence[str] = ()) -> DataFrame:
    """F-13: distinct flattened paths over all records, or over those of each value of the columns ``by``."""
    return _opened(df, by, rec, False).where(~F.col("branch")).select(*by, "path").distinct()
