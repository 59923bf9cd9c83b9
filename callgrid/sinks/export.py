"""Delimited-text export (SNK-11) and its file name (SNK-12)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callgrid.schemas import CSV_HEADER_TO_COLUMN

EXPORT_PREFIX = "queue-analytics"


def export_file_name(start: str, end: str) -> str:
    """SNK-12."""
    return f"{EXPORT_PREFIX}-{start}_{end}.csv"


def export_text(value: Column) -> Column:
    """F-26: the text of a VARIANT value: text as it is, whole numbers without a decimal point, other numbers in plain
    digits, ``true`` / ``false``, JSON for what is nested, '' for nothing."""
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    num = F.try_variant_get(value, "$", "double")
    short = num.cast("string")
    plain = F.when(short.contains("E"), F.regexp_replace(F.format_string("%.20f", num), "0+$", "")).otherwise(short)
    number = F.when((num == F.floor(num)) & (F.abs(num) < 1e15), num.cast("bigint").cast("string")).otherwise(plain)
    return (F.when(kind == "VOID", F.lit(""))
            .when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json(value))
            .when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|INT|SMALLINT|TINYINT|DECIMAL)"), number)
            .otherwise(F.try_variant_get(value, "$", "string")))


def commit_file(spark: SparkSession, folder: str, target: str) -> str:
    """The one part file that a job left in ``folder``, renamed to ``target`` through Hadoop's file system.

    Readers of ``target`` see the file before or the new one, never a part of it: the rename replaces it in one step
    where the file system can, and the folder goes afterwards.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(conf)
    parts = [x.getPath() for x in fs.listStatus(path(folder)) if x.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise ValueError(f"{len(parts)} part files in {folder}, not one")
    fs.mkdirs(path(target).getParent())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(target).toUri(), conf).rename(parts[0], fs.makeQualified(path(target)), how)
    fs.delete(path(folder), True)
    return target


def _aside(target: str) -> str:
    """A folder beside the file to be, where its one part is written first."""
    head, _, name = target.rpartition("/")
    return f"{head}/_{name}-{uuid.uuid4().hex}"


def write_text_file(df: DataFrame, target: str) -> str:
    """One row of text as one file named ``target``."""
    folder = _aside(target)
    df.coalesce(1).write.text(folder)
    return commit_file(df.sparkSession, folder, target)


def _csv_writer(df: DataFrame, columns: Sequence[str]) -> DataFrameWriter:
    return (df.select(*columns).write.option("header", True).option("quote", '"').option("escape", '"')
            .option("emptyValue", "").option("nullValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """SNK-11 as a folder of part files, for what has no bound: chosen column order, RFC-style quoting, null -> ''."""
    _csv_writer(df, columns).mode("overwrite").csv(path)


def write_csv_file(df: DataFrame, root: str, start: str, end: str, columns: Sequence[str], order: Sequence[str] = ()) -> str:
    """SNK-11 / SNK-12: one report export as one file under its name. Its rows go through one task: a report's rows are
    bounded by its queues, days, agents and callers listed."""
    target = f"{root.rstrip('/')}/{export_file_name(start, end)}"
    folder = _aside(target)
    one = df.coalesce(1)
    _csv_writer(one.sortWithinPartitions(*order) if order else one, columns).csv(folder)
    return commit_file(df.sparkSession, folder, target)


def write_queue_exports(legs: DataFrame, root: str, period: str) -> None:
    """Raw legs as the exports that S-1 finds: for each queue a folder of part files in file order, with the exports' headers."""
    named = legs.withColumn("file", F.concat(F.lit("calls_"), "queue_id", F.lit(f"_{period}.csv")))
    # sorted by the folder first: the writer then adds no sort of its own, which would not keep the file order
    named = named.repartitionByRange("file", "leg_no").sortWithinPartitions("file", "leg_no")
    columns = [F.col(name).alias(header) for header, name in CSV_HEADER_TO_COLUMN.items()]
    _csv_writer(named.select(*columns, F.lit("").alias(" "), "file"), ["*"]).partitionBy("file").csv(root)


def write_inventory_document(inventory: DataFrame, path: str, start: str, end: str, validation: dict | None = None) -> str:
    """SNK-10: the field inventory as one JSON document (date range, sorted paths, count, validation).

    The inventory holds distinct field paths, bounded by the record schema, so gathering
    it into one document is safe.
    """
    fields = inventory.agg(F.sort_array(F.collect_set("path")).alias("fields"))
    validation_json = json.dumps(validation or {"status": "success"}, sort_keys=True)
    doc = fields.select(F.to_json(F.struct(
        F.struct(F.lit(end).alias("end"), F.lit(start).alias("start")).alias("date_range"), F.size("fields").alias("field_count"),
        "fields", F.parse_json(F.lit(validation_json)).alias("validation"))).alias("value"))
    return write_text_file(doc, path)


def write_ordered_parts(df: DataFrame, folder: str, order: Sequence[Column], key: str) -> DataFrame:
    """An unbounded list as JSON lines in range-sorted part files, and its directory: (file, rows, first, last ``key``).

    Reading the files by name gives the list in order; no task or document holds more than a part of it.
    """
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").json(folder)
    parts = df.sparkSession.read.schema(df.schema).json(folder).select(key, F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("_at"))
    return parts.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min_by(key, "_at").alias("first"), F.max_by(key, "_at").alias("last"))


def read_parts(spark: SparkSession, folder: str, directory: DataFrame, schema: StructType) -> DataFrame:
    """The list of :func:`write_ordered_parts`, from the files that its directory names (one name a part)."""
    names = [f"{folder}/{r.file}" for r in directory.select("file").collect()]
    return spark.read.schema(schema).json(names) if names else spark.createDataFrame([], schema)


def write_report_bundle(period_doc: DataFrame, queue_docs: DataFrame, root: str, period: str, start: str, end: str) -> str:
    """SNK-2 below :func:`bundle_folder`: the period's JSON in ``metrics/`` and a document a queue in
    ``queues/file=metrics_<queue>/``; returns the folder. The callers' parts are there before (the document names them)."""
    folder = bundle_folder(root, period, start, end)
    period_doc.select("document").coalesce(1).write.mode("overwrite").text(f"{folder}/metrics")
    queue_docs.select(F.col("document").alias("value"), F.concat(F.lit("metrics_"), F.col("queue_id")).alias("file")).write.mode(
        "overwrite").partitionBy("file").text(f"{folder}/queues")
    return folder


def bundle_folder(root: str, period: str, start: str, end: str) -> str:
    return f"{root.rstrip('/')}/reports/{period}_{start}_{end}"
