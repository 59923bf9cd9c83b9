"""Per-queue CSV exports (S-1 discovery, S-2 scan with lineage, U-1 all queues).

All queues' exports are read by one scan: every column as text by position (no inference, T1), put
under its own file's header by the queue that ``_metadata.file_path`` names, so exports may order
or leave out columns as they like. pandas' missing-value tokens become null; the blank-header junk
columns are dropped (P-4, T21); ``leg_no`` is the file-order ordinal (file path, split offset, row
position) used by keep-last. An export is a file, or a folder of part files, named
``*_<queue id>_*.csv``.

Quoted fields may hold line breaks, as the exports allow; a file is then one split. Where
it is known that no field holds one, ``multiline=False`` scans a large export by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callgrid.functions.exprs import na_to_null
from callgrid.schemas import CSV_HEADER_TO_COLUMN, DEFAULT_QUEUES, RAW_LEG_COLUMNS, Queue, queue_dim


def find_queue_csv(spark: SparkSession, csv_dir: str, queue_id: str) -> str | None:
    """S-1: the one export of a queue; None when the folder or a match is missing, error when ambiguous.

    A listing only. Storage and permission errors are raised, not taken for a missing file.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(csv_dir, f"*_{queue_id}_*.csv")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted(s.getPath().toString() for s in (fs.globStatus(pattern) or []))
    if not files:
        return None
    if len(files) > 1:
        names = ", ".join(f.rsplit("/", 1)[-1] for f in files)
        raise ValueError(f"Multiple CSV files found for queue {queue_id}: {names}")
    return files[0]


def _reader(spark: SparkSession, multiline: bool) -> DataFrameReader:
    return (spark.read.option("header", True).option("inferSchema", False).option("multiLine", multiline)
            .option("quote", '"').option("escape", '"'))


def read_exports(spark: SparkSession, paths: dict[str, str], queues: tuple[Queue, ...] = DEFAULT_QUEUES,
                 multiline: bool = True) -> DataFrame:
    """S-2 / U-1: raw legs with lineage columns of the exports at ``paths`` (by queue id), in one scan.

    Only the header line of each export is looked at beforehand.
    """
    headers = {q: _reader(spark, multiline).csv(p).columns for q, p in paths.items()}
    width = max(len(h) for h in headers.values())
    schema = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(width)])
    lines = _reader(spark, multiline).schema(schema).csv(list(paths.values()))
    queue = F.regexp_extract("_metadata.file_path", r"_([^_/]+)_[^/]*\.csv(/[^/]*)?$", 1)
    lines = lines.select("*", queue.alias("queue_id"), F.col("_metadata.file_path").alias("source_file"),
                         F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                                  F.monotonically_increasing_id().alias("row")).alias("leg_no"))

    def column(header: str) -> Column:
        """The header's column: where it stands in each export."""
        places: dict[int | None, list[str]] = {}
        for q, h in headers.items():
            places.setdefault(h.index(header) if header in h else None, []).append(q)
        if len(places) == 1:
            at = next(iter(places))
            return F.lit(None).cast("string") if at is None else F.col(f"f{at}")
        return F.coalesce(*[F.when(F.col("queue_id").isin(*qs), F.col(f"f{at}")) for at, qs in places.items() if at is not None])

    legs = lines.select("leg_no", "queue_id", "source_file",
                        *[na_to_null(column(header)).alias(name) for header, name in CSV_HEADER_TO_COLUMN.items()])
    return legs.join(F.broadcast(queue_dim(spark, queues).drop("queue_pos")), "queue_id").select(*RAW_LEG_COLUMNS)


def load_queue_csv(spark: SparkSession, path: str, queue: Queue, multiline: bool = True) -> DataFrame:
    """S-2: the export of one queue -> raw legs with lineage columns."""
    return read_exports(spark, {queue.queue_id: path}, (queue,), multiline)


def load_csv_legs(spark: SparkSession, csv_dir: str, queues: tuple[Queue, ...] = DEFAULT_QUEUES,
                  multiline: bool = True) -> tuple[DataFrame | None, list[dict]]:
    """All queues (U-1) plus the gap rows of queues without an export (J-7)."""
    found = {q.queue_id: find_queue_csv(spark, csv_dir, q.queue_id) for q in queues}
    gaps = [{"queue_id": q, "reason": "missing_csv", "message": f"No CSV found for queue {q} in {csv_dir}"}
            for q, path in found.items() if path is None]
    paths = {q: path for q, path in found.items() if path is not None}
    return (read_exports(spark, paths, queues, multiline) if paths else None), gaps
