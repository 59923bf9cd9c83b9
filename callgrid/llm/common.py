"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrid.session import ensure_checkpoint_dir

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"


_PACKAGE = Path(__file__).resolve().parents[1]


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the session's Python workers, once a session, in case they cannot import it already."""
    context = spark.sparkContext
    if getattr(context, "_callgrid_shipped", False):
        return
    out = Path(tempfile.mkdtemp(prefix="callgrid-code-")) / "callgrid.zip"  # on the driver; Spark brings it to the executors
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(_PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(_PACKAGE.parent))
    context.addPyFile(str(out))
    context._callgrid_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """All words of a text as an array (null text: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often the body names it.

    A projected column would do the same only as long as the optimiser does not merge
    the projections and copy the expression into each element of a lambda.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def located(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that Spark resolves it to, for tasks that open files themselves."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return f"file://{found[5:]}" if found.startswith("file:/") and not found.startswith("file://") else found


#: The tables (session, name, path) written since the innermost :func:`passing` block began.
_made: ContextVar[list[tuple[SparkSession, str, str]] | None] = ContextVar("made", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts lineage through files that survive a lost executor, and gives the planner real
    sizes, so that a join broadcasts this table only below the session's threshold.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    made = _made.get()
    if made is not None:
        made.append((spark, name, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(*kept: str) -> Iterator[None]:
    """Tables that :func:`written` makes in this block are deleted at its end, but for those of the names ``kept``, which
    pass to the block around it. What is read later must come from the kept ones alone."""
    outer, made = _made.get(), []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for spark, name, path in made:
            if name not in kept:
                where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
            elif outer is not None:
                outer.append((spark, name, path))


#: Bits that :func:`sifted` has for each key, and bits in all at most (8 MB).
BITS_A_KEY, MOST_BITS = 16, 2**26
_CHUNK = 32768  # bits in a row of bitmap_construct_agg


def sifted(rows: DataFrame, values: list[Column], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``values`` may be a row of ``keys``, rows whose values surely are none).

    Told by a broadcast bitmap of the keys' hashes, so that a join with few of many wide rows deals out these alone. No
    row that has a key is in the second part; with up to 4 million keys some 6 % of the others are in the first, with
    more keys more of them, as the bitmap grows no further. ``keys`` is read twice.
    """
    chunks = max(1, min(MOST_BITS, BITS_A_KEY * keys.count()) // _CHUNK)
    bit = lambda columns: F.pmod(F.xxhash64(*columns), F.lit(chunks * _CHUNK))
    bits = keys.select(bit([F.col(c) for c in keys.columns]).alias("bit")).groupBy(F.floor(F.col("bit") / _CHUNK).alias("__chunk"))
    bits = bits.agg(F.bitmap_construct_agg(F.col("bit") % _CHUNK).alias("__bits"))
    placed = rows.withColumn("__bit", bit(values))
    placed = placed.join(F.broadcast(bits), F.floor(placed["__bit"] / _CHUNK) == bits["__chunk"], "left")
    at = F.col("__bit") % _CHUNK
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return placed.where(found).select(*rows.columns), placed.where(~found).select(*rows.columns)
