"""WARC archives with revisit records, and a two-level capture index.

Writing: of records with equal payloads of ``MIN_REVISIT`` bytes or more, the one with the
smallest page_id holds the payload, the others are revisit records that name it. The
smallest id of each digest comes from a partial aggregate, so a payload that a third of
all pages share costs one row a task. Each task writes one archive, a gzip member a record,
under a name of its own attempt in the shared folder; only archives in the capture table,
which Spark commits, count, so a lost or repeated task leaves no wrong record.

Index: captures are range-partitioned and sorted by their key (host labels reversed, then
path), page_id and place. Each task writes its lines as compressed blocks of ``BLOCK_LINES``
into one index file, and one row a block (first and last key, file, offset, length) goes
to the block directory, which stays a small sorted table. A lookup narrows the directory,
reads only the blocks that can hold its keys, searches their lines by bisection, and then
reads the records' byte ranges.

Reading back goes over every index block: its captures are grouped by archive and place,
so that each archive's byte ranges are read in order. Revisits take payload size and
digest from their own headers, and the named response from the record it refers to.

Results in special cases: a null html is an empty payload; a null url is written as an
empty one; payloads below ``MIN_REVISIT`` bytes are responses all; rows that repeat a page_id
and its html are records of their own, the first in order of writing being the response
of that page (its repeats, if long enough, revisit the same page_id); pages are written whole;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrid.llm.common import located, scratch, written

#: Smaller payloads are never stored as revisits.
MIN_REVISIT = 100
#: Capture lines in one compressed block of the index.
BLOCK_LINES = 3000
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
#: Byte ranges of an archive that one reading task takes on at a time.
READ_SPAN = 32 << 20

CAPTURE = "url_key string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, archive string, offset long, length long"


def _storage(uri: str):
    """(file system, path) of a location in the shared folder: local, HDFS or an object store."""
    from pyarrow import fs

    scheme, _, rest = uri.partition("://")
    if not rest and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri  # callers that share no file system with Spark give plain paths
    return fs.FileSystem.from_uri(f"s3://{rest}" if scheme in ("s3a", "s3n") else uri)


def url_key(url: str | None) -> str:
    """Sort key of an address: host labels reversed, port, path and query, lower-cased, without fragment."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return (url or "").strip().lower()
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    return f"{host}{f':{port}' if port and port not in (80, 443) else ''}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _record(kind: str, page_id, url: str | None, payload: bytes, digest: str, refers_to, size: int) -> bytes:
    """One record as a gzip member; a revisit has no payload but the full one's size and digest."""
    head = {
        "WARC-Type": kind, "WARC-Record-ID": f"<urn:page:{page_id}>", "WARC-Date": DATE,
        "WARC-Target-URI": " ".join((url or "").split()), "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Payload-Length": str(size),
        **({"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"} if kind == "revisit" else {}),
        "Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload)),
    }
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + payload + b"\r\n\r\n"
    return gzip.compress(raw, LEVEL, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4:
        raise ValueError(f"a record of {len(rest) - 4} bytes says {size}")
    return fields, rest[:size]


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write an archive a task below ``folder``; the committed capture table, one row a record."""
    given = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    digest = F.sha2("payload", 256).alias("payload_digest")
    long = given.select("page_id", digest, F.octet_length("payload").alias("size")).where(F.col("size") >= MIN_REVISIT)
    first = long.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    shared = written(first.where("n > 1").select(F.col("payload_digest").alias("own"), "first_id"), "warc-shared")
    keyed = given.withColumn("payload_digest", F.when(F.octet_length("payload") >= MIN_REVISIT, F.sha2("payload", 256)))
    # one row a digest; a payload that many pages share is a skewed join key, which the session splits
    rows = keyed.join(shared, keyed["payload_digest"] == shared["own"], "left").select("page_id", "url", "payload", "first_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place, told = None, 0, []
        name = f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
        written_ids = set()
        for batch in batches:
            rows = []
            for page_id, url, payload, first_id in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "first_id"))):
                if out is None:
                    storage, path = _storage(name)
                    storage.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = storage.open_output_stream(path, compression=None)
                own, size = hashlib.sha256(payload).hexdigest(), len(payload)
                again = first_id is not None and (page_id != first_id or page_id in written_ids)
                if first_id is not None and page_id == first_id:
                    written_ids.add(page_id)
                kind, refers_to = ("revisit", first_id) if again else ("response", None)
                member = _record(kind, page_id, url, b"" if again else payload, own, refers_to, size)
                out.write(member)
                rows.append((url_key(url), page_id, kind, refers_to, size, own, name, place, len(member)))
                place += len(member)
            if rows:
                told.append(rows)
                columns = list(zip(*rows))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=[f.split(" ")[0] for f in CAPTURE.split(", ")])
                told.clear()
        if out is not None:
            out.close()

    return written(rows.mapInArrow(run, CAPTURE), "warc-captures")


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the sorted capture lines as compressed blocks below ``folder``; the committed block directory."""
    order = ["url_key", "page_id", "archive", "offset"]
    ordered = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        name, out, place, lines = f"{folder}/index-{uuid.uuid4().hex}.cdx", None, 0, []

        def block() -> pa.RecordBatch:
            nonlocal out, place
            if out is None:
                storage, path = _storage(name)
                storage.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = storage.open_output_stream(path, compression=None)
            data = zlib.compress("\n".join(json.dumps(x, ensure_ascii=True) for x in lines).encode(), LEVEL)
            out.write(data)
            row = [(lines[0][0], lines[-1][0], name, place, len(data), len(lines))]
            place += len(data)
            lines.clear()
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*row), kinds)], names=["first_key", "last_key", "file", "offset", "length", "lines"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append(list(row))
                if len(lines) == BLOCK_LINES:
                    yield block()
        if lines:
            yield block()
        if out is not None:
            out.close()

    return written(ordered.mapInArrow(run, "first_key string, last_key string, file string, offset long, length long, lines long"), "warc-directory")


def _lines(file: str, offset: int, length: int) -> list[list]:
    """The capture lines of one index block, read by its byte range."""
    import json

    storage, path = _storage(file)
    with storage.open_input_file(path) as f:
        return [json.loads(x) for x in zlib.decompress(f.read_at(length, offset)).decode().split("\n")]


def lookup(directory: DataFrame, urls: list[str]) -> list[tuple[dict[str, str], bytes]]:
    """Records (headers, payload) of a stated list of addresses, in key order.

    The directory is filtered by the keys' range of blocks (a pushed-down comparison on its
    sorted columns); each block found is searched by bisection and each record read by its range.
    """
    keys = sorted({url_key(u) for u in urls})
    hit = F.lit(False)
    for k in keys:
        hit = hit | ((F.col("first_key") <= k) & (F.col("last_key") >= k))
    out = []
    for b in directory.where(hit).orderBy("first_key", "file", "offset").toLocalIterator():
        lines = _lines(b.file, b.offset, b.length)
        for k in keys:
            at = bisect_left(lines, k, key=lambda x: x[0])
            while at < len(lines) and lines[at][0] == k:
                storage, path = _storage(lines[at][6])
                with storage.open_input_file(path) as f:
                    out.append(parse(f.read_at(lines[at][8], lines[at][7])))
                at += 1
    return out


def read(directory: DataFrame) -> DataFrame:
    """Every record, found through the index: page_id, record_type, refers_to, payload size and digest by its headers,
    and, for responses, the size and digest of the payload that was read."""
    def captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                rows = _lines(file, offset, length)
                yield pa.RecordBatch.from_arrays([pa.array([r[6] for r in rows]), pa.array([r[7] for r in rows], pa.int64()), pa.array([r[8] for r in rows], pa.int64())],
                                                 names=["archive", "offset", "length"])

    ranges = directory.select("file", "offset", "length").repartition("file", "offset").mapInArrow(captures, "archive string, offset long, length long")
    ranges = ranges.withColumn("span", F.floor(F.col("offset") / READ_SPAN)).repartition("archive", "span").sortWithinPartitions("archive", "offset")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, f = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != opened:
                    storage, path = _storage(archive)
                    opened, f = archive, storage.open_input_file(path)
                head, payload = parse(f.read_at(length, offset))
                own = (len(payload), hashlib.sha256(payload).hexdigest()) if head["WARC-Type"] == "response" else (None, None)
                number = lambda k: int(head[k][10:-1]) if k in head and head[k] != "<urn:page:None>" else None
                rows.append((number("WARC-Record-ID"), head["WARC-Type"], number("WARC-Refers-To"), int(head["WARC-Payload-Length"]),
                             head["WARC-Payload-Digest"].removeprefix("sha256:"), *own))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds],
                                             names=["page_id", "record_type", "refers_to", "said_bytes", "said_digest", "read_bytes", "read_digest"])

    return ranges.mapInArrow(records, "page_id long, record_type string, refers_to long, said_bytes long, said_digest string, read_bytes long, read_digest string")


def archive(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(captures, directory) of ``pages`` written as archives and an index in a fresh place of the shared folder."""
    folder = located(pages.sparkSession, scratch(pages.sparkSession, "warc"))
    captures = write(pages, f"{folder}/archives")
    return captures, build_index(captures, f"{folder}/index")


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, as read back from the archives.

    A response's size and digest are those of the payload that was read; a revisit's those
    of the response that it names, whose digest must be the one its own header says.
    """
    _, directory = archive(pages)
    back = written(read(directory), "warc-records")
    answers = back.where("record_type = 'response'").groupBy(F.col("page_id").alias("named"), F.col("read_digest").alias("named_digest")).agg(
        F.max("read_bytes").alias("named_bytes"))
    rows = back.join(answers, (back["refers_to"] == answers["named"]) & (back["said_digest"] == answers["named_digest"]), "left")
    wrong = ((F.col("record_type") == "response") & ~((F.col("said_digest") == F.col("read_digest")) & (F.col("said_bytes") == F.col("read_bytes")))) | (
        (F.col("record_type") == "revisit") & ~F.coalesce(F.col("named_bytes") == F.col("said_bytes"), F.lit(False)))
    size = F.when(wrong, F.raise_error(F.lit("a record does not match its payload")).cast("long")).otherwise(F.coalesce("read_bytes", "named_bytes"))
    return rows.select("page_id", size.alias("payload_bytes"), F.coalesce("read_digest", "named_digest").alias("payload_digest"), "record_type", "refers_to")
