"""WARC archives: records with an index of byte ranges, and coalesced reads of the selected ones."""

from __future__ import annotations

import gzip
import hashlib
import os
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rosterforge.llm.common import parts_for, small_batches
from rosterforge.sources.staging import scratch_path, stored

MIN_REVISIT_BYTES = 100      # equal payloads below this size are all stored
ARCHIVE_BYTES = 64 << 20     # payload bytes, before compression, that an archive aims at
RANGE_BYTES = 4 << 20        # most bytes of several records fetched by one read
GAP_BYTES = 64 << 10         # unwanted bytes read through rather than skipped
GROUP_BYTES = 16 << 20       # bytes of an archive that one reading task covers
LEVEL = 3                    # of the compression of records
RECORD_DATE = "2020-01-01T00:00:00Z"
END = "\r\n\r\n"


def record_head(row: dict) -> bytes:
    """The head of a record. White space and control characters of an address are percent-encoded."""
    revisit = row["record_type"] == "revisit"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:page:{row['record']}>",
        f"WARC-Date: {RECORD_DATE}",
    ]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in row["url"]))
    lines.append(f"WARC-Payload-Digest: sha256:{row['payload_digest']}")
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{row['refers_to']}>",
            f"X-Payload-Length: {row['payload_bytes']}",
        ]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if revisit else row['payload_bytes']}"]
    return ("\r\n".join(lines) + END).encode("utf-8", "replace")


def _uniform(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """The pages in uniform names; `tie` tells rows with the same id but other contents apart."""
    return pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("tie", F.xxhash64("url", "payload"))


def record_kinds(pages: DataFrame) -> DataFrame:
    """One narrow row per page: digest, size, response or revisit, what it refers to, and its archive.

    The first of equal payloads is found by a combined minimum per digest; the rows go back to it
    by a plain join with one row per digest, whose large partitions Spark may split. Records are
    dealt over archives by hash of the id, so neither a hot payload nor a hot site fills one.
    """
    rows = stored(
        pages.select(
            "page_id", "tie", F.sha2("payload", 256).alias("payload_digest"),
            F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        ),
        "payloads",
    )
    n_archives = parts_for(rows.agg(F.sum("payload_bytes")).first()[0] or 0, ARCHIVE_BYTES)
    named = F.col("page_id").isNotNull() & (F.col("payload_bytes") >= MIN_REVISIT_BYTES)
    firsts = (
        rows.filter(named).groupBy("payload_digest")
        .agg(F.min(F.struct("page_id", "tie")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("payload_digest", "first")
    )
    nth = F.row_number().over(W.partitionBy("page_id", "tie").orderBy("tie"))
    leads = (F.col("first.page_id") == F.col("page_id")) & (F.col("first.tie") == F.col("tie")) & (F.col("nth") == 1)
    again = F.col("first").isNotNull() & F.col("page_id").isNotNull() & ~leads
    return (
        rows.join(firsts, "payload_digest", "left").withColumn("nth", nth)
        .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(again, F.col("first.page_id")))
        .withColumn("archive", _archive(n_archives))
        .drop("first")
    ).withColumn("n_archives", F.lit(n_archives))


def _archive(n: int):
    return F.pmod(F.xxhash64("page_id", "tie"), F.lit(n)).cast("int")


def _shared(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of Spark's default file system where it has none of its own."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()


def _store(path: str):
    """(file system or None for the local disk, name) of a path in a store that all executors share."""
    if path.startswith("/") or urlparse(path).scheme == "file":
        return None, unquote(urlparse(path).path)
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _create(path: str):
    store, name = _store(path)
    if store is None:
        os.makedirs(os.path.dirname(name), exist_ok=True)
        return open(name, "xb")  # noqa: SIM115
    return store.open_output_stream(name)


def _open(path: str):
    store, name = _store(path)
    return open(name, "rb") if store is None else store.open_input_file(name)  # noqa: SIM115


_INDEX = (
    "page_id bigint, url string, payload_digest string, payload_bytes bigint, record_type string, refers_to bigint, "
    "record string, path string, offset bigint, length bigint"
)


def write_archives(pages: DataFrame, kinds: DataFrame, folder: str) -> DataFrame:
    """Write a record per row into archives below `folder`; returns the index, to be stored at once.

    Index: page_id, url, payload_digest, payload_bytes, record_type, refers_to, record, path,
    offset, length. Payloads are compressed where they are read, so each moves once and small,
    and meet their narrow row by a sorted exchange over archives. A record is a gzip member for
    its head and one for its payload, streamed to a file of the task's own name: what a lost
    task leaves behind is in no index, and its rerun writes anew.
    """
    spark = pages.sparkSession
    small_batches(spark)
    n_archives = kinds.agg(F.max("n_archives")).first()[0] or 1

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [gzip.compress(p + END.encode(), LEVEL, mtime=0) for p in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(packed, pa.binary())], ["archive", "page_id", "tie", "url", "packed"]
            )

    texts = pages.select(_archive(n_archives).alias("archive"), "page_id", "tie", "url", "payload").mapInArrow(
        shrink, "archive int, page_id bigint, tie bigint, url string, packed binary"
    )
    both = kinds.drop("n_archives").withColumn("side", F.lit(0)).unionByName(
        texts.withColumn("side", F.lit(1)), allowMissingColumns=True
    )
    # by the number itself: hashed again, archives would share tasks while other tasks have none
    dealt = both.repartitionById(n_archives, F.col("archive")).sortWithinPartitions("archive", "page_id", "tie", "side", "nth")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, archive, path, offset, heads = None, None, "", 0, []
        try:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    if row["side"] == 0:  # the heads of equal rows come before their payloads
                        heads.append(row)
                        continue
                    head = heads.pop(0)
                    if archive != row["archive"]:
                        if file:
                            file.close()
                        archive, offset = row["archive"], 0
                        path = f"{folder}/{archive:06d}-{uuid.uuid4().hex}.warc.gz"
                        file = _create(path)
                    name = "none" if row["page_id"] is None else row["page_id"]
                    record = f"{name}-{row['tie'] & (2**64 - 1):016x}-{head['nth']}"
                    head = {**head, "url": row["url"], "record": record}
                    data = gzip.compress(record_head(head), LEVEL, mtime=0)
                    data += row["packed"] if head["record_type"] == "response" else gzip.compress(END.encode(), mtime=0)
                    file.write(data)
                    out.append({**head, "path": path, "offset": offset, "length": len(data)})
                    offset += len(data)
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW_INDEX)
        finally:
            if file:
                file.close()

    return dealt.mapInArrow(write, _INDEX)


_ARROW_INDEX = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("record", pa.string()), ("path", pa.string()),
    ("offset", pa.int64()), ("length", pa.int64()),
])


def coalesce_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """Sorted (offset, length) ranges joined into reads: (offset, length, numbers of the ranges)."""
    reads: list[tuple[int, int, list[int]]] = []
    for i, (offset, length) in enumerate(ranges):
        if reads:
            start, size, own = reads[-1]
            end = max(start + size, offset + length)
            if offset - (start + size) <= GAP_BYTES and end - start <= RANGE_BYTES:
                reads[-1] = (start, end - start, [*own, i])
                continue
        reads.append((offset, length, [i]))
    return reads


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Head and payload of one compressed record; the bytes must be exactly a record."""
    head, sep, rest = gzip.decompress(data).partition(END.encode())
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or not sep or rest[size:] != END.encode():
        raise ValueError(f"damaged record: {lines[:3]}")
    return fields, rest[:size]


def read_records(selected: DataFrame) -> DataFrame:
    """Fetch the selected index rows from their archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to and url, all taken from the bytes read.

    Rows are grouped by archive and stretch of GROUP_BYTES, sorted by offset, and fetched by a
    few coalesced reads, so each task holds at most RANGE_BYTES or one record of an archive.
    """
    placed = selected.select("page_id", "record", "path", "offset", "length")
    stretch = F.floor(F.col("offset") / GROUP_BYTES)

    def fetch(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        rows = table.select(["page_id", "record", "offset", "length"]).to_pylist()
        out = []
        with _open(table.column("path")[0].as_py()) as f:
            for start, size, own in coalesce_ranges([(r["offset"], r["length"]) for r in rows]):
                f.seek(start)
                data = f.read(size)
                for r in (rows[i] for i in own):
                    at = r["offset"] - start
                    fields, payload = parse_record(data[at : at + r["length"]])
                    if fields["WARC-Record-ID"] != f"<urn:page:{r['record']}>":
                        raise ValueError(f"the index points at another record than {r['record']}")
                    digest, n, refers = hashlib.sha256(payload).hexdigest(), len(payload), None
                    if fields["WARC-Type"] == "revisit":
                        digest, n = fields["WARC-Payload-Digest"].split(":")[1], int(fields["X-Payload-Length"])
                        refers = int(fields["WARC-Refers-To"].split(":")[-1].rstrip(">"))
                    elif fields["WARC-Payload-Digest"] != f"sha256:{digest}":
                        raise ValueError(f"the payload of {r['record']} does not have its digest")
                    out.append((r["page_id"], n, digest, fields["WARC-Type"], refers, fields.get("WARC-Target-URI")))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
        return pa.table({n: pa.array([o[i] for o in out], k) for i, (n, k) in enumerate(zip(names, kinds))})

    schema = (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
    )
    return placed.withColumn("stretch", stretch).groupBy("path", "stretch").applyInArrow(fetch, schema)


def archive_round_trip(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Write, index and read back: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    A null html is an empty payload and a null url leaves its line out. Of rows that repeat an id
    each gets a record of its own; of equal rows one leads. A record without an id cannot be
    referred to and is always a response. An empty table gives no rows. A revisit whose target is
    missing or has another payload raises an error.
    """
    uniform = _uniform(pages, id_col, url_col, html_col)
    kinds = stored(record_kinds(uniform), "record_kinds")
    folder = _shared(pages.sparkSession, scratch_path(pages.sparkSession, "warc"))
    index = stored(write_archives(uniform, kinds, folder), "warc_index")
    found = stored(read_records(index), "warc_records")
    # a hot payload shrinks to one line here before it meets its response
    links = found.filter("record_type = 'revisit'").select("refers_to", "payload_bytes", "payload_digest").distinct()
    kept = found.filter("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"
    )
    lost = links.join(kept, ["refers_to", "payload_bytes", "payload_digest"], "left_anti").head(1)
    if lost:
        raise ValueError(f"a revisit points at nothing: {lost[0]}")
    return found
