"""WARC archives (operator 8): index first, then coalesced byte-range reads.

Writing: every page becomes one WARC/1.1 record (a gzip member of its own). Of
pages with equal payloads the smallest id is written as ``response``, the others
as ``revisit`` of it. Each task streams its records into archive files of its own
in a folder that all executors share, and returns an index row per record: file,
offset, length, url, digest, type. The index is written as a table; files of lost
or repeated task attempts carry other names and are in no index row, so they are
never read.

Reading: the wanted index rows are dealt out by file and stretch of file, sorted
by offset, and neighbouring ranges are fetched with one read. Records are parsed,
and payload digests computed again and compared.

Defined cases: a null html is an empty payload; a null url has no target header;
a null id counts as larger than any other; repeated rows with the smallest id are
all ``response``; payloads below ``min_revisit_bytes`` are all ``response``; an
empty table gives an empty index; only the three named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.llm.common import read
from responsekit.session import ensure_checkpoint_dir, materialize

#: An archive file is closed beyond this size; ranges of up to GAP bytes apart are fetched together, up to READ bytes.
FILE_BYTES, GAP, READ = 1 << 30, 64 << 10, 8 << 20
#: Index rows of one stretch of a file are read by one task.
STRETCH = 32 << 20
WARC_DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = T.StructType([
    T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
RECORD = T.StructType([
    T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload", T.BinaryType())])


def open_store(folder: str):
    """File system and path of a shared folder named by a URI or an absolute path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page_id: str | None) -> str:
    return f"<urn:x-page:{page_id or ''}>"


def record_bytes(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record: WARC headers, block, two line ends. A revisit's block is the HTTP head alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {page_urn(page_id)}",
            f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]|{}^`\\\"<>"))
    if refers_to:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    block = http if refers_to else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Headers and payload of a record; the digest of a response is checked against its payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    sizes = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    out = {"record_type": fields["WARC-Type"], "payload_bytes": int(sizes["Content-Length"]),
           "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
           "refers_to": fields.get("WARC-Refers-To"), "payload": None}
    if out["record_type"] == "response":
        out["payload"] = payload
        if len(payload) != out["payload_bytes"] or base32_sha1(payload) != out["payload_digest"]:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    else:
        out["refers_to"] = out["refers_to"].removeprefix("<urn:x-page:").removesuffix(">") or None
    return out


class ArchiveWriter:
    """Appends gzip members to archive files named after the task attempt."""

    def __init__(self, folder: str, level: int):
        from pyspark import TaskContext
        task = TaskContext.get()
        self.store, self.folder = open_store(folder)
        self.stem = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        self.level, self.out, self.files = level, None, 0

    def add(self, record: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at > FILE_BYTES:
            self.close()
            self.name, self.at, self.files = f"{self.stem}-{self.files}.warc.gz", 0, self.files + 1
            self.out = self.store.open_output_stream(f"{self.folder}/{self.name}", compression=None)  # members are packed here
        pack = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        member = pack.compress(record) + pack.flush()
        self.out.write(member)
        self.at += len(member)
        return self.name, self.at - len(member), len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def with_types(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """``pages`` (page_id, url, html) with ``revisits``: the id of the response of the same payload, if another."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.withColumn("sha", F.sha1(payload))
    # written before it is joined back, so that adaptive execution can split a payload that very many pages have
    first = materialize(hashed.groupBy("sha").agg(F.min("page_id").alias("first_id")))
    is_revisit = ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.octet_length(payload) >= min_revisit_bytes)
    return hashed.join(first, "sha").select("page_id", "url", "html", is_revisit.alias("is_revisit"), "first_id")


def write_archive(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, level: int = 6) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns the index, a written table (ids as text)."""
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    typed = with_types(pages, min_revisit_bytes).select(F.col("page_id").cast("string"), "url", "html", "is_revisit",
                                                        F.col("first_id").cast("string"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, level)
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                page_id, url, html, is_revisit, first_id = (c[k].as_py() for c in batch.columns)
                payload = (html or "").encode("utf-8", "surrogatepass")
                digest = base32_sha1(payload)
                refers = page_urn(first_id) if is_revisit else None
                where = writer.add(record_bytes(page_id, url, payload, digest, refers))
                rows.append((page_id, url, digest, "revisit" if refers else "response", *where))
            yield pa.RecordBatch.from_pylist([dict(zip(INDEX.names, r)) for r in rows], schema=index_schema)
        writer.close()

    from pyspark.sql.pandas.types import to_arrow_schema
    index_schema = to_arrow_schema(INDEX)

    return materialize(typed.mapInArrow(write, INDEX))


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that ``index`` (all or some of its rows) points at, parsed and checked."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        name, source = None, None
        for batch in batches:
            rows = batch.to_pylist()
            at = 0
            while at < len(rows):
                end, first = at + 1, rows[at]
                while (end < len(rows) and rows[end]["file"] == first["file"]
                       and rows[end]["offset"] - rows[end - 1]["offset"] - rows[end - 1]["length"] <= GAP
                       and rows[end]["offset"] + rows[end]["length"] - first["offset"] <= READ):
                    end += 1
                if name != first["file"]:
                    if source is not None:
                        source.close()
                    name, source = first["file"], store.open_input_file(f"{path}/{first['file']}")
                last = rows[end - 1]
                block = source.read_at(last["offset"] + last["length"] - first["offset"], first["offset"])
                out = []
                for r in rows[at:end]:
                    start = r["offset"] - first["offset"]
                    got = parse_record(zlib.decompress(block[start: start + r["length"]], 31))
                    out.append({"page_id": r["page_id"], "url": r["url"], **got,
                                "payload": got["payload"] if payloads else None})
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                at = end
        if source is not None:
            source.close()

    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(RECORD)
    wanted = index.select("page_id", "url", "file", "offset", "length", F.floor(F.col("offset") / STRETCH).alias("stretch"))
    return (wanted.repartition("file", "stretch").sortWithinPartitions("file", "offset")
            .select("page_id", "url", "file", "offset", "length").mapInArrow(fetch, RECORD))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = f"{ensure_checkpoint_dir(spark)}/warc/{uuid.uuid4().hex}"
    kind = pages.schema["page_id"].dataType
    return read_records(write_archive(pages, folder), folder, payloads=False).select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first_id FROM p GROUP BY hex)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p JOIN f USING (hex)
"""
