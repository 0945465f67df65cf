"""WARC archives: write, resolve revisits by payload digest, rewrite, read back."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxstrata.llm.bpe import slices, text_sizes
from rxstrata.llm.storage import open_input, remove, written_whole
from rxstrata.session import stage, staging_path

LEAST_REVISIT_BYTES = 1000
DATE = "2001-01-01T00:00:00Z"

# fixed values of the format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"

HEADERS = (
    "page_id long, url string, digest string, payload_bytes long,"
    " file string, offset long, length long"
)


def _record(kind: str, page_id, url, digest: str, n_bytes: int, payload: bytes, extra=()) -> bytes:
    """One record: WARC header, HTTP header, and the payload unless it is a revisit."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {n_bytes}\r\n\r\n"
    ).encode()
    block = http + (payload if kind == "response" else b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:unknown"
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        "Content-Type: application/http; msgtype=response",
        *extra,
        f"Content-Length: {len(block)}",
    ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _member(record: bytes, level: int) -> bytes:
    """A gzip member of its own, so that a record can be read without the others."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _parse(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC fields, HTTP header, body) of an unpacked record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a {VERSION} record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit its block")
    http, _, body = block.partition(b"\r\n\r\n")
    return fields, http, body


def _id_of(field: str) -> int | None:
    number = field.strip("<>").removeprefix(RECORD_ID)
    return int(number) if number else None


def write_responses(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes every page as a response record, one archive per partition of ``pages``.

    Returns the headers: page_id, url, digest (hex SHA-1), payload_bytes, and where the
    record stands (file, offset, length). Payloads do not leave the task.
    """

    def run(batches):
        uri = f"{folder}/pages-{TaskContext.get().partitionId():06d}.warc.gz"
        with written_whole(uri) as out:
            offset = 0
            for batch in batches:
                for part in slices(batch, text_sizes(batch.column(2))):
                    rows = []
                    for page_id, url, html in zip(*(c.to_pylist() for c in part.columns), strict=True):
                        payload = (html or "").encode()
                        digest = hashlib.sha1(payload).hexdigest()
                        packed = _member(_record("response", page_id, url, digest, len(payload), payload), 1)
                        out.write(packed)
                        rows.append((page_id, url, digest, len(payload), uri, offset, len(packed)))
                        offset += len(packed)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                        names=["page_id", "url", "digest", "payload_bytes", "file", "offset", "length"],
                    )

    chosen = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    return chosen.mapInArrow(run, HEADERS)


def resolve(headers: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Headers with ``original``: the record with the same payload that stays, or null.

    Of equal digests with at least ``least_bytes`` the record with the largest page_id
    stays (null smallest; of repeated ids the last by file and offset). Headers are
    folded per (file, digest) before the shuffle by digest, and the answer is joined
    back on the same pair, so a payload that fills the corpus makes one row per file.
    """
    long = headers.filter(F.col("payload_bytes") >= least_bytes)
    keys = ["digest", "payload_bytes"]
    leaves = long.groupBy("file", *keys).agg(
        F.max(F.struct("page_id", "file", "offset", "url")).alias("best")
    )
    roots = leaves.groupBy(*keys).agg(F.max("best").alias("original"))
    answers = leaves.select("file", *keys).join(roots, keys)
    joined = headers.join(answers, ["file", *keys], "left")
    itself = (F.col("original.file") == F.col("file")) & (F.col("original.offset") == F.col("offset"))
    return joined.withColumn("original", F.when(~F.coalesce(itself, F.lit(True)), F.col("original")))


def rewrite(resolved: DataFrame, folder: str) -> DataFrame:
    """Writes the archives anew: responses and revisits with fresh headers.

    Every source archive becomes one archive of the same number; a revisit names its
    original's record and target and has no payload. Source archives are deleted by the
    caller. Returns uri and n_records of the new archives.
    """

    def flush(uri, rows):
        with open_input(uri) as source, written_whole(f"{folder}/{uri.rsplit('/', 1)[1]}") as out:
            for r in rows:
                args = (r["page_id"], r["url"], r["digest"], r["payload_bytes"])
                if r["original"] is None:
                    source.seek(r["offset"])
                    _, _, payload = _parse(zlib.decompress(source.read(r["length"]), 31))
                    record = _record("response", *args, payload)
                else:
                    first = r["original"]
                    of = "" if first["page_id"] is None else first["page_id"]
                    extra = [
                        f"WARC-Profile: {REVISIT_PROFILE}",
                        f"WARC-Refers-To: <{RECORD_ID}{of}>",
                        f"WARC-Refers-To-Date: {DATE}",
                    ]
                    record = _record("revisit", *args, b"", extra)
                out.write(_member(record, 6))
        return f"{folder}/{uri.rsplit('/', 1)[1]}", len(rows)

    def run(batches):
        done, current, rows = [], None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["file"] != current:
                    if rows:
                        done.append(flush(current, rows))
                    current, rows = r["file"], []
                rows.append(r)
        if rows:
            done.append(flush(current, rows))
        if done:
            yield pa.RecordBatch.from_pydict(
                {"uri": [u for u, _ in done], "n_records": pa.array([n for _, n in done], pa.int64())}
            )

    parts = int(resolved.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        resolved.repartition(parts, "file")
        .sortWithinPartitions("file", "offset")
        .mapInArrow(run, "uri string, n_records long")
    )


def records(source) -> Iterator[bytes]:
    """The unpacked records of an archive, one at a time."""
    pending = b""
    while True:
        unpacker = zlib.decompressobj(31)
        parts = io.BytesIO()
        while not unpacker.eof:
            pending = pending or source.read(1 << 20)
            if not pending:
                if parts.tell():
                    raise EOFError("the archive ends within a record")
                return
            parts.write(unpacker.decompress(pending))
            pending = unpacker.unused_data if unpacker.eof else b""
        yield parts.getvalue()


def read(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record.

    A response's payload is hashed and held against its header.
    """

    def row(record: bytes):
        fields, http, body = _parse(record)
        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        kind = fields["warc-type"]
        length = int(re.search(rb"content-length: *(\d+)", http, re.IGNORECASE)[1])
        if kind == "response" and (hashlib.sha1(body).hexdigest() != digest or len(body) != length):
            raise ValueError(f"payload and header differ: {fields['warc-record-id']}")
        of = _id_of(fields["warc-refers-to"]) if kind == "revisit" else None
        return _id_of(fields["warc-record-id"]), length, digest, kind, of

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with open_input(uri) as source:
                    found = [row(r) for r in records(source)]
                columns = list(zip(*found, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.select("uri").repartition(parts, "uri").mapInArrow(run, schema)


def archive(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """The deduplicated archives (uri, n_records) of ``pages`` in a new shared folder.

    Null html is an empty payload, a null url becomes ``urn:unknown``, control
    characters in urls are percent-encoded, ids may be null or repeated. Payloads are
    written where they are read; only headers are shuffled.
    """
    spark = pages.sparkSession
    headers = stage(write_responses(pages, staging_path(spark, "warc-raw")), "warc-headers")
    done = stage(rewrite(resolve(headers, least_bytes), staging_path(spark, "warc")), "warc-list")

    def drop(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                remove(uri)
            yield batch

    headers.select("file").distinct().mapInArrow(drop, "file string").write.format("noop").mode("overwrite").save()
    return done
