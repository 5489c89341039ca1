"""WARC archives: a writer with one gzip member per record, and a splittable reader.

Writing: equal payloads share one ``response`` record, that of the smallest page;
the others become ``revisit`` records that refer to it and carry no payload, only
the HTTP headers with its length. Each task writes archives of its own in the
shared folder, under names that no other attempt uses, and returns them as rows
of a manifest; what a lost attempt left is in no manifest.

Reading: the archives are cut into byte ranges, and each task takes ranges. It
scans for the gzip magic, tries to decode a WARC header at every candidate and
goes on from the next byte if that fails. A record belongs to the range in which
its member starts, however far it runs; after a whole record (decoded to its
checksum, with the length its header states) the scan goes on at its end. So each
record is read once, whatever the ranges.

What a reader returns of a payload (its length, its digest) is computed from the bytes
it read, not taken from headers. :func:`verified` makes reading complete or
fail: every byte of every archive must belong to a record, the manifest's number of
records must have been read, and every payload must have the digest and length its
headers state. A revisit has no payload: it takes length and digest from the response it
refers to, which must exist with the digest that the revisit states.

Archives are opened through ``pyarrow.fs``: local files, ``hdfs:``, ``viewfs:``, ``s3:`` (``s3a:``
and ``s3n:`` name the same store), ``gs:``, ``abfs(s):`` and ``dbfs:`` by its mount. A folder
of another scheme is refused before anything is written. Credentials are those that the
file system finds in the executors' environment.

HTTP headers are split off where the record's type of content is application/http;
the whole block of any other record is its payload.

A task holds one record and a read buffer at a time. Defined cases: a null page
is an empty payload; with a null page id among equal payloads, the smallest
other id is the response's; rows that tie for it are all responses; line breaks
in a url are percent-encoded; a null url leaves the header out; repeated rows
give repeated records; empty tables give no archive and an empty result. Extra
columns are not read.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import in_arrow, quoted
from quarry.operators.staging import broadcast_if_small, stage
from quarry.session import staging_path

ARCHIVE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
LEAST_PAYLOAD = 0
MOST_READ_TASKS = 20_000
_CHUNK = 1 << 20
MAGIC = b"\x1f\x8b\x08"
_PAGE = "urn:x-page:"
# Schemes as Hadoop names them, by what opens them.
_MOUNTS = {"file": "/", "dbfs": "/dbfs/"}
_SCHEMES = {"hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _open(uri: str):
    """File system and path of a Hadoop-style URI."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if uri.startswith("/") or not colon:
        return fs.LocalFileSystem(), uri
    if scheme in _MOUNTS:
        return fs.LocalFileSystem(), _MOUNTS[scheme] + rest.lstrip("/")
    scheme = _SCHEMES.get(scheme)
    if scheme is None:
        raise ValueError(f"archives cannot be opened at {uri}: use one of {', '.join([*_MOUNTS, *_SCHEMES])}")
    return fs.FileSystem.from_uri(f"{scheme}:{rest}")


# ------------------------------------------------------------------- writing

def _record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if first is not None else http + payload
    name = lambda x: f"<{_PAGE}{'' if x is None else x}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {name(page)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if ord(c) < 32 else c for c in url))
    if first is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(first)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + packer.flush()


def write_warc(df: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html",
               least_payload: int = LEAST_PAYLOAD, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> DataFrame:
    """Write the archives; return the staged manifest: path, bytes, records."""
    spark = df.sparkSession
    folder = (folder or staging_path(spark, "warc")).rstrip("/")
    _open(folder)  # a store that no task could open is refused here
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(df[quoted(html)].cast("string"), F.lit("")).cast("binary")
    src = df.select(df[quoted(key)].cast("long").alias("page"), df[quoted(url)].cast("string").alias("url"), body.alias("payload"))
    src = src.withColumn("digest", F.sha1("payload"))
    sized = src.select("page", "digest", F.octet_length("payload").alias("bytes")).where(F.col("bytes") >= least_payload)
    shared = (sized.groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 and first is not null").select("digest", "first"))
    shared = broadcast_if_small(stage(shared, "warc-shared"))
    rows = (src.join(shared, "digest", "left")
            .withColumn("first", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")))
            .select("page", "url", "payload", "digest", "first"))

    def write(it):
        out, path, made, records = None, "", 0, 0
        for batch in it:
            for page, link, payload, digest, first in zip(*(c for c in batch.columns)):
                if out is None:
                    files, at = _open(folder)
                    files.create_dir(at, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, made, records = f"{folder}/{name}", 0, 0
                    out = files.open_output_stream(f"{at}/{name}", compression=None)
                sha = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                member = _record(page.as_py(), link.as_py(), payload.as_py(), sha, first.as_py(), date)
                out.write(member)
                made, records = made + len(member), records + 1
                if made >= archive_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [made], "records": [records]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [made], "records": [records]})

    return stage(in_arrow(rows, write, "path string, bytes long, records long"), "warc-manifest").df


# ------------------------------------------------------------------- reading

class _Window:
    """Reads of a file by offset, through one buffer."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def read(self, offset: int, n: int) -> bytes:
        end = min(offset + n, self.size)
        if not self.at <= offset or end > self.at + len(self.data):
            self.file.seek(offset)
            self.at, self.data = offset, self.file.read(min(max(n, _CHUNK), self.size - offset))
        return self.data[offset - self.at:end - self.at]


def _headers(data: bytes) -> dict[str, str] | None:
    """Fields of a WARC header block; None if it is no such block."""
    lines = data.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def _member(window: _Window, offset: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header, block and end of the record whose member starts at ``offset``, or None."""
    unpack, data, at, fields, wanted, searched = zlib.decompressobj(31), bytearray(), offset, None, 0, 0
    step = 1 << 12  # the first bytes tell most false candidates
    try:
        while not unpack.eof:
            piece = window.read(at, step)
            if not piece:
                return None
            data += unpack.decompress(piece)
            at, step = at + len(piece), _CHUNK >> 2
            if fields is None:
                if not b"WARC/".startswith(bytes(data[:5])):
                    return None
                head = data.find(b"\r\n\r\n", searched)  # as far as the member goes
                searched = max(0, len(data) - 3)
                if head >= 0:
                    fields = _headers(bytes(data[:head]))
                    if fields is None:
                        return None
                    wanted = head + 4 + int(fields["content-length"]) + 4
            if fields is not None and len(data) > wanted:
                return None
    except zlib.error:
        return None
    if fields is None or len(data) != wanted or not data.endswith(b"\r\n\r\n"):
        return None
    return fields, bytes(data[head + 4:-4]), at - len(unpack.unused_data)


def members_in(uri: str, size: int, start: int, end: int):
    """Offset, header, block and bytes of the member of each record that starts in [start, end)."""
    files, path = _open(uri)
    with files.open_input_file(path) as file:
        window, at = _Window(file, size), start
        while at < min(end, size):
            piece = window.read(at, min(_CHUNK, end - at + len(MAGIC) - 1))
            hit = piece.find(MAGIC)
            if hit < 0:
                at += max(1, len(piece) - len(MAGIC) + 1)
                continue
            at += hit
            if at >= end:
                return
            found = _member(window, at)
            if found is None:
                at += 1
                continue
            yield at, found[0], found[1], found[2] - at
            at = found[2]


def records_in(uri: str, size: int, start: int, end: int):
    """Offset, header and block of each record whose member starts in [start, end)."""
    for at, fields, block, _ in members_in(uri, size, start, end):
        yield at, fields, block


READ_SCHEMA = ("path string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
               "payload_digest string, payload_bytes long, payload binary, digest_ok boolean, member_bytes long")


def _row(path: str, offset: int, fields: dict[str, str], block: bytes, member_bytes: int | None = None) -> tuple:
    """A revisit has the digest and length that it states, any other record those of its payload."""
    http, payload = b"", block
    if fields.get("content-type", "").partition(";")[0].strip().lower() == "application/http":
        http, _, payload = block.partition(b"\r\n\r\n")
    stated = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    full = int(stated[0]) if stated else len(payload)
    digest = fields.get("warc-payload-digest", "").rpartition(":")[2]
    revisit, ok = fields["warc-type"] == "revisit", None
    if not revisit:
        read = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ok = digest in ("", read) and full == len(payload)
        digest, full = read, len(payload)
    return (path, offset, fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-target-uri"),
            fields.get("warc-refers-to"), digest, full, None if revisit else payload, ok, member_bytes)


def read_warc(archives: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """Records of the archives in a table with path and bytes; ``payloads=False`` leaves the
    payload column null (lengths and digests are of the full payload either way).

    Damaged members are skipped here, and a revisit's length and digest are its own header's;
    :func:`verified` checks both."""
    ranges = archives.where("bytes > 0").select("path", "bytes", F.explode(
        F.expr(f"sequence(0L, bytes - 1, {int(split_bytes)}L)")).alias("start"))
    tasks = ranges.agg(F.count(F.lit(1))).first()[0]
    ranges = ranges.repartition(max(1, min(tasks, MOST_READ_TASKS)))
    names = [x.split(" ")[0] for x in READ_SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary(), pa.bool_(), pa.int64()]

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def read(it):
        rows, held = [], 0
        for batch in it:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                for offset, fields, block, member in members_in(path, size, start, start + split_bytes):
                    row = _row(path, offset, fields, block, member)
                    if not payloads:
                        row = (*row[:8], None, *row[9:])
                    rows.append(row)
                    held += len(row[8] or b"") + 512
                    if held >= _CHUNK:
                        yield pack(rows)
                        rows, held = [], 0
        if rows:
            yield pack(rows)

    return in_arrow(ranges, read, READ_SCHEMA)


class DamagedArchiveError(ValueError):
    pass


def verified(records: DataFrame, archives: DataFrame) -> DataFrame:
    """The rows of :func:`read_warc` over ``archives``, once they are known to be all of them
    and right; else :class:`DamagedArchiveError`.

    The records are staged (with their payloads, if they were read). Revisits are joined to the
    responses that some revisit names, one row each; a response that a third of all revisits
    name is one row on its side, so the join may split the revisits."""
    held = stage(records, "warc-records").df
    read = held.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum("member_bytes").alias("covered"),
                                    F.count_if(~F.col("digest_ok")).alias("wrong"))
    stated = F.col("records") if "records" in archives.columns else F.lit(None)
    sums = (archives.select("path", "bytes", stated.cast("long").alias("records")).join(read, "path", "left")
            .select("path", "bytes", "records", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "covered", "wrong")]))
    off = sums.where("covered <> bytes or n <> records or wrong > 0")
    bad = off.orderBy("path").limit(5).collect()
    if bad:
        raise DamagedArchiveError("; ".join(
            f"{r['path']}: {r['n']} records of {r['records']}, {r['covered']} bytes of {r['bytes']}, {r['wrong']} wrong payloads" for r in bad))

    revisit = F.col("record_type") == "revisit"
    named = held.where(revisit).select(F.col("refers_to").alias("record_id")).distinct()
    first = (held.where(~revisit).join(named, "record_id", "left_semi")
             .groupBy(F.col("record_id").alias("first_id"), F.col("payload_digest").alias("first_digest"))
             .agg(F.max("payload_bytes").alias("first_bytes")))
    first = broadcast_if_small(stage(first, "warc-first"))
    met = held.where(revisit).join(first, [held.refers_to == first.first_id, held.payload_digest == first.first_digest], "left")
    length = F.when(F.col("first_bytes") == F.col("payload_bytes"), F.col("first_bytes")).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("no response with the payload of revisit"), "record_id", F.lit("of"), "refers_to")).cast("long"))
    met = met.select(*[length.alias(c) if c == "payload_bytes" else F.col(c) for c in held.columns])
    return held.where(~revisit).unionByName(met)


def archive_table(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Path and bytes of existing archives (files, folders or globs), listed by Spark."""
    return spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("bytes"))


def page_number(name):
    """The page id in a record id of this writer; null if it has none."""
    return F.regexp_extract(name, f"^<{_PAGE}(-?[0-9]+)>$", 1).try_cast("long")
