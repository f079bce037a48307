"""WARC archives: a writer and a salvage reader.

Writer: each task writes its records, a gzip member each, to files of its own in a folder of the
shared storage and returns their names. Names are unique to the attempt and only returned files
are read, so a repeated or lost task leaves no double records. Records with equal payloads of at
least ``REVISIT_BYTES`` are found by digest: the one with the smallest id is a response, the
others are revisits that refer to it. The first ids are aggregated per digest before any join,
and the join is salted, so a payload that fills a third of the table does not meet in one task.

Salvage reader: files are read in windows. A member (or, in plain files, a record) must inflate,
start with a version line, have the length its header names, and a response's payload must have
the digest its header names. After a failed check the reader searches for the next gzip member or
version line that passes, goes on from there and logs the bytes between as a quarantined gap.

Defined cases: null payloads are empty; a null id is written as such and read back as null; rows
with equal id and payload are all responses if that id is the smallest; payloads hold any bytes,
version lines included; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffmart.llm.common import input_partitions, materialize, shared_path, ship_code

REVISIT_BYTES = 100
FILE_BYTES = 16 << 20
WINDOW, FIRST = 1 << 20, 1 << 10          # bytes read at once, and of a record that may be none
HEAD = 1 << 17                            # more than a gzip header's largest extra field; content begins before
SALTS = 32
_URN = "urn:page:"
MANIFEST_DDL = "file string, bytes long, records long"
RECORD_SCHEMA = pa.schema([("file", pa.string()), ("position", pa.int64()), ("bytes", pa.int64()), ("kind", pa.string()), ("page_id", pa.int64()),
                           ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                           ("payload", pa.binary()), ("reason", pa.string())])
RECORD_DDL = ("file string, position long, bytes long, kind string, page_id long, url string, payload_bytes long, "
              "payload_digest string, refers_to long, payload binary, reason string")


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null for responses)."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    first = (p.where(F.length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1").select(F.col("digest").alias("first_digest"), "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("first_salt")))
    p = p.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = p.join(first, (F.col("digest") == F.col("first_digest")) & (F.col("salt") == F.col("first_salt")), "left")
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def _urn(page_id: int | None) -> str:
    return f"<{_URN}{'null' if page_id is None else page_id}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record, not yet compressed."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}",
             "WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url or ""), f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def write_archives(rows: DataFrame, folder: str, compress: bool = True, file_bytes: int = FILE_BYTES, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write ``rows`` (of :func:`with_revisits`) to files under ``folder``; returns the manifest,
    itself a written table."""
    ship_code(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        fs.create_dir(base, recursive=True)
        done, out, name, size, count = [], None, "", 0, 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc{'.gz' if compress else ''}", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                record = encode_record(page_id, url, payload, digest, refers_to, date)
                if compress:
                    z = zlib.compressobj(4, zlib.DEFLATED, 31)
                    record = z.compress(record) + z.flush()
                out.write(record)
                size, count = size + len(record), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{base}/{name}", size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{base}/{name}", size, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "bytes", "records"])

    return materialize(rows.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, MANIFEST_DDL), "warc-manifest")


class _Source:
    """A file read in windows, from any position."""

    def __init__(self, handle: pa.NativeFile):
        self.handle, self.size = handle, handle.size()
        self.at, self.data = 0, b""

    def read(self, position: int, n: int) -> bytes:
        if not (self.at <= position and position + n <= self.at + len(self.data)):
            self.handle.seek(position)
            self.at, self.data = position, self.handle.read(max(n, WINDOW))
        return self.data[position - self.at:position - self.at + n]

    def search(self, what: bytes, position: int) -> int:
        """The next place of ``what``, or the file's end."""
        while position < self.size:
            self.read(position, min(len(what), self.size - position))       # the window holds it now
            found = self.data.find(what, position - self.at)
            if found >= 0:
                return self.at + found
            position = max(position + 1, self.at + len(self.data) - len(what) + 1)
        return self.size


class BadRecord(ValueError):
    pass


def _header(data: bytes) -> tuple[dict[str, str], int]:
    """Fields and length of a record's header."""
    if not re.match(rb"WARC/1\.[01]\r\n", data):
        raise BadRecord("no version line")
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise BadRecord("no end of header")
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in data[:end].decode("utf-8", "replace").split("\r\n")[1:]))
    if not fields.get("content-length", "").isdigit():
        raise BadRecord("no content length")
    return fields, end + 4


def _number(urn: str) -> int | None:
    m = re.fullmatch(rf"<{_URN}(-?\d+)>", urn)
    return int(m[1]) if m else None


def decode_record(data: bytes) -> dict:
    """Fields of a whole record; raises :class:`BadRecord` if a check fails."""
    fields, start = _header(data)
    size = int(fields["content-length"])
    if data[start + size:] != b"\r\n\r\n":
        raise BadRecord("content length does not fit")
    block = data[start:start + size]
    kind, digest = fields.get("warc-type", ""), fields.get("warc-payload-digest", "").removeprefix("sha256:")
    cut = block.find(b"\r\n\r\n")
    http, payload = (block[:cut], block[cut + 4:]) if cut >= 0 else (b"", block)
    if kind == "response" and digest and hashlib.sha256(payload).hexdigest() != digest:
        raise BadRecord("payload digest differs")
    named = re.search(rb"(?i)content-length: *(\d+)", http)
    return {"kind": kind, "page_id": _number(fields.get("warc-record-id", "")), "url": fields.get("warc-target-uri"),
            "payload_bytes": int(named[1]) if kind == "revisit" and named else len(payload), "payload_digest": digest,
            "refers_to": _number(fields.get("warc-refers-to", "")), "payload": None if kind == "revisit" else payload, "reason": None}


def _member(src: _Source, position: int) -> tuple[bytes, int]:
    """A gzip member's content and its end in the file."""
    z, parts, at = zlib.decompressobj(31), [], position
    while not z.eof:
        data = src.read(at, min(WINDOW if parts else FIRST, src.size - at))
        if not data:
            raise BadRecord("file ends inside a member")
        try:
            parts.append(z.decompress(data))
        except zlib.error as e:
            raise BadRecord(f"member does not inflate: {e}") from None
        if len(parts) <= 2 and not b"WARC/1.".startswith(b"".join(parts)[:7]):
            raise BadRecord("no version line")
        at += len(data)
        if at - position > HEAD and not any(parts):
            raise BadRecord("no content behind the member's header")
    return b"".join(parts), at - len(z.unused_data)


def _plain(src: _Source, position: int) -> tuple[bytes, int]:
    """A plain record's bytes and its end in the file."""
    ask = FIRST
    while True:      # to the header's end, however long its fields are, but only over header lines
        data = src.read(position, min(ask, src.size - position))
        if not re.match(rb"WARC/1\.[01]\r\n", data):
            raise BadRecord("no version line")
        end = data.find(b"\r\n\r\n")
        lines = data[:end if end >= 0 else data.rfind(b"\r\n")].split(b"\r\n")[1:]
        if any(b":" not in x and x[:1] not in b" \t" for x in lines):
            raise BadRecord("no header field")
        if end >= 0 or len(data) < ask:
            break
        ask *= 2
    fields, start = _header(data)
    end = position + start + int(fields["content-length"]) + 4
    if end > src.size:
        raise BadRecord("file ends inside a record")
    return src.read(position, end - position), end


def salvage(handle: pa.NativeFile) -> Iterator[dict]:
    """Records and gaps of one file, in order. A gap has kind ``gap`` and a reason."""
    src = _Source(handle)
    position, bad_from, reason = 0, -1, ""
    marks = {b"\x1f\x8b\x08": -1, b"WARC/1.": -1}          # each one's next place, so that no byte is searched twice
    while position < src.size:
        gz = src.read(position, 2) == b"\x1f\x8b"
        try:
            data, end = (_member if gz else _plain)(src, position)
            record = decode_record(data)
        except BadRecord as e:
            if bad_from < 0:
                bad_from, reason = position, str(e)
            for mark, place in marks.items():
                if place <= position:
                    marks[mark] = src.search(mark, position + 1)
            position = min(marks.values())
            continue
        if bad_from >= 0:
            yield {"position": bad_from, "bytes": position - bad_from, "kind": "gap", "reason": reason}
            bad_from = -1
        yield record | {"position": position, "bytes": end - position}
        position = end
    if bad_from >= 0:
        yield {"position": bad_from, "bytes": src.size - bad_from, "kind": "gap", "reason": reason}


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of all files of a manifest; damaged stretches as rows of kind ``gap``, and a file
    without any that gives fewer or more records than the manifest says as a ``gap`` of no bytes."""
    ship_code(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, written in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = pafs.FileSystem.from_uri(file if "://" in file else f"file://{file}")
                rows: list[dict] = []
                size = n_records = n_gaps = 0
                with fs.open_input_file(path) as handle:
                    for r in salvage(handle):
                        if not with_payload:
                            r["payload"] = None
                        n_records, n_gaps = n_records + (r["kind"] != "gap"), n_gaps + (r["kind"] == "gap")
                        rows.append({"file": file} | r)
                        size += 300 + len(r.get("payload") or b"")
                        if size > 4 * WINDOW:
                            yield pa.RecordBatch.from_pylist(rows, schema=RECORD_SCHEMA)
                            rows, size = [], 0
                if n_records != written and not n_gaps:
                    rows.append({"file": file, "position": 0, "bytes": 0, "kind": "gap", "reason": f"{n_records} records read, {written} written"})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=RECORD_SCHEMA)

    files = manifest.select("file", "records")
    return files.repartition(max(1, 4 * input_partitions(files))).mapInArrow(run, RECORD_DDL)


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write archives of all pages and read them back."""
    manifest = write_archives(with_revisits(pages, id_col, url_col, payload_col), shared_path(spark, "warc"))
    return read_archives(manifest, with_payload=False)


def whole(records: DataFrame) -> DataFrame:
    """``records``, or an error if there is a gap among them: for archives just written."""
    told = F.raise_error(F.concat_ws(" ", F.lit("damaged archive"), "file", "reason")).cast("boolean")
    return records.where(F.when(F.col("kind") == "gap", told).otherwise(F.lit(True)))


def digest(records: DataFrame) -> DataFrame:
    """What a page's record says. Nothing may be missing (:func:`whole`)."""
    return (whole(records)
            .select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to"))


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
f AS (SELECT payload, min(page_id) AS first_id FROM p WHERE octet_length(payload) >= 100 GROUP BY payload)
SELECT p.page_id, octet_length(p.payload)::BIGINT AS payload_bytes, sha256(p.payload) AS payload_digest,
  CASE WHEN f.first_id IS NULL OR f.first_id = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload = f.payload
"""
