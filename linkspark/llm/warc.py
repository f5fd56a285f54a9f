"""WARC archives: a writer of one gzip member a record, and a splittable reader."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import locate
from .common import fresh_dir, stash

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range that one reading task scans, and of one read from storage.
SPLIT, CHUNK = 8 << 20, 1 << 18
#: Reading tasks at most; beyond so many ranges a task reads several.
READERS = 100_000
DATE = "1970-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
WRITTEN = "path string, bytes long, records long"
RECORD = "path string, position long, record_type string, record_id string, refers_to string, target_uri string, declared_digest string, payload_bytes long, payload binary"


def sha1_base32(payload) -> F.Column:
    """Bare upper-case base32 SHA-1 of a binary column, without Python: each 5 hexadecimal digits are 4 of base 32."""
    text = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(text, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def clean(value: str | None) -> str:
    """A header's value: on one line."""
    return re.sub(r"[\r\n\x00]+", " ", value or "")


def record(kind: str, ident: str, uri: str, refers: str | None, digest: str, payload: bytes) -> bytes:
    """One record as a gzip member. A revisit has the HTTP head of the full payload and no body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{clean(ident)}>", f"WARC-Date: {DATE}"]
    if uri:
        head.append(f"WARC-Target-URI: {clean(uri)}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{clean(refers)}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n") + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def write(records: DataFrame, folder: str) -> DataFrame:
    """Writes ``records(record_type, record_id, refers_to, target_uri, digest, payload)`` to ``folder``, an archive a partition.

    Gives (path, bytes, records) of each archive. A file has the name of its attempt and
    counts only if the result names it, so a task can run again, or twice at once, on any
    storage, without a rename: what an attempt that failed left is never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = locate(folder)
        store.create_dir(base, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        count = size = 0
        with store.open_output_stream(f"{base}/{name}", compression=None) as out:
            for batch in batches:
                for kind, ident, refers, uri, digest, payload in zip(*(c for c in batch.columns), strict=True):
                    member = record(kind.as_py(), ident.as_py(), uri.as_py(), refers.as_py(), digest.as_py(), payload.as_py() or b"")
                    out.write(member)
                    count, size = count + 1, size + len(member)
        if count:
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [count]})
        else:
            store.delete_file(f"{base}/{name}")

    return records.select("record_type", "record_id", "refers_to", "target_uri", "digest", "payload").mapInArrow(run, WRITTEN)


class Source:
    """Buffered bytes of an archive at any position."""

    def __init__(self, handle):
        self.handle, self.size, self.at, self.data = handle, handle.size(), 0, b""

    def get(self, position: int, least: int = 1) -> bytes:
        """Bytes from ``position``, at least ``least`` unless the file ends before."""
        if not self.at <= position <= self.at + len(self.data) - min(least, self.size - position):
            self.handle.seek(position)
            self.at, self.data = position, self.handle.read(CHUNK)
        return self.data[position - self.at :]


def member(source: Source, start: int) -> tuple[bytes, int] | None:
    """The WARC record in the gzip member at ``start`` and where it ends, or None if there is none.

    Its first bytes must decode to a WARC version line, and its checksum must hold.
    """
    unpack, parts, at, seen = zlib.decompressobj(31), [], start, b""
    try:
        while not unpack.eof:
            data = source.get(at)
            if not data:
                return None
            parts.append(unpack.decompress(data))
            at += len(data)
            if len(seen) < 9:
                seen += parts[-1][:9]
                if not b"WARC/1.".startswith(seen[:7]):
                    return None
    except zlib.error:
        return None
    return b"".join(parts), at - len(unpack.unused_data)


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        return None
    head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = head.get("content-length", "")
    if not size.isdigit() or len(data) < end + 4 + int(size):
        return None
    return head, data[end + 4 : end + 4 + int(size)]


def first_member(source: Source, start: int, end: int) -> int | None:
    """The first position from ``start``, before ``end``, where a record's member begins: magic whose member decodes to a WARC head, with the right checksum."""
    at = start
    while at < end:
        data = source.get(at, len(MAGIC))
        if not data:
            return None
        hit = data.find(MAGIC)
        if hit < 0:
            at += max(1, len(data) - len(MAGIC) + 1)
            continue
        at += hit
        if at >= end:
            return None
        found = member(source, at)
        if found and parse(found[0]):
            return at
        at += 1
    return None


def records_in(handle, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, head, block) of each record whose member begins in [start, end)."""
    source = Source(handle)
    at = first_member(source, start, end)
    while at is not None and at < end:
        found = member(source, at)
        parsed = parse(found[0]) if found else None
        if not parsed:
            # damaged: go on at the next member
            at = first_member(source, at + 1, end)
            continue
        yield at, *parsed
        at = found[1] if found[1] < source.size else None


def read(archives: DataFrame, split: int = SPLIT) -> DataFrame:
    """The records of ``archives(path, bytes)``: RECORD's columns, one row a record.

    Archives are cut into ranges of ``split`` bytes that tasks scan on their own, as many
    tasks as ranges up to READERS: the first gzip magic in a range that decodes to a WARC
    head starts its records, and a record belongs to the range in which it starts, so none
    is read twice or lost. A record's payload is its block without the HTTP head; a
    revisit's payload is null and payload_bytes what its HTTP head tells. A damaged member
    is passed over, its neighbours are not; an empty table of archives gives no rows. A
    payload that is an archive itself, so dense that gzip stores it as it is, can look like
    records to a range that starts inside it.
    """
    total = archives.agg(F.sum(F.ceil(F.greatest(F.col("bytes"), F.lit(1)) / split))).first()[0] or 1
    ranges = archives.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("long"))).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split, F.col("bytes")).alias("end"))
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = locate(path)
                with store.open_input_file(name) as handle:
                    for at, head, block in records_in(handle, start, end):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind = head.get("warc-type")
                        length = re.search(rb"(?i)^content-length:\s*(\d+)", http, re.M)
                        bare = lambda x: x.strip("<>") if x else None
                        revisit = kind == "revisit"
                        declared = (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                        rows.append((path, at, kind, bare(head.get("warc-record-id")), bare(head.get("warc-refers-to")), head.get("warc-target-uri"), declared, (int(length[1]) if length else None) if revisit else len(payload), None if revisit else payload))
                        size += len(block)
                        if size >= 4 << 20 or len(rows) >= 4096:
                            yield flush()
                            rows, size = [], 0
        if rows:
            yield flush()

    # one range a row, dealt in turn to a stated number of tasks, which is never lowered for the rows being small
    return ranges.repartition(min(int(total), READERS)).mapInArrow(run, RECORD)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """write()'s records of ``pages(page_id, url, html)``.

    Of pages with equal payloads of at least ``least`` bytes, those with the largest
    page_id are responses and the others revisits of it; smaller ones are all responses.
    Equal payloads are found by SHA-1 and length. A null html is an empty payload, a null
    page_id is smaller than any other, a null url is left out. Rows that repeat the
    largest page_id of a payload are all responses.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("digest", sha1_base32("payload")).withColumn("n", F.length("payload"))
    first = rows.groupBy(F.col("digest").alias("_d"), F.col("n").alias("_n")).agg(F.max("page_id").alias("first"))
    rows = rows.join(first, (F.col("digest") == F.col("_d")) & (F.col("n") == F.col("_n")))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    again = (F.col("n") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        name(F.col("page_id")).alias("record_id"),
        F.when(again, name(F.col("first"))).alias("refers_to"),
        "target_uri", "digest", "payload",
    )


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes pages as archives to the shared folder, reads them back and describes each record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    archives = stash(write(page_records(pages, least), fresh_dir(spark, "warc")), "warc-list")
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return read(archives).select(
        number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        F.when(F.col("record_type") == "revisit", F.col("declared_digest")).otherwise(sha1_base32("payload")).alias("payload_digest"),
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )
