"""WARC archives compressed record by record with a Zstandard dictionary that leads the file in a skippable frame."""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import materialize, new_path
from millrace.llm.text import unit_hash

#: Skippable frame of the dictionary, as in the .warc.zst format.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: Records from which the dictionary is built, about, and the bytes of a payload up to which a row may be picked for that.
SAMPLE_ROWS, SAMPLE_BYTES = 400, 64 << 10
#: An archive is closed after so many bytes.
ARCHIVE_BYTES = 128 << 20
LEVEL = 3


def payload_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def build_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the records ``samples``: trained, or their plain content where they are too few or too small."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        blank = _record("response", "http://", "", "1970-01-01T00:00:00Z", b"", payload_digest(b""), "", None, None)
        return b"".join([blank, *samples])[-DICTIONARY_BYTES:]


def _record(kind: str, url: str, page: str, date: str, payload: bytes, digest: str, name: str, refers: str | None, refers_url: str | None) -> bytes:
    """One WARC/1.1 record, the page's body as a resource of an HTTP response; a revisit has headers only.

    ``name`` makes the record's id, so it must be the record's alone.
    """
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if kind == "response":
        block = head + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    else:
        block = head + b"\r\n"
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", date), ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", page), ("X-Payload-Length", str(len(payload))),
    ]
    if refers is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To-Target-URI", _one_line(refers_url or "")), ("WARC-Refers-To-Date", date), ("X-Refers-To-Page", refers)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def _one_line(url: str) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url)


class ArchiveWriter:
    """Appends records to a stream: the dictionary frame first, then each record as a frame of its own."""

    def __init__(self, out, dictionary: bytes) -> None:
        self.out, self.size = out, 0
        data = zstandard.ZstdCompressionDict(dictionary)
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        self._put(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
        self.encode = zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_content_size=True, write_checksum=True).compress

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.encode(record))


def read_records(stream) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    start = stream.read(8)
    if len(start) < 8:
        return
    magic, size = struct.unpack("<II", start)
    if magic == DICTIONARY_FRAME:
        packed = stream.read(size)
        if packed[:4] == zstandard.FRAME_HEADER:
            packed = zstandard.ZstdDecompressor().decompress(packed)
        context, held = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(packed)), b""
    else:
        context, held = zstandard.ZstdDecompressor(), start
    frame, parts = context.decompressobj(), []
    while chunk := held or stream.read(1 << 18):
        parts.append(frame.decompress(chunk))
        held = b""
        if frame.eof:
            yield b"".join(parts)
            held, frame, parts = frame.unused_data, context.decompressobj(), []
    if parts:
        raise ValueError("the archive ends within a record")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload (behind the HTTP header) of a record."""
    stream = io.BytesIO(record)
    if stream.readline().rstrip() != b"WARC/1.1":
        raise ValueError("not a WARC record")
    fields = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode().partition(": ")
        fields[name] = value
    at = stream.tell()
    block = record[at : at + int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def assign(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to, refers_url`` of each row: the largest page_id with an equal payload, for rows that revisit it.

    Payloads are compared by SHA-1 and length, counted before they are dealt out. Who revisits is decided on ids and
    digests and joined back by both, so a payload of a third of all pages moves no page. Null html is an empty payload.
    A null page_id is never the largest: such rows revisit the group's largest, or are responses where the group has
    none. Rows that repeat the largest page_id are responses too.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html")})
    sizes = rows.select("page_id", "url", "digest", "bytes").where(F.col("bytes") >= min_revisit_bytes)
    groups = sizes.groupBy("digest", "bytes").agg(F.max("page_id").alias("largest"), F.max(F.struct("page_id", "url")).url.alias("largest_url"), F.count("*").alias("n")).where("n > 1 and largest is not null")
    groups = materialize(groups.drop("n"), "payloads")
    revisits = sizes.drop("url").join(groups, ["digest", "bytes"]).where(~F.col("page_id").eqNullSafe(F.col("largest"))).distinct()
    revisits = materialize(revisits.withColumnsRenamed({"page_id": "__id", "digest": "__digest", "bytes": "__bytes"}), "revisits")
    joined = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")) & (F.col("bytes") == F.col("__bytes")), "left")
    return joined.select("page_id", "url", "html", F.col("largest").alias("refers_to"), F.col("largest_url").alias("refers_url"))


def write_archives(pages: DataFrame, out_dir: str, date: str = "1970-01-01T00:00:00Z", **columns) -> DataFrame:
    """Write a record for each row of ``pages`` under ``out_dir`` (a URI that all executors see); returns ``path, records, bytes``.

    A task writes archives under a name of its attempt and returns their paths, so what a lost or repeated attempt
    leaves is never read: the returned table, kept in the shared folder, is the list of what was committed. A record
    is in memory at a time, and each has an id of its own, repeated rows too. Odd rows are treated as by ``assign``; an
    empty table gives no archive. The dictionary is built on the driver from the records of about SAMPLE_ROWS distinct
    pages picked by hash, of at most SAMPLE_BYTES each.
    """
    rows = assign(pages, **columns)
    html, url = (F.col(columns.get(f"{c}_col", c)) for c in ("html", "url"))
    small = pages.select(url.cast("string").alias("u"), F.coalesce(html, F.lit("")).alias("t")).where(F.octet_length("t") <= SAMPLE_BYTES)
    # copies of a page are one page to the sample: they are counted by their hash, and only those picked are made distinct
    pages_left = small.select(F.xxhash64("t", "u").alias("h")).distinct().count()
    sample = small.where(unit_hash("t", "u", seed="dictionary") < SAMPLE_ROWS / max(pages_left, 1)).distinct().limit(4 * SAMPLE_ROWS)
    payloads = sorted((r["t"].encode(), r["u"] or "") for r in sample.collect())
    samples = [_record("response", u, str(k), date, t, payload_digest(t), f"sample {k}", None, None) for k, (t, u) in enumerate(payloads)]
    sent = pages.sparkSession.sparkContext.broadcast(build_dictionary(samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(out_dir)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        stem = f"{root}/part-{task.partitionId():05d}-{uuid.uuid4().hex}"
        done: list[tuple[str, int, int]] = []
        out = writer = None
        count = 0

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((f"{stem}-{len(done)}.warc.zst", count, writer.size))
                out = None

        try:
            for batch in batches:
                for page, url, html, refers, refers_url in zip(*(batch.column(k) for k in range(5))):
                    if out is None:
                        out = files.open_output_stream(f"{stem}-{len(done)}.warc.zst", compression=None)
                        writer, count = ArchiveWriter(out, sent.value), 0
                    page, refers, payload = page.as_py(), refers.as_py(), html.as_py().encode()
                    kind = "response" if refers is None else "revisit"
                    name = f"{stem} {len(done)} {count}"
                    writer.add(_record(kind, url.as_py() or "", "" if page is None else str(page), date, payload, payload_digest(payload), name, None if refers is None else str(refers), refers_url.as_py()))
                    count += 1
                    if writer.size >= ARCHIVE_BYTES:
                        close()
            close()
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())], names=["path", "records", "bytes"])

    return materialize(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, out_dir: str) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload`` of each record of ``archives``.

    Response payloads are digested again and must agree with their headers; a revisit has no payload (null). An empty
    page_id field gives null, an empty payload an empty one; a record that is cut or damaged is an error. Records come as
    often as they were written. No archives give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _files(out_dir)
        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
        schema = pa.schema(kinds)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for record in read_records(stream):
                        fields, payload = parse_record(record)
                        kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                        if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
                            raise ValueError(f"damaged record in {path}")
                        refers = fields.get("X-Refers-To-Page")
                        rows.append({"page_id": int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None, "url": fields["WARC-Target-URI"], "record_type": kind, "refers_to": int(refers) if refers else None, "payload_bytes": size, "payload_digest": digest, "payload": payload if kind == "response" else None})
                        held += len(payload)
                        if held > 8 << 20 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    dealt = archives.select("path").repartition(max(1, archives.count()), "path")
    return dealt.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def archive_folder(pages: DataFrame) -> str:
    """A new folder for archives in the shared folder."""
    return new_path(pages.sparkSession, "warc")
