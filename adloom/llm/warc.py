"""WARC archives in Zstandard, one frame per record, dictionary in a leading skippable frame.

``write_archives`` gives every distinct payload of a useful size one response
record and every further copy a revisit record; ``read_archives`` streams the
files back, decodes frame by frame, and checks every record's headers and
lengths. Files lie wherever Arrow's file systems reach (file, hdfs, s3, gs).

Defined results: a null payload is an empty one. A null id is written without
an id header and read back as null. Rows that share the smallest id of their
payload (repeated rows) are all responses. Columns beyond id, url and payload
are not archived, whatever their names. An empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from adloom.llm.sampling import smallest
from adloom.llm.workspace import Workspace

#: Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

#: Tasks that read archives at once; with more archives a task reads several.
READERS = 20_000

RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, error string"
)


# --- one record ----------------------------------------------------------------


def build_record(page_id, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """The bytes of one record. A revisit carries the digest and length of the payload, not the payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", " ".join(url.split())))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    return head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; ``error`` says what is wrong with it, else it is None."""
    out = dict.fromkeys(["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "error"])
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        return out | {"error": "no WARC header"}
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            return out | {"error": "bad header line"}
        fields[name.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - fields.keys()
    if missing:
        return out | {"error": f"missing header {min(missing)}"}
    length = fields["content-length"]
    if not length.isdigit() or int(length) + 4 != len(rest) or not rest.endswith(b"\r\n\r\n"):
        return out | {"error": "block length differs from Content-Length"}
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    number = lambda key: int(fields[key]) if key in fields else None
    try:
        page_id, refers_to, size = number("x-page-id"), number("x-refers-to-page-id"), number("x-payload-length")
    except ValueError:
        return out | {"error": "a number is not one"}
    out |= {"page_id": page_id, "url": fields.get("warc-target-uri"), "record_type": kind, "payload_digest": digest}
    out |= {"payload_bytes": size, "refers_to": refers_to}
    if not gap or not http.startswith(b"HTTP/"):
        return out | {"error": "no HTTP header"}
    if kind == "revisit":
        return out if refers_to is not None and not payload else out | {"error": "bad revisit"}
    if kind != "response" or size != len(payload) or hashlib.sha256(payload).hexdigest() != digest:
        return out | {"error": "payload differs from its digest or length"}
    return out | {"payload": payload}


# --- one archive ----------------------------------------------------------------


def archive_head(dictionary: bytes | None) -> bytes:
    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def read_frames(stream, piece: int = 1 << 20) -> Iterator[bytes]:
    """The decoded frames of an archive, one at a time; the file is never held whole."""
    held = stream.read(8)
    dictionary = None
    if len(held) == 8:
        magic, size = struct.unpack("<II", held)
        if magic == DICTIONARY_FRAME:
            body = stream.read(size)
            if len(body) != size:
                raise ValueError("the dictionary frame is cut off")
            if body[:4] == struct.pack("<I", ZSTD_FRAME):
                body = zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 24)
            dictionary = zstandard.ZstdCompressionDict(body)
            held = b""
    maker = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while True:
        if not held:
            held = stream.read(piece)
            if not held:
                return
        frame, parts = maker.decompressobj(), []
        while True:
            parts.append(frame.decompress(held))
            if frame.eof:
                held = frame.unused_data
                break
            held = stream.read(piece)
            if not held:
                raise ValueError("the last frame is cut off")
        yield b"".join(parts)


def _open_folder(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- Spark ----------------------------------------------------------------------


def train_dictionary(
    pages: DataFrame, page_id: str, url: str, payload: str, samples: int = 200, sample_bytes: int = 8192, size: int = 32768
) -> bytes | None:
    """A dictionary from at most ``samples`` payloads, at most ``sample_bytes`` of each; None if there are none.

    It changes the size of the archives only.
    """
    some = smallest(pages.where(F.length(payload) > 0), F.xxhash64(page_id, url), samples)
    texts = [r.t.encode() for r in some.select(F.substring(F.col(payload), 1, sample_bytes).alias("t")).collect()]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:  # too few samples to train from: their own bytes serve as the dictionary
        return b"".join(t[: size // max(1, len(texts))] for t in texts) or None


def with_record_types(pages: DataFrame, page_id: str, url: str, payload: str, least: int) -> DataFrame:
    """Columns page_id, url, payload, digest, refers_to (null: response)."""
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    base = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        text.alias("payload"),
        F.sha2(text, 256).alias("digest"),
    )
    first = (
        base.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    typed = base.join(first, "digest", "left")
    copy = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return typed.select("page_id", "url", "payload", "digest", F.when(copy, F.col("first")).alias("refers_to"))


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 100,
    level: int = 6,
    archive_bytes: int = 64 << 20,
) -> DataFrame:
    """Write the pages as archives below ``folder``; returns one row (path, records, bytes) per archive.

    A task that is run again writes new files, and only the files named in the
    rows of its successful run count.
    """
    head = archive_head(dictionary := train_dictionary(pages, page_id, url, payload))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        maker = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True)
        store, base = _open_folder(folder)
        store.create_dir(base, recursive=True)
        out, path, records, size = None, "", 0, 0

        def done():
            out.close()
            return pd.DataFrame({"path": [path], "records": [records], "bytes": [size]})

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    path, records, size = f"{folder}/{name}", 0, len(head)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)  # the name would make Arrow compress again
                    out.write(head)
                record = build_record(row["page_id"], row["url"], row["payload"].encode(), row["digest"], row["refers_to"])
                frame = maker.compress(record)
                out.write(frame)
                records, size = records + 1, size + len(frame)
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    def write_arrow(batches):
        for frame in write(batches):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    typed = with_record_types(pages, page_id, url, payload, least)
    return typed.mapInArrow(write_arrow, "path string, records long, bytes long")


def read_archives(spark: SparkSession, archives: DataFrame, payloads: bool = True, batch_bytes: int = 16 << 20) -> DataFrame:
    """The records of the archives named in column ``path``, each archive in a task of its own up to ``READERS`` tasks.

    Columns as in RECORD_SCHEMA; a record that fails a check has ``error`` set.
    ``payloads=False`` leaves the payload column null after checking it.
    """
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                folder, _, name = path.rpartition("/")
                store, base = _open_folder(folder)
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for raw in read_frames(stream):
                        record = parse_record(raw)
                        if not payloads:
                            record["payload"] = None
                        held += len(record["payload"] or b"") + 200
                        rows.append(record)
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    paths = archives.select("path")
    return paths.repartition(max(1, min(paths.count(), READERS))).mapInArrow(read, RECORD_SCHEMA)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and return what reading them back gives."""
    spark = pages.sparkSession
    space = Workspace(spark, "warc")
    written = space.stage(write_archives(pages, f"{space.folder}/archives"), "manifest")
    back = read_archives(spark, written, payloads=False)
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("bad record: "), "error")).cast("long"))
    return back.select(
        F.coalesce(checked, F.col("page_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
