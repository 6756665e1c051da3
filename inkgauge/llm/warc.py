"""WARC archives with one Zstandard frame per record and the dictionary up front.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary; every record follows as a frame of its own. The reader loads the
dictionary, decodes frame by frame from a stream, and validates versions, header
fields, lengths, record ends and payload digests.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgauge.llm.frames import map_batches, sample_per_class, written
from inkgauge.session import scratch_path

DICT_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_OK = "HTTP/1.1 200 OK"
READ_BYTES = 1 << 18
ROLL_BYTES = 64 << 20  # an archive is closed beyond this size
SAMPLES = 256  # pages the dictionary is trained on, at most
SAMPLE_BYTES = 4096  # from each
DICT_BYTES = 64 << 10
URN = "<urn:x-page:{}>"


class ArchiveError(ValueError):
    """An archive that breaks the format."""


# -- records -------------------------------------------------------------------


def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record of the page ``refers_to``."""
    http = f"{HTTP_OK}\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    url = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "urn:x-page:unknown")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", URN.format("none" if page_id is None else page_id)),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is None:
        return record_bytes(fields, http + payload)
    return record_bytes([*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", URN.format(refers_to))], http)


def _fields(lines: list[str]) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ArchiveError(f"not a header field: {line[:80]!r}")
        found[name.strip().lower()] = value.strip()
    return found


def _number(fields: dict[str, str], name: str) -> int:
    value = fields.get(name, "")
    if not value.isdigit():
        raise ArchiveError(f"{name} is {value!r}")
    return int(value)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; raises ArchiveError on any fault."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not blank or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ArchiveError("a record has no version line or no end of headers")
    fields = _fields(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not fields.get(name):
            raise ArchiveError(f"{name} is missing")
    length = _number(fields, "content-length")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"{fields['warc-record-id']}: {len(rest) - 4} bytes, {length} announced")
    return fields, rest[:length]


def parse_page(data: bytes) -> tuple[int | None, int, str, str, int | None, bytes]:
    """(page_id, payload_bytes, digest, record type, refers_to, payload)."""
    fields, block = parse_record(data)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise ArchiveError(f"unexpected record of type {kind}")
    head, blank, payload = block.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        raise ArchiveError("a block is not an HTTP message")
    length = _number(_fields(head.decode("latin-1").split("\r\n")[1:]), "content-length")
    scheme, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if scheme != "sha1":
        raise ArchiveError("no SHA-1 payload digest")
    named = lambda value: None if (n := value.rpartition(":")[2].rstrip(">")) == "none" else int(n)
    refers_to = None
    if kind == "response":
        if length != len(payload) or hashlib.sha1(payload).hexdigest() != digest:
            raise ArchiveError(f"{fields['warc-record-id']}: the payload is not the announced one")
    else:
        refers_to = named(fields.get("warc-refers-to", ""))
    return named(fields["warc-record-id"]), length, digest, kind, refers_to, payload


# -- archives ------------------------------------------------------------------


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary) if dictionary else b""
    return DICT_MAGIC.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True)


def read_records(stream) -> Iterator[bytes]:
    """Decoded records of an open archive; memory for one record and one read."""
    data = stream.read(READ_BYTES)
    if len(data) < 8 or int.from_bytes(data[:4], "little") != DICT_MAGIC:
        raise ArchiveError("the archive does not begin with a dictionary frame")
    size, data = int.from_bytes(data[4:8], "little"), data[8:]
    while len(data) < size:
        more = stream.read(READ_BYTES)
        if not more:
            raise ArchiveError("the dictionary frame is cut off")
        data += more
    packed, data = data[:size], data[size:]
    if packed.startswith(ZSTD_MAGIC):
        packed = zstandard.ZstdDecompressor().decompress(packed)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(packed) if packed else None)
    while data or (data := stream.read(READ_BYTES)):
        frame, parts = decoder.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise ArchiveError(f"a frame cannot be decoded: {e}") from e
            if frame.eof:
                break
            data = stream.read(READ_BYTES)
            if not data:
                raise ArchiveError("the last frame is cut off")
        data = frame.unused_data
        yield b"".join(parts)


def _write(folder: str, dictionary: bytes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
            fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        compressor, done, out = _compressor(dictionary), [], None
        for pdf in batches:
            columns = (pdf["page_id"].astype(object), pdf["url"], pdf["html"], pdf["digest"], pdf["keep"].astype(object))
            for page_id, url, html, digest, keep in zip(*columns, strict=True):
                page_id, keep = (None if pd.isna(x) else int(x) for x in (page_id, keep))
                frame = compressor.compress(
                    page_record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), digest, keep)
                )
                if out is None:
                    # every attempt of a task has files of its own; the returned rows name those that count
                    name = f"{root}/{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.zst"
                    out, size, records = store.open_output_stream(name, compression=None), 0, 0
                    out.write(dictionary_frame(dictionary))
                out.write(frame)
                size, records = size + len(frame), records + 1
                if size >= ROLL_BYTES:
                    out.close()
                    done.append((name, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records))
        yield pd.DataFrame(done, columns=["path", "records"])

    return run


def _read(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local = not ("://" in folder or folder.startswith("file:"))
        store = fs.LocalFileSystem() if local else fs.FileSystem.from_uri(folder)[0]
        for pdf in batches:
            for path, announced in zip(pdf["path"], pdf["records"], strict=True):
                rows, seen = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for data in read_records(stream):
                        rows.append(parse_page(data)[:5])
                        seen += 1
                        if len(rows) >= 1000:
                            yield _frame(rows)
                            rows = []
                if seen != announced:
                    raise ArchiveError(f"{path}: {seen} records, {announced} were written")
                yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of pages; raw content where there are too few to train on."""
    found = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).where("length(html) > 0")
    picked = sample_per_class(found.withColumn("all", F.lit(0)), "all", F.xxhash64("page_id"), SAMPLES)
    picked = picked.select("_order", F.substring("html", 1, SAMPLE_BYTES).alias("html")).dropDuplicates(["_order"])
    texts = [r.html.encode("utf-8", "surrogatepass") for r in sorted(picked.collect())]
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        raw = b"".join(texts)[-DICT_BYTES:]
        return raw if len(raw) >= 8 else b""


def write_warc(pages: DataFrame, folder: str, least_revisit: int = 1000) -> DataFrame:
    """Write (page_id, url, html) rows as archives; returns (path, records) of each archive.

    The payload is the html in UTF-8 (null: empty). Of pages with equal payloads of
    at least ``least_revisit`` bytes the one of the largest page_id is the response
    and the others revisit it; all rows of that id are responses, as are payloads
    that only null ids have. Null urls get a placeholder. Other columns are ignored;
    an empty table writes no archive.

    Only digests are grouped, so a payload may be shared by most pages. The pages
    move once, to meet their decision.
    """
    pages = pages.select(
        F.col("page_id").cast("bigint"), "url", "html",
        F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"),
    )
    long = F.octet_length("html") >= least_revisit
    groups = pages.where(long).groupBy("digest").agg(F.max("page_id").alias("keep"), F.min("page_id").alias("least"))
    ids = pages.where(long).select("page_id", "digest")
    again = ids.join(groups.where("least < keep"), "digest").where("page_id < keep").select("page_id", "digest", "keep")
    orphan = ids.where("page_id IS NULL").join(groups.where("keep IS NOT NULL"), "digest").select(
        "page_id", "digest", "keep"
    )
    again = again.unionByName(orphan).distinct().withColumnsRenamed({"page_id": "_id", "digest": "_digest"})
    rows = pages.join(again, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    rows = rows.select("page_id", "url", "html", "digest", "keep")
    return map_batches(rows, _write(folder, train_dictionary(pages)), "path string, records bigint")


def read_warc(spark: SparkSession, archives: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record.

    An archive is the unit of work; memory is that of one record. Any fault of the
    format fails the job with ArchiveError.
    """
    schema = (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    )
    return map_batches(archives.repartition("path"), _read(folder), schema)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to the shared folder and read the archives back."""
    folder = scratch_path(spark, "warc")
    archives = written(write_warc(pages, folder), "archives")
    return read_warc(spark, archives, folder)
