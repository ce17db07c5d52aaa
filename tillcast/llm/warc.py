"""WARC archives (.warc.zst) with embedded Zstandard dictionaries.

A task writes archives of at most ARCHIVE_RECORDS records.  For each it
trains a dictionary from records of that archive, puts it into a leading
skippable frame, and compresses every record as a frame of its own.

Spark's text writer makes the files, so that they are committed task by
task on any file system that Spark reaches: a row is a frame, and the line
separator is an empty skippable frame, which Zstandard readers pass over.
An archive that is full by bytes before it is by records is filled up with
empty rows, for the writer starts a new file after a fixed number of rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import pick, ready, scratch

ARCHIVE_RECORDS = 1000
ARCHIVE_BYTES = 16 << 20     # of payload, after which an archive takes no more records
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20       # of records that a dictionary is trained from, at most
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"

# Magic numbers of the Zstandard format, and of dictionary
# frames in the .warc.zst format.
SKIPPABLE = 0x184D2A50
DICTIONARY = 0x184D2A5D
FRAME = 0xFD2FB528

EMPTY_FRAME = struct.pack("<II", SKIPPABLE, 0).decode("ascii")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, owner: int | None) -> bytes:
    """A response record; with an owner a revisit, which has the headers of
    the response (its length too) but not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if owner is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
    if owner is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {record_id(owner)}", f"X-Refers-To-Page-ID: {owner}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a record; the payload of a response is checked against its digest."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    block = block[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged payload in {fields['warc-record-id']}")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("x-page-id"), "record_id": fields["warc-record-id"], "url": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": number("x-refers-to-page-id"), "payload_bytes": size, "payload_digest": digest, "payload": payload if kind == "response" else None}


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained from records spread over the archive; too few or too small
    ones serve as raw content instead."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    sample = [r[:SAMPLE_BYTES // 8] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=200, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict((b"".join(sample)[:DICTIONARY_BYTES] + b"\0" * 8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes]) -> list[bytes]:
    """The frames of one archive."""
    shared = dictionary(records)
    shared.precompute_compress(level=LEVEL)
    packer = zstandard.ZstdCompressor(dict_data=shared, write_content_size=True, write_checksum=True)
    body = shared.as_bytes()
    return [struct.pack("<II", DICTIONARY, len(body)) + body, *map(packer.compress, records)]


def frames(data: bytes) -> Iterator[bytes]:
    """Records of an archive, in order."""
    shared, at = None, 0
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0]
        if magic & ~15 == SKIPPABLE:
            size = struct.unpack_from("<I", data, at + 4)[0]
            if magic == DICTIONARY:
                body = data[at + 8:at + 8 + size]
                kind = zstandard.DICT_TYPE_FULLDICT if body[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
                shared = zstandard.ZstdCompressionDict(body, dict_type=kind)
            at += 8 + size
            continue
        if magic != FRAME:
            raise ValueError(f"no frame at byte {at}")
        reader = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
        parts, step = [], 1 << 14
        while not reader.eof:
            if at >= len(data):
                raise ValueError("the archive ends within a frame")
            piece = data[at:at + step]
            parts.append(reader.decompress(piece))
            at += len(piece)
            step = min(step * 2, 1 << 20)
        at -= len(reader.unused_data)
        yield b"".join(parts)


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[bytes] = []
    held = 0

    def out(full: bool) -> pa.RecordBatch:
        rows = archive(waiting)
        rows += [b""] * (1 + ARCHIVE_RECORDS - len(rows) if full else 0)
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["frame"])

    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            page_id, url, payload, owner = (x.as_py() for x in row)
            waiting.append(record(page_id, url, payload or b"", owner))
            held += len(waiting[-1])
            if len(waiting) == ARCHIVE_RECORDS or held > ARCHIVE_BYTES:
                yield out(True)
                waiting, held = [], 0
    if waiting:
        yield out(False)


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> None:
    """A record per row, in .warc.zst files below ``folder``.

    Of rows with equal payloads of at least ``min_bytes`` bytes those with
    the smallest id are responses (repeated rows all are), the others
    revisits of it; rows with a null id count as largest, and if all have
    none, all are responses.  Null payload is empty, a null url is left
    out; an empty table writes no archive.
    """
    spark = pages.sparkSession
    ready(spark)
    rows = pick(pages, page_id=id_col, url=url_col, payload=payload_col).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.coalesce(F.col("payload").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("payload", 256)))
    first = (rows.filter(F.octet_length("payload") >= min_bytes).groupBy("sha")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    owner = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    told = rows.join(first, "sha", "left").select("page_id", "url", "payload", owner.alias("owner"))
    (told.mapInArrow(_archives, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1 + ARCHIVE_RECORDS).option("compression", "none").text(folder))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(conf)
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.endswith(".txt"):
            if status.getLen() == 0:
                files.delete(status.getPath(), False)
            else:
                files.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(path, name.removesuffix(".txt") + ".warc.zst"))


RECORD = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _reading(payload: bool):
    schema = RECORD if payload else RECORD.remove(len(RECORD) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for data in frames(content.as_py()):
                    rows.append(parse(data))
                    held += len(data)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read_warc(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of all .warc.zst files below ``folder``: page_id, record_id,
    url, record_type, refers_to, payload_bytes, payload_digest and payload
    (null for revisits)."""
    ready(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    kinds = "page_id long, record_id string, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    return files.mapInArrow(_reading(payload), kinds + (", payload binary" if payload else ""))


def archive_pages(pages: DataFrame, folder: str | None = None, payload: bool = False, **columns) -> DataFrame:
    """``pages`` written to archives (in the shared checkpoint folder if none is
    named) and read back."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    write_warc(pages, folder, **columns)
    return read_warc(spark, folder, payload)
