"""WARC archives whose records are Zstandard frames with a dictionary in front.

Each file begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, trained on the first records that the file's task writes (at most
TRAIN_BYTES), of an eighth of their size and DICTIONARY_BYTES at most. Where the
trainer finds nothing in common, or has under LEAST_SAMPLES records, the frame
is empty and the records are compressed without one. Every record, a WARC/1.1
header and block, is a frame of its own.

Of the pages with equal payloads the one with the smallest page_id is a response
and the others are revisit records, which carry the HTTP header with the
payload's length, its digest and the id of the response, but no payload. Only
digests and ids are shuffled, combined first; the digests of two and more pages
go to every task if their table has BROADCAST_BYTES at most, else the pages are
joined with them, dealt out to SALTS tasks where one payload is on many.

Record ids are unique: that of a page's first row with a payload is made of its
page_id and digest, those of others have a number of their own behind it. Only
a table with repeated rows is written to the shared folder for that, to number them.

Defined results: a null html is an empty payload; payloads of any size are
written whole; pages without a page_id are responses and never referred to, and
one that is the empty string is an id like any other;
repeated rows of the smallest page_id are responses each; a null url has no
target URI; an empty table makes no archive; extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import io
import itertools
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .arrow import pieces
from .files import new_file, open_file
from .shared import new_path, table_bytes, written

SKIPPABLE = 0x184D2A5D
DICTIONARY_BYTES, TRAIN_BYTES, LEAST_SAMPLES, LEVEL = 64 << 10, 4 << 20, 8, 3
BROADCAST_BYTES, SALTS = 16 << 20, 16
#: The records' date; a run gives the same archives again.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id, sha1: str = "", number: int | None = None) -> str:
    """page_id, then the payload's digest, then a number for all but the first row with both. A row without a page_id has another prefix, so that an empty one is told apart."""
    parts = ["" if page_id is None else quote(str(page_id), safe=""), sha1, "" if number is None else str(number)]
    return f"<urn:{'nopage' if page_id is None else 'page'}:{':'.join(parts).rstrip(':')}>"


def _page_id(record_id: str | None) -> str | None:
    return unquote(record_id[len("<urn:page:") : -1].split(":")[0]) if record_id and record_id.startswith("<urn:page:") else None


def record(page_id, url: str | None, payload: bytes, refers_to, number: int | None = None) -> bytes:
    """One record; refers_to: the response's page_id for a revisit, else None; number: what tells rows of equal page_id and payload apart."""
    sha1 = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, sha1, number)}", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {quote(url, safe=_URI)}"] if url else []
    head += [f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, sha1)}"] if refers_to is not None else []
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: What a target URI keeps as it is.
_URI = ":/?#[]@!$&'()*+,;=%~"


def write_archive(out, records: Iterator[bytes]) -> int:
    """Writes the dictionary frame and a frame per record; the number of records."""
    samples, held = [], 0
    for r in records:
        samples.append(r)
        held += len(r)
        if held >= TRAIN_BYTES:
            break
    try:
        dictionary = zstandard.train_dictionary(min(DICTIONARY_BYTES, held // 8), samples).as_bytes() if len(samples) >= LEAST_SAMPLES else b""
    except zstandard.ZstdError:  # too little, or nothing in common
        dictionary = b""
    out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if data:
        data.precompute_compress(level=LEVEL)
    zip_ = zstandard.ZstdCompressor(level=LEVEL, dict_data=data)
    n = 0
    for r in itertools.chain(samples, records):
        out.write(zip_.compress(r))
        n += 1
    return n


def read_archive(file) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(WARC header, HTTP header, payload) of each record; streams, and checks the digests of responses."""
    magic, size = struct.unpack("<II", file.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    dictionary = file.read(size)
    unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
    stream = io.BufferedReader(unzip.stream_reader(file, read_across_frames=True), 1 << 20)

    def header(lines) -> dict[str, str]:
        next(lines)
        return dict(x.split(": ", 1) for x in itertools.takewhile(bool, (x.decode().rstrip("\r\n") for x in lines)))

    while stream.peek(1):
        head = header(iter(stream.readline, b""))
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")
        top, _, payload = block.partition(b"\r\n\r\n")
        if head["WARC-Type"] == "response" and head["WARC-Payload-Digest"] != f"sha1:{digest(payload)}":
            raise ValueError(f"the payload of {head['WARC-Record-ID']} has another digest")
        yield head, header(iter([x + b"\r\n" for x in top.split(b"\r\n")])), payload


def write_archives(pages: DataFrame, folder: str | None = None) -> str:
    """Writes pages (page_id, url, html) as archives, one for each task; the folder's URI."""
    folder = folder or new_path(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.monotonically_increasing_id().alias("_row"))
    keyed = rows.withColumn("_key", F.unhex(F.sha1(F.col("html").cast("binary"))))
    narrow = written(keyed.select("_key", "page_id"), "warc-keys")
    firsts = narrow.groupBy("_key").agg(F.min("page_id").alias("_first"), F.count("*").alias("_many")).where("_many > 1").select("_key", "_first")
    firsts = written(firsts, "warc-digests", compact=True)
    repeats = lambda rows, *more: rows.where("page_id is not null").groupBy("_key", "page_id").agg(F.count("*").alias("_many"), *more).where("_many > 1")
    if repeats(narrow).isEmpty():
        number = F.when(F.col("page_id").isNull(), F.col("_row"))
    else:  # rows of equal page_id and payload: the first is the one that is referred to, so rows must keep their numbers
        keyed = written(keyed, "warc-rows")
        again = written(repeats(keyed, F.min("_row").alias("_one")).select(F.col("_key").alias("_key2"), F.col("page_id").alias("_page2"), "_one"), "warc-repeats", compact=True)
        same = (F.col("_key") == F.col("_key2")) & (F.col("page_id") == F.col("_page2"))
        keyed = keyed.join(F.broadcast(again) if table_bytes(again) <= BROADCAST_BYTES else again, same, "left")
        number = F.when(F.col("page_id").isNull() | (F.col("_row") != F.col("_one")), F.col("_row"))
    if table_bytes(firsts) <= BROADCAST_BYTES:
        joined = keyed.join(F.broadcast(firsts), "_key", "left")
    else:
        salted = firsts.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
        joined = keyed.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["_key", "_salt"], "left")
    joined = joined.select("page_id", "url", "html", F.when(F.col("page_id") != F.col("_first"), F.col("_first")).alias("_refers_to"), number.alias("_number"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part for batch in batches for part in pieces(batch, "html"))
        first = next(parts, None)
        if first is None:
            return
        with new_file(folder, f"{TaskContext.get().partitionId():06d}.warc.zst") as (out, uri):
            n = write_archive(out, (record(i, u, h.encode("utf-8", "surrogatepass"), r, n) for part in itertools.chain([first], parts) for i, u, h, r, n in zip(*(c.to_pylist() for c in part.columns), strict=True)))
        yield pa.RecordBatch.from_pydict({"uri": [uri], "records": pa.array([n], pa.int64())})

    joined.mapInArrow(write, "uri string, records bigint").write.parquet(f"{folder}/manifest")
    return folder


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record of the archives; ids as strings."""
    files = [(r.uri,) for r in spark.read.parquet(f"{folder}/manifest").orderBy("uri").collect()]  # a row for each archive

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with open_file(uri) as file:
                    found = ((_page_id(h["WARC-Record-ID"]), int(http["Content-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], _page_id(h.get("WARC-Refers-To"))) for h, http, _ in read_archive(file))
                    while rows := list(itertools.islice(found, 4096)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return spark.createDataFrame(files, "uri string").mapInArrow(read, "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes archives and returns what they hold, ids in the type of page_id."""
    kind = pages.schema["page_id"].dataType
    found = read_archives(pages.sparkSession, write_archives(pages))
    return found.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
