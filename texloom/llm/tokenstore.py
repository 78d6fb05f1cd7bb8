"""Token files: each document's ids compressed alone, with one shared Zstandard dictionary.

A store is a folder of files. Their layout (little-endian):

    "TLZ1", u8 bytes per id, u8 1 where names are text, 2 zero bytes, 32 bytes SHA-256 of the dictionary
    one Zstandard frame per document
    index, four arrays of a value for each document: u8 has a name, i64 doc_id (or u64 end of its UTF-8 name), u64 number of ids, u64 end of its frame;
        where names are text their bytes follow
    u64 documents, u64 offset of the index, "TLZ1"

So one document is read by one seek, whatever its length. The dictionary is
trained on the serialized ids of a bounded sample (SAMPLE_BYTES of each of
DICTIONARY_DOCS documents by a hash of their id), lies beside the files and is found by its hash.
Documents lie in ascending doc_id order over the files in manifest order.

Defined results: a null or empty text holds the end id only; rows without a
doc_id come first; rows of one doc_id are ordered by a hash of their text and
each keeps its own entry; long texts are encoded whole; an empty table makes a
store without files; extra columns are not looked at; a doc_id of any type
but a whole number is stored as text and read back in its type. If the sample is too
small for a dictionary, the hash is that of no bytes and frames use none.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType

from .arrow import pieces, texts_of
from .encoders import PIECE_BYTES, encoder
from .files import new_file, open_file
from .shared import new_path

MAGIC, HEAD, FOOT = b"TLZ1", 40, 20
DICTIONARY_DOCS, DICTIONARY_BYTES, LEVEL = 512, 64 << 10, 3
#: Serialized bytes of a document that the dictionary is trained on at most.
SAMPLE_BYTES = 64 << 10


def trained(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary, or no bytes where there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if sum(map(len, samples)) > 8 * size else b""
    except zstandard.ZstdError:
        return b""


class Writer:
    """Writes one file; add documents in order, then finish. named: doc_ids are strings."""

    def __init__(self, out, dictionary: bytes, dtype: np.dtype, named: bool = False):
        self.out, self.dtype, self.at, self.named = out, np.dtype(dtype), HEAD, named
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if data:
            data.precompute_compress(level=LEVEL)
        self.zip = zstandard.ZstdCompressor(level=LEVEL, dict_data=data) if data else zstandard.ZstdCompressor(level=LEVEL)
        self.ids: list[int | str | None] = []
        self.sizes: list[int] = []
        self.ends: list[int] = []
        out.write(MAGIC + bytes([self.dtype.itemsize, named, 0, 0]) + hashlib.sha256(dictionary).digest())

    def add(self, doc_id: int | str | None, ids: np.ndarray) -> None:
        frame = self.zip.compress(ids.astype(self.dtype, copy=False).tobytes())
        self.out.write(frame)
        self.at += len(frame)
        self.ids.append(doc_id)
        self.sizes.append(len(ids))
        self.ends.append(self.at)

    def finish(self) -> tuple[int, int]:
        """(documents, ids)."""
        names = [(x or "").encode() for x in self.ids] if self.named else []
        keys = np.cumsum(list(map(len, names)), dtype=np.int64) if self.named else [x or 0 for x in self.ids]
        for values, kind in (([x is not None for x in self.ids], "u1"), (keys, "<i8"), (self.sizes, "<u8"), (self.ends, "<u8")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(b"".join(names) + struct.pack("<QQ", len(self.ids), self.at) + MAGIC)
        return len(self.ids), sum(self.sizes)


class Reader:
    """Random and sequential access to one file."""

    def __init__(self, file, dictionary: bytes):
        self.file = file
        size = file.size()
        file.seek(size - FOOT)
        n, at = struct.unpack("<QQ", (foot := file.read(FOOT))[:16])
        file.seek(0)
        head = file.read(HEAD)
        if head[:4] != MAGIC or foot[16:] != MAGIC or head[8:] != hashlib.sha256(dictionary).digest():
            raise ValueError("not a token file, or its dictionary is another one")
        self.dtype = np.dtype(f"<u{head[4]}")
        file.seek(at)
        index = file.read(size - FOOT - at)
        here = np.frombuffer(index[:n], "u1").astype(bool)
        keys = np.frombuffer(index[n : 9 * n], "<i8").tolist()
        if head[5]:
            names = index[25 * n :]
            keys = [names[a:b].decode() for a, b in zip([0, *keys[:-1]], keys, strict=True)] if n else []
        self.ids = [x if ok else None for x, ok in zip(keys, here, strict=True)]
        self.sizes = np.frombuffer(index[9 * n : 17 * n], "<u8").astype(np.int64)
        self.ends = np.frombuffer(index[17 * n : 25 * n], "<u8").astype(np.int64)
        self.zip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.ids)

    def get(self, k: int) -> np.ndarray:
        """The ids of the file's k-th document; reads its frame alone."""
        start = int(self.ends[k - 1]) if k else HEAD
        self.file.seek(start)
        raw = self.zip.decompress(self.file.read(int(self.ends[k]) - start), max_output_size=int(self.sizes[k]) * self.dtype.itemsize)
        return np.frombuffer(raw, self.dtype)

    def __iter__(self) -> Iterator[tuple[int | str | None, np.ndarray]]:
        for k in range(len(self)):
            yield self.ids[k], self.get(k)


def tokenized_sample(docs: DataFrame, path: str, kind: str, end_id: int, rows: int = DICTIONARY_DOCS) -> list[bytes]:
    """Serialized ids of at most `rows` documents, SAMPLE_BYTES of each (the documented bound of the dictionary's training)."""
    chosen = docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, kind)
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                made = [np.append(x, np.array(end_id, x.dtype)).tobytes()[:SAMPLE_BYTES] for x in enc.encode_all(texts_of(part))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "ids"])

    some = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "text").limit(rows)
    return [bytes(r.ids) for r in some.mapInArrow(serialized, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary").orderBy("doc_id", "ids").collect()]


def write_store(docs: DataFrame, tokenizer: str, kind: str, end_id: int, folder: str | None = None) -> str:
    """Encodes every document and writes a store; the folder's URI. tokenizer: a file of the tokenizers library; kind: see encoders."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    dictionary = trained(tokenized_sample(docs, tokenizer, kind, end_id))
    with new_file(folder, "dictionary.zdict") as (out, dictionary_uri):
        out.write(dictionary)

    kind_of_id = docs.schema["doc_id"].dataType
    named = not isinstance(kind_of_id, IntegralType)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, writer = encoder(tokenizer, kind), TaskContext.get().partitionId(), None
        with_end = lambda x: np.append(x, np.array(end_id, x.dtype))
        batches = (part for batch in batches for part in pieces(batch, "text", PIECE_BYTES))
        first = next(batches, None)
        if first is None:
            return
        with new_file(folder, f"{shard:06d}.tlz") as (out, uri):
            writer = Writer(out, dictionary, enc.dtype, named)
            while first is not None:
                for doc_id, ids in zip(first.column("doc_id").to_pylist(), enc.encode_all(texts_of(first)), strict=True):
                    writer.add(doc_id, with_end(ids))
                first = next(batches, None)
            n, tokens = writer.finish()
        enc.rest()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "uri": [uri], "docs": [n], "tokens": [tokens]}, schema=pa.schema([("shard", pa.int32()), ("uri", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    tie = F.xxhash64("text").alias("_tie")
    ordered = docs.select("doc_id", "text", tie).repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select(F.col("doc_id").cast("string" if named else "long").alias("doc_id"), "text")
    manifest = ordered.mapInArrow(write, "shard int, uri string, docs bigint, tokens bigint")
    manifest.withColumn("dictionary", F.lit(dictionary_uri)).withColumn("id_type", F.lit(kind_of_id.simpleString())).write.parquet(f"{folder}/manifest")
    return folder


def read_store(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, start (ids before it), n_tokens and ids_crc32 of each document, read from the files of a store; id_type: that of a store without files."""
    # one row for each file; a document count never reaches the driver
    files = [r.asDict() for r in spark.read.parquet(f"{folder}/manifest").orderBy("shard").collect()]
    starts = np.cumsum([0, *(f["tokens"] for f in files)]).tolist()
    id_type = files[0]["id_type"] if files else id_type
    stored, arrow_type = ("bigint", pa.int64()) if id_type in ("tinyint", "smallint", "int", "bigint") else ("string", pa.string())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["dictionary"]) as f:
                    dictionary = f.read()
                with open_file(row["uri"]) as f:
                    reader = Reader(f, dictionary)
                    at = row["start"] + np.append(0, np.cumsum(reader.sizes))
                    crcs = []
                    for k in range(len(reader)):
                        crcs.append(zlib.crc32(reader.get(k).astype("<u4").tobytes()))
                    for k in range(0, len(reader), 1 << 14):
                        cut = slice(k, k + (1 << 14))
                        yield pa.RecordBatch.from_arrays([pa.array(reader.ids[cut], arrow_type), pa.array(at[:-1][cut], pa.int64()), pa.array(reader.sizes[cut], pa.int64()), pa.array(crcs[cut], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = [(f["uri"], f["dictionary"], s) for f, s in zip(files, starts, strict=False)]
    return spark.createDataFrame(rows, "uri string, dictionary string, start bigint").mapInArrow(read, f"doc_id {stored}, start bigint, n_tokens bigint, ids_crc32 bigint").withColumn("doc_id", F.col("doc_id").cast(id_type))


def round_trip(docs: DataFrame, tokenizer: str, kind: str, end_id: int) -> DataFrame:
    """Writes a store and returns what its files hold."""
    return read_store(docs.sparkSession, write_store(docs, tokenizer, kind, end_id), docs.schema["doc_id"].dataType.simpleString())
