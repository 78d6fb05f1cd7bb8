"""Data sources with a commit: folders of files written by name, and archives read member by member.

paper_folder (writer): rows (path, content) become files below the option `path`. A task writes a file under a name of its own
and gives it its final one when it is whole; then it lists what it wrote. Only the commit makes a manifest, which names the lists
of the attempts that counted. Files that no manifest names belong to a run that failed: a later run writes them again.

archive_members (reader and stream reader): rows (path, member, content, error) of the .tar.gz files below the option `path`. Each
archive is a partition, opened by the task and read as a stream, so that an archive may be larger than any cell; a member is
a cell. What cannot be read of an archive is one row with its error. As a stream, each archive counts once: the offset holds the
latest modification time and the paths that share it.

Both open files with pyarrow, so paths must be ones it knows (local, hdfs, s3, gs), not those that only Spark's readers know.
"""

from __future__ import annotations

import dataclasses
import json
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

MANIFESTS = "_manifests"
#: Bytes of members that are handed on at a time.
BATCH_BYTES = 4 << 20


def opened(uri: str):
    """(pyarrow file system, path in it) of a URI or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


@dataclasses.dataclass
class _Listed(WriterCommitMessage):
    """The list of the files that one task wrote, and how many they are."""

    name: str
    files: int


class _FolderWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder, self.job = folder, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Listed:
        system, base = opened(self.folder)
        written = []
        for batch in iterator:
            for k in range(batch.num_rows):
                name, content = batch.column("path")[k].as_py(), batch.column("content")[k].as_py()
                if not name:
                    raise ValueError("a file without a path")
                target = f"{base}/{name}"
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                part = f"{target}.{uuid.uuid4().hex[:12]}.part"
                with system.open_output_stream(part) as out:
                    out.write(content or b"")
                system.move(part, target)
                written.append(name)
        listing = f"{self.job}-{uuid.uuid4().hex[:12]}.list"
        system.create_dir(f"{base}/{MANIFESTS}/lists", recursive=True)
        with system.open_output_stream(f"{base}/{MANIFESTS}/lists/{listing}") as out:
            out.write("".join(json.dumps({"path": name}) + "\n" for name in written).encode())
        return _Listed(listing, len(written))

    def commit(self, messages: list[_Listed | None]) -> None:
        system, base = opened(self.folder)
        system.create_dir(f"{base}/{MANIFESTS}", recursive=True)
        said = {"lists": sorted(m.name for m in messages if m), "files": sum(m.files for m in messages if m)}
        part = f"{base}/{MANIFESTS}/.{self.job}.part"
        with system.open_output_stream(part) as out:
            out.write(json.dumps(said).encode())
        system.move(part, f"{base}/{MANIFESTS}/{self.job}.json")

    def abort(self, messages: list[_Listed | None]) -> None:
        """Nothing is taken back: without a manifest no file counts."""


class PaperFolder(DataSource):
    """df.write.format("paper_folder").mode("append").save(folder) for rows of path and content."""

    @classmethod
    def name(cls) -> str:
        return "paper_folder"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("paper_folder appends; it never overwrites")
        return _FolderWriter(self.options["path"])


def committed(spark: SparkSession, folder: str) -> DataFrame:
    """path of the files that some manifest of the folder names; the lists are read by Spark, the manifests (one a run) by the driver."""
    from pyarrow import fs

    system, base = opened(folder)
    lists: list[str] = []
    for info in system.get_file_info(fs.FileSelector(f"{base}/{MANIFESTS}", allow_not_found=True)):
        if info.is_file and info.base_name.endswith(".json"):
            with system.open_input_file(info.path) as f:
                lists += json.loads(f.read())["lists"]
    if not lists:
        return spark.createDataFrame([], "path string")
    return spark.read.schema("path string").json([f"{folder.rstrip('/')}/{MANIFESTS}/lists/{x}" for x in lists])


def archives_below(folder: str) -> list[tuple[int, str]]:
    """(modification time in ns, URI) of each archive, in order."""
    from pyarrow import fs

    system, base = opened(folder)
    prefix = folder.split("://", 1)[0] + "://" if "://" in folder else "file://"
    found = [i for i in system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)) if i.is_file and i.base_name.endswith((".tar.gz", ".tgz", ".tar"))]
    return sorted((i.mtime_ns or 0, prefix + i.path) for i in found)


_MEMBERS = pa.schema([("path", pa.string()), ("member", pa.string()), ("content", pa.binary()), ("error", pa.string())])


def members(uri: str) -> Iterator[pa.RecordBatch]:
    """The files in one archive, read from front to back."""
    rows: list[tuple] = []
    held = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _MEMBERS.types, strict=True)], schema=_MEMBERS)

    try:
        system, path = opened(uri)
        with system.open_input_stream(path, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
            for m in tar:
                if m.isfile():
                    rows.append((uri, m.name, tar.extractfile(m).read(), None))
                    held += m.size
                    if held >= BATCH_BYTES:
                        yield batch()
                        rows, held = [], 0
    except (tarfile.TarError, EOFError, OSError, zlib.error) as e:
        rows.append((uri, None, None, str(e)[:300]))
    if rows:
        yield batch()


class _Archive(InputPartition):
    pass


class _ArchiveReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [_Archive(uri) for _, uri in archives_below(self.folder)] or [_Archive(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            yield from members(partition.value)


class _ArchiveStream(DataSourceStreamReader):
    """Offsets: the latest modification time, and the archives of just that time that count as read."""

    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"time": -1, "paths": "[]"}

    def latestOffset(self) -> dict:
        found = archives_below(self.folder)
        last = found[-1][0] if found else -1
        return {"time": last, "paths": json.dumps([uri for t, uri in found if t == last])}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, upto = set(json.loads(start["paths"])), set(json.loads(end["paths"]))
        new = [uri for t, uri in archives_below(self.folder) if (t > start["time"] or t == start["time"] and uri not in before) and (t < end["time"] or t == end["time"] and uri in upto)]
        return [_Archive(uri) for uri in new] or [_Archive(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            yield from members(partition.value)

    def commit(self, end: dict) -> None:
        pass


class ArchiveMembers(DataSource):
    """spark.read.format("archive_members").load(folder), and the same with readStream."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return "path string, member string, content binary, error string"

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _ArchiveStream(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PaperFolder)
    spark.dataSource.register(ArchiveMembers)
