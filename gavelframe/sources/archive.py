"""ZIP archives of pages or feeds as a data source for reading and writing: spark.read.format("archive").

An archive is read in parts: its table of contents tells where each entry stands, so that entries are dealt to partitions of about part_bytes and each task reads only the
ranges of its own. Conditions on archive and entry (=, IN, beginnings) leave out archives and entries before anything is read. Written, each task makes one archive,
under a name that the driver commits by a manifest; those of lost or failed tasks aren't in it and are removed.

Paths go through pyarrow's file systems (local and mounted folders, hdfs://, s3://, gs://), which driver and executors must both reach.

Options: path (a ZIP file, or a folder, of which the committed archives count, or all .zip files if none was written by Spark), part_bytes, content ("false" lists entries without
reading them). Schema: archive string, entry string, size long, content binary.

Defined cases: an empty folder gives no rows; folders inside archives are no entries; entries of equal names are each returned; an entry longer than part_bytes is a partition of its own; null entries or
contents are refused when writing; a damaged archive fails the query.
"""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import Row, StructType

SCHEMA = "archive string, entry string, size long, content binary"
PART_BYTES = 1 << 26
MANIFEST = "_ARCHIVES"
BATCH_ROWS = 256


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.LocalFileSystem(), path


def contents(path: str) -> list[tuple[int, str, int]]:
    """(number, name, size) of the entries of an archive, from its table of contents."""
    files, name = _open(path)
    with files.open_input_file(name) as f, zipfile.ZipFile(f) as archive:
        return [(k, i.filename, i.file_size) for k, i in enumerate(archive.infolist()) if not i.is_dir()]


@dataclass
class Part(InputPartition):
    """Entries of one archive, by number; all of them where numbers is None (the task then looks them up)."""

    archive: str
    numbers: list[int] | None


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.size, self.whole = options["path"], int(options.get("part_bytes", PART_BYTES)), options.get("content", "true").lower() != "false"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps conditions on archive and entry, which partitions() and read() apply in full; the rest is Spark's."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in ("archive", "entry") and isinstance(f, (EqualTo, In, StringStartsWith)):
                kind = {EqualTo: "equal", In: "in", StringStartsWith: "starts"}[type(f)]
                self.tests.append((column, kind, tuple(f.value) if isinstance(f, In) else f.value))
            else:
                yield f

    def passes(self, column: str, value: str) -> bool:
        fits = {"equal": lambda x: value == x, "in": lambda x: value in x, "starts": lambda x: value.startswith(x)}
        return all(fits[kind](x) for name, kind, x in self.tests if name == column)

    def archives(self) -> list[tuple[str, int]]:
        """(path, bytes) of the archives at the path."""
        files, name = _open(self.path)
        about = files.get_file_info(name)
        if about.type == fs.FileType.File:
            return [(self.path, about.size)]
        found = {i.base_name: i.size for i in files.get_file_info(fs.FileSelector(name)) if i.type == fs.FileType.File}
        if MANIFEST in found:
            with files.open_input_stream(f"{name}/{MANIFEST}") as f:
                names = f.read().decode().split()
        else:
            names = sorted(n for n in found if n.lower().endswith(".zip"))
        return [(f"{self.path.rstrip('/')}/{n}", found[n]) for n in names]

    def partitions(self) -> Sequence[InputPartition]:
        parts: list[InputPartition] = []
        for archive, size in self.archives():
            if not self.passes("archive", archive.rsplit("/", 1)[-1]):
                continue
            if size <= self.size:  # small ones are read whole by a task, which looks at the contents itself
                parts.append(Part(archive, None))
                continue
            numbers, held = [], 0
            for k, name, length in contents(archive):
                if not self.passes("entry", name):
                    continue
                if numbers and held + length > self.size:
                    parts.append(Part(archive, numbers))
                    numbers, held = [], 0
                numbers.append(k)
                held += length
            if numbers:
                parts.append(Part(archive, numbers))
        return parts

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archive at all
            return
        files, name = _open(partition.archive)
        own = partition.archive.rsplit("/", 1)[-1]
        with files.open_input_file(name) as f, zipfile.ZipFile(f) as archive:
            every = archive.infolist()
            chosen = [i for i in every if not i.is_dir() and self.passes("entry", i.filename)] if partition.numbers is None else [every[k] for k in partition.numbers]
            for s in range(0, len(chosen), BATCH_ROWS):
                some = chosen[s : s + BATCH_ROWS]
                data = [archive.read(i) for i in some] if self.whole else [None] * len(some)
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(some), pa.string()), pa.array([i.filename for i in some], pa.string()), pa.array([i.file_size for i in some], pa.int64()), pa.array(data, pa.binary())], ["archive", "entry", "size", "content"])


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class ArchiveWriter(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict[str, str], overwrite: bool) -> None:
        if not {"entry", "content"} <= set(schema.names):
            raise ValueError("columns entry and content are needed")
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite

    def write(self, iterator: Iterator[Row]) -> Written:
        files, folder = _open(self.path)
        name, out = f"part-{uuid.uuid4().hex}.zip", None
        try:
            for row in iterator:
                if row.entry is None or row.content is None:
                    raise ValueError("an entry and its content must not be null")
                if out is None:
                    files.create_dir(folder, recursive=True)
                    stream = files.open_output_stream(f"{folder}/{name}")
                    out = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
                data = row.content
                out.writestr(row.entry, data.encode() if isinstance(data, str) else bytes(data))
            if out is not None:
                out.close()
                stream.close()
            return Written(name if out is not None else None)
        except BaseException:
            if out is not None:
                stream.close()
                files.delete_file(f"{folder}/{name}")
            raise

    def _names(self, messages: list[WriterCommitMessage | None]) -> list[str]:
        return [m.name for m in messages if m is not None and m.name]

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = _open(self.path)
        files.create_dir(folder, recursive=True)
        names = self._names(messages)
        before = [i for i in files.get_file_info(fs.FileSelector(folder)) if i.type == fs.FileType.File]
        if not self.overwrite and any(i.base_name == MANIFEST for i in before):
            with files.open_input_stream(f"{folder}/{MANIFEST}") as f:
                names = f.read().decode().split() + names
        with files.open_output_stream(f"{folder}/{MANIFEST}.new") as f:
            f.write("\n".join(names).encode())
        files.move(f"{folder}/{MANIFEST}.new", f"{folder}/{MANIFEST}")
        for i in before:
            if i.base_name.startswith("part-") and i.base_name not in names:  # of what was replaced, and of tasks that were lost
                files.delete_file(i.path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, folder = _open(self.path)
        for name in self._names(messages):
            files.delete_file(f"{folder}/{name}")


class ArchiveDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with conditions handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArchiveDataSource)
