"""Data sources of their own: members of ZIP archives, and recorded pages of services as a table and as a stream.

    register(spark)
    spark.read.format("zip_members").options(path=folder, unreadable="fail").load()
    frame.write.format("zip_members").option("path", folder).mode("append").save()
    spark.readStream.format("recorded_pages").option("path", folder).option("batch_bytes", "1m").load()

Files are reached through pyarrow's file systems, so a folder can lie wherever these have access to. What a task writes has a
name of its own until the job commits, and goes if it is aborted.
"""

from __future__ import annotations

import bisect
import io
import itertools
import json
import posixpath
import re
import shutil
import tempfile
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import Row, StructType

#: Compressed bytes of the members that one task reads, of the pages of one micro-batch, and of one page at most.
PARTITION_BYTES, BATCH_BYTES, PAGE_BYTES = 32 << 20, 32 << 20, 16 << 20
#: How long folders have been left alone before a listing that may serve again.
QUIET_NS = 1_000_000_000
#: Bytes of the recorded pages that one task reads.
TASK_BYTES = 1 << 20
#: Bytes of text and rows of one batch that a reader of members hands on, about.
READ_BYTES, READ_ROWS = 4 << 20, 8192
#: An abort ends when it found nothing so many times, so many seconds apart.
ABORT_LOOKS, ABORT_WAIT_S = 5, 0.2
WAITING = "_waiting-"


def _size(text: str | None, default: int) -> int:
    if not text:
        return default
    number, unit = re.fullmatch(r"([0-9]+)([kmg]?)b?", text.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def _files(path: str, ending: str) -> list[fs.FileInfo]:
    store, folder = _store(path)
    if store.get_file_info(folder).type == fs.FileType.File:
        return [store.get_file_info(folder)]
    found = store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    hidden = lambda p: posixpath.basename(p)[:1] in ("_", ".")
    return sorted((f for f in found if f.type == fs.FileType.File and f.path.endswith(ending) and not hidden(f.path)), key=lambda f: f.path)


@dataclass
class Members(InputPartition):
    """Members of an archive by their places in its central directory, as a name can be there twice."""

    archive: str
    places: tuple[int, ...]

    def __post_init__(self):
        super().__init__(self.archive)


class _Test:
    """A pushed filter on one column; others stay with Spark."""

    def __init__(self, filters: list[Filter]):
        self.filters = filters

    def __call__(self, **values: str) -> bool:
        for test in self.filters:
            value = values[test.attribute[0]]
            if isinstance(test, EqualTo) and value != test.value or isinstance(test, In) and value not in test.value or isinstance(test, StringStartsWith) and not value.startswith(test.value):
                return False
        return True


class _ZipReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.columns = schema.names
        self.path, self.ending = options["path"], options.get("ending", "")
        self.most = _size(options.get("partition_bytes"), PARTITION_BYTES)
        if (unreadable := options.get("unreadable", "skip")) not in ("skip", "fail"):
            raise ValueError(f"unreadable is skip or fail, not {unreadable}")
        self.strict = unreadable == "fail"
        self.test = _Test([])

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes tests of archives and members: they prune archives before these are opened, and members before they are read."""
        taken = [f for f in filters if isinstance(f, (EqualTo, In, StringStartsWith)) and f.attribute in (("archive",), ("member",))]
        self.test = _Test(taken)
        return (f for f in filters if f not in taken)

    def partitions(self) -> list[InputPartition]:
        """Runs of members of some bytes each, by the central directories alone."""
        store, folder = _store(self.path)
        if self.strict and store.get_file_info(folder).type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no archives at {self.path}")
        by_archive = _Test([f for f in self.test.filters if f.attribute == ("archive",)])
        parts: list[InputPartition] = []
        for file in _files(self.path, ".zip"):
            if not by_archive(archive=file.path):
                continue
            places, size = [], 0
            with store.open_input_file(file.path) as source, zipfile.ZipFile(source) as archive:
                for place, member in enumerate(archive.infolist()):
                    if member.is_dir() or not member.filename.endswith(self.ending) or not self.test(archive=file.path, member=member.filename):
                        continue
                    if places and size + member.compress_size > self.most:
                        parts.append(Members(file.path, tuple(places)))
                        places, size = [], 0
                    places.append(place)
                    size += member.compress_size
            if places:
                parts.append(Members(file.path, tuple(places)))
        return parts or [Members("", ())]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        """Members as batches of some bytes of text each. One that can't be decompressed or decoded is left out, or an error by option `unreadable`."""
        if not partition.places:
            return
        store, _ = _store(self.path)
        rows: list[tuple] = []
        size = 0
        with store.open_input_file(partition.archive) as source, zipfile.ZipFile(source) as archive:
            members = archive.infolist()
            for member in (members[place] for place in partition.places):
                row = {"archive": partition.archive, "member": member.filename, "bytes": member.file_size}
                if "text" in self.columns:  # else no member is decompressed
                    try:
                        row["text"] = archive.read(member).decode()
                    except (UnicodeDecodeError, zipfile.BadZipFile, zlib.error) as error:
                        if self.strict:
                            raise ValueError(f"{member.filename} of {partition.archive} can't be read: {error}") from error
                        continue
                    size += row["bytes"]
                rows.append(tuple(row[c] for c in self.columns))
                if size >= READ_BYTES or len(rows) >= READ_ROWS:
                    yield self._batch(rows)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64() if c == "bytes" else pa.string() for c in self.columns]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=self.columns)


@dataclass
class Written(WriterCommitMessage):
    files: tuple[tuple[str, str], ...]


class _FolderWriter(DataSourceWriter):
    """Tasks write files of waiting names; the commit gives them their own."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex

    def _put(self, name: str, content: BinaryIO) -> tuple[str, str]:
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        waiting = posixpath.join(folder, f"{WAITING}{self.job}-{uuid.uuid4().hex}")
        with store.open_output_stream(waiting) as out:
            shutil.copyfileobj(content, out)
        return waiting, posixpath.join(folder, name)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)  # a table without rows is a folder without files
        if self.overwrite:
            for file in _files(self.path, ""):
                store.delete_file(file.path)
        for message in messages:
            for waiting, name in message.files if message else ():
                store.move(waiting, name)

    def abort(self, messages: list[Written | None]) -> None:
        """Tasks that still run may write after the others are stopped, so it looks again until there is nothing new."""
        store, folder = _store(self.path)
        quiet = 0
        while quiet < ABORT_LOOKS:
            mine = [f.path for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if posixpath.basename(f.path).startswith(f"{WAITING}{self.job}")]
            for path in mine:
                store.delete_file(path)
            quiet = 0 if mine else quiet + 1
            time.sleep(ABORT_WAIT_S)


class _ZipWriter(_FolderWriter):
    def write(self, iterator: Iterator[Row]) -> Written:
        """One archive per task, put together in an unnamed local file; equal rows give equal bytes."""
        first = next(iterator, None)
        if first is None:
            return Written(())
        with tempfile.TemporaryFile() as out:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                for row in itertools.chain((first,), iterator):
                    archive.writestr(zipfile.ZipInfo(row["member"]), row["text"] or "", zipfile.ZIP_DEFLATED)
            out.seek(0)
            return Written((self._put(f"part-{uuid.uuid4().hex}.zip", out),))


class ZipMembers(DataSource):
    """(archive, member, bytes, text) of the members of ZIP archives in a folder; rows of (member, text) written become archives.

    With the option unreadable="fail", a member that can't be read or a folder that isn't there is an error, not left out.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return "archive string, member string, bytes bigint, text string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ZipReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _ZipWriter(self.options, overwrite)


@dataclass
class Pages(InputPartition):
    """Pages that one task reads: number, path and bytes of each."""

    files: tuple[tuple[int, str, int], ...]

    def __post_init__(self):
        super().__init__(self.files[:1])


class _Pages:
    """The pages of a folder in the order of their numbers, which end their files' names."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.columns = schema.names
        self.path = options["path"]
        self.batch = _size(options.get("batch_bytes"), BATCH_BYTES)
        self.most = _size(options.get("page_bytes"), PAGE_BYTES)

    def pages(self) -> list[tuple[int, str, int]]:
        return sorted((int(m[1]), f.path, f.size) for f in _files(self.path, ".json") if (m := re.search(r"([0-9]+)\.json$", f.path)))

    def tasks(self, pages: list[tuple[int, str, int]]) -> list[InputPartition]:
        """Runs of pages of some bytes each, as a task costs more than a small page."""
        parts: list[InputPartition] = []
        run: list[tuple[int, str, int]] = []
        size = 0
        for page in pages:
            if run and size + page[2] > TASK_BYTES:
                parts.append(Pages(tuple(run)))
                run, size = [], 0
            run.append(page)
            size += page[2]
        return [*parts, Pages(tuple(run))]

    def read(self, partition: Pages) -> Iterator[tuple]:
        store, _ = _store(self.path)
        for number, path, _ in partition.files:
            size = store.get_file_info(path).size
            if size > self.most:
                raise ValueError(f"page {number} has {size} bytes, more than {self.most}")
            with store.open_input_stream(path) as source:
                row = {"page": number, "bytes": size, "body": source.read().decode()}
            yield tuple(row[c] for c in self.columns)


class _PageReader(_Pages, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.tasks(self.pages())


class _PageStream(_Pages, DataSourceStreamReader):
    """Offsets are numbers of pages; a batch ends with the page that fills its bytes.

    With the option catch_up, a batch takes at least that part of the bytes that wait (8: an eighth), so a stream that is far
    behind needs batches by the logarithm of what waits. Tasks have pages of some bytes each, whatever the batch.
    A listing serves while its folders' times of change stay as they are, where the store has such times and they were not
    just set as the listing began; so listings don't grow with the batches.
    """

    def __init__(self, schema: StructType, options: dict[str, str]):
        super().__init__(schema, options)
        self.part = int(options["catch_up"]) if "catch_up" in options else None
        self.planned: int | None = None
        self.listed: list[tuple[int, str, int]] = []
        self.upto: list[int] = [0]
        self.times: dict[str, int] | None = None

    def _list(self) -> None:
        """Lists the pages anew if they may have changed."""
        store, folder = _store(self.path)
        changed = lambda paths: {i.path: i.mtime_ns for i in store.get_file_info(paths)}
        if self.times is not None and changed([*self.times]) == self.times:
            return
        start = time.time_ns()
        self.listed = self.pages()
        self.upto = [*itertools.accumulate((size for _, _, size in self.listed), initial=0)]  # bytes before each page
        times = changed([*{folder, *(posixpath.dirname(path) for _, path, _ in self.listed)}])
        quiet = all(at is not None and at < start - QUIET_NS for at in times.values())
        self.times = times if quiet else None

    def initialOffset(self) -> dict:
        return {"page": -1}

    def _after(self, number: int) -> int:
        return bisect.bisect_right(self.listed, number, key=lambda page: page[0])

    def latestOffset(self) -> dict:
        after = -1 if self.planned is None else self.planned
        self._list()
        if (start := self._after(after)) < len(self.listed):
            before = self.upto[start]
            most = max(self.batch, (self.upto[-1] - before) // self.part if self.part else 0)
            end = bisect.bisect_left(self.upto, before + most, start + 1)  # the first page count that fills it
            after = self.listed[min(end, len(self.listed)) - 1][0]
        self.planned = after
        return {"page": after}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.planned = max(end["page"], self.planned if self.planned is not None else -1)
        self._list()
        return self.tasks(self.listed[self._after(start["page"]) : self._after(end["page"])])

    def commit(self, end: dict) -> None:
        """Recorded pages stay."""


class _PageWriter(_FolderWriter):
    def write(self, iterator: Iterator[Row]) -> Written:
        return Written(tuple(self._put(f"page-{row['page']}.json", io.BytesIO((row["body"] or "").encode())) for row in iterator))


class RecordedPages(DataSource):
    """(page, bytes, body) of the recorded answers of a service, one file `...<page>.json` each, as a table or as a stream."""

    @classmethod
    def name(cls) -> str:
        return "recorded_pages"

    def schema(self) -> str:
        return "page bigint, bytes bigint, body string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PageReader(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _PageStream(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _PageWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (ZipMembers, RecordedPages):
        spark.dataSource.register(source)


def body_of(rows: list[dict]) -> str:
    """A page's text, with its keys in order."""
    return json.dumps(rows, sort_keys=True, separators=(",", ":"))
