"""Data sources for recordings: one that reads headers by byte ranges, and one that writes files with a commit.

Both reach any store that Arrow's file systems know, and folders that all executors mount.
"""

from __future__ import annotations

import itertools
import posixpath
import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringEndsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from turnloom.schemas import AUDIO_SUFFIXES
from turnloom.sources.riff import Reader, frames_of

HEADERS = "path string, suffix string, length bigint, ok boolean, error string, sample_rate int, channels int, frames bigint, duration double"
FILES = "folder string, name string, content binary"
_COMPARE: dict[type, Callable] = {GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, StringEndsWith: lambda a, b: a.endswith(b)}


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if re.match(r"^\w[\w+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def header_row(system: fs.FileSystem, path: str, shown: str, length: int) -> tuple:
    """What a file's header says, read by ranges: its chunks' heads and its format, never its samples."""
    suffix = path.rpartition(".")[2].lower()
    try:
        with system.open_input_file(path) as file:

            def read(at: int, n: int) -> bytes:
                file.seek(at)
                return file.read(n)

            rate, channels, frames = frames_of(Reader(read, length))
        return shown, suffix, length, True, None, rate, channels, frames, frames / rate
    except Exception as e:  # the file fails, the others go on
        return shown, suffix, length, False, f"{type(e).__name__}: {e}", None, None, None, None


@dataclass
class Paths(InputPartition):
    """Some files of a scan, with their lengths."""

    files: list[tuple[str, int]]


class HeaderReader(DataSourceReader):
    """Lists files, leaves out those that pushed filters on path, suffix and length refuse, and reads the headers of the rest."""

    def __init__(self, options: dict):
        self.root, self.recursive = options["path"], options.get("recursive", "false").lower() == "true"
        self.each, self.asked = int(options.get("filesperpartition", "512")), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Take comparisons of what a listing knows; the rest stays with Spark."""
        for f in filters:
            if type(f) in _COMPARE and f.attribute in (("path",), ("suffix",), ("length",)):
                self.asked.append((f.attribute[0], type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Paths]:
        """Blocks of paths."""
        system, root = opened(self.root)
        files = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=self.recursive)):
            suffix = info.base_name.rpartition(".")[2].lower()
            known = {"path": info.path, "suffix": suffix, "length": info.size}
            if info.type == fs.FileType.File and suffix in AUDIO_SUFFIXES and all(_COMPARE[kind](known[name], value) for name, kind, value in self.asked):
                files.append((info.path, info.size))
        files.sort()
        return [Paths(list(block)) for block in itertools.batched(files, self.each)]

    def read(self, partition: Paths) -> Iterator[tuple]:
        """Rows of one block."""
        system, _ = opened(self.root)
        for path, length in partition.files:
            yield header_row(system, path, path, length)


class WavHeaders(DataSource):
    """``spark.read.format("wav_headers").load(folder)``: rate, channels, frames and seconds of recordings."""

    @classmethod
    def name(cls) -> str:
        """The format's name."""
        return "wav_headers"

    def schema(self) -> str:
        """Fixed columns."""
        return HEADERS

    def reader(self, schema: StructType) -> HeaderReader:
        """The reader of a scan."""
        return HeaderReader(self.options)


@dataclass
class Moves(WriterCommitMessage):
    """Files that a task has written, and where they belong."""

    pairs: list[tuple[str, str]]


class FileWriter(DataSourceArrowWriter):
    """Tasks write below a folder of this job; only the commit moves files to their places, and an abort takes the folder away.

    The driver makes that folder, and tasks only folders in it, so what still runs after an abort fails and leaves nothing.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.root, self.overwrite, self.job = options["path"].rstrip("/"), overwrite, f".job-{uuid.uuid4().hex}"
        system, root = opened(self.root)
        system.create_dir(f"{root}/{self.job}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Moves:
        """Write what one task has, into a folder of its own."""
        system, root = opened(self.root)
        own, pairs = f"{root}/{self.job}/{uuid.uuid4().hex}", []
        for batch in iterator:
            for folder, name, content in zip(*(batch.column(c).to_pylist() for c in ("folder", "name", "content")), strict=True):
                if content is None:
                    continue
                place = posixpath.normpath(posixpath.join(folder or "", name))
                if place.startswith(("..", "/")):
                    raise ValueError(f"{place} is outside the folder")
                if not pairs:
                    system.create_dir(own, recursive=False)
                with system.open_output_stream(f"{own}/{len(pairs)}") as out:
                    out.write(content)
                pairs.append((f"{own}/{len(pairs)}", f"{root}/{place}"))
        return Moves(pairs)

    def commit(self, messages: list[Moves | None]) -> None:
        """Move the files of the tasks that count; two files for one place are an error before anything is moved."""
        system, root = opened(self.root)
        pairs = [p for m in messages if m is not None for p in m.pairs]
        if len({to for _, to in pairs}) < len(pairs):
            self.abort(messages)
            raise ValueError("two rows have the same folder and name")
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if info.base_name != self.job:
                    (system.delete_dir if info.type == fs.FileType.Directory else system.delete_file)(info.path)
        for folder in sorted({posixpath.dirname(to) for _, to in pairs}):
            system.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda p: system.move(*p), pairs))
        self._clear(system, root)

    def abort(self, messages: list[Moves | None]) -> None:
        """Take away what tasks have written."""
        self._clear(*opened(self.root))

    def _clear(self, system: fs.FileSystem, root: str) -> None:
        for last in range(-9, 1):  # a task that is still writing may add a file meanwhile
            if system.get_file_info(f"{root}/{self.job}").type != fs.FileType.Directory:
                return
            try:
                system.delete_dir(f"{root}/{self.job}")
            except OSError:
                if last == 0:
                    raise


class WavFiles(DataSource):
    """``write.format("wav_files").option("path", root)``: rows (folder, name, content) as files."""

    @classmethod
    def name(cls) -> str:
        """The format's name."""
        return "wav_files"

    def writer(self, schema: StructType, overwrite: bool) -> FileWriter:
        """The writer of one job."""
        return FileWriter(self.options, overwrite)


def headers_under(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Headers of the recordings in a folder; filters on path, suffix and length are applied to the listing.

    Pushing filters to Python sources is a setting of the session, which this turns on.
    """
    spark.dataSource.register(WavHeaders)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("wav_headers").option("recursive", str(recursive).lower()).load(path)


def write_files(rows: DataFrame, root: str, folder: str | None = "call_id", name: str = "name", content: str = "content", mode: str = "append") -> None:
    """Write each row's content to ``root/folder/name``: all files appear when the job has succeeded, or none."""
    spark = rows.sparkSession
    spark.dataSource.register(WavFiles)
    place = rows[folder].cast("string") if folder else rows[name].substr(1, 0)
    rows.select(place.alias("folder"), rows[name].alias("name"), rows[content].alias("content")).write.format("wav_files").mode(mode).option("path", root).save()
