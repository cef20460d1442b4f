"""A Spark data source of text lines that know their place: ``spark.read.format("ordered_lines").load(path)``.

Files are read in splits, in any order and by any executor. ``seq`` of a line is the number of its file, in the order of
names, and the byte at which it starts, so it needs neither a pass to count lines nor a join, and a repeated read gives
the same numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

if TYPE_CHECKING:
    from pyarrow import fs

SCHEMA = "value string, seq long"
SPLIT_BYTES = 128 << 20
READ_BYTES = 4 << 20
# bits of ``seq`` for the place in a file: a terabyte, and eight million files
PLACE_BITS = 40
GZIP = 16 + zlib.MAX_WBITS


@dataclass
class Split(InputPartition):
    path: str
    number: int
    start: int
    end: int | None


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path (local, ``file:``, ``hdfs:``, ``s3:``, ``gs:``) and the path in it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class OrderedLinesReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, split_bytes

    def files(self) -> list[fs.FileInfo]:
        from pyarrow import fs

        store, path = file_system(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"No corpus at {self.path}: download the metadata snapshot (JSON lines) and pass its path.")
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
        inside = [f for f in found if f.type == fs.FileType.File and not _hidden(f.path[len(path.rstrip("/")) :])]
        return sorted(inside, key=lambda f: f.path)

    def partitions(self) -> list[Split]:
        """Splits in the order of files; a compressed file is one split."""
        splits = []
        for number, file in enumerate(self.files()):
            if file.path.endswith(".gz"):
                splits.append(Split(file.path, number, 0, None))
                continue
            splits += [Split(file.path, number, a, min(a + self.split_bytes, file.size)) for a in range(0, file.size, self.split_bytes)]
        return splits or [Split("", 0, 0, 0)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        """Lines that start in the split; the last one is read to its end, the first half line belongs to the split before."""
        if not split.path:
            return
        store, _ = file_system(self.path)
        with store.open_input_file(split.path) as file:
            blocks = _inflated(file) if split.end is None else _blocks(file, max(split.start - 1, 0))
            place, rest, skip = max(split.start - 1, 0), b"", split.start > 0
            for block in blocks:
                lines = (rest + block).split(b"\n")
                rest = lines.pop()
                yield from self._batch(lines, place, split, skip)
                place += sum(map(len, lines)) + len(lines)
                skip = skip and not lines
                if split.end is not None and place >= split.end:
                    return
            if rest:
                yield from self._batch([rest], place, split, skip)

    @staticmethod
    def _batch(lines: list[bytes], place: int, split: Split, skip: bool) -> Iterator[pa.RecordBatch]:
        texts, seq = [], []
        for i, line in enumerate(lines):
            start, place = place, place + len(line) + 1
            if (i == 0 and skip) or (split.end is not None and start >= split.end):
                continue
            if start == 0:
                line = line.removeprefix(b"\xef\xbb\xbf")
            # text that is not UTF-8 fails the job
            texts.append(line.removesuffix(b"\r").decode("utf-8"))
            seq.append((split.number << PLACE_BITS) + start)
        for a in range(0, len(texts), 10_000):
            yield pa.RecordBatch.from_pydict({"value": texts[a : a + 10_000], "seq": pa.array(seq[a : a + 10_000], pa.int64())})


def _hidden(path: str) -> bool:
    return any(part.startswith(("_", ".")) for part in path.strip("/").split("/"))


def _blocks(file, start: int) -> Iterator[bytes]:
    file.seek(start)
    while block := file.read(READ_BYTES):
        yield block


def _inflated(file) -> Iterator[bytes]:
    """Content of a gzip file of one or more members, in bounded pieces."""
    machine = zlib.decompressobj(GZIP)
    for block in _blocks(file, 0):
        while block:
            yield machine.decompress(block, READ_BYTES)
            block = machine.unconsumed_tail
            if machine.eof:
                block, machine = machine.unused_data, zlib.decompressobj(GZIP)
    yield machine.flush()


class OrderedLines(DataSource):
    """Options: ``path`` (a file or a folder, hidden files left out) and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "ordered_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> OrderedLinesReader:
        return OrderedLinesReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(OrderedLines)
