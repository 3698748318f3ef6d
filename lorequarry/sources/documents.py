"""A Spark data source of documents: `spark.read.format("lore_documents").load(path)`.

Rows are (path, folder, name, offset, text). Files are listed once; filters on folder and name
reach the listing, so files that cannot match are never opened. With the option `record` a row is a
whole `file`, a `line`, or a Markdown `section`; line files are split over tasks by byte ranges,
and no file of lines or sections is held whole. Text that is not UTF-8 stops the query, or, with
`mode` permissive, gives a row without text.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

SCHEMA = "path string, folder string, name string, offset long, text string"
RECORDS = ("file", "line", "section")
#: Bytes of a line file that one task reads, and of a buffer.
SPLIT_BYTES, BUFFER = 64 << 20, 1 << 20
#: Rows and bytes of text of a batch that is handed to Spark.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
_HEADING = re.compile(rb"#{1,6} ")


def register(spark: SparkSession) -> None:
    """Make the source known to a session and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Documents)


class Documents(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lore_documents"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Part(InputPartition):
    def __init__(self, path: str, start: int, end: int | None):
        self.path, self.start, self.end = path, start, end


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if urlparse(path).scheme:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _names(path: str) -> tuple[str, str]:
    folder, _, name = path.rpartition("/")
    return folder.rpartition("/")[2], name


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.pattern = options["path"], options.get("pattern", "*")
        self.record, self.mode = options.get("record", "file"), options.get("mode", "failfast").lower()
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))
        if self.record not in RECORDS or self.mode not in ("failfast", "permissive"):
            raise ValueError(f"record is one of {RECORDS}, mode failfast or permissive")
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on folder and name are kept for the listing; Spark still has to see to all others."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            kind = {EqualTo: "is", In: "in", StringStartsWith: "starts", StringEndsWith: "ends"}.get(type(f))
            if column in ("folder", "name") and kind:
                self.wanted.append((column, kind, tuple(f.value) if kind == "in" else f.value))
            else:
                yield f

    def _fits(self, path: str) -> bool:
        folder, name = _names(path)
        tests = {"is": str.__eq__, "in": lambda x, values: x in values, "starts": str.startswith, "ends": str.endswith}
        return fnmatch.fnmatchcase(name, self.pattern) and all(tests[kind](folder if column == "folder" else name, value) for column, kind, value in self.wanted)

    def partitions(self) -> list[InputPartition]:
        """A part for each file that fits, or for each byte range of a line file."""
        system, root = _opened(self.root)
        found = system.get_file_info(root)
        files = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
        parts: list[InputPartition] = []
        for f in sorted((f for f in files if f.type == fs.FileType.File and self._fits(f.path)), key=lambda f: f.path):
            if self.record == "line" and f.size > self.split:
                parts += [_Part(f.path, at, at + self.split) for at in range(0, f.size, self.split)]
            else:
                parts.append(_Part(f.path, 0, None))
        return parts or [_Part("", 0, 0)]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        system, _ = _opened(self.root)
        folder, name = _names(part.path)
        rows: list[tuple] = []
        held = 0
        with system.open_input_file(part.path) as file:
            pieces = {"file": self._whole, "line": self._lines, "section": self._sections}[self.record](file, part)
            for at, raw in pieces:
                rows.append((part.path, folder, name, at, self._text(raw, part.path, at)))
                held += len(raw)
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _text(self, raw: bytes, path: str, at: int) -> str | None:
        try:
            return raw.decode()
        except UnicodeDecodeError as why:
            if self.mode == "permissive":
                return None
            raise ValueError(f"{path} is not UTF-8 at {at + why.start}") from why

    def _whole(self, file: pa.NativeFile, part: _Part) -> Iterator[tuple[int, bytes]]:
        yield 0, file.read()

    def _lines(self, file: pa.NativeFile, part: _Part) -> Iterator[tuple[int, bytes]]:
        """Lines that begin in the part: the first one does not, unless a line ends just before it."""
        begin = max(part.start - 1, 0)
        file.seek(begin)
        at, rest, skip = begin, b"", part.start > 0
        while part.end is None or at < part.end:
            block = file.read(BUFFER)
            lines = (rest + block).split(b"\n")
            rest = lines.pop()
            for line in lines:
                if part.end is not None and at >= part.end:
                    return
                if not skip:
                    yield at, line.removesuffix(b"\r")
                at, skip = at + len(line) + 1, False
            if not block:
                if rest and not skip:
                    yield at, rest.removesuffix(b"\r")
                return

    def _sections(self, file: pa.NativeFile, part: _Part) -> Iterator[tuple[int, bytes]]:
        """Runs of lines from one Markdown heading to the next."""
        begin, held = 0, []
        for at, line in self._lines(file, part):
            if _HEADING.match(line) and held:
                yield begin, b"\n".join(held)
                held = []
            begin = at if not held else begin
            held.append(line)
        if held:
            yield begin, b"\n".join(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "folder", "name", "offset", "text"])
