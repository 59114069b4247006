"""A Python data source over a channel's history, for batch backfill and for streams that follow its growth.

A history is one or more files of JSON lines that are only appended to. It is read by byte ranges, so that executors read side
by side whatever the ids are; a line belongs to the range that it begins in. Streams keep byte offsets, so that a micro-batch
reads what is new and nothing else. Files are reached through pyarrow's file systems (local, hdfs://, s3://, ...), so executors
need no local copy.

Options
    path ............... a file or a folder
    min_id, max_id ..... ids beyond the first, up to the second; no bound where missing
    offset_id .......... ids below this one (history from the newest to the oldest)
    limit, order ....... ``newest`` or ``oldest``: that many messages from that end, in order; read by one task each file
    max_bytes .......... bytes of a partition (64 MiB)

Defined results
    lines that aren't JSON objects with an id .... left out
    an open last line ............................. left to the next micro-batch; read by a batch
    missing fields ................................ ''
    no file ....................................... no rows
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "source_key string, message_id bigint, text string, posted_at string"


def _files(path: str) -> tuple[object, list[tuple[str, int]]]:
    """(file system, [(path, bytes)]) in order of name."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    info = system.get_file_info(inner)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
    return system, sorted((f.path, f.size) for f in found if f.type == fs.FileType.File)


def _lines(path: str, file: str, low: int, high: int) -> Iterator[tuple]:
    """Messages of the lines that begin in [low, high) of a file."""
    system, _ = _files(path)
    with system.open_input_file(file) as f:
        at = max(low - 1, 0)
        f.seek(at)
        rest, first = b"", low > 0
        while at < high or rest or first:
            block = f.read(1 << 20)
            lines = (rest + block).split(b"\n")
            begin = at - len(rest)
            rest = lines.pop() if block else b""
            for line in lines:
                if first:
                    first = False
                elif begin >= high:
                    return
                elif (row := _row(line)) is not None:
                    yield row
                begin += len(line) + 1
            at += len(block)
            if not block or begin >= high:
                return


def _row(line: bytes) -> tuple | None:
    try:
        m = json.loads(line)
        return m.get("source_key", ""), int(m["message_id"]), m.get("text", ""), m.get("posted_at", "")
    except (ValueError, KeyError, TypeError, AttributeError):
        return None


class ByteRange(InputPartition):
    def __init__(self, file: str, low: int, high: int):
        self.file, self.low, self.high = file, low, high


def _ranges(begin: dict[str, int], end: dict[str, int], size: int) -> list[ByteRange]:
    return [ByteRange(f, a, min(a + size, high)) for f, high in sorted(end.items()) for a in range(begin.get(f, 0), high, size)]


class _Wanted:
    """The ids that the options ask for."""

    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("max_bytes", 64 << 20))
        number = lambda name: int(options[name]) if options.get(name) is not None else None
        self.low, self.high, self.below, self.limit = number("min_id"), number("max_id"), number("offset_id"), number("limit")
        self.newest = options.get("order", "newest") == "newest"

    def __call__(self, row: tuple) -> bool:
        i = row[1]
        return (self.low is None or i > self.low) and (self.high is None or i <= self.high) and (self.below is None or i < self.below)


class HistoryReader(DataSourceReader):
    """Reads a history in partitions of byte ranges; with a limit, each file by one task that keeps no more rows than that."""

    def __init__(self, options: dict):
        self.wanted = _Wanted(options)

    def partitions(self) -> list[InputPartition]:
        _, files = _files(self.wanted.path)
        size = self.wanted.size if self.wanted.limit is None else 1 << 62
        return _ranges({}, dict(files), size) or [ByteRange("", 0, 0)]

    def read(self, part: ByteRange) -> Iterator[tuple]:
        w = self.wanted
        rows = (r for r in _lines(w.path, part.file, part.low, part.high) if w(r)) if part.file else iter(())
        if w.limit is None:
            return rows
        return iter((heapq.nlargest if w.newest else heapq.nsmallest)(w.limit, rows, key=lambda r: r[1]))


class TailReader(DataSourceStreamReader):
    """Follows a history: the offset is the number of bytes read of each file."""

    def __init__(self, options: dict):
        self.wanted = _Wanted(options)
        self.seen: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self, *_: object) -> dict:
        system, files = _files(self.wanted.path)
        ends = dict(self.seen)
        for file, size in files:
            done = ends.get(file, 0)
            if size > done:
                with system.open_input_file(file) as f:  # up to the last whole line; the range is cut into partitions
                    ends[file] = done + self._whole(f, done, size - done)
        self.seen = ends
        return ends

    @staticmethod
    def _whole(f: object, done: int, take: int) -> int:
        """Bytes up to the last line end of the range, looked for from its end."""
        high = take
        while high > 0:
            low = max(0, high - (1 << 16))
            f.seek(done + low)
            if (k := f.read(high - low).rfind(b"\n")) >= 0:
                return low + k + 1
            high = low
        return 0

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.seen = dict(end)
        return _ranges(start, end, self.wanted.size)

    def read(self, part: ByteRange) -> Iterator[tuple]:
        return (r for r in _lines(self.wanted.path, part.file, part.low, part.high) if self.wanted(r))


class ChannelHistory(DataSource):
    """``spark.read.format('channel_history')`` and ``spark.readStream`` with the options above."""

    @classmethod
    def name(cls) -> str:
        return "channel_history"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return HistoryReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: ANN001
        return TailReader(self.options)
