"""Landed event documents as a data source: spark.read and spark.readStream.format("event_records") (EXT1, SRC1, SRC12).

A document is a JSON array of events or an envelope {"events": [...]}. Each event is a row; a text that is neither, or no JSON, is
a row whose text is in ``bad``. Documents are lines, or whole files where wholeFile is true. Tasks read byte ranges of
large files of lines and groups of small files; ranges follow from sizes alone, so a task that is lost reads the same again.
"""

from __future__ import annotations

import io
import json
import posixpath
import uuid
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file string, position int, event string, bad string"
SPLIT_BYTES = 128 << 20
#: A file's cost beside its bytes, so that a task is not given too many empty ones.
FILE_COST = 1 << 20

Span = tuple[str, int, int]


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def _dumped(value: object) -> str:
    """JSON text; half of a surrogate pair, which UTF-8 lacks, stays an escape."""
    out = json.dumps(value, ensure_ascii=False)
    return out if out.isascii() or not any("\ud800" <= ch <= "\udfff" for ch in out) else json.dumps(value)


def events_of(text: str) -> list[str] | None:
    """The events of a document as JSON texts; None for a text that is no such document."""
    try:
        doc = json.loads(text, parse_constant=_no_constant)
        if isinstance(doc, dict):
            doc = doc.get("events")
        return [_dumped(e) for e in doc] if isinstance(doc, list) else None
    except (ValueError, RecursionError):
        return None


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def files_of(path: str) -> list[tuple[str, int]]:
    """(file, bytes) below a folder, or of one file, by name; names that start with _ or . are left out at every depth."""
    store, root = _store(path)
    info = store.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(info.path, info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    below = store.get_file_info(pafs.FileSelector(root, recursive=True))
    shown = lambda p: not any(part[:1] in ("_", ".") for part in p[len(root) :].strip("/").split("/"))
    return sorted((f.path, f.size) for f in below if f.type == pafs.FileType.File and shown(f.path))


class Options:
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options.get("path")
        if not self.path:
            raise ValueError("event_records needs a path")
        self.whole = options.get("wholeFile", "false").lower() == "true"
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        if self.split < 1:
            raise ValueError("splitBytes must be at least 1")

    def spans(self, files: list[tuple[str, int]]) -> list[list[Span]]:
        """Byte ranges for tasks: large files of lines are cut, small ones share a task."""
        tasks, group, held = [], [], 0
        for name, size in files:
            step = max(size, 1) if self.whole or name.endswith(".gz") else self.split
            for start in range(0, size, step):
                end = min(start + step, size)
                if group and held + end - start + FILE_COST > self.split:
                    tasks.append(group)
                    group, held = [], 0
                group.append((name, start, end))
                held += end - start + FILE_COST
        return [*tasks, group] if group else tasks


def _documents(store: pafs.FileSystem, span: Span, whole: bool) -> Iterator[bytes]:
    """Documents that start in the range, up to a line's end beyond it; a compressed file is one range."""
    name, start, end = span
    if name.endswith(".gz"):
        with store.open_input_stream(name, compression="gzip") as stream:
            yield from [stream.read()] if whole else io.BufferedReader(stream)
        return
    with store.open_input_file(name) as raw:
        if whole:
            yield raw.read(end)
            return
        lines = io.BufferedReader(raw, 1 << 20)
        at = start
        if start:
            lines.seek(start - 1)
            at += len(lines.readline()) - 1  # the rest of a line that another range has
        while at < end:
            line = lines.readline()
            if not line:
                return
            at += len(line)
            yield line


def read_spans(path: str, spans: list[Span], whole: bool) -> Iterator[tuple[str, int | None, str | None, str | None]]:
    store, _ = _store(path)
    for span in spans:
        for raw in _documents(store, span, whole):
            try:
                text = raw.decode("utf-8-sig")
                found = events_of(text) if text.strip() else []
            except UnicodeDecodeError:
                text, found = raw.decode("utf-8", "replace"), None
            if found is None:
                yield (span[0], None, None, text.rstrip("\r\n"))
            else:
                yield from ((span[0], n, event, None) for n, event in enumerate(found))


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = Options(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(s) for s in self.options.spans(files_of(self.options.path))] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return read_spans(self.options.path, partition.value, self.options.whole)


class StreamReader(DataSourceStreamReader):
    """Files that have not been named before, by a log: numbered lists of new files with the bytes they had then.

    An offset is the number of lists. A list is written before its offset is used and never changed, so a batch that starts over
    reads the same bytes. The log belongs to one stream.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.options = Options(options)
        if not options.get("log"):
            raise ValueError("a stream of event_records needs a log, a folder of its own in shared storage")
        self.log_path = options["log"]
        self.most = int(options.get("maxFilesPerTrigger", 0)) or None
        self.named: set[str] = set()
        self.lists = 0

    def initialOffset(self) -> dict:
        return {"lists": 0}

    def _list(self, number: int) -> list[tuple[str, int]] | None:
        store, folder = _store(self.log_path)
        name = posixpath.join(folder, f"{number:012d}.json")
        if store.get_file_info(name).type == pafs.FileType.NotFound:
            return None
        with store.open_input_stream(name) as stream:
            return [(n, size) for n, size in json.loads(stream.read())]

    def latestOffset(self) -> dict:
        while (files := self._list(self.lists)) is not None:
            self.named.update(n for n, _ in files)
            self.lists += 1
        new = [f for f in files_of(self.options.path) if f[0] not in self.named][: self.most]
        if new:
            store, folder = _store(self.log_path)
            store.create_dir(folder, recursive=True)
            draft = posixpath.join(folder, f".{uuid.uuid4().hex}")
            with store.open_output_stream(draft) as out:
                out.write(json.dumps(new).encode())
            store.move(draft, posixpath.join(folder, f"{self.lists:012d}.json"))
            self.named.update(n for n, _ in new)
            self.lists += 1
        return {"lists": self.lists}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = [f for n in range(start["lists"], end["lists"]) for f in self._list(n)]
        return [InputPartition(s) for s in self.options.spans(files)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return read_spans(self.options.path, partition.value, self.options.whole)


class EventRecords(DataSource):
    """Options: path, wholeFile (false), splitBytes (128 MB); for streams log and maxFilesPerTrigger (all)."""

    @classmethod
    def name(cls) -> str:
        return "event_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> Reader:
        return Reader(self.options)

    def streamReader(self, schema: object) -> StreamReader:
        return StreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(EventRecords)
