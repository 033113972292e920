"""Log files that are still being written, as a stream."""

from __future__ import annotations

import glob
import os
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from logloom.schema import SEQUENCE

#: Bytes that one task reads.
SPLIT = 64 << 20
#: Bytes that are looked through at once for the end of the last whole line.
LOOK_BACK = 1 << 16
# Fixed value: seconds after which an unwritten, renamed file is complete.
DEFAULT_QUIET = 10.0

_SCHEMA = pa.schema([("value", pa.string()), ("file_time", pa.timestamp("us", "UTC")), ("file_path", pa.string()), ("block_start", pa.int64())])


class Span(InputPartition):
    """The lines of a file that begin from ``first`` up to ``last``, before ``end``.

    ``begin`` is where lines not read before begin.
    """

    def __init__(self, key: str, path: str, pattern: str, time: int, begin: int, first: int, last: int, end: int):
        super().__init__(key)
        self.key, self.path, self.pattern, self.time = key, path, pattern, time
        self.begin, self.first, self.last, self.end = begin, first, last, end


def _key(stat: os.stat_result) -> str:
    return f"{stat.st_dev}-{stat.st_ino}"


def _whole_lines(path: str, size: int) -> int:
    """Where the last line that has an end ends."""
    with open(path, "rb") as file:
        while size > 0:
            start = max(0, size - LOOK_BACK)
            file.seek(start)
            found = file.read(size - start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            size = start
    return 0


class GrowingReader(DataSourceStreamReader):
    """Offsets are byte positions: for each file, by its identity, where whole lines end.

    A renamed file keeps its identity, so a rotated log is read to its end under its
    new name and the file that takes its place from its start. A last line
    without an end waits until it has one, or until its file no longer has the
    followed name and nobody has written to it for ``quiet`` seconds. A file that
    has become shorter was emptied and is read from its start.
    """

    def __init__(self, options: dict):
        self.pattern = options["path"]
        self.follow = options.get("follow") or None
        self.start = options.get("start", "earliest")
        self.quiet = float(options.get("quiet", DEFAULT_QUIET))

    def initialOffset(self) -> dict:
        return self.latestOffset() if self.start == "latest" else {}

    def latestOffset(self) -> dict:
        found = {}
        for path in sorted(glob.glob(self.pattern)):
            try:
                stat = os.stat(path)
                if not os.path.isfile(path):
                    continue
                end = _whole_lines(path, stat.st_size)
            except FileNotFoundError:  # renamed or removed meanwhile; the next look finds it
                continue
            left = self.follow is not None and os.path.basename(path) != self.follow
            if left and end < stat.st_size and time.time() - stat.st_mtime > self.quiet:
                end = stat.st_size
            found[_key(stat)] = [path, end, stat.st_mtime_ns // 1000]
        return found

    def partitions(self, start: dict, end: dict) -> list[Span]:
        spans = []
        for key, (path, last, modified) in sorted(end.items()):
            begin = start.get(key, [path, 0, 0])[1]
            begin = 0 if last < begin else begin
            for first in range(begin, last, SPLIT):
                spans.append(Span(key, path, self.pattern, modified, begin, first, min(first + SPLIT, last), last))
        return spans

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        with _opened(span) as file:
            at = span.first
            if at > span.begin:  # the line that is under way here belongs to the span before
                file.seek(at - 1)
                at += len(file.readline()) - 1
            else:
                file.seek(at)
            texts, places = [], []
            while at < span.last:
                line = file.readline(span.end - at)
                if not line:
                    raise EOFError(f"{span.path} ends at {at}, before {span.end}")
                texts.append(line.removesuffix(b"\n").removesuffix(b"\r").decode(errors="replace"))
                places.append(at)
                at += len(line)
                if len(texts) == 4096:
                    yield _lines(span, texts, places)
                    texts, places = [], []
            yield _lines(span, texts, places)

    def commit(self, end: dict) -> None:
        pass


def _opened(span: Span):
    """The file, wherever it has been moved since."""
    for path in [span.path, *glob.glob(span.pattern)]:
        try:
            file = open(path, "rb")
        except FileNotFoundError:
            continue
        if _key(os.fstat(file.fileno())) == span.key:
            return file
        file.close()
    raise FileNotFoundError(f"{span.path} is gone before its lines were read")


def _lines(span: Span, texts: list[str], places: list[int]) -> pa.RecordBatch:
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(texts, pa.string()),
            pa.array([span.time] * n, pa.timestamp("us", "UTC")),
            pa.array([span.path] * n, pa.string()),
            pa.array(places, pa.int64()),
        ],
        schema=_SCHEMA,
    )


class GrowingText(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_text"

    def schema(self) -> str:
        return "value string, file_time timestamp, file_path string, block_start bigint"

    def streamReader(self, schema: StructType) -> GrowingReader:
        return GrowingReader(dict(self.options))


def follow_access_log(
    spark: SparkSession,
    path: str,
    start: str = "latest",
    follow: str | None = None,
    quiet: float = DEFAULT_QUIET,
) -> DataFrame:
    """Lines appended to the files of a glob pattern, with their place ``_seq``.

    The pattern has to cover the names that rotation gives (``/logs/access.log*``);
    ``follow`` is the base name that is written to. ``start`` is ``"latest"`` (what is
    appended from now on, and files that appear later) or ``"earliest"``. A trigger
    reads what was whole when it began, in spans of ``SPLIT`` bytes; every executor must see
    the files under the same names, as on a shared mount. For closed files in a store
    use ``stream_access_log``.
    """
    if start not in ("latest", "earliest"):
        raise ValueError(f"start must be 'latest' or 'earliest', not {start!r}")
    spark.dataSource.register(GrowingText)
    reader = spark.readStream.format("growing_text").option("start", start).option("quiet", str(quiet))
    if follow is not None:
        reader = reader.option("follow", follow)
    place = "struct(file_time, file_path, block_start, 0L AS line)"
    return reader.load(path).selectExpr("value", f"CAST({place} AS {SEQUENCE.simpleString()}) AS _seq")
