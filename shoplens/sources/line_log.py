"""An offset-addressed source of text lines (K3): append-only files read by byte ranges.

The twin of the reference's topic for a folder that all executors reach: each
file is like a partition of a topic, a position in it is a byte offset, and a
micro-batch is a range of offsets per file, kept in the query's checkpoint. A
restarted query goes on from there; nothing is lost or read twice. Registered as
the Python data source ``adlines`` (``register``):

    spark.readStream.format("adlines").option("path", folder).load()

Options:

- ``startingOffsets``: ``latest`` (default: lines appended after the first
  start) or ``earliest``; it holds for a new query, not for a resumed one;
- ``maxBytesPerTrigger``: about how much a micro-batch takes (whole lines, files
  in the order of their names; at least one line); without it, all there is;
- ``positions``: a file that keeps the last planned offsets, needed with
  ``maxBytesPerTrigger``: Spark does not tell a Python source where a resumed
  query stands. It belongs to one query, as its checkpoint does. It is written
  before Spark sees an offset, so it is never behind the checkpoint: a plan that
  Spark did not come to makes the next micro-batch larger, never a gap;
- ``rangeBytes``: the most one task reads (default 16 MiB);
- ``files``: a JSON list of names; only these files are read, so that several queries
  share a folder as consumers share a topic's partitions.

Only whole lines are offered: bytes after the last line feed wait for it. Files
may grow; a file that shrinks below its offset is an error, a file that vanishes
(retention) is left out of the offsets. Names that begin with ``.`` or ``_`` are
not read. Columns: value (without its line feed; bytes that are not UTF-8 are
replaced), file, position. As a batch source it reads all whole lines.

A trigger ``availableNow`` asks a Python source once for its end, so with
``maxBytesPerTrigger`` it takes one such part and stops.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "value string, file string, position bigint"
RANGE_BYTES = 16 << 20
BLOCK = 1 << 20
SLACK = 4 << 10  # read after the end of a range, for the rest of its last line
# the source goes to the workers by value: they need no installation of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Range(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


class Folder:
    """The files of a folder: sizes, whole lines, ranges."""

    def __init__(self, path: str, files: str | None = None):
        self.path, self.files = path, None if files is None else set(json.loads(files))

    def _open(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", self.path))

    def sizes(self) -> dict[str, int]:
        system, root = self._open()
        found = system.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return {f.base_name: f.size for f in sorted(found, key=lambda f: f.base_name)
                if f.is_file and f.base_name[0] not in "._" and (self.files is None or f.base_name in self.files)}

    def line_end(self, file: str, start: int, limit: int, size: int) -> int:
        """The end of the last whole line of ``file`` in start..limit; if the first
        line is longer, its end; ``start`` if it has no end yet."""
        system, root = self._open()
        with system.open_input_file(f"{root}/{file}") as f:
            at = limit
            while at > start:
                a = max(start, at - BLOCK)
                cut = f.read_at(at - a, a).rfind(b"\n")
                if cut >= 0:
                    return a + cut + 1
                at = a
            at = limit
            while at < size:
                cut = f.read_at(min(BLOCK, size - at), at).find(b"\n")
                if cut >= 0:
                    return at + cut + 1
                at += BLOCK
        return start

    def plan(self, start: dict[str, int], budget: int | None) -> dict[str, int]:
        """The offsets after about ``budget`` bytes from ``start``."""
        end = {}
        for file, size in self.sizes().items():
            at = start.get(file, 0)
            if size < at:
                raise RuntimeError(f"{file} is shorter ({size} bytes) than what was read of it ({at})")
            end[file] = at
            if size > at and (budget is None or budget > 0):
                end[file] = self.line_end(file, at, size if budget is None else min(size, at + budget), size)
                if budget is not None:
                    budget -= end[file] - at
        return end

    def ranges(self, start: dict[str, int], end: dict[str, int], step: int) -> list[Range]:
        return [Range(file, a, min(a + step, stop)) for file, stop in sorted(end.items())
                for a in range(start.get(file, 0), stop, step)]

    def lines(self, part: Range) -> Iterator[pa.RecordBatch]:
        """The lines that begin in the range; the last one may end after it."""
        system, root = self._open()
        with system.open_input_file(f"{root}/{part.file}") as f:
            at, rest = part.start, b""
            if at > 0 and f.read_at(1, at - 1) != b"\n":  # inside a line that began before
                while True:
                    block = f.read_at(BLOCK, at)
                    cut = block.find(b"\n")
                    if cut >= 0 or not block:
                        at += cut + 1 if block else 0
                        break
                    at += len(block)
            read = at
            while at < part.end:
                block = f.read_at(min(BLOCK, max(0, part.end - read) + max(SLACK, len(rest))), read)
                read += len(block)
                parts = (rest + block).split(b"\n")
                rest = parts.pop()
                values, places = [], []
                for line in parts:
                    if at >= part.end:
                        break
                    values.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                    places.append(at)
                    at += len(line) + 1
                if values:
                    yield pa.RecordBatch.from_pydict({"value": values, "file": [part.file] * len(values),
                                                      "position": pa.array(places, pa.int64())})
                if not block:
                    break


class LineStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = Folder(options["path"], options.get("files"))
        self.starting = options.get("startingOffsets", "latest")
        if self.starting not in ("latest", "earliest"):
            raise ValueError("startingOffsets is latest or earliest")
        budget = options.get("maxBytesPerTrigger")
        self.budget = None if budget is None else int(budget)
        self.positions = options.get("positions")
        if self.budget is not None and self.positions is None:
            raise ValueError("maxBytesPerTrigger needs a positions file")
        self.step = int(options.get("rangeBytes", RANGE_BYTES))
        self.known: dict | None = None

    def _known(self) -> dict:
        """Where the query began and what was planned last; a new query begins now.
        Spark asks for the end of the first micro-batch before its beginning."""
        if self.known is None and self.positions is not None:
            system, name = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", self.positions))
            if system.get_file_info(name).type != pafs.FileType.NotFound:
                with system.open_input_file(name) as f:
                    self.known = json.loads(f.read())
        if self.known is None:
            first = {} if self.starting == "earliest" else self.folder.plan({}, None)
            self._keep({"initial": first, "planned": first})
        return self.known

    def _keep(self, known: dict) -> None:
        if self.positions is not None and known != self.known:
            system, name = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", self.positions))
            system.create_dir(name.rpartition("/")[0], recursive=True)
            temporary = f"{name}.{uuid.uuid4().hex}"
            with system.open_output_stream(temporary) as f:
                f.write(json.dumps(known).encode())
            system.move(temporary, name)
        self.known = known

    def initialOffset(self) -> dict:
        """Where a new query begins."""
        return self._known()["initial"]

    def latestOffset(self) -> dict:
        known = self._known()
        planned = self.folder.plan({} if self.positions is None else known["planned"], self.budget)
        self._keep({**known, "planned": planned})
        return planned

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.folder.ranges(start, end, self.step)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.folder.lines(partition)


class LineBatch(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.step = Folder(options["path"], options.get("files")), int(options.get("rangeBytes", RANGE_BYTES))

    def partitions(self) -> Sequence[InputPartition]:
        return self.folder.ranges({}, self.folder.plan({}, None), self.step)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.folder.lines(partition)


class LineLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "adlines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LineBatch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LineStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LineLog)


def read_line_stream(spark: SparkSession, path: str, starting: str = "latest", max_bytes: int | None = None,
                     positions: str | None = None, range_bytes: int = RANGE_BYTES,
                     files: Sequence[str] | None = None) -> DataFrame:
    """The folder, or some of its files, as a stream of value, file, position."""
    register(spark)
    reader = (spark.readStream.format("adlines").option("path", path).option("startingOffsets", starting)
              .option("rangeBytes", range_bytes))
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if positions is not None:
        reader = reader.option("positions", positions)
    if files is not None:
        reader = reader.option("files", json.dumps(list(files)))
    return reader.load()
