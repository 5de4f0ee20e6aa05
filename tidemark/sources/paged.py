"""A Spark data source over services that answer in pages, ordered by (time, key).

A service is any object with ``page(after, upto, size)``: the first `size` rows, as tuples of the
schema, with after < (time, key) <= upto, in order; and ``newest()``: the greatest (time, key), or None
while there are no rows. Times are text that sorts as time does. A batch read is cut into ranges of
time that tasks page through by themselves; a stream's offset is the (time, key) of the last row, so
a restart begins after it, without loss or repeat.
"""

from __future__ import annotations

import datetime
import functools
import itertools
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

Place = tuple[str, str]
#: Bytes of a file that are read at once.
BLOCK = 1 << 16
#: Before and after every (time, key).
LOW, HIGH = ("", ""), ("\U0010ffff", "")


@dataclass
class FileService:
    """A service of JSON lines below a folder's URI: files sorted by time, then key, which are two of their fields.

    A page opens only files that reach into its range; their first and last lines say so. Files are
    never read whole: a page's first line is found by halving, or is where the page before ended, and
    blocks are read from there until the page is full. So memory holds a page and a block, however
    large the files are.
    """

    folder: str
    fields: Sequence[str]
    time: str
    key: str
    #: Path -> a place, and where the first line after it begins.
    _ends: dict[str, tuple[Place, int]] = field(default_factory=dict, repr=False)

    def _place_of(self, row: dict) -> Place:
        return row[self.time], str(row[self.key])

    def _place(self, line: bytes) -> Place:
        return self._place_of(json.loads(line))

    @functools.cached_property
    def _files(self) -> list[tuple[Place, Place, str]]:
        store, inside = pafs.FileSystem.from_uri(self.folder)
        out = []
        for info in store.get_file_info(pafs.FileSelector(inside, recursive=True)):
            if info.is_file and info.size and info.extension in ("json", "jsonl", "txt"):
                with store.open_input_file(info.path) as file:
                    near = 1 << 12
                    while b"\n" not in (head := file.read_at(near, 0)) and near < info.size:
                        near *= 2
                    while len(tail := file.read_at(min(near, info.size), max(0, info.size - near)).splitlines()) < 2 and near < info.size:
                        near *= 2
                out.append((self._place(head.splitlines()[0]), self._place(tail[-1]), info.path))
        return sorted(out)

    def _lines(self, file, at: int) -> Iterator[tuple[int, int, bytes]]:
        """Start, end and bytes of each line that begins at or after a byte of a file; blank lines are left out."""
        start, held = max(0, at - 1), b""
        skip = at > 0  # up to the end of the line that the byte before belongs to
        while True:
            block = file.read_at(BLOCK, start + len(held))
            *lines, rest = (held + block).split(b"\n") if block else (held, b"")
            for line in lines:
                end = start + len(line) + 1
                if not skip and line.strip():
                    yield start, end, line
                skip, start = False, end
            if not block:
                return
            held = b"" if skip else rest
            start += len(rest) if skip else 0

    def _after(self, file, size: int, after: Place) -> int:
        """Where the first line after a place begins, in a sorted file; the file's size if there is none."""
        low, high, found = 0, size, size
        while low < high:
            middle = (low + high) // 2
            start, end, line = next(self._lines(file, middle), (size, size, b""))
            if start >= high:
                high = middle
            elif self._place(line) > after:
                high, found = middle, start
            else:
                low = end
        return found

    def page(self, after: Place, upto: Place, size: int) -> list[tuple]:
        store, _ = pafs.FileSystem.from_uri(self.folder)
        out: list[tuple[Place, str, int, tuple]] = []
        began: dict[str, int] = {}
        for first, last, path in self._files:  # by first place: a file that begins after a full page's end adds nothing
            if first > upto or (len(out) >= size and first > out[size - 1][0]):
                break
            if last > after:
                with store.open_input_file(path) as file:
                    known, at = self._ends.get(path, (LOW, 0))
                    began[path] = at = at if known == after else self._after(file, file.size(), after)
                    own = ((self._place_of(row := json.loads(line)), path, end, tuple(map(row.get, self.fields))) for _, end, line in self._lines(file, at))
                    within = itertools.takewhile(lambda r: r[0] <= upto, (r for r in own if r[0] > after))
                    out = sorted([*out, *itertools.islice(within, size)], key=lambda r: r[0])[:size]
        if out:
            began |= {path: end for _, path, end, _ in out}  # in order, so that each file's last row in the page counts
            self._ends = {path: (out[-1][0], at) for path, at in began.items()}
        return [row for *_, row in out]

    def newest(self) -> Place | None:
        return max((last for _first, last, _path in self._files), default=None)


@dataclass
class Range(InputPartition):
    after: Place
    upto: Place


def cut(after: Place, upto: Place, parts: int) -> list[Range]:
    """Ranges of equal time between two places; one range where the ends are not times."""
    try:
        low, high = (datetime.datetime.fromisoformat(p[0].replace("Z", "+00:00")) for p in (after, upto))
        step = (high - low) / parts
        # Text of the ends' own form, so that borders sort among the rows.
        inner = [(low + step * i).isoformat(timespec="microseconds" if "." in upto[0] else "seconds").replace("+00:00", "Z" if upto[0].endswith("Z") else "+00:00") for i in range(1, parts)]
    except ValueError:
        inner = []
    ends = [after, *sorted({(t, "") for t in inner if after < (t, "") < upto}), upto]
    return [Range(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _paged(service: Any, part: Range, size: int, places: tuple[int, int]) -> Iterator[tuple]:
    """The rows of a range, page after page, each from the last row of the one before."""
    after = part.after
    while True:
        rows = service.page(after, part.upto, size)
        yield from rows
        if len(rows) < size:
            return
        after = (rows[-1][places[0]], str(rows[-1][places[1]]))


def source(name: str, make: Callable[[], Any], schema: str, time: str, key: str) -> type[DataSource]:
    """A data source class for a service; make() builds the service where it is used, on driver and executors.

    Options: page_size (1000), parts (8), and for batches start and stop: times, the first included
    and the last not; for streams start alone.
    """
    fields = [f.strip().split()[0] for f in schema.split(",")]
    places = fields.index(time), fields.index(key)

    class _Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.options = options

        def partitions(self) -> list[Range]:
            service = make()
            newest = service.newest()
            start, stop = self.options.get("start"), self.options.get("stop")
            if newest is None:
                return [Range(HIGH, HIGH)]
            first = service.page(LOW, HIGH, 1)[0] if start is None else None
            low = (start, "") if start is not None else (first[places[0]], "")
            # A key is never empty, so (time, "") comes before all rows of its time.
            return cut(low, min((stop, ""), newest) if stop is not None else newest, int(self.options.get("parts", 8)))

        def read(self, partition: Range) -> Iterator[tuple]:
            return _paged(make(), partition, int(self.options.get("page_size", 1000)), places)

    class _Stream(DataSourceStreamReader):
        def __init__(self, options: dict):
            self.options = options

        def initialOffset(self) -> dict:
            return {"time": self.options.get("start", LOW[0]), "key": ""}

        def latestOffset(self) -> dict:
            newest = make().newest()
            return self.initialOffset() if newest is None else {"time": newest[0], "key": newest[1]}

        def partitions(self, start: dict, end: dict) -> list[Range]:
            low, high = (start["time"], start["key"]), (end["time"], end["key"])
            return cut(low, high, int(self.options.get("parts", 8))) if low < high else [Range(high, high)]

        def read(self, partition: Range) -> Iterator[tuple]:
            return _paged(make(), partition, int(self.options.get("page_size", 1000)), places)

        def commit(self, end: dict) -> None:
            pass

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema):
            return _Reader(self.options)

        def streamReader(self, schema):
            return _Stream(self.options)

    return Paged


def register(spark: SparkSession, name: str, make: Callable[[], Any], schema: str, time: str, key: str) -> None:
    """After this, spark.read.format(name) and spark.readStream.format(name) read the service."""
    spark.dataSource.register(source(name, make, schema, time, key))
