"""Sources that read parts of raw files: features of a collection by byte range, lines of a zipped table.

A collection of features is one JSON document, which a line-wise or whole-file reader
gives to one task. Here a file is cut into ranges of bytes. A first pass tells of each
range, whichever way it begins (inside a text or not), how it ends and how deep brackets go;
put together in order, these few numbers give the exact state at every border. A second
pass then reads each range alone and gives out the features that begin in it.
"""

from __future__ import annotations

import csv
import io
import json
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, and those read at once behind its end to finish its last feature.
RANGE_BYTES, MORE_BYTES = 32 << 20, 1 << 20
#: Features and bytes of a batch that a task hands on.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
#: Bytes looked back for the key of an array.
KEY_BYTES = 64
QUOTE, BACKSLASH = 34, 92
#: In place of where the features open: the range is a whole file.
ALONE = -2


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file as Spark names it."""
    if "://" not in path and ":/" in path:
        path = path.replace(":/", ":///", 1)
    return fs.FileSystem.from_uri(path)


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Paths and sizes of the files that a path or pattern names, in order; nothing is read."""
    rows = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    return sorted((r["path"], r["length"]) for r in rows)


# --- structure of JSON bytes ------------------------------------------------------------


def escaped_before(read, at: int) -> bool:
    """Whether the byte at `at` follows an odd number of backslashes; read(begin, end) gives bytes."""
    run, step = 0, 64
    while at:
        back = read(max(0, at - step), at)
        kept = back.rstrip(b"\\")
        run += len(back) - len(kept)
        if kept:
            break
        at, step = at - len(back), 1 << 16
    return run % 2 == 1


def structure(data: bytes, escaped: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places of the quotes that begin or end a text, and of all brackets, in some bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    quotes = np.flatnonzero(raw == QUOTE)
    if len(quotes):
        behind = quotes[(quotes > 0) & (raw[np.maximum(quotes, 1) - 1] == BACKSLASH)]
        drop = []
        for q in behind.tolist():
            begin = q
            while begin and data[begin - 1] == BACKSLASH:
                begin -= 1
            # a run that reaches the first byte goes on before it
            if (q - begin + (escaped and begin == 0)) % 2:
                drop.append(q)
        if escaped and quotes[0] == 0:
            drop.append(0)
        quotes = np.setdiff1d(quotes, drop, assume_unique=True)
    brackets = np.flatnonzero(((raw | 0x20) == 0x7B) | ((raw | 0x20) == 0x7D))
    return quotes, brackets


# an opening and a closing bracket of either kind differ from a brace in one bit
def _outside(quotes: np.ndarray, brackets: np.ndarray, inside: bool) -> np.ndarray:
    return brackets[(np.searchsorted(quotes, brackets) + inside) % 2 == 0]


def _steps(data: bytes, at: np.ndarray) -> np.ndarray:
    kind = np.frombuffer(data, dtype=np.uint8)[at]
    return np.where((kind | 0x20) == 0x7B, 1, -1).astype(np.int64)


def _arrays_of(key: bytes, before: bytes, data: bytes, at: np.ndarray) -> list[int]:
    """Those of the places where an array opens as the value of a key."""
    raw = np.frombuffer(data, dtype=np.uint8)
    found = []
    for k in at[(raw[at] == 0x5B) & np.isin(raw[np.maximum(at, 1) - 1], list(b": \t\r\n["))].tolist():
        head = (before[-KEY_BYTES:] + data[:k] if k < KEY_BYTES else data[k - KEY_BYTES : k]).rstrip()
        if head.endswith(b":") and head[:-1].rstrip().endswith(key):
            found.append(k)
    return found


def outline(read, begin: int, end: int) -> dict:
    """What a range does, for either state at its begin: see `borders`. Depths count from its begin."""
    data = read(begin, end)
    before = read(max(0, begin - KEY_BYTES), begin)
    quotes, brackets = structure(data, escaped_before(read, begin))
    found = {"turns": int(len(quotes) % 2)}
    for inside in (0, 1):
        at = _outside(quotes, brackets, bool(inside))
        depth = np.cumsum(_steps(data, at))
        opens = []
        for k in _arrays_of(b'"features"', before, data, at):
            i = int(np.searchsorted(at, k))
            low = int(depth[i + 1 :].min()) if i + 1 < len(depth) else int(depth[i])
            opens.append([k + begin, int(depth[i]) - 1, low])
        found[str(inside)] = {
            "change": int(depth[-1]) if len(depth) else 0,
            "low": min(0, int(depth.min())) if len(depth) else 0,
            "opens": opens,
        }
    return found


@dataclass
class Range(InputPartition):
    """Bytes [begin, end) of a file and the state before the first of them."""

    path: str
    begin: int
    end: int
    inside: bool = False
    depth: int = 0
    opened: int = -1  # where the array of features opens, -1 where it has not opened before the end


def borders(ranges: list[Range], outlines: list[dict]) -> list[Range]:
    """The ranges of one file in order with their states; those that no feature can begin in are left out."""
    inside, depth, opened, closed, found = False, 0, -1, False, []
    for one, told in zip(ranges, outlines):
        state = told[str(int(inside))]
        here = next((o for o in state["opens"] if depth + o[1] == 1), None) if opened < 0 else None
        if here:
            opened = here[0]
        if opened >= 0 and not closed:
            found.append(Range(one.path, one.begin, one.end, inside, depth, opened))
        low = here[2] if here else state["low"]
        closed = closed or (opened >= 0 and depth + low < 2)
        depth += state["change"]
        inside ^= bool(told["turns"])
    return found


def features_in(read, size: int, one: Range) -> Iterator[bytes]:
    """The features that begin in a range, each whole, from the file's bytes read(begin, end)."""
    data = read(one.begin, one.end)
    escaped, inside, depth = escaped_before(read, one.begin), one.inside, one.depth
    quotes, brackets = structure(data, escaped)
    at = _outside(quotes, brackets, inside)
    steps = _steps(data, at)
    after = depth + np.cumsum(steps)
    use = at + one.begin > one.opened  # behind the place where the array opens
    shut = np.flatnonzero(use & (after < 2))
    if len(shut):
        use[shut[0] :] = False
    starts = at[use & (steps > 0) & (after == 3)]
    ends = at[use & (steps < 0) & (after == 2)] + 1
    ends = ends[ends > starts[0]] if len(starts) else ends[:0]
    for a, b in zip(starts.tolist(), ends.tolist()):
        yield data[a:b]
    if len(starts) <= len(ends):
        return
    # the last feature goes on behind the range
    parts, here = [data[int(starts[-1]) :]], one.end
    inside = bool((len(quotes) + inside) % 2)
    depth = int(after[-1])
    while here < size:
        more = read(here, min(size, here + MORE_BYTES))
        quotes, brackets = structure(more, escaped_before(read, here))
        at = _outside(quotes, brackets, inside)
        after = depth + np.cumsum(_steps(more, at))
        done = np.flatnonzero(after == 2)
        if len(done):
            parts.append(more[: int(at[done[0]]) + 1])
            break
        parts.append(more)
        inside = bool((len(quotes) + inside) % 2)
        depth = int(after[-1]) if len(after) else depth
        here += len(more)
    yield b"".join(parts)


# --- the sources ------------------------------------------------------------------------


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows whose last value is a text."""

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    held, bytes_held = [], 0
    for row in rows:
        held.append(row)
        bytes_held += len(row[-1])
        if len(held) >= BATCH_ROWS or bytes_held >= BATCH_BYTES:
            yield batch()
            held, bytes_held = [], 0
    if held:
        yield batch()


def _reader(path: str):
    place, name = place_of(path)
    file = place.open_input_file(name)

    def read(begin: int, end: int) -> bytes:
        return file.read_at(end - begin, begin) if end > begin else b""

    return file, read


class FeatureRanges(DataSource):
    """Features of collections as text, a partition for each range.

    Options: `ranges`, a JSON list of ranges, and `outlines`: true for what the ranges do
    in place of the features.
    """

    @classmethod
    def name(cls) -> str:
        return "feature_ranges"

    def schema(self) -> str:
        return "path string, feature string"

    def reader(self, schema) -> DataSourceReader:
        return _RangeReader([Range(*r) for r in json.loads(self.options["ranges"])], self.options.get("outlines") == "true")


class _RangeReader(DataSourceReader):
    def __init__(self, ranges: list[Range], outlines: bool):
        self.ranges, self.outlines = ranges, outlines

    def partitions(self) -> list[Range]:
        return self.ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        file, read = _reader(partition.path)
        with file:
            if self.outlines:
                told = outline(read, partition.begin, partition.end)
                rows = iter([(partition.path, json.dumps({"begin": partition.begin, **told}))])
            else:
                # a file of one range tells its own border while it is read
                own = [partition] if partition.opened != ALONE else borders([partition], [outline(read, 0, partition.end)])
                rows = ((r.path, f.decode("utf-8", "replace")) for r in own for f in features_in(read, file.size(), r))
            yield from _batches(rows, pa.schema({"path": pa.string(), "feature": pa.string()}))


def _rows(spark: SparkSession, ranges: list[Range], outlines: bool = False) -> DataFrame:
    spark.dataSource.register(FeatureRanges)
    given = json.dumps([[r.path, r.begin, r.end, r.inside, r.depth, r.opened] for r in ranges])
    return spark.read.format("feature_ranges").option("ranges", given).option("outlines", str(outlines).lower()).load()


def known(path: str) -> bool:
    """Whether the file system of a path is one that Python knows here."""
    try:
        return place_of(path) is not None
    except (OSError, ValueError, pa.ArrowException):
        return False


def splittable(files: list[tuple[str, int]]) -> bool:
    """Whether byte ranges of the files can be read: not compressed, and on a file system known here."""
    packed = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")
    return bool(files) and all(not path.endswith(packed) and known(path) for path, _ in files)


def feature_rows(spark: SparkSession, files: list[tuple[str, int]], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows (path, feature): the features of the collections in some files, as JSON text.

    A feature is an element of the array under the key `features` of the file's object, in
    whatever order keys stand, however they are laid out. A file that fits one range is
    read once; the borders inside larger ones come from one pass over their bytes, of
    which a few numbers for each range reach the driver.
    """
    several = [
        [Range(path, at, min(size, at + range_bytes)) for at in range(0, size, range_bytes)]
        for path, size in files
        if size > range_bytes
    ]
    found = [Range(path, 0, size, opened=ALONE) for path, size in files if size <= range_bytes]
    if several:
        told: dict[tuple[str, int], dict] = {}
        for row in _rows(spark, [r for own in several for r in own], outlines=True).collect():
            one = json.loads(row["feature"])
            told[row["path"], one["begin"]] = one
        for own in several:
            found += borders(own, [told[r.path, r.begin] for r in own])
    return _rows(spark, found)


# --- zipped tables ----------------------------------------------------------------------

#: Cells of a line that can be picked, and characters after which an open quote is taken for a stray one.
CELLS, OPEN_QUOTE = 64, 1 << 20
# Texts that stand for no value in the trip files.
NO_VALUE = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)


def table_lines(file, wanted: Sequence[str]) -> Iterator[tuple[list[int], str]]:
    """Records of the largest member of a zip, in its directory, each with the places of the wanted columns.

    The member is read as a stream, so a task holds a piece of it. A record whose quotes
    are open goes on in the next line. The first record names the columns; a column that
    it does not name has place -1.
    """
    with zipfile.ZipFile(file) as archive:
        members = archive.infolist()
        if not members:
            return
        largest = max(members, key=lambda member: member.file_size)
        with archive.open(largest) as member:
            places = None
            for record in _records(io.TextIOWrapper(member, encoding="utf-8-sig", errors="replace", newline="")):
                if places is None:
                    names = [name.strip() for name in next(csv.reader([record]))]
                    places = [names.index(c) if c in names else -1 for c in wanted]
                    if max(places, default=-1) >= CELLS:
                        raise ValueError(f"a wanted column stands behind the first {CELLS}")
                elif record:
                    yield places, record


def _records(lines) -> Iterator[str]:
    held = ""
    for line in lines:
        held += line
        if held.count('"') % 2 and len(held) < OPEN_QUOTE:
            continue
        yield held.rstrip("\r\n")
        held = ""
    if held:
        yield held.rstrip("\r\n")


LINES = pa.schema({"path": pa.string(), "places": pa.list_(pa.int32()), "line": pa.string()})
LINE_TYPES = "path string, places array<int>, line string"


class _Seekable(io.RawIOBase):
    """A file of Arrow's for the zip reader, which tells by OSError that a place is none."""

    def __init__(self, file):
        self.file, self.at = file, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.file.size()}[whence]
        if at < 0:
            raise OSError("before the first byte")
        self.at = at
        return at

    def tell(self) -> int:
        return self.at

    def readinto(self, buffer) -> int:
        size = max(0, min(len(buffer), self.file.size() - self.at))
        data = self.file.read_at(size, self.at) if size else b""
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)


@dataclass
class Archive(InputPartition):
    path: str


class ZippedTables(DataSource):
    """Lines of the largest member of each archive, a partition for each archive.

    Options: `paths` and `wanted`, JSON lists of archives and of column names.
    """

    @classmethod
    def name(cls) -> str:
        return "zipped_tables"

    def schema(self) -> str:
        return LINE_TYPES

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(json.loads(self.options["paths"]), json.loads(self.options["wanted"]))


class _ArchiveReader(DataSourceReader):
    def __init__(self, paths: list[str], wanted: list[str]):
        self.paths, self.wanted = paths, wanted

    def partitions(self) -> list[Archive]:
        return [Archive(p) for p in self.paths]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        place, name = place_of(partition.path)
        with place.open_input_file(name) as file:
            raw = io.BufferedReader(_Seekable(file), 1 << 20)
            rows = ((partition.path, places, line) for places, line in table_lines(raw, self.wanted))
            yield from _batches(rows, LINES)


def zipped_lines(spark: SparkSession, files: list[tuple[str, int]], wanted: Sequence[str]) -> DataFrame:
    """Rows (path, places, line) of the tables in some archives."""
    spark.dataSource.register(ZippedTables)
    paths = json.dumps([path for path, _ in files])
    return spark.read.format("zipped_tables").option("paths", paths).option("wanted", json.dumps(list(wanted))).load()


def cells_of(lines: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns as text, and the path, of rows (path, places, line)."""
    parsed = F.from_csv("line", F.lit(", ".join(f"c{i} string" for i in range(CELLS))), {"escape": '"'})
    rows = lines.select("path", "places", parsed.alias("_cells"))

    def picked(cells):
        found = F.transform("places", lambda place: F.get(cells, place))
        return F.transform(found, lambda text: F.when(~text.isin(*NO_VALUE), text))

    # the inner array is built once for a line: a lambda's argument stands for its value
    whole = F.array(F.array(*[F.col(f"_cells.c{i}") for i in range(CELLS)]))
    rows = rows.select("path", F.get(F.transform(whole, picked), F.lit(0)).alias("_picked"))
    return rows.select(*[F.get("_picked", F.lit(i)).alias(c) for i, c in enumerate(wanted)], "path")
