"""Near-duplicate vectors by an inverted multi-index with multi-sequence traversal."""

from __future__ import annotations

import heapq
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import components, group_edges, table, whole_groups
from dockwise.session import settle, work_dir

#: Vectors that the codebooks are fitted on.
SAMPLE = 20_000
#: Largest codebook of a half; smaller where a label has fewer than CELL rows for each cell.
CODES = 256
CELL = 64
#: Vectors of a block, which lie together in a file and go round the others together, and their bytes at most.
BLOCK, BLOCK_BYTES = 16_384, 8 << 20
#: Rows of both sides that are compared at once, few enough for a processor's own memory.
LEFT, RIGHT = 1_024, 256
#: Axes on which two vectors are laid before they are compared in full.
AXES = 16
#: Rounding of squared distances of unit vectors, allowed for so that no bound exceeds the distance.
ROUNDING = 1e-13
#: Rounding of half a squared distance on the axes, in single precision.
COARSE = 1e-5
#: Tasks that the blocks are dealt to at most.
TASKS = 2_000
#: Files that a task holds open.
OPEN = 64


def codebook(points: np.ndarray, size: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means centres of some points; the start is drawn with a fixed seed."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centres = points[rng.choice(len(points), min(size, len(points)), replace=False)]
    for _ in range(rounds):
        owner = squares(points, centres).argmin(axis=1)
        for k in range(len(centres)):
            own = points[owner == k]
            if len(own):
                centres[k] = own.mean(axis=0)
    return centres


def squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres."""
    found = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)
    return np.maximum(found, 0)


class MultiIndex:
    """Two codebooks for the halves of unit vectors; a cell is a pair of codes.

    axes: orthonormal columns; a distance on them never exceeds the whole one.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray, stop: float, axes: np.ndarray | None = None):
        self.books = (first, second)
        self.between = tuple(np.array([np.sqrt(((b - c) ** 2).sum(axis=1)) for c in b]) for b in self.books)
        self.stop = stop
        self.axes = axes

    def homes(self, unit: np.ndarray) -> list[np.ndarray]:
        """Own code of each half."""
        cut = self.books[0].shape[1]
        return [squares(half, book).argmin(axis=1) for half, book in zip((unit[:, :cut], unit[:, cut:]), self.books)]

    def bounds(self, unit: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Own code of each half, and how far a point must move at least to get each code."""
        homes, bounds = [], []
        cut = self.books[0].shape[1]
        for half, book, between in zip((unit[:, :cut], unit[:, cut:]), self.books, self.between):
            d = squares(half, book)
            home = d.argmin(axis=1)
            further = np.maximum(d - d[np.arange(len(d)), home][:, None] - ROUNDING, 0)
            homes.append(home)
            bounds.append(further / np.maximum(2 * between[home], 1e-30))
        return homes, bounds

    def home(self, homes) -> np.ndarray:
        return homes[0] * len(self.books[1]) + homes[1]

    def visits(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Multi-sequence traversal: cells by rising distance until it exceeds `stop`.

        first, second: the bounds of one vector for the codes of each half. Both are
        sorted; a heap holds the frontier of the product grid.
        """
        order1, order2 = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        a, b = (first[order1] ** 2).tolist(), (second[order2] ** 2).tolist()
        limit, width = self.stop**2, len(second)
        heap, found = [(a[0] + b[0], 0, 0)], []
        while heap:
            distance, i, j = heapq.heappop(heap)
            if distance > limit:
                break
            found.append(int(order1[i]) * width + int(order2[j]))
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        return found


def _units(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; a single component gets a zero beside it."""
    x = x.astype(np.float64)
    if x.shape[1] == 1:
        x = np.column_stack([x, np.zeros(len(x))])
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _rows(raw, dim: int) -> np.ndarray:
    """Vectors from their float32 bytes."""
    return np.frombuffer(b"".join(raw), dtype="<f4").reshape(-1, dim)


#: Vectors that equal each other in a batch are one row, with all their ids.
PACKED = "label int, dim int, raw binary, ids array<long>"


def pack_vectors(rows: DataFrame) -> DataFrame:
    """Rows (label, dim, raw, ids) of rows (vec_id, label, v) whose components are all finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, label, v = (batch.column(c) for c in ("vec_id", "label", "v"))
            dims = pc.list_value_length(v).to_numpy(zero_copy_only=False)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype("<f4") + np.float32(0)  # no negative zeros
            starts = np.cumsum(dims) - dims
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = flat[starts[at][:, None] + np.arange(dim)] if len(at) < len(dims) else flat
                raw, width = x.tobytes(), 4 * dim
                own = label.take(pa.array(at)).to_pylist()
                known: dict[tuple[int, bytes], int] = {}
                codes = [known.setdefault((k, raw[i * width : (i + 1) * width]), len(known)) for i, k in enumerate(own)]
                codes = np.array(codes)
                found = ids.take(pa.array(at[np.argsort(codes, kind="stable")]))
                ends = np.append(0, np.cumsum(np.bincount(codes))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _ in known], pa.int32()),
                        pa.array(np.full(len(known), dim), pa.int32()),
                        pa.array([r for _, r in known], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), found),
                    ],
                    ["label", "dim", "raw", "ids"],
                )

    return rows.select("vec_id", "label", "v").mapInArrow(run, PACKED)


def fit(rows: DataFrame, threshold: float) -> dict[int, MultiIndex]:
    """An index per dimension for rows (vec_id, label, v) whose components are all finite.

    Codebooks and axes come from a sample of at most SAMPLE different vectors, drawn by a hash
    of their components: first a share of the hashes, so that few more than these are sorted.
    The traversal stops at the linking distance: bounds never exceed the distance, so every
    cell that can hold a link is visited, whatever the sample.
    """
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold) + ROUNDING))
    index = {}
    rows = rows.withColumns({"dim": F.size("v"), "h": F.xxhash64("v")})
    labels = rows.groupBy("dim", "label").agg(F.approx_count_distinct("h").cast("double").alias("n"))
    # of_label: how many vectors the label of a vector has on average
    sizes = labels.groupBy("dim").agg(F.sum("n").alias("n"), (F.sum(F.col("n") ** 2) / F.sum("n")).alias("of_label"))
    for row in sizes.orderBy("dim").collect():  # a row per dimension
        dim, share = row["dim"], max(1, int(row["n"]) // SAMPLE)
        drawn = rows.filter((F.col("dim") == dim) & (F.pmod("h", F.lit(share)) == 0))
        drawn = pack_vectors(drawn).select("raw").distinct()
        drawn = drawn.orderBy(F.xxhash64("raw"), "raw").limit(SAMPLE)
        unit = _units(_rows(drawn.toPandas()["raw"], dim))
        size = int(np.clip(round((row["of_label"] / CELL) ** 0.5), 1, CODES))
        half = unit.shape[1] // 2
        centred = unit - unit.mean(axis=0)
        axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :AXES]  # those of the largest variance
        books = codebook(unit[:, :half], size), codebook(unit[:, half:], size)
        index[dim] = MultiIndex(*books, radius, np.ascontiguousarray(axes))
    return index


def _place(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a file or folder that every executor reaches."""
    return arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace(":", "://", 1))


class _Writer:
    """A file of its own for each task attempt, opened when it gets its first bytes."""

    def __init__(self, root: str):
        self.path = f"{root}/part-{TaskContext.get().partitionId()}-{uuid.uuid4().hex}"
        self.out, self.at = None, 0

    def write(self, data: bytes) -> int:
        """Where the data begins."""
        if self.out is None:
            place, path = _place(self.path)
            place.create_dir(path.rpartition("/")[0], recursive=True)
            self.out = place.open_output_stream(path, compression=None)
        self.out.write(data)
        self.at += len(data)
        return self.at - len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


class _Reader:
    """Ranges of bytes of files, the last few of which stay open."""

    def __init__(self):
        self.files: dict[str, pa.NativeFile] = {}

    def read(self, path: str, at: int, size: int) -> bytes:
        if path not in self.files:
            if len(self.files) >= OPEN:
                self.files.pop(next(iter(self.files))).close()
            place, own = _place(path)
            self.files[path] = place.open_input_file(own)
        return self.files[path].read_at(size, at)


LAID = pa.schema(
    [
        ("label", pa.int32()), ("dim", pa.int32()), ("node", pa.int64()), ("vec_id", pa.int64()), ("path", pa.string()),
        ("at", pa.int64()), ("n", pa.int32()), ("cells", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
    ]
)


def lay_vectors(packed: DataFrame, index: dict[int, MultiIndex], root: str, block: int = BLOCK) -> DataFrame:
    """Writes the vectors under `root` once, ordered by cell; rows of two kinds, told apart by `path`.

    Where it is null: the node of an input row (node, vec_id). Else a block: vectors of one
    label and dimension, numbered on from `node`, which lie at `at` of the file: places on the
    axes, number of copies, float32 components. cells, counts: the cells in it and their vectors.
    """

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, cell = batch.column("dim").to_numpy(), np.zeros(batch.num_rows, dtype=np.int32)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                found = index[dim]
                cell[at] = found.home(found.homes(_units(_rows(batch.column("raw").take(pa.array(at)).to_pylist(), dim))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(root)
        node = TaskContext.get().partitionId() << 33
        last, raws, copies, cells = (), [], [], []

        def close() -> pa.RecordBatch:
            label, dim = last[:2]
            x = _rows(raws, dim)
            axes = (_units(x) @ index[dim].axes).astype("<f4")
            at = out.write(axes.tobytes() + np.array(copies, dtype="<i8").tobytes() + x.tobytes())
            own, counts = np.unique(cells, return_counts=True)
            values = [label, dim, node - len(raws), None, out.path, at, len(raws), own.tolist(), counts.tolist()]
            raws.clear(), copies.clear(), cells.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, LAID)], schema=LAID)

        for batch in batches:
            ids = batch.column("ids")
            sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
            own = np.empty(len(sizes), dtype=np.int64)
            keys = zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "cell", "raw")))
            for k, (key, size) in enumerate(zip(keys, sizes.tolist())):
                if key == last:
                    copies[-1] += size
                else:
                    if raws and (key[:2] != last[:2] or len(raws) >= min(block, max(1, BLOCK_BYTES // (4 * key[1])))):
                        yield close()
                    last = key
                    raws.append(key[3]), copies.append(size), cells.append(key[2])
                    node += 1
                own[k] = node - 1
            member = {"node": pa.array(np.repeat(own, sizes)), "vec_id": ids.flatten()}
            nulls = [member.get(f.name, pa.nulls(int(sizes.sum()), f.type)) for f in LAID]
            yield pa.RecordBatch.from_arrays(nulls, schema=LAID)
        if raws:
            yield close()
        out.close()

    filed = packed.mapInArrow(home, f"{PACKED}, cell int").withColumn("h", F.xxhash64("raw"))
    dealt = filed.repartitionByRange("label", "dim", "cell", "h").sortWithinPartitions("label", "dim", "cell", "h", "raw")
    return dealt.select("label", "dim", "cell", "raw", "ids").mapInArrow(
        run,
        "label int, dim int, node long, vec_id long, path string, at long, n int, cells array<int>, counts array<int>",
    )


def directories(blocks: DataFrame, root: str, block: int = BLOCK) -> DataFrame:
    """Rows (label, dim, path, at, size, own, start): each block by its place in the list of its label and dimension.

    The lists are written under `root`; a block comes behind those whose cells come before its own.
    A block of more than `block` vectors gives several rows, one for each piece that begins at `start`.
    """
    key = ["label", "dim"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = _Writer(root)
        for rows in whole_groups(batches, key):
            for start, end in zip(*group_edges(rows, key)):
                part = rows.iloc[start:end]
                counts = [np.asarray(x, dtype=np.int64) for x in part["counts"]]
                data = {
                    "files": part["path"].tolist(),
                    "at": part["at"].to_numpy(),
                    "n": part["n"].to_numpy(),
                    "node": part["node"].to_numpy(),
                    "block": np.repeat(np.arange(len(part)), [len(x) for x in counts]),
                    "cell": np.concatenate([np.asarray(x, dtype=np.int64) for x in part["cells"]]),
                    "start": np.concatenate([np.cumsum(x) - x for x in counts]),
                    "count": np.concatenate(counts),
                }
                data = pickle.dumps(data)
                begins = [(own, start) for own, n in enumerate(part["n"].tolist()) for start in range(0, n, block)]
                found = pd.DataFrame(begins, columns=["own", "start"])
                label, dim = (int(part[k].iloc[0]) for k in key)
                found = found.assign(label=label, dim=dim, path=out.path, at=out.write(data), size=len(data))
                yield found[[*key, "path", "at", "size", "own", "start"]]
        out.close()

    first, last = F.element_at("cells", 1), F.element_at("cells", -1)
    dealt = blocks.withColumns({"first": first, "last": last}).repartition(*key)
    dealt = dealt.sortWithinPartitions(*key, "first", "last", "node")
    return dealt.mapInPandas(run, "label int, dim int, path string, at long, size long, own int, start int")


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of places a and b; label holds the smallest place of each one's set."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, nearer := label[label]):
            label[:] = nearer


class _Lists:
    """The blocks of one label and dimension, read where they lie."""

    def __init__(self, reader: _Reader, listed: dict, dim: int, index: MultiIndex):
        self.reader, self.dim, self.index = reader, dim, index
        self.files, self.at, self.n, self.node = (listed[k] for k in ("files", "at", "n", "node"))
        self.block, self.cell, self.start, self.count = (listed[k] for k in ("block", "cell", "start", "count"))
        self.width = 4 * index.axes.shape[1]  # bytes of a vector's places on the axes

    def part(self, k: int, skip: int, size: int) -> bytes:
        return self.reader.read(self.files[k], int(self.at[k]) + skip, size)

    def vectors(self, k: int, start: int, end: int) -> np.ndarray:
        """Unit vectors from `start` to `end` of block k."""
        skip = int(self.n[k]) * (self.width + 8) + 4 * self.dim * start
        return _units(_rows([self.part(k, skip, 4 * self.dim * (end - start))], self.dim))

    def copies(self, k: int, start: int, end: int) -> np.ndarray:
        return np.frombuffer(self.part(k, int(self.n[k]) * self.width + 8 * start, 8 * (end - start)), dtype="<i8")

    def axes(self, k: int, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Places on the axes, and minus half their squares."""
        on = np.frombuffer(self.part(k, self.width * start, self.width * (end - start)), dtype="<f4").reshape(end - start, -1)
        return on, ((on.astype(np.float64) ** 2).sum(axis=1) / -2).astype(np.float32)


class _Piece:
    """Vectors of a block, from `start` to `end`, and what links them to those they have met."""

    def __init__(self, lists: _Lists, k: int, start: int, end: int):
        self.lists, self.k, self.start, self.end = lists, k, start, end
        self.node = int(lists.node[k]) + start
        self.unit, self.copies = lists.vectors(k, start, end), lists.copies(k, start, end)
        on, half = lists.axes(k, start, end)
        self.axes = np.column_stack([on, half, np.ones_like(half)])
        self.label, self.links = np.arange(end - start), np.zeros(end - start, dtype=np.int64)

    def meet(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Arrays (a, b, n) as in `link_vectors`, b -1 for null."""
        lists, index = self.lists, self.lists.index
        width = len(index.books[1])
        first, second = (np.ascontiguousarray(x.T, np.float32) ** 2 for x in index.bounds(self.unit)[1])
        limit = np.float32(index.stop**2 * (1 + 1e-6))  # single precision, rounded up
        later = np.flatnonzero(lists.block >= self.k)
        code1, code2 = lists.cell[later] // width, lists.cell[later] % width
        some1, some2 = np.unique(code1), np.unique(code2)
        # the traversal of all vectors of the piece at once, among the codes that occur
        least1, least2 = (
            np.sqrt(x[some].min(axis=1).astype(np.float64)) * (1 - 1e-6) for x, some in ((first, some1), (second, some2))
        )
        visited = np.zeros(len(some1) * len(some2), dtype=bool)
        visited[index.visits(least1, least2)] = True
        wanted = visited[np.searchsorted(some1, code1) * len(some2) + np.searchsorted(some2, code2)]
        later = later[wanted]
        for own in np.split(later, np.flatnonzero(np.diff(lists.block[later])) + 1):
            if not len(own):
                continue
            k = int(lists.block[own[0]])
            n = int(lists.n[k])
            # of the own block, this piece itself and what lies behind it
            others = [_Other(self, k, *x) for x in ([(self.start, self.end), (self.end, n)] if k == self.k else [(0, n)])]
            for runs in np.split(own, np.flatnonzero(np.diff(lists.cell[own] // width)) + 1):
                code = int(lists.cell[runs[0]]) // width
                some = np.flatnonzero(first[code] <= limit)
                visits = first[code][some] + second[lists.cell[runs] % width][:, some] <= limit
                starts = lists.start[runs]
                for visit, start, end in zip(visits, starts.tolist(), (starts + lists.count[runs]).tolist()):
                    rows = some[visit]
                    if len(rows):
                        for other in others:
                            other.meet(rows, start, end, threshold)
            for other in others:
                some = np.flatnonzero(other.links)
                if len(some) and not other.same:
                    yield other.node + some, self.node + other.to[some], other.links[some]
        some = np.flatnonzero(self.links)
        apart = self.label[some] != some
        yield self.node + some, np.where(apart, self.node + self.label[some], -1), self.links[some]


class _Other:
    """Vectors of a block that a piece meets, or the piece itself."""

    def __init__(self, home: _Piece, k: int, start: int, end: int):
        self.home, self.k, self.start, self.end = home, k, start, end
        self.same = k == home.k and start == home.start
        self.node = int(home.lists.node[k]) + start
        self.links = home.links if self.same else np.zeros(end - start, dtype=np.int64)
        self.to = np.full(end - start, -1, dtype=np.int64)
        self.axes = self.copies = None

    def meet(self, rows: np.ndarray, start: int, end: int, threshold: float) -> None:
        """Vectors `rows` of the piece meet those of a cell, which lie from `start` to `end` of the block."""
        home, lists, unit = self.home, self.home.lists, None
        start, end = max(start, self.start) - self.start, min(end, self.end) - self.start
        if start >= end:
            return
        if self.axes is None:
            on, half = lists.axes(self.k, self.start, self.end)
            self.axes = np.column_stack([on, np.ones_like(half), half])
        here, close = home.axes[rows], -lists.index.stop**2 / 2 - COARSE
        for at in range(0, len(rows), LEFT):
            for to in range(start, end, RIGHT):
                x, y = rows[at : at + LEFT], np.arange(to, min(to + RIGHT, end))
                # minus half the squared distances on the axes
                near = here[at : at + LEFT] @ self.axes[to : to + RIGHT][: len(y)].T >= close
                if not np.count_nonzero(near):
                    continue
                if self.same:
                    near &= x[:, None] < y[None]
                if unit is None:
                    unit = home.unit[start:end] if self.same else lists.vectors(self.k, self.start + start, self.start + end)
                there = unit[to - start :][: len(y)]
                if np.count_nonzero(near) > near.size // 16:
                    near &= home.unit[x] @ there.T >= threshold
                    i, j = np.nonzero(near)
                else:
                    i, j = np.nonzero(near)
                    hit = np.einsum("ij,ij->i", home.unit[x[i]], there[j]) >= threshold
                    i, j = i[hit], j[hit]
                if len(i):
                    self.link(x, y, i, j)

    def link(self, x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        """Counts the links between x[i] of the piece and y[j], and unites them."""
        home = self.home
        if self.copies is None:
            self.copies = home.lists.copies(self.k, self.start, self.end)
        if len(i) < 4096:
            np.add.at(home.links, x[i], self.copies[y[j]])
            np.add.at(self.links, y[j], home.copies[x[i]])
        else:
            one = np.zeros((len(x), len(y)))  # sums of whole numbers, exact up to 2^53
            one[i, j] = 1
            home.links[x] += (one @ self.copies[y]).astype(np.int64)
            self.links[y] += (home.copies[x] @ one).astype(np.int64)
        if self.same:
            _unite(home.label, x[i], y[j])
            return
        fresh = self.to[y[j]] < 0
        self.to[y[j[fresh]]] = x[i[fresh]]
        _unite(home.label, x[i], self.to[y[j]])


def link_vectors(blocks: DataFrame, index: dict[int, MultiIndex], threshold: float, block: int = BLOCK) -> DataFrame:
    """Rows (a, b, n): n links of vector a; b null or a vector of its component.

    blocks: those of `lay_vectors`. A piece of `block` vectors goes its traversal once: it
    visits all cells in which one of its vectors can have a link, and in each of them those
    vectors alone are compared, with the vectors of the cell that lie behind them, so that
    each pair is compared once. Vectors are read where they lie and never copied, and pairs
    are not laid out: a task returns sums of links and a spanning forest.
    """
    listed = settle(directories(blocks, work_dir(blocks.sparkSession, "lists"), block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, known = _Reader(), None
        for batch in batches:
            for row in batch.to_pylist():
                if known != (row["path"], row["at"]):
                    known = row["path"], row["at"]
                    lists = _Lists(reader, pickle.loads(reader.read(*known, row["size"])), row["dim"], index[row["dim"]])
                end = min(row["start"] + block, int(lists.n[row["own"]]))
                for a, b, n in _Piece(lists, row["own"], row["start"], end).meet(threshold):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=b < 0), pa.array(n)], ["a", "b", "n"])

    return listed.repartition(min(max(listed.count(), 1), TASKS)).mapInArrow(run, "a long, b long, n long")


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Vectors of one label (not null) and one dimension link at a cosine of `threshold` or
    more, in double precision; n_links counts the other rows linked directly,
    component_id is the smallest id reachable, the own one included, kept says whether it
    is the own id. A vector that is null, empty, zero or holds null or non-finite
    components links with nothing. Equal vectors are one until the end, with their number,
    so a vector that a third of all rows share is compared once; its ids go through one task.
    A null id takes part and ranks behind all ids. An empty table gives an empty result.

    Every pair that is reported is verified, and every link is found (see `fit`).
    """
    rows = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("int").alias("label"),
        F.col(vector_col).cast("array<float>").alias("v"),
    )
    finite = F.forall("v", lambda x: F.coalesce(x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    good = F.coalesce(
        F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    rows = rows.withColumn("good", good)

    index = fit(rows.filter("good"), threshold)
    packed = pack_vectors(rows.filter("good"))
    laid = settle(lay_vectors(packed, index, work_dir(rows.sparkSession, "vectors")))  # fixes the node numbers
    members = laid.filter("path IS NULL").select("node", "vec_id")
    met = settle(link_vectors(laid.filter("path IS NOT NULL"), index, threshold))
    equal = members.groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    counts = met.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    found = components(met.filter("b IS NOT NULL").select("a", "b"))
    grouped = equal.join(found, "node", "left").withColumn("root", F.coalesce("component_id", "node")).drop("component_id")
    least = grouped.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    classes = grouped.join(least, "root").join(counts, "node", "left")
    classes = classes.select(
        "node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = [F.col("vec_id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id"]
    linked = members.join(classes, "node").select(*out)
    alone = rows.filter(~F.col("good")).select("vec_id", F.lit(0).alias("n_links"), F.col("vec_id").alias("component_id"))
    whole = linked.unionByName(alone.select(*out))
    return whole.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op7_embeddings": op7_embeddings}
