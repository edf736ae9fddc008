"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors have cosine >= t exactly when their squared distance is at most 2 - 2t.
A fixed rotation spreads that distance evenly; the rotated vectors are split into at
most ``MOST_BLOCKS`` blocks of dimensions, and each block gets the share of the squared
distance that its dimensions are of all.  If two vectors are within the whole budget,
some block is within its own (pigeonhole), so the union of the blocks' range joins holds
every linked pair.

What is dealt out for the joins is a sketch: the rotated vector in one byte a dimension
(two where the budget is small), its scale, and how far it is from the vector in each
block.  By the triangle inequality two sketches bound the distance of their vectors from
both sides.  Most pairs are decided by the bounds; the rest, within the sketches' error of
the threshold, are verified on the whole vectors.

A block's range join: its vectors are put in cells, each by the nearest of some pivots
(means of a sample; they decide the cost, not the result), and cells in chunks of bounded
bytes, a large cell in several.  Every two chunks meet in one task, which reads both from
the table of chunks (a cartesian product of its rows): no vector is copied for the tiles it
meets, so disk is in proportion to the input.  Of two cells only vectors are compared that
are near each other along the line between the pivots; block distances are then matrix
products.  Pairs never leave a task but for those to verify, only counts of links and a
spanning forest of them do.  A pair near in several blocks counts in the first of them.

Equal vectors are one node with a number of copies (a 64-bit digest of the components).

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing and are kept; vectors of different lengths do not link; a null id takes
part, but the id of a component is the least that is not null; equal rows are copies of
each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import clear_scratch
from .common import map_batches, materialize, scratch_folder, ship_package
from .graph import connected_components, local_forest

BLOCK_DIMS = 22
MOST_BLOCKS = 3  # each is a copy of the sketches
TILE_BYTES = 20 << 20  # of a chunk
LEAST_ROWS = 64  # of a chunk, whatever its bytes
GROUP_ROWS = 4096  # vectors of one length that are joined in one task
CHUNKS = 6  # at least, of more vectors than that
CELL_ROWS = 2048
MOST_CELLS = 4096
PIVOT_BYTES = 8 << 20
ROUNDS = 4  # of the pivots' means
WIDE_BELOW = 0.3  # radius below which a sketch has two bytes a dimension
SLACK = 1e-9  # of squared distances, for rounding
COARSE_SLACK = 1e-5  # the same where single precision chooses candidates
SURE_SLACK = 1e-7  # of distances that bounds decide
STRIP_BYTES = 4 << 20
STEPS = 14  # of the distances along a line
SLAB = 1 << 21  # of such distances at once
FAR = np.float32(1e9)  # beyond all of them
PAIRS = 1 << 13
SEED = 20240101


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int) -> list[tuple[int, int]]:
    """First and end dimension of each block, of nearly equal sizes."""
    n = min(MOST_BLOCKS, -(-dims // BLOCK_DIMS))
    cuts = [round(i * dims / n) for i in range(n + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def budgets(dims: int, threshold: float) -> np.ndarray:
    """The squared distance each block may have: its dimensions' share of the whole."""
    return np.array([(2 - 2 * threshold) * (e - b) / dims for b, e in blocks(dims)])


def _radius(threshold: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * threshold)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The bytes of a binary column without nulls, all values of one width: a row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    start = pa.Array.from_buffers(pa.int32(), len(column) + 1, [None, column.buffers()[1]], offset=column.offset)[0].as_py()
    return np.frombuffer(column.buffers()[2], np.uint8)[start : start + len(column) * width].reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary column of the bytes of each row."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _unit(raw: np.ndarray, kind: str) -> np.ndarray:
    """Unit vectors of rows of components' bytes."""
    part = raw.view(kind).astype(np.float64)
    part /= np.abs(part).max(axis=1, keepdims=True)
    return part / np.sqrt((part**2).sum(axis=1, keepdims=True))


def _nodes(kind: str):
    """Digest, length and components of each row's vector; nulls where it has no direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, ids = batch.column("vec"), batch.column("vec_id")
            starts = column.offsets.to_numpy()
            sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(starts), 0)
            parts = column.values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            none = [np.flatnonzero(sizes == 0)]
            for size in np.unique(sizes[sizes > 0]):
                rows = np.flatnonzero(sizes == size)
                vecs = parts[starts[rows][:, None] + np.arange(size)].astype(kind) + np.zeros(1, kind)  # no -0
                good = np.isfinite(vecs).all(axis=1) & (vecs != 0).any(axis=1)
                none.append(rows[~good])
                rows, vecs = rows[good], vecs[good]
                if not len(rows):
                    continue
                raw, width = vecs.tobytes(), int(size) * vecs.itemsize
                digest = b"".join(hashlib.blake2b(raw[k : k + width], digest_size=8).digest() for k in range(0, len(raw), width))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), pa.array(np.frombuffer(digest, "<i8")), pa.array(np.full(len(rows), size, np.int32)), _binary(vecs)], names=["vec_id", "node", "dims", "raw"]
                )
            rows = np.concatenate(none)
            if len(rows):
                nulls = [pa.nulls(len(rows), t) for t in (pa.int64(), pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), *nulls], names=["vec_id", "node", "dims", "raw"])

    return run


def _levels(threshold: float) -> np.dtype:
    return np.dtype(np.int8 if _radius(threshold) >= WIDE_BELOW else np.int16)


def _row(dims: int, level: np.dtype) -> np.dtype:
    """A sketch: components in units of the scale, and each block's error."""
    return np.dtype([("q", level, (dims,)), ("scale", "<f4"), ("off", "<f4", (len(blocks(dims)),))])


def _sketch(units: np.ndarray, level: np.dtype) -> np.ndarray:
    dims = units.shape[1]
    turned = units @ rotation(dims)
    out = np.zeros(len(units), _row(dims, level))
    out["scale"] = np.nextafter((np.abs(turned).max(axis=1) / np.iinfo(level).max).astype(np.float32), np.float32(1))
    scale = out["scale"].astype(np.float64)[:, None]
    near = np.rint(turned / scale)
    out["q"] = near
    apart = np.add.reduceat((turned - near * scale) ** 2, [b for b, _ in blocks(dims)], axis=1)
    out["off"] = np.sqrt(apart) * (1 + 1e-6) + 1e-12
    return out


def _block(rows: np.ndarray, begin: int, end: int) -> np.ndarray:
    return rows["q"][:, begin:end] * rows["scale"][:, None]


def _nearest(part: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    half, out = (pivots**2).sum(axis=1) / 2, np.zeros(len(part), np.int64)
    step = max(1, STRIP_BYTES // (4 * len(pivots)))
    for k in range(0, len(part), step):
        out[k : k + step] = (part[k : k + step] @ pivots.T - half).argmax(axis=1)
    return out


def _pivots(part: np.ndarray, count: int) -> np.ndarray:
    """Means of the parts of a sample."""
    pivots = part[np.sort(np.random.default_rng(SEED).choice(len(part), count, replace=False))].copy()
    for _ in range(ROUNDS if count > 1 else 0):
        cell = _nearest(part, pivots)
        order, n = np.argsort(cell, kind="stable"), np.bincount(cell, minlength=count)
        some = np.flatnonzero(n)
        pivots[some] = np.add.reduceat(part[order], (np.cumsum(n) - n)[some], axis=0) / n[some, None]
    return pivots


def _sketches(kind: str, level: np.dtype, sent):
    """The sketch of each vector, and its cell in each block where its length has pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = sent.value
        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            for dims in np.unique(sizes).tolist():
                rows = pa.array(np.flatnonzero(sizes == dims))
                raw = batch.column("raw").take(rows)
                sketch = _sketch(_unit(_matrix(raw, dims * np.dtype(kind).itemsize), kind), level)
                cells = np.zeros((len(rows), len(blocks(dims))), np.int16)
                for b, (begin, end) in enumerate(blocks(dims) if dims in pivots else []):
                    cells[:, b] = _nearest(_block(sketch, begin, end), pivots[dims][b])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(rows) for c in ("vec_id", "node", "dims")), _binary(cells), _binary(sketch.view(np.uint8).reshape(len(rows), -1))],
                    names=["vec_id", "node", "dims", "cells", "sketch"],
                )

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of each length, block and cell."""
    for batch in batches:
        sizes = batch.column("dims").to_numpy()
        for dims in np.unique(sizes).tolist():
            n = len(blocks(dims))
            cells = _matrix(batch.column("cells").take(pa.array(np.flatnonzero(sizes == dims))), 2 * n).view(np.int16)
            for b in range(n):
                cell, times = np.unique(cells[:, b], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cell), dims, np.int32)), pa.array(np.full(len(cell), b, np.int32)), pa.array(cell.astype(np.int32)), pa.array(times.astype(np.int64))],
                    names=["dims", "block", "cell", "n"],
                )


def _chunks(counts: np.ndarray, fit: int) -> tuple[np.ndarray, np.ndarray]:
    """First chunk of each cell and number of its chunks."""
    first, parts = np.zeros(len(counts), np.int64), -(-counts // fit)
    at, room = -1, 0
    for cell in np.flatnonzero(counts):
        if parts[cell] > 1:
            first[cell], at, room = at + 1, at + parts[cell], 0
        else:
            if counts[cell] > room:
                at, room = at + 1, fit
            first[cell], room = at, room - counts[cell]
    return first, np.maximum(parts, 1)


def _deal(block: int, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, parts = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            width = len(batch.column("cells")[0].as_py())
            cell = _matrix(batch.column("cells"), width).view(np.int16)[:, block].astype(np.int64)
            chunk = first[cell] + batch.column("node").to_numpy() % parts[cell]
            columns = [pa.array(chunk.astype(np.int32)), pa.array(cell.astype(np.int32)), *(batch.column(c) for c in ("node", "copies", "sketch"))]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "cell", "node", "copies", "sketch"])

    return run


def _packed(table: pa.Table) -> pa.Table:
    """A chunk in one value: columns one after the other, by cell."""
    table = table.take(pa.array(np.lexsort((table["node"].to_numpy(), table["cell"].to_numpy()))))
    width = len(table["sketch"][0].as_py())
    columns = (table["cell"].to_numpy(), table["node"].to_numpy(), table["copies"].to_numpy(), _matrix(table["sketch"], width))
    return pa.table({"chunk": table["chunk"].slice(0, 1), "n": pa.array([len(table)], pa.int32()), "rows": pa.array([b"".join(c.tobytes() for c in columns)], pa.binary())})


class _Side:
    """Vectors of a chunk, sorted by cell."""

    def __init__(self, cell: np.ndarray, node: np.ndarray, copies: np.ndarray, rows: np.ndarray):
        self.node, self.copies, self.rows = node, copies, rows
        self.starts = np.flatnonzero(np.diff(cell, prepend=-1))
        self.cells = cell[self.starts]
        self.ends = np.append(self.starts[1:], len(cell))
        self.links = np.zeros(len(node), np.int64)

    @classmethod
    def of(cls, packed, n: int, dims: int, level: np.dtype) -> _Side:
        cell, node, copies = np.frombuffer(packed, "<i4", n), np.frombuffer(packed, "<i8", n, 4 * n), np.frombuffer(packed, "<i8", n, 12 * n)
        return cls(cell, node, copies, np.frombuffer(packed, _row(dims, level), n, 20 * n))

    def place(self, block: int, begin: int, end: int) -> None:
        self.part = _block(self.rows, begin, end)
        self.off = self.rows["off"][:, block]
        half, one = (self.part.astype(np.float64) ** 2).sum(axis=1, keepdims=True).astype(np.float32) / 2, np.ones((len(self.part), 1), np.float32)
        # One product gives z.z' - |z|^2 / 2 - |z'|^2 / 2, minus half the squared distance.
        self.left, self.right = np.hstack([self.part, -half, one]), np.hstack([self.part, one, -half])
        self.most_off = np.maximum.reduceat(self.off, self.starts)


FOUND = "a long, b long, links long"  # a node's links; an edge of the forest; a pair to verify has -1


def _by_step(distances: np.ndarray, cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of distances below STEPS, by cell and whole step, and how many each cell has up to each."""
    some = np.flatnonzero(distances < STEPS)
    key = cell[some] * STEPS + distances[some].astype(np.int64)
    ends = np.cumsum(np.bincount(key, minlength=cells * STEPS).reshape(-1, STEPS), axis=1)
    return some[np.argsort(key.astype(np.uint16) if cells * STEPS < 1 << 16 else key, kind="stable")], ends


class _Meeting:
    """All linked pairs of two chunks of a block, or of one."""

    def __init__(self, dims: int, threshold: float):
        self.dims, self.cuts, self.limit = dims, [b for b, _ in blocks(dims)], np.sqrt(np.maximum(0, budgets(dims, threshold)) + SLACK)
        self.radius = _radius(threshold)
        self.buffer = np.empty(STRIP_BYTES // 4, np.float32)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.open: list[tuple[np.ndarray, np.ndarray]] = []

    def verify(self, x: np.ndarray, y: np.ndarray) -> None:
        one, two, block = self.one, self.two, self.block
        for k in range(0, len(x), PAIRS):
            i, j = x[k : k + PAIRS], y[k : k + PAIRS]
            a, b = one.rows[i], two.rows[j]
            gap = a["q"] * a["scale"].astype(np.float64)[:, None]
            gap -= b["q"] * b["scale"].astype(np.float64)[:, None]
            apart = np.add.reduceat(gap**2, self.cuts, axis=1)
            off = a["off"].astype(np.float64), b["off"].astype(np.float64)
            within = apart <= (self.limit + (off[0] + off[1])) ** 2
            first = within[:, block] & ~within[:, :block].any(axis=1)
            error = (np.sqrt((off[0] ** 2).sum(axis=1)) + np.sqrt((off[1] ** 2).sum(axis=1)))[first]
            far, i, j = np.sqrt(apart.sum(axis=1))[first], i[first], j[first]
            sure = far + error <= self.radius - SURE_SLACK
            unsure = ~sure & (far - error <= self.radius + SURE_SLACK)
            if unsure.any():
                self.open.append((one.node[i[unsure]], two.node[j[unsure]]))
            i, j = i[sure], j[sure]
            if len(i):
                np.add.at(one.links, i, two.copies[j])
                np.add.at(two.links, j, one.copies[i])
                self.edges.append(local_forest(one.node[i], two.node[j]))

    def compare(self, x: slice, y: slice, least: np.float32) -> None:
        """Verifies near ones of all rows ``x`` and ``y``; of one chunk with itself each pair once."""
        same, width = self.one is self.two, y.stop - y.start
        step = max(1, STRIP_BYTES // (4 * width))
        for at in range(x.start, x.stop, step):
            begin = at if same else y.start
            near = np.flatnonzero((self.one.left[at : min(at + step, x.stop)] @ self.two.right[begin : y.stop].T >= least).ravel())
            if len(near):
                i, j = np.divmod(near, y.stop - begin)
                i, j = at + i, begin + j
                self.verify(*((i[i < j], j[i < j]) if same else (i, j)))

    def sort_out(self, strips: list[tuple[int, int, np.ndarray, np.ndarray]], size: int, least: np.float32) -> None:
        """Verifies near ones of the strips of products in the buffer."""
        near = np.flatnonzero(self.buffer[:size] >= least)
        if len(near):
            of = np.searchsorted([s[0] for s in strips], near, "right") - 1
            for k in np.unique(of):
                begin, width, x, y = strips[k]
                i, j = np.divmod(near[of == k] - begin, width)
                self.verify(x[i], y[j])

    def cross(self, x: np.ndarray, x_ends: list[int], y: np.ndarray, right: np.ndarray, y_ends: list[int], least: np.float32) -> None:
        """Verifies near ones of rows whose steps are less than STEPS together; ``x_ends`` and
        ``y_ends`` are how many have each step at most."""
        left, strips, size = self.one.left[x], [], 0
        begin, widest = 0, 0
        for step, end in enumerate(x_ends):
            widest = max(widest, y_ends[STEPS - 1 - step])
            if end - begin < LEAST_ROWS and step < STEPS - 1:  # some more in one product
                continue
            if widest > len(self.buffer):
                self.buffer = np.concatenate([self.buffer[:size], np.empty(widest, np.float32)])
            while begin < end and widest:
                most = (len(self.buffer) - size) // widest
                if not most:
                    self.sort_out(strips, size, least)
                    strips, size = [], 0
                    continue
                stop = min(end, begin + most)
                out = self.buffer[size : size + (stop - begin) * widest].reshape(-1, widest)
                np.matmul(left[begin:stop], right[:widest].T, out=out)
                strips.append((size, widest, x[begin:stop], y))
                size, begin = size + out.size, stop
            begin, widest = end, 0
        if strips:
            self.sort_out(strips, size, least)

    def join(self, one: _Side, two: _Side, block: int, pivots: np.ndarray) -> None:
        self.one, self.two, self.block = one, two, block
        begin, end = blocks(self.dims)[block]
        one.place(block, begin, end)
        if two is not one:
            two.place(block, begin, end)
        reach = np.float32(self.limit[block] + COARSE_SLACK)
        half = (pivots**2).sum(axis=1) / 2
        mine, theirs, sizes = pivots[two.cells], half[two.cells], two.ends - two.starts
        own = np.einsum("ij,ij->i", two.part, np.repeat(mine, sizes, axis=0)) - np.repeat(theirs, sizes)
        of, n_cells = np.repeat(np.arange(len(sizes)), sizes), len(sizes)
        slab = max(LEAST_ROWS, SLAB // n_cells)
        for k, cell in enumerate(one.cells):
            low = (-((self.limit[block] + one.most_off[k] + two.most_off) ** 2 + COARSE_SLACK) / 2).astype(np.float32)
            for m in np.flatnonzero(two.cells == cell):
                self.compare(slice(one.starts[k], one.ends[k]), slice(two.starts[m], two.ends[m]), low[m])
            others = two.cells != cell
            if one is two:
                others[:k] = False
            if not others.any():
                continue
            between = np.sqrt(((mine - pivots[cell]) ** 2).sum(axis=1))
            inverse = np.where(between > 1e-6, 1 / np.maximum(between, 1e-6), 0).astype(np.float32)
            # Along the line between two pivots, the vectors' distances from the middle, less their errors: a
            # pair is no nearer than the sum.
            behind = (own - (two.part @ pivots[cell] - half[cell])) * inverse[of] - two.off
            least_behind = np.minimum.reduceat(behind, two.starts)
            for at in range(one.starts[k], one.ends[k], slab):
                rows = slice(at, min(at + slab, one.ends[k]))
                part = one.part[rows]
                ahead = mine @ part.T
                np.subtract(part @ pivots[cell] - half[cell], ahead, out=ahead)
                ahead += theirs[:, None]
                ahead *= inverse[:, None]
                ahead -= one.off[rows]
                least_ahead = ahead.min(axis=1)
                left_over = reach - least_ahead - least_behind
                meets = others & (left_over > 0)
                if not meets.any():
                    continue
                # Both sides in steps of what is left over, counted from the nearest vector.
                scale = np.where(meets, STEPS / np.where(meets, left_over, 1), 1).astype(np.float32)
                ahead -= np.where(meets, least_ahead, -FAR)[:, None]
                ahead *= scale[:, None]
                x, x_ends = _by_step(ahead.ravel(), np.repeat(np.arange(n_cells), ahead.shape[1]), n_cells)
                y, y_ends = _by_step((behind - np.where(meets, least_behind, -FAR).astype(np.float32)[of]) * scale[of], of, n_cells)
                x = at + x % ahead.shape[1]
                right, x_at, y_at = two.right[y], 0, 0
                for m, (a, b) in enumerate(zip(x_ends.tolist(), y_ends.tolist(), strict=True)):
                    if a[-1] and b[-1]:
                        here = slice(y_at, y_at + b[-1])
                        self.cross(x[x_at : x_at + a[-1]], a, y[here], right[here], b, low[m])
                    x_at, y_at = x_at + a[-1], y_at + b[-1]

    def found(self) -> pa.RecordBatch:
        sides = [self.one] if self.one is self.two else [self.one, self.two]
        nodes, links = np.concatenate([s.node[s.links > 0] for s in sides]), np.concatenate([s.links[s.links > 0] for s in sides])
        a, b = local_forest(*(np.concatenate(c) for c in zip(*self.edges, strict=True))) if self.edges else (nodes[:0], nodes[:0])
        c, d = (np.concatenate(c) for c in zip(*self.open, strict=True)) if self.open else (nodes[:0], nodes[:0])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([nodes, a, c])),
                pa.concat_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(np.concatenate([b, d]))]),
                pa.concat_arrays([pa.array(links), pa.nulls(len(a), pa.int64()), pa.array(np.full(len(c), -1, np.int64))]),
            ],
            names=["a", "b", "links"],
        )


def _met(dims: int, threshold: float, level: np.dtype, block: int, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = sent.value[dims][block]
        for batch in batches:
            for k in range(batch.num_rows):
                i, n, j, m = (batch.column(c)[k].as_py() for c in ("i", "n", "j", "m"))
                one = _Side.of(batch.column("x")[k].as_buffer(), n, dims, level)
                two = one if i == j else _Side.of(batch.column("y")[k].as_buffer(), m, dims, level)
                meeting = _Meeting(dims, threshold)
                meeting.join(one, two, block, pivots)
                yield meeting.found()

    return run


def _joined(threshold: float, level: np.dtype):
    """All linked pairs of a length with few vectors."""

    def run(table: pa.Table) -> pa.Table:
        dims = table["dims"][0].as_py()
        row = _row(dims, level)
        side = _Side(np.zeros(len(table), np.int64), table["node"].to_numpy(), table["copies"].to_numpy(), _matrix(table["sketch"], row.itemsize).view(row).ravel())
        meeting = _Meeting(dims, threshold)
        for b, (begin, end) in enumerate(blocks(dims)):
            meeting.join(side, side, b, np.zeros((1, end - begin), np.float32))
        return pa.Table.from_batches([meeting.found()])

    return run


def _verified(threshold: float, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            for dims in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dims)
                for k in range(0, len(rows), PAIRS):
                    some = batch.take(pa.array(rows[k : k + PAIRS]))
                    x, y = (_unit(_matrix(some.column(c), dims * np.dtype(kind).itemsize), kind) for c in ("raw_a", "raw_b"))
                    yield some.select(["a", "b"]).filter(pa.array(np.einsum("ij,ij->i", x, y) >= threshold))

    return run


def _collect_garbage(spark: SparkSession) -> None:
    """Has Spark remove the shuffle files of plans that are done: it does when the driver
    finds that nothing refers to them."""
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # a Spark Connect session has no handle to it
        pass


def _meet_chunks(sketches: DataFrame, dims: int, block: int, counts: np.ndarray, threshold: float, level: np.dtype, sent) -> DataFrame:
    """What the pairs of vectors of one length have in one block, a task for every two chunks."""
    spark = sketches.sparkSession
    fit = max(LEAST_ROWS, TILE_BYTES // (_row(dims, level).itemsize + 20))
    plan = spark.sparkContext.broadcast(_chunks(counts, min(fit, max(LEAST_ROWS, -(-int(counts.sum()) // CHUNKS)))))
    rows = sketches.where(F.col("dims") == dims).select("node", "copies", "cells", "sketch")
    dealt = map_batches(rows, _deal(block, plan), "chunk int, cell int, node long, copies long, sketch binary")
    path = scratch_folder(spark, "chunks")
    dealt.groupBy("chunk").applyInArrow(_packed, "chunk int, n int, rows binary").write.option("maxRecordsPerFile", 1).parquet(path)
    chunks = spark.read.schema("chunk int, n int, rows binary").parquet(path)
    one = chunks.select(F.col("chunk").alias("i"), "n", F.col("rows").alias("x"))
    two = chunks.select(F.col("chunk").alias("j"), F.col("n").alias("m"), F.col("rows").alias("y"))
    # Of (i, j) and (j, i) one, so that each row of the product has half of its tasks.
    pairs = one.join(two.hint("shuffle_replicate_nl"), F.expr("i = j or (i < j) = ((i + j) % 2 = 0)"))
    found = materialize(map_batches(pairs, _met(dims, threshold, level, block, sent), FOUND), "found")
    clear_scratch(spark, [path])
    _collect_garbage(spark)
    return found


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    spark = vectors.sparkSession
    ship_package(spark)
    single = vectors.schema[vec_col].dataType == T.ArrayType(T.FloatType(), vectors.schema[vec_col].dataType.containsNull) if isinstance(vectors.schema[vec_col].dataType, T.ArrayType) else False
    kind, level = "<f4" if single else "<f8", _levels(threshold)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec"))
    id_field = rows.schema["vec_id"]
    schema = T.StructType([id_field, T.StructField("node", T.LongType()), T.StructField("dims", T.IntegerType()), T.StructField("raw", T.BinaryType())])
    units = materialize(map_batches(rows, _nodes(kind), schema), "units")
    directed = units.where("node is not null")
    # Lengths of more vectors than one task joins: at most a row for each so many vectors.
    few = min(GROUP_ROWS, max(LEAST_ROWS, TILE_BYTES // 64))
    pivots: dict[int, list[np.ndarray]] = {}
    for dims, n in directed.groupBy("dims").count().where(F.col("count") > few).collect():
        cells = max(1, min(MOST_CELLS, n // CELL_ROWS, PIVOT_BYTES // (4 * dims)))
        # Digests are spread evenly: those of a range are a sample.
        sample = directed.where((F.col("dims") == dims) & (F.col("node") < -(1 << 63) + int((1 << 64) * min(0.999, 8 * cells / n)))).dropDuplicates(["node"])
        got = sample.select("node", "raw").toArrow().sort_by("node")
        part = (_unit(_matrix(got["raw"], dims * np.dtype(kind).itemsize), kind) @ rotation(dims)).astype(np.float32) if len(got) else np.zeros((1, dims), np.float32)
        pivots[dims] = [_pivots(np.ascontiguousarray(part[:, b:e]), min(cells, max(1, len(part) // 4))) for b, e in blocks(dims)]
    sent = spark.sparkContext.broadcast(pivots)
    schema = T.StructType([id_field, *(T.StructField(n, t) for n, t in (("node", T.LongType()), ("dims", T.IntegerType()), ("cells", T.BinaryType()), ("sketch", T.BinaryType())))])
    sketches = materialize(
        map_batches(directed, _sketches(kind, level, sent), schema)
        .groupBy("node")
        .agg(*(F.first(c).alias(c) for c in ("dims", "cells", "sketch")), F.count("*").alias("copies"), F.min("vec_id").alias("least")),
        "sketches",
    )
    _collect_garbage(spark)
    small = sketches.where(~F.col("dims").isin(list(pivots))) if pivots else sketches
    found = [materialize(small.select("dims", "node", "copies", "sketch").groupBy("dims").applyInArrow(_joined(threshold, level), FOUND), "found")]
    if pivots:
        counts = map_batches(sketches.where(F.col("dims").isin(list(pivots))).select("dims", "cells"), _count, "dims int, block int, cell int, n long")
        of = {(d, b): np.zeros(len(p), np.int64) for d in pivots for b, p in enumerate(pivots[d])}
        for dims, block, cell, n in counts.groupBy("dims", "block", "cell").agg(F.sum("n")).collect():  # a row for each occupied cell
            of[dims, block][cell] = n
        found += [_meet_chunks(sketches, dims, block, n, threshold, level, sent) for (dims, block), n in of.items()]
    found = reduce(DataFrame.union, found)
    nodes = sketches.select("node", "copies", "least")
    links, edges = found.where("links > 0").select(F.col("a").alias("node"), "links"), found.where("links is null").select("a", "b")
    unsure = found.where("links = -1").select("a", "b")
    if not unsure.isEmpty():
        ends = unsure.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        whole = materialize(directed.join(ends, "node", "left_semi").groupBy("node").agg(F.first("dims").alias("dims"), F.first("raw").alias("raw")).join(nodes.select("node", "copies"), "node"), "whole")
        side = lambda end: whole.select(F.col("node").alias(end), *([F.col("dims")] if end == "a" else []), F.col("raw").alias(f"raw_{end}"))
        pairs = unsure.join(side("a"), "a").join(side("b"), "b").select("a", "b", "dims", "raw_a", "raw_b")
        linked = materialize(map_batches(pairs, _verified(threshold, kind), "a long, b long"), "linked")
        both = linked.union(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = links.union(both.join(nodes.select(F.col("node").alias("b"), F.col("copies").alias("links")), "b").select(F.col("a").alias("node"), "links"))
        edges = edges.union(linked)
    links = links.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(edges)
    rooted = nodes.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(least, "root").join(links, "node", "left").select(F.col("node").alias("v"), "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return units.select("vec_id", "node").join(named, F.col("node") == F.col("v"), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )
