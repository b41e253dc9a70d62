"""Vector codes by product quantisation, with memoised grid cells for the nearest entry.

A part of a vector lies in a coarse grid cell. Of the codebook's entries, one whose least distance
to the cell's box is above another's largest distance to it is dominated: it cannot be nearest to
anything in the box. As the difference of two squared distances is linear in the point, its least
value over the box tells more such entries. Those that are left are worked out once per cell, kept
under the cell's hash, and only they are compared exactly with the parts that fall into the cell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import join_groups, named, schema_of, staged
from wattledger.llm.vectors import matrix, scaled, usable, widened

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Width of a grid cell, in whole units of a component.
CELL = 768
# Cells that a worker remembers for one part; beyond that it starts afresh, so memory stays bounded.
REMEMBERED_CELLS = 50_000
# Whole components up to this give squared distances that fit 64 bits.
MOST = 1 << 26

_FACTORS = np.random.default_rng(12).integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)


class Grid:
    """The remembered cells of one part's codebook."""

    def __init__(self, entries: np.ndarray, cell: int, most_cells: int = REMEMBERED_CELLS) -> None:
        self.entries, self.cell, self.most_cells = entries, cell, most_cells
        # How far the difference of two entries' squared distances varies over a box, halved.
        self.spread = (cell - 1) * np.abs(entries[:, None, :] - entries[None, :, :]).sum(axis=2)
        self.forget()

    def forget(self) -> None:
        self.place: dict[int, int] = {}
        self.cells = np.zeros((0, self.entries.shape[1]), dtype=np.int64)
        self.open = np.zeros((0, len(self.entries)), dtype=bool)

    def not_dominated(self, cells: np.ndarray) -> np.ndarray:
        """Per cell, the entries that no other one is nearer than over the whole box."""
        low = cells * self.cell
        high = low + self.cell - 1
        least = np.zeros((len(cells), len(self.entries)), dtype=np.int64)
        largest = np.zeros_like(least)
        for axis in range(cells.shape[1]):
            at, a, b = self.entries[:, axis][None, :], low[:, axis, None], high[:, axis, None]
            least += np.maximum(0, np.maximum(a - at, at - b)) ** 2
            largest += np.maximum(np.abs(at - a), np.abs(at - b)) ** 2
        kept = least <= largest.min(axis=1, keepdims=True)
        # d(x, e) - d(x, f) = at(e) - at(f) for the box's middle, give or take the spread.
        middle = (self.entries**2).sum(axis=1) - (low + high) @ self.entries.T
        for other in range(len(self.entries)):
            kept &= middle - middle[:, other, None] <= self.spread[other]
        return kept

    def candidates(self, points: np.ndarray) -> np.ndarray:
        """Per point, the entries that are left of its cell."""
        cells = points // self.cell
        hashes = (cells.astype(np.uint64) * _FACTORS[: cells.shape[1]]).sum(axis=1, dtype=np.uint64)
        keys, first, of_key = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.place) + len(keys) > self.most_cells:
            self.forget()
        new = np.array([i for i, key in enumerate(keys.tolist()) if key not in self.place], dtype=np.int64)
        if len(new):
            self.place.update(zip(keys[new].tolist(), range(len(self.cells), len(self.cells) + len(new))))
            self.cells = np.concatenate([self.cells, cells[first[new]]])
            self.open = np.concatenate([self.open, self.not_dominated(cells[first[new]])])
        known = np.array([self.place[key] for key in keys.tolist()], dtype=np.int64)[of_key]
        found = self.open[known]
        # Two cells under one hash: the one that is not remembered keeps every entry.
        found[(self.cells[known] != cells).any(axis=1)] = True
        return found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per point, its nearest entry (the lower one among ties) and the squared distance."""
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, entry = np.nonzero(self.candidates(points))
        distance = np.zeros(len(row), dtype=np.int64)
        for axis in range(points.shape[1]):
            distance += (points[row, axis] - self.entries[entry, axis]) ** 2
        # Every point has a candidate, so its pairs start where its row number first stands.
        start = np.searchsorted(row, np.arange(len(points)))
        best = np.minimum.reduceat(distance * len(self.entries) + entry, start)
        return best % len(self.entries), best // len(self.entries)


def grids(codebooks: np.ndarray, cell: int) -> list[Grid]:
    return [Grid(entries, cell) for entries in codebooks]


def parts_of(lists: pa.Array, parts: int, width: int) -> np.ndarray:
    """The vectors as (row, part, position)."""
    rows = widened(matrix(lists, parts), width * parts)
    if rows.size and max(-int(rows.min()), int(rows.max())) > MOST:
        raise ValueError("a component is too large for 64-bit squared distances")
    return rows.reshape(len(rows), parts, width)


def next_codebooks(rows: DataFrame, codebooks: np.ndarray, cell: int) -> np.ndarray:
    """One round: each entry becomes the floor of the mean of the parts nearest to it.

    A task sums the parts of each entry and gives a row per cell of that table; Spark adds them,
    and the driver gets as many numbers as the codebooks hold, whatever the number of rows.
    """
    parts, entries, width = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = grids(codebooks, cell)
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            points = parts_of(batch.column(0), parts, width)
            for part, grid in enumerate(memo):
                code, _ = grid.nearest(points[:, part])
                np.add.at(total[part], code, np.pad(points[:, part], ((0, 0), (0, 1)), constant_values=1))
        used = np.flatnonzero(np.repeat(total[:, :, -1].ravel() > 0, width + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total.ravel()[used])], ["place", "v"]
        )

    summed = rows.select("v").mapInArrow(sums, "place int, v long").groupBy("place").agg(F.sum("v").alias("v"))
    total = np.zeros(parts * entries * (width + 1), dtype=np.int64)
    for row in summed.collect():  # at most one for each number of the codebooks and counts
        total[row.place] = row.v
    total = total.reshape(parts, entries, width + 1)
    made, used = codebooks.copy(), total[:, :, -1] > 0
    made[used] = total[used][:, :-1] // total[used][:, -1:]
    return made


def codebooks_of(rows: DataFrame, parts: int, entries: int, rounds: int, cell: int) -> np.ndarray:
    """The codebooks after `rounds` rounds, from the vectors of the smallest ids: (part, entry, position)."""
    widest = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    width = -(-widest // parts)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).toArrow()
    start = parts_of(first["v"].combine_chunks(), parts, width) if first.num_rows else np.zeros((0, parts, width), np.int64)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds if first.num_rows else 0):
        books = next_codebooks(rows, books, cell)
    return books


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, comma-joined."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def grid_codes(
    vectors: DataFrame,
    carry: list[str],
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    cell: int = CELL,
) -> DataFrame:
    """Every usable vector with its code: `carry`, code, error, label_error, codebooks_sha256.

    Components x count as floor(scale * x). A vector is cut into `parts` equal parts; a part's
    code is the nearest entry of its codebook, two hex digits each. Codebooks start from the
    smallest ids and take `rounds` rounds of assignment and floored means. `error` is the sum of
    the squared distances, `label_error` its sum over the rows of one label.

    Cases: vectors that are null or hold a null or non-finite component get no row; shorter
    vectors, or a length that is no multiple of `parts`, count as filled up with zeros; fewer
    vectors than `entries` make shorter codebooks; of equal ids the smaller vector starts first,
    null ids come last; null labels are one label; repeated rows are rows of their own; components
    too large for 64-bit distances raise; an empty table gives an empty result; `carry` may name
    any columns except those made here.
    """
    kept = vectors.where(usable(named(vec_col)))
    label = F.coalesce(F.concat(F.lit("="), named(label_col).cast("string")), F.lit(""))
    rows = staged(
        kept.select(
            *[named(c) for c in carry], label.alias("_label"), named(id_col).alias("_id"),
            scaled(named(vec_col), scale).alias("_v"),
        ),
        "codes-rows",
    )
    books = codebooks_of(rows.select(F.col("_id").alias("vec_id"), F.col("_v").alias("v")), parts, entries, rounds, cell)
    width = books.shape[2]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = grids(books, cell)
        for batch in batches:
            points = parts_of(batch.column(0), parts, width)
            found = [grid.nearest(points[:, part]) for part, grid in enumerate(memo)]
            codes = np.stack([code for code, _ in found], axis=1).astype(np.uint8)
            made = [pa.array([row.tobytes().hex() for row in codes], pa.string()), pa.array(sum(d for _, d in found))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], [*batch.schema.names[1:], "code", "error"])

    passed = [*carry, "_label"]
    coded = rows.select("_v", *[named(c) for c in passed]).mapInArrow(
        encode, schema_of(rows, passed, "code string, error long")
    )
    coded = staged(coded, "codes-coded")
    labels = coded.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows"))
    marked = join_groups(coded, staged(labels, "codes-labels"), "_label", "_rows")
    return marked.select(
        *[named(c) for c in carry], "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
