"""Exact top-k by inner product: score-at-a-time over postings in the order of quantised impact.

The vectors are cut into blocks. A block files every row under each component, and a component's
postings lie in segments of equal quantised magnitude, largest first. A query takes segments in
falling order of the most they can add to a score, by either sign, and adds their quantised
impact to the rows' accumulators. What lies in the untouched segments is bounded, so at any time
some rows are proved not to be among the best; the others are possible members. It stops when
scoring those exactly is cheaper than the postings left, and scores them exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattledger.functions.plans import scratch_path
from wattledger.llm.common import named, staged
from wattledger.llm.vectors import matrix, scaled, usable, widened

TOP = 10
SCALE = 1024
QUERY_EVERY = 100
# Quantised magnitudes of a component's postings.
LEVELS = 64
BLOCK_ROWS = 8192
# Queries that go to the executors at a time; more take more passes over the index.
BLOCK_QUERIES = 4096
# Postings that cost as much as one component of an exact score.
POSTINGS_PER_PRODUCT = 0.25


class Segments:
    """One block of the index: rows as whole numbers, and their postings by component."""

    def __init__(self, rows: np.ndarray, postings: np.ndarray | None = None) -> None:
        self.rows = rows
        size, width = rows.shape
        magnitude = np.abs(rows)
        self.most = magnitude.max(axis=0, initial=0)
        self.step = int(self.most.max(initial=0)) // LEVELS + 1
        level = (magnitude // self.step).T
        # postings[c]: the rows by falling quantised magnitude of component c.
        filed = np.argsort(-level, axis=1, kind="stable") if postings is None else postings
        self.postings = filed.astype(np.intp, copy=False)
        # ahead[c, m]: how many of them have a magnitude of level m or more.
        counts = np.bincount((level + np.arange(width)[:, None] * (LEVELS + 1)).ravel(), minlength=width * (LEVELS + 1))
        self.ahead = counts.reshape(width, LEVELS + 1)[:, ::-1].cumsum(axis=1)[:, ::-1]
        # A segment's postings share one impact, the middle of its level.
        middle = np.sign(rows.T) * (level * self.step + (self.step - 1) / 2)
        self.impact = np.take_along_axis(middle, self.postings, axis=1)

    def possible(self, query: np.ndarray, count: int, least: float, own: int | None) -> np.ndarray:
        """Rows that may be among the `count` best of this query and score `least` or more; all
        others are proved not to be. Row `own` is left out."""
        size, width = self.rows.shape
        weight = np.abs(query[:width])
        used = np.flatnonzero((weight > 0) & (self.most > 0))
        weight, signed, reach = weight[used], query[used].astype(float), weight[used] * self.most[used]
        scores = np.zeros(size)
        if own is not None:
            scores[own] = -np.inf
        # Quantising moves a component by half a step at most; the last term covers rounding.
        error = float(weight.sum()) * (self.step - 1) / 2 + float(reach.sum()) * 1e-9
        done = np.zeros(len(used), dtype=np.int64)
        impact = float(reach.max(initial=0))
        while True:
            impact /= 2
            # The least level whose segments can add `impact`; those below are left for later.
            level = np.clip(np.ceil((impact / weight + 1) / self.step) - 1, 0, LEVELS).astype(np.int64)
            upto = self.ahead[used, level]
            at = [self.postings[c, a:b] for c, a, b in zip(used, done, upto) if b > a]
            if at:
                added = [self.impact[c, a:b] * w for c, a, b, w in zip(used, done, upto, signed) if b > a]
                scores += np.bincount(np.concatenate(at), np.concatenate(added), size)
            done = upto
            rest = float(np.minimum(np.maximum(weight * (level * self.step - 1), 0), reach).sum())
            left = size * len(used) - int(done.sum())
            room = error + (rest if left else 0.0)
            floor = least
            if size > count:
                floor = max(floor, np.partition(scores, size - count)[size - count] - room)
            members = np.flatnonzero((scores + room >= floor) & (scores > -np.inf))
            if not left or len(members) * width <= left * POSTINGS_PER_PRODUCT:
                return members

    def best(self, query: np.ndarray, count: int, least: float, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and exact scores of the possible members."""
        members = self.possible(query, count, least, own)
        return members, self.rows[members] @ query[: self.rows.shape[1]]


FOUND = "query long, query_id long, vec_id long, row long, score long"


def index_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """From (row, vec_id, v): one row per block of up to `block_rows` vectors of one partition."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(part: pa.Table) -> pa.RecordBatch:
            part = part.combine_chunks()
            vectors = matrix(part["v"].chunk(0))
            index = Segments(vectors)
            made = [
                [vectors.shape[1]], [part["row"].to_pylist()], [part["vec_id"].to_pylist()],
                [vectors.tobytes()], [index.postings.astype(np.int32).tobytes()],
            ]
            kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(made, kinds)], ["width", "rows", "vec_ids", "vectors", "postings"]
            )

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= block_rows:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, block_rows))
                held = table.slice(block_rows).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    made = "width int, rows array<long>, vec_ids array<long>, vectors binary, postings binary"
    return rows.select("row", "vec_id", "v").mapInArrow(build, made)


def search(index: DataFrame, queries: pa.Table, count: int) -> DataFrame:
    """For each query the `count` best rows of each task's blocks, as FOUND.

    `queries` (row, vec_id, v) is one bounded block of queries.
    """
    queries = queries.combine_chunks()
    numbers = np.asarray(queries["row"])
    names = queries["vec_id"].to_pylist()
    vectors = matrix(queries["v"].chunk(0)) if len(names) else np.zeros((0, 0), np.int64)
    shared = index.sparkSession.sparkContext.broadcast((numbers, names, vectors))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_rows, own_ids, asked = shared.value
        # Of each query: score, id and row number of its best rows so far.
        best: list[list[tuple]] = [[] for _ in own_ids]
        for batch in batches:
            for i in range(batch.num_rows):
                width, rows, ids, raw, filed = (batch.column(c)[i].as_py() for c in range(5))
                vectors = np.frombuffer(raw, np.int64).reshape(len(rows), width)
                block = Segments(vectors, np.frombuffer(filed, np.int32).reshape(width, len(rows)))
                wide = widened(asked, width)
                if float(np.abs(wide[:, :width]).max(initial=0)) * float(block.most.max(initial=0)) * width >= 2.0**63:
                    raise ValueError("inner products of these vectors do not fit 64 bits")
                place = {row: at for at, row in enumerate(rows)}
                for n, query in enumerate(wide):
                    found = best[n]
                    least = -found[-1][0] if len(found) == count else -np.inf
                    at, scores = block.best(query, count, least, place.get(int(own_rows[n])))
                    if len(at) > count:
                        enough = scores >= np.partition(scores, len(at) - count)[len(at) - count]
                        at, scores = at[enough], scores[enough]
                    found += [
                        (-s, ids[a] is None, ids[a] if ids[a] is not None else 0, rows[a])
                        for s, a in zip(scores.tolist(), at.tolist())
                    ]
                    best[n] = sorted(found)[:count]
        flat = [(n, *entry) for n, found in enumerate(best) for entry in found]
        n, score, none, name, row = map(list, zip(*flat)) if flat else ([], [], [], [], [])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(own_rows[i]) for i in n], pa.int64()), pa.array([own_ids[i] for i in n], pa.int64()),
                pa.array([None if x else i for x, i in zip(none, name)], pa.int64()),
                pa.array(row, pa.int64()), pa.array([-s for s in score], pa.int64()),
            ],
            ["query", "query_id", "vec_id", "row", "score"],
        )

    return index.mapInArrow(look, FOUND)


def top_products(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    count: int = TOP,
    scale: int = SCALE,
    query_every: int = QUERY_EVERY,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The `count` rows of highest inner product with each query: query_id, rank, vec_id, score.

    Components x count as floor(scale * x). Queries are the rows whose id is divisible by
    `query_every`; candidates are all rows but the query's own. Ties go to the smaller id.

    The index is written once; a block of queries, bounded in number, goes to all blocks of the
    index at a time. A task keeps the best rows of each query over its blocks, so it gives
    `count` rows a query; those are ranked by a window that is limited ahead of its shuffle.

    Cases: vectors that are null or hold a null or non-finite component take no part; shorter
    vectors count as filled up with zeros; a row with a null id is no query and comes last among
    ties; rows under one id, equal ones too, are rows of their own, and as queries get a ranking
    each; scores beyond 64 bits raise; other columns are not looked at; an empty table gives an
    empty result.
    """
    spark = vectors.sparkSession
    kept = vectors.select(named(id_col).cast("long").alias("vec_id"), named(vec_col).alias("v")).where(usable(F.col("v")))
    kept = kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", scaled(F.col("v"), scale).alias("v"))
    rows = staged(kept, "impact-rows")
    blocks = max(1, -(-rows.count() // block_rows))
    index = staged(index_blocks(rows.coalesce(blocks), block_rows), "impact-index")
    asked = rows.where(F.col("vec_id") % query_every == 0)
    passes = max(1, -(-asked.count() // block_queries))
    found = scratch_path(spark, "impact-found")
    for nth in range(passes):
        part = asked.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == nth).toArrow()
        # Blocks are large rows of small files: dealt out one by one, not by file size.
        search(index.repartition(blocks), part, count).write.parquet(f"{found}/pass={nth}")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row"))
    best = spark.read.schema(FOUND).parquet(found).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= count)
    return best.select("query_id", "rank", "vec_id", "score")
