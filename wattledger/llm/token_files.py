"""Token ids as ORC files in id order: run-length coded stripes, row indexes, Bloom filters on ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattledger.functions.plans import sized
from wattledger.llm.common import named
from wattledger.llm.encoding import slices, worker_encoder

END_ID = 1
# Rows between index entries, and the false-positive share of the Bloom filters.
INDEX_STRIDE = 1000
BLOOM_FPP = 0.01
# Characters of a text by which the rows of one id are spread over files.
SPREAD_CHARACTERS = 64


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of each text followed by `end_id`, and the list offsets of the texts."""
    ends = np.cumsum(counts)
    closed = np.insert(ids, ends, end_id)
    return closed, np.concatenate([[0], ends + np.arange(1, len(counts) + 1)])


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> None:
    """Encodes every whole text, adds `end_id` and writes the ids to `path`, replacing it.

    Texts are range-partitioned and sorted by id before they are encoded, so a file holds a
    range of ids, its stripes and row groups hold narrower ones, and min/max statistics and
    Bloom filters let readers skip them. A row is: the id, file_no (files in id order), start
    (ids of the file's earlier documents), n_tokens, ids. Integers are stored by ORC's run-length
    coding, version 2. A stripe never needs another one, so readers split files at stripes.

    Cases: a null or empty text is the end id alone; a null id comes first; rows with one id are
    ordered by their texts and spread over files by the first characters of these, so an id that
    many rows share is not one task; a very long text is one row, encoded whole in its task, whose
    memory grows with it; an empty table writes files without rows; other columns stay out.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        file_no, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                ids, offsets = with_end(*encoder.encode(part), end_id)
                counts = np.diff(offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)),
                        pa.array(np.full(len(part), file_no, np.int32)),
                        pa.array(start + np.cumsum(counts) - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                    ],
                    [id_col, "file_no", "start", "n_tokens", "ids"],
                )
                start += int(counts.sum())
                at += len(part)

    kind = docs.schema[id_col].dataType.simpleString()
    # The first characters order texts as whole texts do, and keep the range bounds short.
    opening = F.substring(named(text_col), 1, SPREAD_CHARACTERS)
    ordered = docs.select(named(id_col), named(text_col)).repartitionByRange(named(id_col), opening)
    ordered = ordered.sortWithinPartitions(named(id_col), named(text_col))
    coded = ordered.mapInArrow(
        encode, f"`{id_col}` {kind}, file_no int, start long, n_tokens long, ids array<int>"
    )
    (
        coded.write.mode("overwrite").format("orc")
        .option("orc.write.format", "0.12")
        .option("orc.row.index.stride", INDEX_STRIDE)
        .option("orc.bloom.filter.columns", id_col)
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .option("compression", "zstd")
        .save(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files; filters on the id are answered from stripe metadata first."""
    return spark.read.format("orc").load(path)


def global_starts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """`rows` of the files (with file_no and start) with start counted over all files before."""
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    files = read_token_files(spark, path).groupBy("file_no").agg(F.sum("n_tokens").alias("_n"))
    files = files.select("file_no", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    moved = rows.join(sized(files), "file_no")
    return moved.withColumn("start", F.col("start") + F.col("_before")).drop("_before", "file_no")


def token_digests(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, start, n_tokens, ids_crc32 (over little-endian ids)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            flat = np.asarray(lists.values, dtype="<u4")
            bounds = np.asarray(lists.offsets).tolist()
            crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(crcs, pa.int64())], [*batch.schema.names[:4], "ids_crc32"]
            )

    rows = read_token_files(spark, path).select(id_col, "file_no", "start", "n_tokens", "ids")
    kind = rows.schema[id_col].dataType.simpleString()
    crcs = rows.mapInArrow(
        digest, f"`{id_col}` {kind}, file_no int, start long, n_tokens long, ids_crc32 long"
    )
    return global_starts(crcs, spark, path).select(id_col, "start", "n_tokens", "ids_crc32")
