"""The corpus pipeline: stages over `documents`, each written as Parquet and read by the next.

Every stage takes all rows its predecessor kept. All but the last return the columns of their
input. Rows are kept or dropped where they stand: only texts go through Python, never whole rows,
so extra columns may have any name and type. The columns doc_id, text and source are needed.
In every stage null texts are empty texts, very long texts are read whole, and an empty table stays
empty; what becomes of null ids, ties and repeated rows is said at each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.plans import first_in_group, scratch_path
from wattledger.llm import decontaminate, mixing, quality, sharding, simhash
from wattledger.llm.common import named, table, whole_text

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def row_digest() -> Column:
    """A digest of id and text: equal for copies of a row, never null."""
    ident = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    return F.sha2(F.concat_ws("|", ident, whole_text()), 256)


def packed(docs: DataFrame, *needed: str | Column) -> DataFrame:
    """The needed columns, and the whole row as a struct."""
    return docs.select(*needed, F.struct(*[named(c) for c in docs.columns]).alias("_row"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below the threshold go. A row is judged by its text alone:
    null ids and repeated rows are like any others."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows linked by SimHash the one with the least id stays (null ids last, ties
    by a digest of id and text); of repeated rows one stays."""
    digest = row_digest().alias("_digest")
    near = simhash.near_components(docs.select("doc_id", "text", digest), carry=("_digest",))
    kept = first_in_group(near.select("label", "doc_id", "_digest"), ["label"], [F.asc_nulls_last("doc_id"), F.asc("_digest")])
    # One row per digest and task is all that is shuffled; the join finds its rows in place.
    rows = first_in_group(packed(docs, digest), ["_digest"], [F.lit(0)])
    return rows.join(kept.select("_digest"), "_digest", "left_semi").select("_row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. A row is judged by its text alone: null
    ids and repeated rows are like any others."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix enters a document, each at its own place in training order; the
    row at which a source runs out stays whole. A null source is one source; null or repeated ids
    are ordered by their texts, equal rows are interchangeable."""
    mixed = mixing.mix(packed(docs, "doc_id", "text", "source"), ["doc_id", "_row"])
    return mixing.training_order(mixed).select("_row.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place there; equal texts share a shard, and null or repeated
    ids are ordered by their texts."""
    return sharding.shard_groups(docs, ["doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# The classifier's random features, SimHash bits and the heap are not SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
