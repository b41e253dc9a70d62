"""Plan helpers: checked broadcasts, cut lineage, row numbers that do not pile up on one key."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A contract list, curve or lookup up to this many rows goes to every executor.
BROADCAST_ROWS = 200_000


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when `df` has at most `rows` rows; reads no more than one row beyond that."""
    return df.limit(rows + 1).count() <= rows


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` for a join: broadcast when its counted size allows, else a shuffled join.

    The shuffled join is left to adaptive execution, which splits skewed partitions.
    """
    return F.broadcast(df) if fits(df, rows) else df.hint("merge")


def sized_all(*dfs: DataFrame, rows: int = BROADCAST_ROWS) -> list[DataFrame]:
    """`sized` for several tables, which are counted in one job."""
    if not dfs:
        return []
    counts = [
        df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n") for i, df in enumerate(dfs)
    ]
    counted = {r.i: r.n for r in reduce(DataFrame.unionByName, counts).collect()}
    return [F.broadcast(df) if counted[i] <= rows else df.hint("merge") for i, df in enumerate(dfs)]


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach: spark.checkpoint.dir.

    Raises where it is unset; only a session whose tasks run in the driver's own process, as in
    tests, gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="wattledger-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, in the shared folder."""
    return f"{shared_dir(spark)}/wattledger/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    """`df` as a parquet table in the shared folder: nothing upstream runs twice, and readers
    prune columns, push filters down and know its size. By the columns `parts`, which have few
    values, it is stored apart."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`cut` in buckets of `keys`: rows are shuffled once here, and not again by aggregates whose groups
    hold all keys. A key that owns much of the table is one bucket."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stage_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).write.option("path", scratch_path(spark, "stage"))
    dealt.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name, format="parquet")
    return spark.table(name)


def first_in_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group.

    Written as `row_number() = 1`, which Spark turns into a per-task group limit ahead of the
    shuffle: a task sends at most one row per key, so a hot key costs nothing.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_nth", F.row_number().over(ranked)).where(F.col("_nth") == 1).drop("_nth")
    )


def numbered_in_chunks(
    df: DataFrame, keys: list[str], chunk: Column, order: list[Column], name: str
) -> DataFrame:
    """`row_number()` per `keys`, ordered by `chunk` and then `order`, without one task per key.

    Each (keys, chunk) is numbered on its own; the rows of the earlier chunks are added from
    per-chunk counts, which are combined before they are shuffled. A key that owns a third of
    the table is spread over its chunks. The rows themselves are shuffled once, for the window
    and the join alike. Keys and chunk must not be null.
    """
    chunked = df.withColumn("_chunk", chunk)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_chunk", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(*order))
    return (
        chunked.withColumn("_within", within)
        .join(offsets, [*keys, "_chunk"])
        .select(*df.columns, (F.col("_within") + F.col("_before")).cast("int").alias(name))
    )
