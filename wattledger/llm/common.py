"""What the operators of this package share: stage tables, running totals without a hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattledger.functions.plans import scratch_path, sized

# Rows that one window task orders, which may carry texts; keys with more are spread over buckets
# of about this size.
BUCKET_ROWS = 10_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` as a parquet table in the shared folder: computed once, pruned by its readers."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named(column: str) -> Column:
    """The column of just this name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def schema_of(df: DataFrame, carry: list[str], made: str) -> StructType:
    """The columns `carry` as `df` has them, under any names, then those of the DDL string `made`."""
    return StructType([*[df.schema[c] for c in carry], *StructType.fromDDL(made).fields])


def whole_text(column: str = "text") -> Column:
    """The text; null reads as empty."""
    return F.coalesce(named(column), F.lit(""))


def unit_interval(hex_digest: Column) -> Column:
    """A hex digest as a number in [0, 1), by its first eight digits."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def running_totals(
    df: DataFrame, keys: list[str], bucket: str, order: list[str] | list[Column], totals: dict[str, Column]
) -> DataFrame:
    """Adds, per `keys`, the total of each column over the rows before this one (0 for the first).

    The order is (`bucket`, `order`). Each (keys, bucket) is summed in its own task and the
    totals of earlier buckets are added, so a key that owns a third of the rows is spread over
    its buckets. `df` is read twice and should be a stage table. Keys may be null.
    """
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    names = {name: f"_sum_{name}" for name in totals}
    offsets = df.groupBy(*keys, bucket).agg(*[F.sum(c).alias(names[n]) for n, c in totals.items()])
    offsets = offsets.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(bucket).alias("_at"),
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(s) for s in names.values()],
    )
    offsets = sized(offsets)
    within = (
        Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = df.withColumns(
        {f"_in_{n}": F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in totals.items()}
    )
    same = F.col(bucket) == F.col("_at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return inside.join(offsets, same).select(
        *[named(c) for c in df.columns],
        *[(F.col(f"_in_{n}") + F.col(s)).alias(n) for n, s in names.items()],
    )


# A group with more than one of this many parts of all rows is heavy; so many can be at most.
HEAVY_PARTS = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str) -> DataFrame:
    """`rows` left-joined to `groups` (one row per key, with its number of rows in `size`).

    Heavy groups, at most HEAVY_PARTS by their definition, are broadcast to their rows; only the
    others are shuffled by key, so no key puts more than a small share of the rows in one task.
    Both inputs are read twice and should be stage tables.
    """
    keys = [key] if isinstance(key, str) else key
    limit = rows.count() // HEAVY_PARTS
    heavy = F.broadcast(groups.where(F.col(size) > limit))
    rest = rows.join(F.broadcast(groups.where(F.col(size) > limit).select(*keys)), keys, "left_anti")
    light = rest.join(groups.where(F.col(size) <= limit), keys, "left")
    return rows.join(heavy, keys).unionByName(light)
