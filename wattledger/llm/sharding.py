"""Sharding by longest-processing-time scheduling: heavy groups first, to the lightest shard."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import BUCKET_ROWS, named, running_totals, staged, unit_interval, whole_text

SHARDS = 40
ROW_BYTES = 16
# A group above 1/HEAVY of a shard's even share is scheduled by itself; lighter ones travel in
# bundles, SHARE_BUNDLES for each shard. Both counts are bounded by the number of shards.
HEAVY = 2000
SHARE_BUNDLES = 500


def schedule(shards: int):
    """LPT over all items of one task, which come in falling size: (item, size) to (item, shard)."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = [(0, shard) for shard in range(shards)]
        for batch in batches:
            chosen = []
            for size in batch.column(1).to_pylist():
                load, shard = loads[0]
                heapq.heapreplace(loads, (load + size, shard))
                chosen.append(shard)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(chosen, pa.int32())], ["_item", "shard"]
            )

    return assign


def shard_groups(docs: DataFrame, carry: list[str], text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Every row with its shard: `carry`, size, text_crc32, shard, slot.

    Size is the text's UTF-8 bytes plus 16. Equal texts stay together. Groups above a set share
    of a shard (at most shards * HEAVY of them can be) are scheduled one by one; the others fall
    by their digest into shards * SHARE_BUNDLES bundles, so the heap sees a bounded list at any
    input size. Both kinds go by falling size to the least-loaded shard. Slots number the rows
    of a shard without gaps, in the order of a digest of id and text.

    Cases: a null text is the empty text without bytes; a very long text is a group like any other,
    in one shard; null or repeated ids are ordered by their texts, equal rows are
    interchangeable; a group beyond a shard's even share fills a shard of its own; an empty table
    gives an empty result; `carry` may name any columns except those made here.
    """
    text = whole_text(text_col)
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    group = F.sha2(text, 256)
    rows = staged(
        docs.select(
            *[named(c) for c in carry],
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            group.alias("_group"),
            F.sha2(F.concat(ident, F.lit("|"), group), 256).alias("_order"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    limit = total // (shards * HEAVY)
    bundles = shards * SHARE_BUNDLES
    bundle = F.concat(F.lit("bundle-"), F.floor(unit_interval(F.col("_group")) * bundles).cast("string"))
    item = F.when(F.col("_bytes") > limit, F.col("_group")).otherwise(bundle)
    items = groups.groupBy(item.alias("_item")).agg(F.sum("_bytes").alias("_bytes"))
    order = [F.desc("_bytes"), F.asc("_item")]
    plan = staged(
        items.repartition(1).sortWithinPartitions(*order)
        .mapInArrow(schedule(shards), "_item string, shard int"),
        "shard-plan",
    )
    light = F.col("_item").startswith("bundle-")
    alone = plan.where(~light).select(F.col("_item").alias("_group"), F.col("shard").alias("_alone"))
    bundled = plan.where(light).select(F.col("_item").alias("_bundle"), F.col("shard").alias("_bundled"))
    # Both lists are bounded by the number of shards, see above.
    placed = (
        rows.withColumn("_bundle", bundle)
        .join(F.broadcast(alone), "_group", "left")
        .join(F.broadcast(bundled), "_bundle", "left")
        .withColumn("shard", F.coalesce("_alone", "_bundled"))
        .drop("_alone", "_bundled", "_bundle")
    )
    buckets = rows.count() // (shards * BUCKET_ROWS) + 1
    placed = placed.withColumn("_bucket", F.floor(unit_interval(F.col("_order")) * buckets))
    numbered = running_totals(placed, ["shard"], "_bucket", ["_order"], {"slot": F.lit(1)})
    return numbered.select(*[named(c) for c in carry], "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
