"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.plans import sized
from wattledger.llm.common import join_groups, staged, whole_text

PREFIX_CHARS = 256
# Surviving (length, prefix) keys that may be sent to every executor: 16 bytes each.
BROADCAST_KEYS = 1_000_000


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest_all: bool = False,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    The first scan keeps a narrow table of lengths and prefix hashes. Lengths that occur once
    are settled; of the others, (length, prefix hash) pairs that occur once are settled too.
    The second scan hashes the full text of the surviving rows only and groups by that hash.
    `digest_all` asks for the digest of the settled rows as well; they stay out of the grouping.

    Cases: a null text equals an empty one. Of equal texts the row with the largest id stays;
    a null id is smaller than all others and rows with null ids only keep null. Rows repeated
    under one id carry the same marks, since the id names the document. An empty table gives
    an empty result. Other columns are not looked at.
    """
    text = whole_text(text_col)
    length, prefix = F.octet_length(text), F.xxhash64(F.substring(text, 1, PREFIX_CHARS))
    seen = staged(docs.select(length.alias("_len"), prefix.alias("_prefix")), "exact-keys")

    lengths = seen.groupBy("_len").count().where("count > 1").select("_len")
    survivors = (
        seen.join(sized(lengths), "_len", "left_semi")
        .groupBy("_len", "_prefix").count().where("count > 1").select("_len", "_prefix")
    )
    survivors = staged(survivors, "exact-survivors").withColumn("_open", F.lit(True))

    hashed = docs.select(
        F.col(id_col), text.alias("_text"), length.alias("_len"), prefix.alias("_prefix")
    ).join(sized(survivors, broadcast_keys), ["_len", "_prefix"], "left")
    full = F.sha2("_text", 256)
    hashed = staged(
        hashed.select(
            F.col(id_col),
            F.col("_open").isNotNull().alias("_open"),
            (full if digest_all else F.when(F.col("_open"), full)).alias("text_sha256"),
        ),
        "exact-hashes",
    )
    groups = (
        hashed.where("_open").groupBy("text_sha256")
        .agg(F.max(id_col).alias("_keep"), F.count(F.lit(1)).alias("_size"))
        .where("_size > 1")
    )
    marked = join_groups(hashed, staged(groups, "exact-groups"), "text_sha256", "_size")
    keep = F.when(F.col("_size").isNull(), F.col(id_col)).otherwise(F.col("_keep"))
    return marked.select(
        F.col(id_col),
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col(id_col)).alias("kept"),
        "text_sha256",
    )
