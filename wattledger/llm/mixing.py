"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.plans import sized
from wattledger.llm.common import BUCKET_ROWS, named, running_totals, staged, unit_interval, whole_text

# Weights and schedules go round over the sources in code point order, null last.
WEIGHTS = (5, 2, 1)
# Weight at the start and at the end of training, in shares of the mean; linear in between.
SCHEDULES = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))
SHARE = 1.5
MOST_REPEATS = 2.0

WORDS = r"[^\x20\x09-\x0D]+"


def cycle(values: tuple, rank: Column) -> Column:
    """values[rank mod their number], rank from 0."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % len(values) + 1).cast("int"))


def in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`rows` as a stage table with _bucket: range partitions of at most about BUCKET_ROWS rows,
    numbered in the given order."""
    buckets = rows.count() // BUCKET_ROWS + 1
    dealt = rows.repartitionByRange(buckets, *order)
    return staged(dealt.withColumn("_bucket", F.spark_partition_id()), name)


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_REPEATS,
) -> DataFrame:
    """One row per source: source, n_rows, source_size, target, rank.

    `sizes` has source and size. The sources share `share` of all sizes by weight; a target
    stops at `most` times its source's size and the excess is shared again by weight until none
    is above. That ends at one level per unit of weight: with the sources in the order of
    stop / weight, the first whose level fits under its stop fixes the level of the rest (later levels are lower).

    Sources are ranked and summed up in range partitions, whose totals are carried over, so no
    task sees all of them where nearly every row has a source of its own. The driver gets four
    numbers.
    """
    per_source = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size")
    )
    last = F.col("source").isNull()  # null comes after all code points
    ordered = in_order(staged(per_source, "mix-sources").withColumn("_all", F.lit(0)), [last, F.col("source")], "mix-ordered")
    ranked = running_totals(ordered, ["_all"], "_bucket", [last, F.col("source")], {"rank": F.lit(1)})
    weighed = ranked.drop("_bucket").withColumns(
        {"_weight": cycle(weights, F.col("rank")).cast("double"), "_stop": F.col("source_size") * F.lit(most)}
    )
    filling = [F.col("_stop") / F.col("_weight"), F.col("rank")]
    filled = in_order(staged(weighed, "mix-weighed"), filling, "mix-filling")
    total, all_weights = filled.agg(F.sum("source_size"), F.sum("_weight")).first()
    summed = running_totals(
        filled, ["_all"], "_bucket", filling, {"_stopped": F.col("_stop"), "_closed": F.col("_weight")}
    )
    level = (F.lit(float(total or 0)) * F.lit(share) - F.col("_stopped")) / (F.lit(all_weights or 0.0) - F.col("_closed"))
    fits = level * F.col("_weight") <= F.col("_stop")
    reached = summed.agg(F.max(F.when(fits, level))).first()[0]
    target = F.least("_stop", F.lit(float("inf") if reached is None else reached) * F.col("_weight"))
    return filled.select("source", "n_rows", "source_size", target.alias("target"), "rank")


def position(consumed: Column, target: Column, start: Column, end: Column) -> Column:
    """Share of training done when a source has given `consumed` of its `target` words.

    Its weight runs from `start` to `end` (mean 1), so by time t it has given
    target * (start * t + (end - start) * t^2 / 2); this is the inverse.
    """
    asked = consumed / target
    return (asked * 2.0) / (start + F.sqrt(start * start + (end - start) * 2.0 * asked))


def mix(
    docs: DataFrame,
    carry: list[str],
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    schedules: tuple[tuple[float, float], ...] = SCHEDULES,
    share: float = SHARE,
    most: float = MOST_REPEATS,
) -> DataFrame:
    """Every row with the words the mix takes of it: `carry`, size, source_size, target, taken,
    passes (how often the mix enters the document), first_position, second_position, positions (one for each pass).

    Size is the number of words. A source's rows stand in the order of a digest of id and text;
    its target is spent along that order, going round again after the last row, and the row at
    which it runs out is taken in part. The position of a row is the moment of training, from 0
    to 1, at which the source's integrated schedule has asked for all words before the row; on
    the second pass those are a whole round more.
    Reruns agree: nothing depends on partitions.

    Cases: a null text has no words; a very long text is one row, taken in part only where its
    source runs out; a null source is a source of its own, after all others; null or repeated ids
    are ordered by their texts, equal rows are interchangeable; rows without words are entered when
    their turn comes but give none; an empty table gives an empty result. `carry` may name any columns
    except those made here.
    """
    text = whole_text(text_col)
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = staged(
        docs.select(
            *[named(c) for c in dict.fromkeys([*carry, "source"])],
            F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"),
            F.sha2(F.concat(ident, F.lit("|"), text), 256).alias("_order"),
        ),
        "mix-rows",
    )
    targets = staged(source_targets(rows.select("source", "size"), weights, share, most), "mix-targets")
    first, last = zip(*schedules)
    targets = targets.select(
        F.col("source").alias("_source"),
        "n_rows",
        "source_size",
        "target",
        cycle(first, F.col("rank")).alias("_start"),
        cycle(last, F.col("rank")).alias("_end"),
    )
    placed = rows.join(sized(targets), F.col("source").eqNullSafe(F.col("_source")))
    buckets = F.ceil(F.col("n_rows") / F.lit(BUCKET_ROWS))
    placed = placed.withColumn("_bucket", F.floor(unit_interval(F.col("_order")) * buckets))
    summed = running_totals(
        placed, ["source"], "_bucket", ["_order", "size"], {"_before": F.col("size")}
    )
    demand = F.floor(F.col("target") + 0.5)
    passes = F.lit(0)
    taken = F.lit(0)
    entered = []
    for nth in range(int(-(-most // 1))):
        left = demand - F.col("source_size") * nth - F.col("_before")
        passes = passes + F.when(left > 0, 1).otherwise(0)
        taken = taken + F.greatest(F.lit(0), F.least(F.col("size"), left))
        consumed = F.col("_before") + F.col("source_size") * nth
        entered.append(F.when(left > 0, position(consumed, F.col("target"), F.col("_start"), F.col("_end"))))
    return summed.select(
        *[named(c) for c in carry],
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        passes.cast("int").alias("passes"),
        F.when(
            passes > 0, position(F.col("_before"), F.col("target"), F.col("_start"), F.col("_end"))
        ).alias("first_position"),
        F.get(F.filter(F.array(*entered), lambda at: at.isNotNull()), F.lit(1)).alias("second_position"),
        F.filter(F.array(*entered), lambda at: at.isNotNull()).alias("positions"),
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for each time the mix enters a row, range-sorted by the `position` of that pass; ties
    by `doc_id` where there is one."""
    ties = ["position", *[c for c in ("doc_id",) if c in mixed.columns]]
    entered = mixed.select("*", F.explode("positions").alias("position"))
    return entered.repartitionByRange(*ties).sortWithinPartitions(*ties)
