"""Joins of dated facts with date ranges by a sweep, for range lists too large to be broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Facts of one part of the sweep, about, and matches that a task puts out at a time.
PART_FACTS = 500_000
BATCH_MATCHES = 100_000
# Days of one key in the common order of key and day: any date of the years 1 to 9999 has a place.
KEY_DAYS = 1 << 23


def _place(key: Column, date: Column) -> Column:
    """Where a date of a key stands in the order of (key, date)."""
    return key.cast("long") * KEY_DAYS + F.unix_date(date) + KEY_DAYS // 2


def _part_bounds(places: DataFrame, part_facts: int) -> np.ndarray:
    """Places at which parts after the first begin, so that parts hold about as many facts.

    One aggregate over the facts' places; the driver gets a number for each part.
    """
    parts = -(-places.count() // part_facts)
    if parts < 2:
        return np.zeros(0, np.int64)
    shares = [i / parts for i in range(1, parts)]
    found = places.agg(F.percentile_approx("_at", shares, 10 * parts).alias("b")).first().b
    return np.unique(np.array(found, dtype=np.int64))


def _copies(ranges: DataFrame, bounds: np.ndarray, schema: StructType) -> DataFrame:
    """Each range in every part that it reaches into, at its first place there."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, last = (np.asarray(batch.column(i), dtype=np.int64) for i in (0, 1))
            opens, closes = (np.searchsorted(bounds, x, side="right") for x in (first, last))
            times = closes - opens + 1
            own = np.repeat(np.arange(len(first)), times)
            part = np.arange(len(own)) - np.repeat(np.cumsum(times) - times, times) + opens[own]
            begin = np.concatenate([[np.iinfo(np.int64).min], bounds])[part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()), pa.array(np.maximum(first[own], begin)), pa.array(np.zeros(len(own), np.int32)),
                    pa.array(last[own]), pa.nulls(len(own), batch.schema.field(2).type), batch.column(3).take(pa.array(own)),
                ],
                ["_part", "_at", "_kind", "_last", "_fact", "_range"],
            )

    return ranges.mapInArrow(copy, schema)


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows in the order of part, place and kind (ranges first): each fact with the ranges that
    are open at its place. Kept in memory are only the open ranges of the current key and part."""
    part, ends, begins, held = -1, np.zeros(0, np.int64), np.zeros(0, np.int64), None

    def joined(facts: pa.Array, ranges: pa.Array, left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
        fact, span = facts.take(pa.array(np.concatenate(left))), ranges.take(pa.array(np.concatenate(right)))
        columns = [*fact.flatten(), *span.flatten()]
        names = [f.name for kind in (fact.type, span.type) for f in kind]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        parts, at, kind, last = (np.asarray(batch.column(i).fill_null(0)) for i in range(4))
        cuts = np.flatnonzero(np.diff(parts)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(parts)]):
            if b == a:
                continue
            if parts[a] != part:
                part, ends, begins, held = parts[a], ends[:0], begins[:0], None
            new = a + np.flatnonzero(kind[a:b] == 0)
            if len(new):
                opened = batch.column(5).take(pa.array(new))
                held = opened if held is None else pa.concat_arrays([held, opened])
                begins, ends = np.concatenate([begins, at[new]]), np.concatenate([ends, last[new]])
            fact = a + np.flatnonzero(kind[a:b] == 1)
            if held is not None and len(fact):
                left, right, size = [], [], 0
                places, first = np.unique(at[fact], return_index=True)
                for place, x, y in zip(places, first, [*first[1:], len(fact)]):
                    open_now = np.flatnonzero((begins <= place) & (ends >= place))
                    # One fact at a time where that many ranges are open.
                    step = max(1, BATCH_MATCHES // max(1, len(open_now)))
                    for z in range(x, y if len(open_now) else x, step):
                        some = fact[z : min(z + step, y)]
                        left.append(np.repeat(some, len(open_now)))
                        right.append(np.tile(open_now, len(some)))
                        size += len(left[-1])
                        if size >= BATCH_MATCHES:
                            yield joined(batch.column(4), held, left, right)
                            left, right, size = [], [], 0
                if size:
                    yield joined(batch.column(4), held, left, right)
            if held is not None:
                still = ends >= at[b - 1]
                if not still.all():
                    held, begins, ends = held.filter(pa.array(still)), begins[still], ends[still]


def sweep_join(
    facts: DataFrame, ranges: DataFrame, key: str, date: str, start: str, end: str, part_facts: int = PART_FACTS
) -> DataFrame:
    """Facts with each range of the same whole-number `key` that covers their `date`, both ends
    included: the columns of `facts`, then those of `ranges` without `key`, `start` and `end`.

    Both sides are cut into parts along (key, date), of about equally many facts; a range stands
    in the parts that it reaches into, so one long range of a hot key is a row in each of the
    key's parts, not a row for each of its days. Within a part both are read once in the order of
    (key, date), with the ranges that are open at a time in memory. A key that owns much of the
    facts has parts by its dates.

    Facts or ranges without key or date, and ranges that end before they start, match nothing.
    """
    dated = facts.where(F.col(key).isNotNull() & F.col(date).isNotNull()).withColumn("_at", _place(F.col(key), F.col(date)))
    bounds = _part_bounds(dated.select("_at"), part_facts)
    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    kept = [c for c in ranges.columns if c not in (key, start, end)]
    span = F.struct(*[F.col(f"`{c}`") for c in kept])
    valid = F.col(key).isNotNull() & (F.col(start) <= F.col(end))
    first, last = (_place(F.col(key), F.col(c)).alias(n) for c, n in ((start, "_first"), (end, "_last")))

    @F.arrow_udf("int")
    def part_of(at: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, np.asarray(at), side="right"), pa.int32())

    part = part_of(F.col("_at")) if len(bounds) else F.lit(0)
    rows = dated.select(
        part.alias("_part"), "_at", F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_last"), fact.alias("_fact")
    )
    range_schema = ranges.select(span.alias("_range")).schema["_range"].dataType
    fact_schema = rows.schema["_fact"].dataType
    schema = StructType.fromDDL("_part int, _at long, _kind int, _last long").add("_fact", fact_schema).add("_range", range_schema)
    given = ranges.where(valid).select(first, last, F.lit(None).cast(fact_schema).alias("_fact"), span.alias("_range"))
    both = rows.withColumn("_range", F.lit(None).cast(range_schema)).unionByName(_copies(given, bounds, schema))
    ordered = both.repartition(len(bounds) + 1, "_part").sortWithinPartitions("_part", "_at", "_kind")
    made = StructType([*facts.schema.fields, *[ranges.schema[c] for c in kept]])
    return ordered.mapInArrow(_matches, made)
