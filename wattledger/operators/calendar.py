"""Time and calendar operators."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattledger.functions.plans import BROADCAST_ROWS, cut, sized
from wattledger.functions.timegrid import period_of, trading_date_of

OPEN_END = date(9999, 12, 31)
HORIZON_DAYS = 365 * 4


def to_trading_interval(df: DataFrame, ts_col: str) -> DataFrame:
    """Adds `interval_date` and `period_id` of the interval that ends at `ts_col`."""
    ts = F.col(ts_col)
    return df.withColumn("interval_date", trading_date_of(ts)).withColumn("period_id", period_of(ts))


def _with_every(days: DataFrame, lookup: DataFrame, broadcast_rows: int) -> DataFrame:
    """Every day with every row of the lookup."""
    rows = lookup.count()
    splits = -(-rows // broadcast_rows) if broadcast_rows else rows
    if splits <= 1:
        return days.withColumn("_split", F.lit(0)).join(F.broadcast(lookup.withColumn("_split", F.lit(0))), "_split").drop("_split")
    dealt = lookup.withColumn("_split", F.pmod(F.xxhash64(*lookup.columns), F.lit(splits)))
    spread = days.withColumn("_split", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(splits - 1).cast("long"))))
    return spread.join(dealt.hint("merge"), "_split").drop("_split")


def day_type_calendar(
    datetimes: DataFrame, jurisdictions: DataFrame, holidays: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """One row per interval and jurisdiction with its day type: W working day, 6 Saturday, S Sunday or holiday.

    The day type is decided once per date and jurisdiction and only then spread over the
    periods of the date. Every date has every jurisdiction: the lookup goes to the dates when its
    counted size allows, else it is dealt into splits of that size, and each split meets the
    dates in a task of its own.
    """
    lookup = jurisdictions.select("jurisdiction_id", "jurisdiction").distinct()
    days = _with_every(datetimes.select("interval_date", "day_of_week").distinct(), lookup, broadcast_rows)
    closed = (
        holidays.where(F.col("holiday_name").isNotNull())
        .select("interval_date", "jurisdiction").distinct().withColumn("public_holiday", F.lit(True))
    )
    typed = (
        days.join(closed, ["interval_date", "jurisdiction"], "left")
        .withColumn("public_holiday", F.coalesce("public_holiday", F.lit(False)))
        .withColumn(
            "day_type",
            F.when(F.col("public_holiday") | (F.col("day_of_week") == 7), "S")
            .when(F.col("day_of_week") == 6, "6")
            .otherwise("W"),
        )
    )
    periods = datetimes.select("interval_date", "day_of_week", "period_id").distinct()
    return periods.join(typed, ["interval_date", "day_of_week"]).select(
        "interval_date", "jurisdiction_id", "period_id", "day_of_week", "public_holiday", "day_type"
    )


def effective_ranges(
    df: DataFrame, keys: list[str], from_col: str, end_default: date = OPEN_END
) -> DataFrame:
    """Adds `to_date`: the day before the next row of the same key starts, or `end_default`.

    A key has one row per start date, so the days of the calendar bound its rows; rows that
    share a start date are ordered by all their other columns.
    """
    following = F.lead(F.date_sub(F.col(from_col), 1), 1)
    ties = sorted(c for c in df.columns if c not in (*keys, from_col))
    return df.withColumn(
        "to_date",
        F.coalesce(
            following.over(Window.partitionBy(*keys).orderBy(from_col, *ties)), F.lit(end_default)
        ),
    )


def compact_ranges(daily: DataFrame, keys: list[str | Column], split_gaps: bool = False) -> DataFrame:
    """First and last date of each attribute combination.

    Gaps inside are bridged, or with `split_gaps` a range ends where a day is missing; the dates
    of one combination are numbered for that, at most one per day.
    """
    if split_gaps:
        named = [k if isinstance(k, str) else k.alias(f"_key{i}") for i, k in enumerate(keys)]
        days = daily.select(*named, "interval_date").distinct()
        names = [c for c in days.columns if c != "interval_date"]
        nth = F.row_number().over(Window.partitionBy(*names).orderBy("interval_date"))
        return days.withColumn("_island", F.date_sub("interval_date", nth)).groupBy(*names, "_island").agg(
            F.min("interval_date").alias("start_date"), F.max("interval_date").alias("end_date")
        ).drop("_island")
    return daily.groupBy(*keys).agg(
        F.min("interval_date").alias("start_date"), F.max("interval_date").alias("end_date")
    )


def expand_to_dates(
    ranges: DataFrame, calendar: DataFrame, start: str = "start_date", end: str = "end_date"
) -> DataFrame:
    """One row per calendar date inside each range, both ends included.

    The range is first cut to the span of the calendar, then exploded in place, then matched
    to the calendar by equality: no range join, and open-ended ranges stay short.
    """
    days = calendar.select("interval_date").distinct()
    first = days.select(F.min("interval_date")).scalar()
    last = days.select(F.max("interval_date")).scalar()
    span = (
        ranges.withColumn("_from", F.greatest(F.col(start), first))
        .withColumn("_to", F.least(F.col(end), last))
        # Without calendar dates there is nothing to cut a range to.
        .where(first.isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col("_from") <= F.col("_to")))
    )
    return (
        span.withColumn("interval_date", F.explode(F.sequence("_from", "_to")))
        .drop("_from", "_to")
        .join(days, "interval_date", "left_semi")
    )


@dataclass(frozen=True)
class DateLookup:
    """The dates of a calendar, and for every day of its span the calendar date at or after it and
    at or before it. `first` and `last` are None without dates."""

    dates: DataFrame
    ends: DataFrame
    first: date | None
    last: date | None

    @property
    def small(self) -> bool:
        """Whether the lookup, a row per day of the span, may go to every executor."""
        return self.first is not None and (self.last - self.first).days < BROADCAST_ROWS


def _lookup(days: DataFrame) -> DateLookup:
    """The lookup has one row per day of the span, ordered within each year; what lies beyond the
    year comes from a row per year."""
    bounds = days.agg(F.min("interval_date").alias("a"), F.max("interval_date").alias("b")).first()
    if bounds.a is None:
        return DateLookup(days, days.where(F.lit(False)), None, None)
    whole = days.sparkSession.range(1).select(F.lit(bounds.a).alias("a"), F.lit(bounds.b).alias("b"))
    span = whole.select(F.explode(F.sequence("a", "b")).alias("day")).withColumn("_year", F.year("day"))
    years = whole.select(F.explode(F.sequence(F.year("a"), F.year("b"))).alias("_year")).join(
        days.groupBy(F.year("interval_date").alias("_year")).agg(
            F.min("interval_date").alias("_first"), F.max("interval_date").alias("_last")
        ),
        "_year",
        "left",
    )
    later = Window.orderBy("_year").rowsBetween(1, Window.unboundedFollowing)
    earlier = Window.orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    years = years.select("_year", F.min("_first").over(later).alias("_later"), F.max("_last").over(earlier).alias("_earlier"))
    onward = Window.partitionBy("_year").orderBy("day").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    so_far = Window.partitionBy("_year").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        span.join(days, F.col("day") == F.col("interval_date"), "left").join(years, "_year")
        .select(
            "day", F.coalesce(F.min("interval_date").over(onward), "_later").alias("next"),
            F.coalesce(F.max("interval_date").over(so_far), "_earlier").alias("previous"),
        )
    )
    return DateLookup(days, ends, bounds.a, bounds.b)


def date_lookup(calendar: DataFrame) -> DateLookup:
    """The lookup of a calendar as stored tables, for several operators to read: the calendar itself
    is read once."""
    found = _lookup(cut(calendar.select("interval_date").distinct()))
    return replace(found, ends=cut(found.ends)) if found.first is not None else found


def dates_of(calendar: DataFrame | DateLookup) -> DataFrame:
    """The different dates of a calendar."""
    return calendar.dates if isinstance(calendar, DateLookup) else calendar.select("interval_date").distinct()


def clip_to_dates(
    ranges: DataFrame, calendar: DataFrame | DateLookup, start: str = "start_date", end: str = "end_date"
) -> DataFrame:
    """Each range cut to its first and last calendar date; ranges without one are dropped.

    The same as expanding to dates and taking their bounds, without the dates: a range looks up
    its two ends among the days of the calendar's span.
    """
    lookup = calendar if isinstance(calendar, DateLookup) else _lookup(dates_of(calendar))
    if lookup.first is None:
        return ranges.where(F.lit(False))
    opening = lookup.ends.select(F.col("day").alias("_from"), F.col("next").alias("_opens"))
    closing = lookup.ends.select(F.col("day").alias("_to"), F.col("previous").alias("_closes"))
    opening, closing = (F.broadcast(x) if lookup.small else x.hint("merge") for x in (opening, closing))
    return (
        ranges.withColumn("_from", F.greatest(F.col(start), F.lit(lookup.first)))
        .withColumn("_to", F.least(F.col(end), F.lit(lookup.last)))
        .where(F.col(start).isNotNull() & F.col(end).isNotNull())
        .join(opening, "_from").join(closing, "_to")
        .where(F.col("_opens") <= F.col("_closes"))
        .withColumn(start, F.col("_opens")).withColumn(end, F.col("_closes"))
        .drop("_from", "_to", "_opens", "_closes")
    )


def horizon_filter(calendar: DataFrame, as_of: date, days: int = HORIZON_DAYS) -> DataFrame:
    """Calendar rows from `as_of` to `as_of + days`, both included."""
    return calendar.where(
        F.col("interval_date").between(F.lit(as_of), F.lit(as_of + timedelta(days=days)))
    )
