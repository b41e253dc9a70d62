from datetime import date, datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from wattledger.functions.plans import first_in_group, numbered_in_chunks
from wattledger.operators import calendar as cal


def test_trading_interval_edges(spark):
    stamps = [datetime(2024, 3, 1, 0, 0), datetime(2024, 3, 1, 0, 5), datetime(2024, 3, 1, 23, 55), datetime(2024, 3, 1, 12, 7)]
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    got = rows(cal.to_trading_interval(df, "ts"), "ts", "interval_date", "period_id")
    assert [r[1:] for r in got] == [
        (date(2024, 2, 29), 288), (date(2024, 3, 1), 1), (date(2024, 3, 1), 145), (date(2024, 3, 1), 287),
    ]


def test_effective_ranges(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 1)), (1, date(2024, 7, 1)), (2, date(2024, 1, 1))], "deal int, start date"
    )
    assert rows(cal.effective_ranges(df, ["deal"], "start")) == [
        (1, date(2024, 1, 1), date(2024, 6, 30)),
        (1, date(2024, 7, 1), date(9999, 12, 31)),
        (2, date(2024, 1, 1), date(9999, 12, 31)),
    ]


def gappy_calendar(spark):
    days = [date(2024, 1, d) for d in (2, 3, 7, 8, 20)]
    return spark.createDataFrame([(d,) for d in days], "interval_date date")


RANGES = [
    (1, date(2023, 1, 1), date(9999, 12, 31)), (2, date(2024, 1, 4), date(2024, 1, 6)),
    (3, date(2024, 1, 3), date(2024, 1, 3)), (4, date(2024, 1, 5), date(2024, 1, 19)),
    (5, date(2024, 1, 9), date(2024, 1, 1)), (6, date(2025, 1, 1), date(2025, 2, 1)),
    (7, None, date(2024, 1, 5)), (8, date(2024, 1, 20), date(2024, 3, 1)),
]


def test_clip_is_expand_and_compact(spark):
    ranges = spark.createDataFrame(RANGES, "id int, start_date date, end_date date")
    calendar = gappy_calendar(spark)
    expanded = cal.compact_ranges(cal.expand_to_dates(ranges, calendar), ["id"])
    clipped = cal.clip_to_dates(ranges, calendar).select("id", "start_date", "end_date")
    assert rows(clipped) == rows(expanded)
    assert [r[0] for r in rows(clipped)] == [1, 3, 4, 8]


def test_horizon_ends_are_included(spark):
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3, 4)], "interval_date date")
    assert len(rows(cal.horizon_filter(days, date(2024, 1, 2), 1))) == 2


def test_day_types(spark):
    days = spark.createDataFrame(
        [(date(2024, 1, d), d, p) for d in (1, 6, 7) for p in (1, 2)], "interval_date date, day_of_week int, period_id int"
    )
    places = spark.createDataFrame([(1, "A"), (2, "B")], "jurisdiction_id int, jurisdiction string")
    holidays = spark.createDataFrame([(date(2024, 1, 1), "B", "x")] * 2, "interval_date date, jurisdiction string, holiday_name string")
    got = rows(cal.day_type_calendar(days, places, holidays), "interval_date", "jurisdiction_id", "period_id", "day_type")
    assert len(got) == 12
    assert {r[:2] + r[3:] for r in got} == {
        (date(2024, 1, 1), 1, "W"), (date(2024, 1, 1), 2, "S"), (date(2024, 1, 6), 1, "6"), (date(2024, 1, 6), 2, "6"),
        (date(2024, 1, 7), 1, "S"), (date(2024, 1, 7), 2, "S"),
    }


def test_chunked_numbers_equal_a_plain_window(spark):
    """One key owns most of the rows, some share a chunk, and two rows differ in the last order column only."""
    hot = spark.range(3000).select(F.lit(1).alias("k"), (F.col("id") % 37).alias("c"), "id")
    cold = spark.range(200).select((F.col("id") % 50 + 2).alias("k"), (F.col("id") % 5).alias("c"), "id")
    df = hot.unionByName(cold)
    plain = F.row_number().over(Window.partitionBy("k").orderBy("c", "id"))
    expected = df.withColumn("n", plain)
    got = numbered_in_chunks(df, ["k"], F.col("c"), [F.col("id")], "n")
    assert rows(got) == rows(expected)


def test_first_in_group_limits_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id").repartition(4)
    top = first_in_group(df, ["k"], [F.col("id").desc()])
    assert rows(top) == [(0, 99), (1, 97), (2, 98)]
    top.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_an_empty_calendar_expands_nothing(spark):
    ranges = spark.createDataFrame([(1, date(2020, 1, 1), date(9999, 12, 31))], "id int, start_date date, end_date date")
    none = spark.createDataFrame([], "interval_date date")
    assert cal.expand_to_dates(ranges, none).count() == 0
    assert cal.clip_to_dates(ranges, none).count() == 0


def test_clipping_crosses_years_without_dates(spark):
    days = spark.createDataFrame([(date(2019, 3, 1),), (date(2022, 5, 5),)], "interval_date date")
    ranges = spark.createDataFrame(
        [(1, date(2019, 4, 1), date(2030, 1, 1)), (2, date(2000, 1, 1), date(2022, 1, 1)), (3, date(2020, 1, 1), date(2021, 1, 1))],
        "id int, start_date date, end_date date",
    )
    got = {r.id: (r.start_date, r.end_date) for r in cal.clip_to_dates(ranges, days).collect()}
    assert got == {1: (date(2022, 5, 5), date(2022, 5, 5)), 2: (date(2019, 3, 1), date(2019, 3, 1))}


def test_a_shared_date_lookup_clips_alike_and_reads_the_calendar_once(spark, tmp_path):
    path = str(tmp_path / "calendar")
    days = [(date(2019, 3, 1),), (date(2019, 3, 1),), (date(2020, 2, 29),), (date(2022, 5, 5),)]
    spark.createDataFrame(days, "interval_date date").write.parquet(path)
    calendar = spark.read.parquet(path)
    made = [(n, date(2018 + n % 5, 1 + n % 12, 1), date(2019 + n % 6, 1 + n % 7, 28)) for n in range(200)] + [(200, None, None)]
    ranges = spark.createDataFrame(made, "id int, start_date date, end_date date")
    lookup = cal.date_lookup(calendar)
    shared = cal.clip_to_dates(ranges, lookup)
    assert sorted(map(tuple, shared.collect())) == sorted(map(tuple, cal.clip_to_dates(ranges, calendar).collect()))
    assert shared.count() > 0
    assert path not in shared._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.interval_date for r in cal.dates_of(lookup).collect()) == sorted({d for d, in days})
    none = cal.date_lookup(calendar.where("interval_date > '2030-01-01'"))
    assert cal.clip_to_dates(ranges, none).count() == 0 and cal.dates_of(none).count() == 0


def test_ranges_split_at_gaps_on_request(spark):
    days = [(1, date(2020, 1, d)) for d in (1, 2, 3, 6, 7)] + [(2, date(2020, 1, 5))]
    daily = spark.createDataFrame(days + days[:2], "k int, interval_date date")
    got = sorted((r.k, r.start_date.day, r.end_date.day) for r in cal.compact_ranges(daily, ["k"], split_gaps=True).collect())
    assert got == [(1, 1, 3), (1, 6, 7), (2, 5, 5)]
    assert {(r.k, r.start_date.day, r.end_date.day) for r in cal.compact_ranges(daily, ["k"]).collect()} == {(1, 1, 7), (2, 5, 5)}
