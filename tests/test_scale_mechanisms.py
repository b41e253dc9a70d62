"""Mechanisms for large inputs: slices that survive a lost driver, sweeps, split passes, one scan per table."""

import random
from datetime import date, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks import queries as q
from conftest import SMALL, rows
from wattledger.functions.plans import cut, cut_by, scratch_path
from wattledger.functions.sweep import sweep_join
from wattledger.operators import calendar as cal
from wattledger.operators import calibrate, report, settle, terms, trades
from wattledger.sources import sinks
from wattledger.sources.checks import check_contract
from wattledger.sources.schemas import TABLES

D = date(2024, 1, 1)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Slices


def named(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, n int")


def stored(spark, path):
    return rows(sinks.read_slices(spark, path), "k", "n")


def test_null_and_escaped_slices_are_replaced_and_cleared(spark):
    path = scratch_path(spark, "slices")
    odd = [None, "a:b", "x", "50%", "p/q=r", "{z}*?", "é ü"]
    sinks.replace_slice(named(spark, *[(k, i) for i, k in enumerate(odd)]), path, ["k"])
    assert {k for k, _ in stored(spark, path)} == set(odd)
    sinks.replace_slice(named(spark, ("x", 20)), path, ["k"], [(None,), ("a:b",), ("{z}*?",)])
    assert dict(stored(spark, path)) == {"x": 20, "50%": 3, "p/q=r": 4, "é ü": 6}
    sinks.replace_slice(named(spark, ("50%", 30), ("p/q=r", 40)), path, ["k"], [("x",), ("never there",)])
    assert dict(stored(spark, path)) == {"50%": 30, "p/q=r": 40, "é ü": 6}
    # At rest the folder is a plain partitioned table.
    assert rows(spark.read.parquet(path), "n") == [(6,), (30,), (40,)]


@pytest.mark.parametrize("alone", [0, 200])
def test_new_folders_move_as_a_whole_and_slices_are_listed_in_few_calls(spark, monkeypatch, alone):
    """Calls to the store for each slice made a table of thousands of slices slow."""
    monkeypatch.setattr(sinks, "LISTED_ALONE", alone)
    path, moved, listed = scratch_path(spark, "levels"), [], []
    move, names = sinks.Folder.move, sinks.Folder.names
    monkeypatch.setattr(sinks.Folder, "move", lambda self, *a: moved.append(a[1]) or move(self, *a))
    monkeypatch.setattr(sinks.Folder, "names", lambda self, *a: listed.append(a) or names(self, *a))
    table = spark.createDataFrame([(f"k{i // 3}:", i % 3, i) for i in range(12)], "k string, part int, n int")
    held = lambda: rows(sinks.read_slices(spark, path, table.schema), "k", "part", "n")
    sinks.replace_slice(table, path, ["k", "part"])
    assert held() == rows(table, "k", "part", "n")
    assert len(moved) == 4 + 1 and len(listed) == 1
    # Old, cleared and new slices below old and new folders, one of them named although it never was.
    later = spark.createDataFrame([("k0:", 1, 100), ("k0:", 7, 101), ("new", 0, 102)], "k string, part int, n int")
    sinks.replace_slice(later, path, ["k", "part"], [("k3:", 2), (None, 0)])
    kept = [r for r in rows(table, "k", "part", "n") if r[:2] not in {("k0:", 1), ("k3:", 2)}]
    assert held() == sorted([*kept, *rows(later, "k", "part", "n")])
    assert rows(spark.read.parquet(path), "n") == sorted((r[2],) for r in held())


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "move", "delete"])
@pytest.mark.parametrize("after", [0, 1, 2, 3])
def test_a_lost_driver_leaves_old_or_new_slices(spark, monkeypatch, step, after):
    """Broken off at any step, readers see all slices as before or all as after; a rerun mends it."""
    path = scratch_path(spark, "lost")
    old = [("a", 1), ("b", 2), ("c:d", 3), (None, 4)]
    new = [("a", 10), ("c:d", 30)]
    after_all = [("a", 10), ("b", 2), ("c:d", 30)]
    sinks.replace_slice(named(spark, *old), path, ["k"])
    plain, calls = getattr(sinks.Folder, step), []

    def failing(self, *args):
        if step != "move" or not args[1].startswith("_"):
            calls.append(args)
            if len(calls) > after:
                raise Lost
        return plain(self, *args)

    monkeypatch.setattr(sinks.Folder, step, failing)
    try:
        sinks.replace_slice(named(spark, *new), path, ["k"], [(None,)])
    except Lost:
        pass
    monkeypatch.undo()
    decided = sinks.Folder(spark, path).exists(sinks.COMMIT)
    left = {k: n for k, n in stored(spark, path)}
    assert len(stored(spark, path)) == len(left)
    assert left == dict(old) if step == "write" and after == 0 else left == dict(after_all)
    assert decided or left in (dict(old), dict(after_all))
    sinks.replace_slice(named(spark, ("b", 20)), path, ["k"])
    expected = {**left, "b": 20}
    assert dict(stored(spark, path)) == expected and not sinks.Folder(spark, path).exists(sinks.COMMIT)
    assert rows(spark.read.parquet(path), "n") == sorted((n,) for n in expected.values())


# Outlook


def test_a_table_stored_by_key_is_summed_where_it_lies(spark):
    for found in ([(None, 1.0), ("a", 2.0), ("a", 3.0), ("b:/", None)], []):
        df = spark.createDataFrame(found, "k string, v double")
        held = cut_by(df, ["k"])
        assert rows(held) == rows(df) and held.schema == df.schema
        sums = held.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).groupBy("k").agg(F.sum("v").alias("v"))
        assert "Exchange" not in executed(sums)
        assert rows(sums) == rows(df.groupBy("k").agg(F.sum("v").alias("v")))


@pytest.mark.parametrize("name", ["r7_outlook_sample_mean", "r12_clean_and_aggregate", "r13_combine_curves", "r14_outlook_report"])
def test_curves_do_not_shuffle_the_outlook_again(spark, name):
    """Its rows are shuffled once a query, when it is stored by deal, and not by each curve."""
    assert "hashpartitioning(deal_id" not in executed(q.QUERIES[name](spark, SMALL))


def test_a_long_product_list_does_not_shuffle_the_rows(spark):
    """Only the products that occur are taken of it."""
    info = spark.range(250_000).selectExpr("cast(id as int) product_id", "concat('I', id % 3) instrument")
    info = info.unionByName(spark.createDataFrame([(7, "again"), (7, "again"), (None, "null")], "product_id int, instrument string"))
    df = spark.createDataFrame([(7, 1), (8, 2), (None, 3), (-1, 4), (8, 2)], "product_id int, n int")
    got = report.product_instrument(df, info)
    assert "SortMergeJoin" not in executed(got)
    assert rows(got, "n", "instrument") == [(1, "I1"), (1, "again"), (2, "I2"), (2, "I2"), (3, None), (4, None)]


# Sweep


def swept_inputs(spark):
    random.seed(2)
    facts = [(k, D + timedelta(days=d), p) for k in (1, 2, 5) for d in range(0, 400, 1 if k == 2 else 7) for p in range(3)]
    facts += [(None, D, 1), (1, None, 1), (-3, date(1, 1, 1), 1), (-3, date(9999, 12, 31), 2)]
    ranges = [(random.choice([1, 2, 2, 2, 3]), D + timedelta(days=a), D + timedelta(days=a + random.randrange(-2, 200)), i)
              for i in range(150) for a in [random.randrange(-50, 420)]]
    ranges += [(2, date(1, 1, 1), date(9999, 12, 31), 900), (-3, date(1, 1, 1), date(9999, 12, 31), 901), (2, D, D, 902)]
    ranges += [(None, D, D, 903), (2, None, D, 904), (2, D, None, 905)]
    return (
        spark.createDataFrame(facts, "k int, day date, p int"),
        spark.createDataFrame(ranges, "k int, opens date, closes date, id int"),
    )


@pytest.mark.parametrize("part_facts, matches", [(10**6, 10**6), (100, 7), (7, 1)])
def test_sweep_equals_a_range_join(spark, monkeypatch, part_facts, matches):
    from wattledger.functions import sweep

    monkeypatch.setattr(sweep, "BATCH_MATCHES", matches)
    facts, ranges = swept_inputs(spark)
    found = sweep_join(facts, ranges, "k", "day", "opens", "closes", part_facts)
    plain = facts.join(F.broadcast(ranges), "k").where(F.col("day").between(F.col("opens"), F.col("closes")))
    assert found.columns == ["k", "day", "p", "id"]
    assert rows(found) == rows(plain.select(found.columns)) and found.count() > 10_000
    assert "Generate" not in executed(found)


def test_sweep_without_facts_or_ranges(spark):
    facts, ranges = swept_inputs(spark)
    for a, b in ((facts.limit(0), ranges), (facts, ranges.limit(0)), (facts.limit(0), ranges.limit(0))):
        assert sweep_join(a, b, "k", "day", "opens", "closes", 50).count() == 0


def test_a_range_is_a_row_per_part_not_per_day(spark):
    facts, _ = swept_inputs(spark)
    long_one = spark.createDataFrame([(2, date(1, 1, 1), date(9999, 12, 31), 1)], "k int, opens date, closes date, id int")
    found = sweep_join(facts, long_one, "k", "day", "opens", "closes", 200)
    assert found.count() == 1200
    found.collect()
    # Of 400 days of that key, the one range stands in as many rows as the key has parts.
    from wattledger.functions.sweep import _copies, _part_bounds, _place
    from pyspark.sql.types import StructType

    bounds = _part_bounds(facts.where("k is not null and day is not null").select(_place(F.col("k"), F.col("day")).alias("_at")), 200)
    given = long_one.select(
        _place(F.col("k"), F.col("opens")).alias("_first"), _place(F.col("k"), F.col("closes")).alias("_last"),
        F.lit(None).cast("struct<a:int>").alias("_fact"), F.struct("id").alias("_range"),
    )
    schema = StructType.fromDDL("_part int, _at long, _kind int, _last long, _fact struct<a:int>, _range struct<id:int>")
    assert 4 <= _copies(given, bounds, schema).count() <= len(bounds) + 1 <= 14


# Turndowns


def turndown_inputs(spark, inputs, tmp_path):
    path = str(tmp_path / "generation")
    inputs.generation.write.parquet(path)
    return spark.read.parquet(path), cut(inputs.terms), cut(inputs.spot)


def test_only_rows_with_a_turndown_meet_prices(spark, inputs, tmp_path):
    generation, limits, spot = turndown_inputs(spark, inputs, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = settle.apply_turndown(generation, limits, spot)
        assert "Exchange hashpartitioning(interval_date" not in executed(few)
        many = settle.apply_turndown(generation, limits, spot, broadcast_rows=0)
        plan = executed(many)
        shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning(interval_date" in line]
        assert shuffled and "PartitionFilters: [isnotnull(_limited" in plan and "NOT _limited" in plan
        assert "region_number" in shuffled[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    columns = ("product_id", "interval_date", "period_id", "generation_mwh")
    assert rows(few, *columns) == rows(many, *columns)
    turned = few.where("generation_mwh = 0").count()
    assert 0 < turned < few.count()


# Energy adjustment


def looped(prices, target, rounds=10, strike=300.0):
    """The plain loop over one group, and the errors ahead of each round."""
    errors = []
    for _ in range(rounds):
        middle = sum(min(max(p, 0), strike) for p in prices) / len(prices)
        gap = target - sum(min(p, 0) for p in prices) / len(prices)
        errors.append(abs(gap - middle))
        if middle:
            prices = [min(p * (gap / middle), strike) if 0 <= p <= strike else p for p in prices]
    return prices, errors


@pytest.mark.parametrize("kind", ["spread", "clipped", "negative", "zeros", "above"])
def test_rounds_by_prefix_sums_equal_the_loop(kind):
    import numpy as np
    import pyarrow as pa

    random.seed(kind)
    prices = [random.uniform(-80, 900) if random.random() < 0.3 else random.uniform(0, 300) for _ in range(500)]
    target = {"spread": 90.0, "clipped": 260.0, "negative": -40.0, "zeros": 50.0, "above": 10.0}[kind]
    if kind == "zeros":
        prices = [0.0] * 30 + [-5.0] * 3
    if kind == "above":
        prices = [400.0, 300.0, 299.999, 0.0]
    n = len(prices)
    group = pa.table({"year": [2024] * n, "quarter": [1] * n, "region_number": [1] * n, "rrp": prices, "target": [target] * n})
    made = calibrate._rounds(10, 300.0)(group).to_pylist()[0]
    expected, errors = looped(prices, target)
    assert made["errors"] == pytest.approx(errors, rel=1e-9, abs=1e-9)
    replayed = np.array(prices)
    for f in made["factors"]:
        if f is not None:
            scaled = (replayed >= 0) & (replayed <= 300)
            replayed[scaled] = np.minimum(replayed[scaled] * f, 300)
    assert replayed.tolist() == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_the_path_is_read_once_for_all_rounds(spark, inputs, monkeypatch):
    """Whatever the number of rounds: one table of the path, one of the factors, no table per round."""
    tables = []
    monkeypatch.setattr(calibrate, "cut", lambda df: tables.append(cut(df)) or tables[-1])
    path, futures = q.path_ahead(inputs), q.futures(inputs)
    for rounds in (1, 10):
        tables.clear()
        calibrate.apply_energy_adjustment(path, futures, inputs.region, max_iterations=rounds)
        assert len(tables) == 2 and tables[1].columns[-2:] == ["errors", "factors"]


# Date buckets


def test_rates_meet_few_days_outside_their_dates(spark, inputs):
    from wattledger.operators.trades import _bucketed

    random.seed(9)
    days = spark.sql("select explode(sequence(date'2020-01-01', date'2023-12-31')) interval_date").select(
        "interval_date", F.lit(1).alias("jurisdiction_id"), F.lit(1).alias("period_id"), F.lit("W").alias("day_type")
    )
    starts = [date(2020, 1, 1) + timedelta(days=random.randrange(1400)) for _ in range(300)]
    data = [(i, s, s + timedelta(days=random.randrange(40)), 1, "W", 1, 1.0) for i, s in enumerate(starts)]
    rates = spark.createDataFrame(data, "product_id int, from_date date, to_date date, jurisdiction_id int, day_type string, period_id int, rate double")

    def pairs(buckets):
        a, b = _bucketed(days, rates, buckets)
        met = a.join(b, ["jurisdiction_id", "period_id", "day_type", "_bucket"])
        inside = F.col("interval_date").between(F.col("from_date"), F.col("to_date"))
        return met.count(), met.where(inside).count()

    expected = sum((min(c, date(2023, 12, 31)) - s).days + 1 for _, s, c, *_ in data)
    # As many buckets as different ends: nothing outside. Fewer: no more than both end buckets hold.
    assert pairs(1000) == (expected, expected)
    met, inside = pairs(60)
    assert inside == expected and met - inside <= 300 * 2 * (1461 / 60) * 2
    plain = rates.join(days, ["jurisdiction_id", "period_id", "day_type"]).where(F.col("interval_date").between(F.col("from_date"), F.col("to_date")))
    columns = ("product_id", "jurisdiction_id", "interval_date", "period_id", "rate")
    for buckets in (1, 7, 512):
        assert rows(trades.rate_calendar(days, rates, buckets=buckets), *columns) == rows(plain, *columns)
    assert trades.rate_calendar(days.limit(0), rates).count() == trades.rate_calendar(days, rates.limit(0)).count() == 0


# Contract check, holidays, certificates


def test_a_contract_is_checked_in_one_scan(spark, inputs):
    sims = cut(inputs.sims)
    parents = {"models": inputs.models, "sample_details": inputs.samples, "regions": inputs.region}
    report = check_contract(sims, TABLES["scenario_prices"], parents)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [model_id") == 1
    assert report.count() == 6 + 1 + 3
    none = check_contract(sims.limit(0), TABLES["scenario_prices"], parents)
    assert none.agg(F.sum("violations")).first()[0] == 0


def test_a_large_lookup_is_split_over_tasks(spark, inputs):
    i = inputs
    whole = cal.day_type_calendar(i.datetimes, i.jurisdiction, i.holidays)
    split = cal.day_type_calendar(i.datetimes, i.jurisdiction, i.holidays, broadcast_rows=6)
    columns = ("interval_date", "jurisdiction_id", "period_id", "day_type")
    assert rows(split, *columns) == rows(whole, *columns)
    plan = executed(split)
    assert "SortMergeJoin [_split" in plan and "_every" not in plan and "NestedLoop" not in plan


def test_certificate_rates_stay_where_they_are(spark, inputs):
    i = inputs
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = terms.retail_certificate_terms(cut(q.star(i)), i.region, cut(q.certificate_rates(i)), q.horizon(i))
        joins = [line for line in executed(made).splitlines() if "Join [" in line and ("interval_date#" in line.split("]")[0] or "Join [product_id#" in line)]
        assert any("LeftSemi" in j for j in joins)
        early = [j for j in joins if "LeftSemi" in j or j.count("#") == 2]
        assert early and all("BroadcastHashJoin" in j for j in early), joins
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Settling again only what changed


def test_one_changed_term_settles_one_contract(spark, inputs, monkeypatch):
    from wattledger.plans import incremental
    from wattledger.plans.revaluation import Tables

    i = inputs
    facts = [cut(x) for x in (i.generation, i.load, i.shapes, i.spot, i.cert_daily, i.rates)]
    book = cut(i.terms)
    tables = Tables(spark, scratch_path(spark, "incremental"))
    money = ("deal_id", "product_id", "instrument_id", "interval_date", "period_id", "region_number", "volume_mwh", "income", "cost")

    def held():
        return rows(sinks.read_slices(spark, tables.path(incremental.EARNINGS)).select(*money))

    def whole(terms):
        return rows(settle.settle_book(terms, *facts).select(*money))

    assert incremental.update_changed_earnings(tables, book, *facts).count() == book.count()
    assert held() == whole(book)
    assert incremental.update_changed_earnings(tables, book, *facts).count() == 0
    dearer = book.withColumn("price", F.when(F.col("deal_id") == 4, F.col("price") + 1).otherwise(F.col("price")))
    again = incremental.update_changed_earnings(tables, dearer, *facts)
    assert rows(again) == rows(dearer.where("deal_id = 4").select("deal_id", "product_id"))
    assert held() == whole(dearer)
    # A contract that leaves takes its rows with it; one that comes back is settled.
    fewer = dearer.where("deal_id <> 3")
    assert incremental.update_changed_earnings(tables, fewer, *facts).count() == 0
    assert held() == whole(fewer)
    assert rows(incremental.update_changed_earnings(tables, dearer, *facts), "deal_id") == [(3,)]
    # Other generation of one product settles the contracts of that product; a run that lost its
    # driver before the digests were replaced settles them once more, to the same rows.
    product = facts[0].agg(F.max("product_id")).first()[0]
    grown = F.when(F.col("product_id") == product, 1.0).otherwise(0.0)
    facts[0] = cut(facts[0].withColumn("generation_mwh", F.col("generation_mwh") + grown))
    plain = incremental.replace_slice

    def lost(df, path, *args):
        if path.endswith(incremental.DIGESTS):
            raise Lost
        plain(df, path, *args)

    monkeypatch.setattr(incremental, "replace_slice", lost)
    with pytest.raises(Lost):
        incremental.update_changed_earnings(tables, dearer, *facts)
    monkeypatch.undo()
    again = incremental.update_changed_earnings(tables, dearer, *facts)
    assert rows(again) == rows(dearer.where(F.col("product_id") == product).select("deal_id", "product_id").distinct()) != []
    assert held() == whole(dearer)


def test_a_turndown_of_another_contract_counts(spark, inputs):
    """Turndowns hold for all contracts of a product, so one that changes settles them all."""
    from wattledger.plans.incremental import contract_digests

    i = inputs
    facts = (i.generation.limit(50), i.load.limit(50), i.shapes.limit(50), i.spot.limit(50), i.cert_daily.limit(50), i.rates.limit(50))
    facts = [cut(f) for f in facts]
    two = cut(i.terms.where("deal_id in (4, 5, 6)").withColumn("product_id", F.when(F.col("deal_id") == 6, 9).otherwise(4)))
    limited = two.withColumn("turndown", F.when(F.col("deal_id") == 4, F.lit(7.0)).otherwise(F.col("turndown")))
    before, after = ({r.deal_id: r.digest for r in contract_digests(t, *facts).collect()} for t in (two, limited))
    assert before[4] != after[4] and before[5] != after[5] and before[6] == after[6]


# Stored profiles


def test_stored_profiles_are_replayed_where_they_lie(spark, inputs):
    from wattledger.operators import profiles
    from wattledger.plans.revaluation import Tables

    i = inputs
    tables = Tables(spark, scratch_path(spark, "bucketed"), buckets=5)
    generation = tables.store("generation_profiles", i.gen_profile, bucket_by=profiles.REPLAY_KEY)
    load = tables.store("load_profiles", i.load_profile, bucket_by=profiles.REPLAY_KEY)
    index = cut(profiles.sample_index(i.path, i.samples, "gen_reference_year"))
    demand = cut(profiles.sample_index(i.path, i.samples, "demand_reference_year"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        none = q.storage_rows(i).limit(0)
        made = profiles.scenario_generation(generation, none, index, validate=False)
        loads = profiles.scenario_load(load, demand, i.jurisdiction)
        for df, year in ((made, "gen_reference_year"), (loads, "demand_reference_year")):
            plan = executed(df)
            replayed = [x for x in plan.splitlines() if "Exchange hashpartitioning(model_id" in x and year in x]
            # Only the index is shuffled, to the buckets of the profiles.
            assert len(replayed) == 1 and ", 5)" in replayed[0] and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plain = profiles.scenario_generation(i.gen_profile, none, index, validate=False)
    assert rows(made.withColumn("generation_mwh", F.round("generation_mwh", 6))) == rows(plain.withColumn("generation_mwh", F.round("generation_mwh", 6)))
    # Stored again, and read by a session that does not know the buckets.
    part = i.gen_profile.where(F.col("product_id") == i.gen_profile.agg(F.max("product_id")).first()[0])
    again = tables.store("generation_profiles", part, bucket_by=profiles.REPLAY_KEY)
    assert again.count() == part.count() == spark.read.parquet(tables.path("generation_profiles")).count() > 0
    spark.sql(f"drop table {tables.bucketed('load_profiles')}")
    assert tables.read("load_profiles").count() == i.load_profile.count()
    # Without rows there are no files to read the columns from.
    columns = tables.store("load_profiles", i.load_profile.limit(0), bucket_by=profiles.REPLAY_KEY).columns
    spark.sql(f"drop table {tables.bucketed('load_profiles')}")
    none = tables.read("load_profiles")
    assert none.columns == columns and none.count() == 0
    parted = tables.store("settlement_terms", i.terms.limit(0), partition_by=("product_id",))
    assert parted.count() == 0
    with pytest.raises(AnalysisException):
        Tables(spark, scratch_path(spark, "missing")).read("load_profiles")
