from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from conftest import rows
from wattledger.functions.plans import cut, scratch_path
from wattledger.operators import calibrate, market, profiles, report, settle, terms, trades
from wattledger.plans import outlook, revaluation, storage
from wattledger.sources.checks import check_contract
from wattledger.sources.schemas import TABLES, instrument_dim
from wattledger.sources.sinks import replace_slice, write_snapshot

QUOTES = """product string, node string, period string, period_start date, period_end date, load string,
    consolidate_date date, price double"""


def test_balance_of_quarter(spark):
    as_of = date(2024, 1, 11)
    quote = lambda product, quarter, day, price: (
        product, "A", f"Q{quarter}", date(2024, quarter * 3 - 2, 1), date(2024, quarter * 3, 28), "Flat", day, price,
    )
    quotes = spark.createDataFrame(
        [
            quote("Swap", 1, date(2024, 1, 9), 60.0), quote("Swap", 1, date(2024, 1, 10), 50.0),
            quote("Cap", 1, date(2024, 1, 8), 10.0), quote("Swap", 2, date(2024, 1, 10), 70.0),
        ],
        QUOTES,
    )
    payout = spark.createDataFrame(
        [(2024, 1, "A1", 100.0, 0.0, 10, 90)],
        "year int, quarter int, regionid string, qtd_swap_payout double, qtd_cap_payout double, days_qtd int, days_in_quarter int",
    )
    got = {r.period: r for r in market.quarterly_futures(quotes, payout, as_of).collect()}
    assert got["Q1"].swap == 50 and got["Q1"].cap == 10 and got["Q1"].energy == 40
    assert got["Q1"].swap_boq == pytest.approx((50 * 90 - 100 * 10) / 80)
    assert got["Q1"].cap_boq == pytest.approx(10 * 90 / 80)
    assert got["Q2"].swap_boq == 70 and got["Q2"].cap is None
    apart = market.quarterly_futures(quotes, payout, as_of, split_by_quote_date=True)
    assert apart.where("period = 'Q1'").count() == 2


def test_quarter_to_date_counts_days_before_today(spark):
    from datetime import datetime

    spot = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0), "A1", 1.0), (datetime(2024, 1, 2, 0, 0), "A1", 400.0), (datetime(2024, 1, 3, 0, 5), "A1", 9.0)],
        "settlementdate timestamp_ntz, regionid string, rrp double",
    )
    days = spark.createDataFrame([(date(2024, 1, 1), 2024, 1), (date(2024, 1, 2), 2024, 1)], "interval_date date, year int, quarter int")
    got = market.quarter_to_date_payout(spot, days, date(2024, 1, 3)).collect()
    assert [(r.qtd_swap_payout, r.qtd_cap_payout, r.days_qtd, r.days_in_quarter) for r in got] == [(400.0, 100.0, 1, 2)]


def test_statuses_default(spark):
    df = spark.createDataFrame([("Approved",), ("Rejected",)], "status string")
    assert report.filter_status(df, None).count() == 1
    assert report.filter_status(df, ["Rejected"]).count() == 1


def test_report_rates_and_status(spark):
    columns = report.DEAL_KEYS + ["year", "quarter", "volume_mwh", "total_cost", "total_income", "total_earnings", "twp", "curve"]
    ddl = "deal_id int, deal_name string, product_name string, instrument string, status string, buy_sell string, strategy string, regionid string, `group` string, year int, quarter int, volume_mwh double, total_cost double, total_income double, total_earnings double, twp double, curve string"
    row = lambda deal, side, volume, curve="c", earned=1.0: (deal, "d", "p", "i", "Approved", side, "s", "r", "g", 2025, 1, volume, 10.0, 30.0, earned, 5.0, curve)
    df = spark.createDataFrame(
        [row(1, "Buy", 10.0), row(2, "Sell", 0.0), row(77, "Buy", 1.0), row(4, "Buy", 1.0, "unnamed"), row(5, "Buy", 1.0, earned=None)], ddl
    )
    assert df.columns == columns
    names = spark.createDataFrame([("c", "Curve")], "curve string, curve_name string")
    got = {r["Deal ID"]: r for r in report.outlook_report(df, names, placeholders=(77,)).collect()}
    assert set(got) == {1, 2, 77}
    assert got[1]["Floating Earnings"] == 30 and got[1]["Fixed Earnings"] == -10 and got[1]["VW Floating Rate"] == 3
    assert got[2]["Floating Earnings"] == -10 and got[2]["Fixed Earnings"] == 30 and got[2]["VW Fixed Rate"] is None
    assert got[1]["Status"] == "Contracted" and got[77]["Status"] == "Hypothetical"


def test_mean_outlook_is_the_total_over_samples_when_all_hold_the_deal(spark, inputs):
    one = q.clean(inputs).drop("sample_id")
    doubled = one.withColumn("sample_id", F.explode(F.array(F.lit(1), F.lit(2))))
    mean = report.outlook_sample_mean(doubled, "x").agg(F.sum("total_earnings")).first()[0]
    total = report.outlook_simple(one, "x").agg(F.sum("total_earnings")).first()[0]
    assert mean == pytest.approx(total)


def test_slices_are_replaced_and_others_kept(spark):
    path = scratch_path(spark, "slices")
    make = lambda day, n: spark.range(n).withColumn("run_date", F.lit(day))
    for df in (make(date(2024, 1, 1), 3), make(date(2024, 1, 2), 4), make(date(2024, 1, 2), 5), make(date(2024, 1, 2), 5)):
        replace_slice(df, path, ["run_date"])
    assert spark.read.parquet(path).groupBy("run_date").count().count() == 2
    assert spark.read.parquet(path).count() == 8
    write_snapshot(make(date(2024, 1, 3), 1), path, ["run_date"])
    assert spark.read.parquet(path).count() == 1


def test_contract_check_finds_faults(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "instrument_id int, instrument string")
    found = {(r.rule, r["columns"]): r.violations for r in check_contract(df, TABLES["instruments"]).collect()}
    assert found == {("not_null", "instrument_id"): 1, ("not_null", "instrument"): 0, ("unique", "instrument_id"): 1}


def test_wholesale_and_storage_terms(spark, inputs):
    got = terms.storage_terms(inputs.storage).first()
    assert got.tolling_fee == 27.5 * (100 + got.deal_id) * 24 and got.quantity == 1


def test_unit_without_meter_gets_the_regional_factor(spark):
    units = spark.createDataFrame(
        [(1, 10, None, 1, "Solar", 12.0), (2, 20, "U", 1, "Solar", 12.0)],
        "deal_id int, product_id int, duid string, region_number int, fuel string, size_mw double",
    )
    day = date(2024, 5, 1)
    clock = spark.createDataFrame([(2024, 5, 1, 1), (2024, 5, 1, 2)], "year int, month_id int, day_id int, period_id int")
    capacity = spark.createDataFrame([(1, day, 1, 0.5, 0.1)], "region_number int, interval_date date, period_id int, solar_avail_cf double, wind_avail_cf double")
    from datetime import datetime

    scada = spark.createDataFrame([("U", datetime(2024, 5, 1, 0, 10), 24.0)], "duid string, settlementdate timestamp_ntz, scadavalue double")
    detail = spark.createDataFrame([("U", day, day, 0.5, 1.0)], "duid string, start_date date, end_date date, transmissionlossfactor double, distributionlossfactor double")
    samples = spark.createDataFrame([(1, 2024)], "model_id int, gen_reference_year int")
    got = profiles.generation_profiles(clock, samples, units, scada, scada.limit(0).withColumnRenamed("scadavalue", "availability"), capacity, detail)
    assert rows(got, "product_id", "period_id", "generation_mwh") == [(10, 1, 0.5), (20, 1, 0.25), (20, 2, 1.0)]


def test_profiles_are_not_shuffled_by_contract_and_equal_plain_rows(spark, monkeypatch):
    """The result has a row for each contract and interval: only what is read may be moved."""
    from datetime import datetime

    monkeypatch.setattr(profiles, "METERS_A_BUCKET", 2)
    units = [
        (p, d, r, f, float(10 + p)) for p, (d, r, f) in enumerate(
            [(None, 1, "Solar"), ("U", 1, "Solar"), ("U", 1, "Solar"), ("U", 2, "Wind"), ("V", 1, "Wind"), ("W", 3, "Wind"),
             ("X", None, "Solar"), ("Y", 1, None), ("Z", 1, "Solar"), ("U", 1, "Wind")]
        )
    ]
    day = date(2024, 5, 1)
    capacity = [(1, day, 1, 0.5, 0.1), (1, day, 1, 0.25, 0.2), (1, day, 2, None, 0.3), (2, day, 1, 0.5, None), (1, day, 9, 0.9, 0.9)]
    at = lambda p: datetime(2024, 5, 1, 0, 5 * p)
    scada = [("U", at(1), 6.0), ("U", at(1), 12.0), ("V", at(2), 24.0), ("W", at(1), 36.0), ("X", at(1), 1.0), ("Y", at(1), 1.0), ("U", at(3), None), (None, at(1), 5.0)]
    dispatch = [("U", at(1), 3.0), ("W", at(2), 48.0), ("V", at(2), None), ("Z", at(9), 9.0)]
    loss = {"U": 0.5, "W": 0.25}

    expected = []
    for product, duid, region, fuel, size in units:
        for period in (1, 2, 3):
            factors = [c[3 if fuel == "Solar" else 4] for c in capacity if c[0] == region and c[2] == period]
            top = lambda xs: max((x for x in xs if x is not None), default=None)
            read = [top(v for d, t, v in source if d == duid and d is not None and t == at(period)) for source in (dispatch, scada)]
            factor = top(factors) if fuel else None
            value = next((v for v in (*read, None if factor is None else factor * size) if v is not None), None)
            if value is not None and region is not None and fuel is not None:
                expected += [(m, product, period, value / 12 * loss.get(duid, 1.0)) for m in (1, 2)]

    frame = spark.createDataFrame
    reading = "duid string, settlementdate timestamp_ntz, {} double"
    got = profiles.generation_profiles(
        frame([(2024, 5, 1, p) for p in (1, 2, 3, 3)], "year int, month_id int, day_id int, period_id int"),
        frame([(1, 2024), (2, 2024), (1, 2024), (1, None)], "model_id int, gen_reference_year int"),
        frame([(p, *u) for p, *u in units], "product_id int, duid string, region_number int, fuel string, size_mw double"),
        frame(scada, reading.format("scadavalue")), frame(dispatch, reading.format("availability")),
        frame(capacity, "region_number int, interval_date date, period_id int, solar_avail_cf double, wind_avail_cf double"),
        frame(
            [(d, day, day, f, 1.0) for d, f in loss.items()],
            "duid string, start_date date, end_date date, transmissionlossfactor double, distributionlossfactor double",
        ),
    )
    assert rows(got, "model_id", "product_id", "period_id", "generation_mwh") == sorted(expected)
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [line for line in plan if "hashpartitioning(duid" in line and "region_number" in line]


def test_unknown_model_raises(inputs):
    with pytest.raises(ValueError):
        profiles.simulations_for(inputs.sims, inputs.models, "absent")
    with pytest.raises(ValueError):
        profiles.simulations_for(inputs.sims, inputs.models, "unused")
    with pytest.raises(TypeError):
        profiles.simulations_for(inputs.sims, inputs.models, 1.5)
    assert profiles.simulations_for(inputs.sims, inputs.models, 1).count() == inputs.sims.count()


def test_revaluation_from_terms_to_quarters(spark, inputs):
    i = inputs
    tables = revaluation.Tables(spark, scratch_path(spark, "revaluation"))
    star, shapes = q.star(i), i.shapes
    book = revaluation.update_terms(
        tables, star, i.units, i.storage, q.certificate_rates(i), trades.deal_factors(i.factors_raw), shapes, i.region,
        i.dates, q.TODAY,
    )
    branches = ("c3_retail_energy_terms", "c4_retail_certificate_terms", "c5_wholesale_terms")
    expected = sum(q.QUERIES[name](spark, i.sf_dir).count() for name in branches)
    assert book.where(F.col("instrument").rlike("retail|flat|profiled")).count() == expected
    revaluation.update_rate_calendar(tables, i.datetimes, i.jurisdiction, i.holidays, q.rates(i), q.TODAY)
    prices = revaluation.update_prices(tables, i.sims, i.models, "base", i.quotes, i.trading, i.dates, i.region, q.TODAY)
    assert check_contract(prices, TABLES["scenario_prices"], {"regions": i.region}).where("violations > 0").count() == 0
    path = tables.path("storage_profiles")
    storage.update_storage_profiles(path, q.dispatch_rows(i), i.storage, i.unit_detail, 1)
    earnings = revaluation.update_earnings(
        tables, i.gen_profile, spark.read.parquet(path), i.load_profile, i.samples, shapes, i.jurisdiction, i.quotes,
        i.dates, q.TODAY,
    )
    assert earnings.count() > 0
    first = revaluation.update_quarters(tables, q.TODAY).count()
    again = revaluation.update_quarters(tables, q.TODAY)
    assert first == again.count() > 0
    income = earnings.agg(F.sum("income")).first()[0]
    assert again.agg(F.sum("income")).first()[0] == pytest.approx(income)
    assert {r.instrument for r in instrument_dim(spark).collect()} >= {r.instrument for r in book.select("instrument").distinct().collect()}


def test_outlook_plan(spark, inputs):
    names = spark.createDataFrame(
        [("h", "Hindcast"), ("m", "Mean"), ("m_p90", "P90"), ("m_p10", "P10"), ("Central", "C"), ("n", "N"), ("n_p90", "N90")], "curve string, curve_name string"
    )
    got = outlook.outlook(
        inputs.outlook, {"m": inputs.outlook, "n": inputs.outlook}, inputs.outlook, inputs.product_instrument, names,
        date(1995, 1, 1), date(2001, 12, 31), hindcast_curve="h", ranks={"p90": 2, "p10": 1},
        csv=scratch_path(spark, "outlook-csv"),
    )
    assert {r["Curve Name"] for r in got.select("Curve Name").distinct().collect()} == {"Hindcast", "Mean", "P90", "P10", "C", "N", "N90"}
    ranks = report.sample_rank(inputs.outlook)
    rows = report.with_year_quarter(report.product_instrument(inputs.outlook, inputs.product_instrument))
    apart = report.outlook_at_rank(rows, ranks, 2, "a").unionByName(report.outlook_at_rank(rows, ranks, 1, "b"))
    together = report.outlook_at_ranks(rows, ranks, {"a": 2, "b": 1})
    columns = ["curve", "deal_id", "year", "quarter", "status", "group", "instrument", "strategy", "regionid"]
    counted = [df.groupBy(*columns).agg(F.round(F.sum("total_cost"), 4).alias("c")) for df in (apart, together)]
    assert counted[0].exceptAll(counted[1]).count() == counted[1].exceptAll(counted[0]).count() == 0


def test_monthly_plan_writes_the_report(spark, inputs):
    path = scratch_path(spark, "monthly-csv")
    got = outlook.monthly_outlook(
        inputs.outlook, inputs.product_instrument, date(1996, 1, 1), date(1998, 12, 31), statuses=["Approved"], csv=path
    )
    stored = spark.read.csv(path, header=True, schema=got.schema)
    assert stored.count() == got.count() > 0
    assert {r["Month"] for r in stored.select("Month").distinct().collect()} <= set(range(1, 13))


def test_profile_refresh(spark, inputs):
    i = inputs
    tables = revaluation.Tables(spark, scratch_path(spark, "profiles"))
    one_model = i.samples.where("model_id = 1").withColumn("gen_reference_year", F.lit(2024))
    generation, load = revaluation.update_profiles(
        tables, i.clock.withColumn("period_30min", F.col("period_id")), one_model, i.units.dropDuplicates(["product_id"]), q.scada(i), q.availability(i), i.capacity,
        i.unit_detail, i.halfhour.limit(0), i.avg_loss, i.jurisdiction,
    )
    assert generation.count() > 0 and load.count() == 0
    assert generation.dtypes == [(f.name, f.dataType.simpleString()) for f in TABLES["generation_profiles"].schema.fields]


def test_a_broken_contract_stops_the_stage(spark):
    tables = revaluation.Tables(spark, scratch_path(spark, "broken"))
    rows = spark.createDataFrame([(1, None, date(2020, 1, 1), 1, 2.0)], "product_id int, jurisdiction_id int, interval_date date, period_id int, rate double")
    with pytest.raises(ValueError, match="rate_calendar"):
        tables.store("rate_calendar", rows)


def test_scratch_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace

    from wattledger.functions.plans import shared_dir

    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda key, default: folder, set=lambda key, value: None)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(session(master))
    assert shared_dir(session("yarn", "hdfs:///x")) == "hdfs:///x" and shared_dir(session("local[4]"))


def test_filters_reach_the_scan(spark, inputs, capsys):
    path = scratch_path(spark, "sims")
    write_snapshot(inputs.sims, path)
    from wattledger.operators import calibrate

    best = spark.createDataFrame([(1, 1998, 3)], "sample_id int, year int, quarter int")
    calibrate.select_best_path(spark.read.parquet(path), best, q.TODAY).explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(interval_date,1998-05-20)" in plan and "Exchange hash" not in plan


def test_wholesale_prices_escalate_on_request(spark):
    trades_ = spark.createDataFrame(
        [(1, 7, "P", "Buy", "Firm", 2.0, 100.0, 300.0, "R1", date(2020, 1, 1), date(2020, 1, 31), "Swap A", "Swap")],
        "deal_id int, product_id int, product_name string, buy_sell string, optionality string, quantity double, price double,"
        " strike_price double, regionid string, product_start_date date, product_end_date date, instrument string, instrument_calculation string",
    )
    regions = spark.createDataFrame([("R1", 1)], "regionid string, region_number int")
    shapes = spark.createDataFrame([], "product_id int, volume_factor double")
    days = spark.sql("select explode(sequence(date'2020-01-01', date'2020-01-31')) interval_date")
    factors = spark.createDataFrame(
        [(1, "R", date(2020, 1, 11), date(2020, 1, 20), 1.1)], "deal_id int, type string, from_date date, to_date date, factor double"
    )
    plain = terms.wholesale_terms(trades_, regions, shapes, days).collect()
    assert [(r.price, r.start_date.day, r.end_date.day) for r in plain] == [(100.0, 1, 31)]
    raised = terms.wholesale_terms(trades_, regions, shapes, days, escalation=factors).collect()
    assert sorted((round(r.price, 2), r.start_date.day, r.end_date.day) for r in raised) == [(100.0, 1, 31), (110.0, 11, 20)]


def test_an_open_toll_can_end_with_its_month(spark):
    contracts = spark.createDataFrame(
        [(1, 7, 1, date(2020, 1, 1), date(2020, 3, 31), 1.0, None, None)],
        "deal_id int, product_id int, region_number int, start_date date, end_date date, quantity_factor double, floor double, turndown double",
    )
    sides = spark.createDataFrame([(7, 1, "Buy", 50.0)], "product_id int, deal_id int, buy_sell string, price double")
    days = spark.sql("select explode(sequence(date'2020-01-01', date'2020-03-31')) interval_date")
    factors = spark.createDataFrame(
        [(1, "M", date(2020, 2, 1), date(9999, 12, 31), 2900.0)], "deal_id int, type string, from_date date, to_date date, factor double"
    )
    got = terms.ppa_energy_terms(contracts, sides, factors, days, open_toll_to_month_end=True).collect()
    tolled = [(r.tolling_fee, r.start_date, r.end_date) for r in got if r.tolling_fee is not None]
    assert tolled == [(100.0, date(2020, 2, 1), date(2020, 2, 29))]


def test_dimension_joins_leave_facts_where_they_are(spark, inputs):
    """Without automatic broadcasts, no fact is shuffled on a key with few values."""
    i = inputs
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = spark.createDataFrame([(1, 2020, 1, 1, 1, date(2020, 1, 1))], "model_id int, demand_reference_year int, month_id int, day_id int, period_id int, interval_date date")
        curve = spark.createDataFrame([(date(1998, 1, 1), 20.0)], "period_start date, price double")
        plans = {
            "regionid": trades.with_region_number(cut(i.trading), i.region),
            "jurisdiction_id": trades.with_jurisdiction(cut(i.load).drop("region_number"), i.jurisdiction),
            "model_id": profiles.simulations_for(cut(i.sims), i.models, 1, validate=False),
            "sample_id": profiles.sample_index(cut(i.path), i.samples, "gen_reference_year"),
            "jurisdiction": profiles.load_profiles(i.datetimes, i.samples, cut(i.halfhour), cut(i.avg_loss), i.jurisdiction),
            "duid": profiles.unit_actuals(cut(q.scada(i)), i.units),
            "year": calibrate.apply_certificate_floor(cut(i.path), curve),
            "jurisdiction_id, 1": profiles.scenario_load(cut(i.load_profile), index, i.jurisdiction),
        }
        for key, df in plans.items():
            name = key.split(",")[0]
            plan = df._jdf.queryExecution().executedPlan().toString()
            joins = [line for line in plan.splitlines() if "Join [" in line and f"{name}#" in line.split("]")[0]]
            assert joins and all("BroadcastHashJoin" in line for line in joins), (key, joins)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_profiles_prune_readings_at_the_scan(spark, inputs, tmp_path):
    i = inputs
    path = str(tmp_path / "ticks")
    q.scada(i).write.parquet(path)
    details = i.samples.withColumn("gen_reference_year", F.lit(2024))
    got = profiles.generation_profiles(i.clock, details, i.units, spark.read.parquet(path), q.availability(i), i.capacity, i.unit_detail)
    assert "GreaterThanOrEqual(settlementdate,2024-01-01" in got._jdf.queryExecution().executedPlan().toString()
