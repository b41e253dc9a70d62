"""One registered query per operator, on the views of `checks.views`.

Money, volumes and prices are rounded to two places where a query hands them to the oracle
comparison; the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import AS_OF, Inputs
from wattledger.functions.plans import cut, cut_by, scratch_path
from wattledger.operators import calendar as cal
from wattledger.operators import calibrate, market, profiles, report, settle, terms, trades
from wattledger.plans import incremental, revaluation
from wattledger.sources import captures, sinks
from wattledger.sources.checks import check_contract
from wattledger.sources.schemas import TABLES, TableContract, instrument_dim, with_instrument

TODAY = date.fromisoformat(AS_OF)
RATE_START, RATE_END = date(1996, 1, 1), date(2001, 12, 31)

# Fixed value: the rounding step of the comparison, a little off one half so that sums which
# land on a half cent fall to the same side in every summation order.
HALF = 0.50031731

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RULES = report.EarningsRules(
    cost_share=((3, (90 - 26) / 90),), cap_following=(5,), income_only=((8, "ppa_lgc"),)
)
EXCLUDED = (2, 9)
PLACEHOLDERS = (7,)
CURVES = [("hindcast", "Hindcast"), ("model", "Model (Mean)"), ("model_p90", "Model (P90)"), ("Central", "Scenario Central")]


def query(name: str):
    """Registers a function of the inputs under `name`."""

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        return build

    return register


def cents(df: DataFrame, *columns: str) -> DataFrame:
    """`columns` rounded to two places, the same way as in the oracles."""
    return df.withColumns({c: F.floor(F.col(f"`{c}`") * 100 + HALF) / 100 for c in columns})


def settled(df: DataFrame) -> DataFrame:
    return cents(df, "volume_mwh", "buy_income", "sell_income")


# Shared inputs


def horizon(i: Inputs) -> DataFrame:
    return cal.horizon_filter(i.dates, TODAY)


def star(i: Inputs) -> DataFrame:
    return trades.trade_star(
        i.legs, i.deals, i.products, i.books, i.strategies, i.companies, i.calendars, i.sim_instruments,
        i.markets, i.nodes, ("line", "productid", "l_suppkey", "quantity", "price"),
    )


def offtake_trades(i: Inputs) -> DataFrame:
    side = F.when(F.col("buy"), "Buy").otherwise("Sell").alias("buy_sell")
    return i.terms.select("product_id", "deal_id", side, "price")


def certificate_rates(i: Inputs) -> DataFrame:
    return trades.certificate_rates(i.cert_rates_raw)


def rates(i: Inputs) -> DataFrame:
    spread = i.halfhour.select("product_id", "jurisdiction").distinct().join(i.jurisdiction, "jurisdiction")
    return trades.retail_rates(i.rate_profiles_raw, i.products, spread)


def curve(i: Inputs) -> DataFrame:
    return market.certificate_curve(i.quotes, TODAY)


def futures(i: Inputs) -> DataFrame:
    return market.quarterly_futures(i.quotes, market.quarter_to_date_payout(i.trading, i.dates, TODAY), TODAY)


def path_ahead(i: Inputs) -> DataFrame:
    return i.path.where(F.col("interval_date") >= F.lit(TODAY))


def scada(i: Inputs) -> DataFrame:
    return i.ticks.withColumnRenamed("value", "scadavalue")


def availability(i: Inputs) -> DataFrame:
    return i.availability


def book(i: Inputs, *instruments: str) -> DataFrame:
    return i.terms.where(F.col("instrument").isin(*instruments))


def dispatch_rows(i: Inputs) -> DataFrame:
    """Dispatch by a plain rule (charge under 50, discharge from 50), which SQL can state too."""
    traces = profiles.storage_price_traces(i.sims, curve(i), i.storage)
    return traces.withColumn("metered_energy_mwh", F.when(F.col("rrp") < 50, -10.0).otherwise(8.0))


def storage_rows(i: Inputs) -> DataFrame:
    return profiles.storage_profiles(dispatch_rows(i), i.storage, i.unit_detail, 1)


def outlook(i: Inputs) -> DataFrame:
    """The outlook, stored by deal once a query: curves are sums per deal, and none shuffles its rows again."""
    if "_outlook" not in i.__dict__:
        i._outlook = cut_by(i.outlook, ["deal_id"])
    return i._outlook


def clean(i: Inputs) -> DataFrame:
    """Outlook rows with quarter and instrument, as the outlook aggregates take them."""
    return report.product_instrument(report.with_year_quarter(outlook(i), month=True), i.product_instrument)


def outlook_cents(df: DataFrame) -> DataFrame:
    return cents(df, "volume_mwh", "total_cost", "total_income", "total_earnings", "twp")


def report_cents(df: DataFrame) -> DataFrame:
    return cents(
        df, "Volume (MWh)", "Fixed Earnings", "VW Fixed Rate", "Floating Earnings", "VW Floating Rate",
        "TW Floating Price", "Total Earnings",
    )


def combined(i: Inputs) -> DataFrame:
    rows = clean(i)
    ranks = cut(report.sample_rank(outlook(i)))
    return report.combine_curves(
        [
            report.outlook_simple(rows, "hindcast"),
            report.outlook_sample_mean(rows, "model"),
            report.outlook_at_rank(rows, ranks, 2, "model_p90"),
            report.outlook_by_scenario(rows),
        ]
    )


def curve_names(i: Inputs) -> DataFrame:
    return i.spark.createDataFrame(CURVES, "curve string, curve_name string")


def whole_book(i: Inputs) -> DataFrame:
    return settle.settle_book(i.terms, i.generation, i.load, i.shapes, i.spot, i.cert_daily, i.rates)


# Sources, sinks, checks


@query("k1_check_contract")
def _(i):
    rates_contract = TableContract(
        "product_id int not null, interval_date date not null, lgc_price double not null",
        ("product_id", "interval_date"), {("product_id",): "products"},
    )
    checks = {
        # Several samples share an interval here, so the key of the one chosen path is repeated.
        "scenario_prices": check_contract(
            i.sims, TABLES["scenario_prices"], {"models": i.models, "sample_details": i.samples, "regions": i.region}
        ),
        "settlement_terms": check_contract(i.terms, TABLES["settlement_terms"], {"regions": i.region}),
        "certificate_rates": check_contract(
            i.cert_rates_raw, rates_contract, {"products": i.product_instrument}
        ),
    }
    labelled = [df.select(F.lit(t).alias("table_name"), "*") for t, df in checks.items()]
    return report.combine_curves(labelled)


@query("k2_instrument_dim")
def _(i):
    ids = i.terms.select("deal_id", "product_id", "instrument_id")
    return with_instrument(ids, instrument_dim(i.spark))


@query("k3_read_generation_contracts")
def _(i):
    path = scratch_path(i.spark, "generation-contracts")
    day = lambda c: F.date_format(c, captures.GENERATION_DATES)
    i.units.select(
        "deal_id", "product_id", F.concat(F.lit("Energy "), "duid").alias("name"), "duid", "fuel", "floor", "turndown",
        "size_mw", F.lit("Q8").alias("rez"), "regionid", day("start_date").alias("product_start_date"),
        day("end_date").alias("product_end_date"), "quantity_factor",
    ).write.csv(path, header=True)
    return captures.read_generation_contracts(i.spark, path, i.region)


@query("k4_read_storage_contracts")
def _(i):
    path = scratch_path(i.spark, "storage-contracts")
    i.storage.select(
        "deal_id", "product_id", F.concat(F.lit("Storage "), "duid").alias("name"), "duid", "buy_sell", "regionid",
        "start_date", "end_date", "capacity", "duration", "rte", "toll",
    ).write.csv(path, header=True)
    return captures.read_storage_contracts(i.spark, path, i.region)


@query("k5_write_snapshot")
def _(i):
    path = scratch_path(i.spark, "snapshot")
    sinks.write_snapshot(i.load, path)
    sinks.write_snapshot(i.generation, path)
    return cents(i.spark.read.parquet(path), "generation_mwh")


@query("k6_replace_slice")
def _(i):
    path = scratch_path(i.spark, "slices")
    rows = settle.orient(settle.flat_energy_swap(book(i, "flat_energy_swap"), i.spot), i.terms)
    for day in (TODAY, date(1998, 5, 21), TODAY):
        sinks.replace_slice(report.quarterly_earnings(rows, day), path, ["run_date"], [(day,)])
    # A rerun without rows clears its own slice.
    gone = date(1998, 5, 22)
    for part in (rows, rows.limit(0)):
        sinks.replace_slice(report.quarterly_earnings(part, gone), path, ["run_date"], [(gone,)])
    return cents(sinks.read_slices(i.spark, path), "volume_mwh", "income", "cost")


@query("k6_replace_named_slices")
def _(i):
    """Slices by product name and side, some names null or with characters that folders escape."""
    path = scratch_path(i.spark, "named-slices")
    name = F.when(F.col("product_id") % 5 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("a:b/c="), F.col("product_id").cast("string"), F.lit(" %"))
    )
    rows = i.terms.select(name.alias("product_name"), "buy", "deal_id", "quantity")
    # Contracts are a small table with many slices: dealt out by slice, all cores write files.
    rows = rows.repartition(i.spark.sparkContext.defaultParallelism * 4, "product_name", "buy")
    sinks.replace_slice(rows, path, ["product_name", "buy"])
    # Null names drop out of the second run, so the slice of null and true is cleared, null and false stays.
    late = rows.where((F.col("deal_id") % 3 == 0) & (F.col("product_name") != "a:b/c=4 %"))
    sinks.replace_slice(late, path, ["product_name", "buy"], [(None, True), ("a:b/c=4 %", True), ("absent", False)])
    return sinks.read_slices(i.spark, path, rows.schema)


@query("k7_write_report_csv")
def _(i):
    path = scratch_path(i.spark, "report")
    rows = report.outlook_report(combined(i), curve_names(i), 1995, PLACEHOLDERS)
    sinks.write_report_csv(rows, path)
    return report_cents(i.spark.read.csv(path, header=True, schema=rows.schema))


# Time and calendar


@query("t1_to_trading_interval")
def _(i):
    ticks = cal.to_trading_interval(i.ticks, "settlementdate").select("duid", "interval_date", "period_id", "value")
    regions = cal.to_trading_interval(i.trading, "settlementdate").select(
        F.col("regionid").alias("duid"), "interval_date", "period_id", F.col("rrp").alias("value")
    )
    return ticks.unionByName(regions)


@query("t2_day_type_calendar")
def _(i):
    return cal.day_type_calendar(i.datetimes, i.jurisdiction, i.holidays)


@query("t3_effective_ranges")
def _(i):
    return cal.effective_ranges(i.factors_raw, ["dealid", "type"], "fromdate")


@query("t4_compact_ranges")
def _(i):
    return cal.compact_ranges(cal.expand_to_dates(i.units, i.dates), ["product_id", "fuel", "region_number"])


@query("t4_split_ranges")
def _(i):
    """Ranges that end where a day has no rate."""
    return cal.compact_ranges(i.cert_rates_raw, ["product_id", "lgc_price"], split_gaps=True)


@query("t5_expand_to_dates")
def _(i):
    return cal.expand_to_dates(i.units.select("deal_id", "product_id", "start_date", "end_date"), i.dates)


@query("t6_horizon_filter")
def _(i):
    return horizon(i)


# Trade and contract reference data


@query("d1_trade_star")
def _(i):
    return star(i)


@query("d2_deal_factors")
def _(i):
    return trades.deal_factors(i.factors_raw)


@query("d3_retail_rates")
def _(i):
    return rates(i)


@query("d4_rate_calendar")
def _(i):
    days = cal.day_type_calendar(i.datetimes, i.jurisdiction, i.holidays)
    return trades.rate_calendar(days, rates(i), RATE_START, RATE_END)


@query("d5_shaped_product_profiles")
def _(i):
    return trades.shaped_product_profiles(i.shapes, i.products)


@query("d6_certificate_rates")
def _(i):
    return certificate_rates(i)


@query("d7_region_lookup")
def _(i):
    return trades.with_region_number(i.trading.select("regionid", "rrp"), i.region)


@query("d7_jurisdiction_lookup")
def _(i):
    return cents(trades.with_jurisdiction(i.load.drop("region_number"), i.jurisdiction), "load_mwh")


# Settlement terms


def c1(i, days):
    return terms.ppa_energy_terms(i.units, offtake_trades(i), trades.deal_factors(i.factors_raw), days)


def c2(i, days):
    return terms.ppa_certificate_terms(i.units, offtake_trades(i), certificate_rates(i), days, (7,))


def terms_cents(df):
    return cents(df, *[c for c in terms.TERM_VALUES])


@query("c1_ppa_energy_terms")
def _(i):
    return terms_cents(c1(i, horizon(i)))


@query("c1_month_end_tolls")
def _(i):
    """Tolls without an end hold to the end of their first month, which lies in the horizon here."""
    factors = trades.deal_factors(i.factors_raw.withColumn("fromdate", F.date_add("fromdate", 150)))
    rows = terms.ppa_energy_terms(i.units, offtake_trades(i), factors, horizon(i), open_toll_to_month_end=True)
    return terms_cents(rows)


@query("c2_ppa_certificate_terms")
def _(i):
    return terms_cents(c2(i, horizon(i)))


@query("c3_retail_energy_terms")
def _(i):
    return terms_cents(terms.retail_energy_terms(star(i), i.region, horizon(i)))


@query("c4_retail_certificate_terms")
def _(i):
    return terms_cents(terms.retail_certificate_terms(star(i), i.region, certificate_rates(i), horizon(i)))


@query("c5_wholesale_terms")
def _(i):
    return terms_cents(terms.wholesale_terms(star(i), i.region, i.shapes, horizon(i)))


@query("c5_escalated_terms")
def _(i):
    factors = trades.deal_factors(i.leg_factors_raw)
    return terms_cents(terms.wholesale_terms(star(i), i.region, i.shapes, horizon(i), escalation=factors))


@query("c6_storage_terms")
def _(i):
    return terms_cents(terms.storage_terms(i.storage))


@query("c7_settlement_terms")
def _(i):
    legs = cut(star(i))
    days, daily_rates = cal.date_lookup(horizon(i)), certificate_rates(i)
    return terms_cents(
        terms.settlement_terms(
            c1(i, days), c2(i, days), terms.retail_energy_terms(legs, i.region, days),
            terms.retail_certificate_terms(legs, i.region, daily_rates, days),
            terms.wholesale_terms(legs, i.region, i.shapes, days), terms.storage_terms(i.storage),
        )
    )


# Market curves


@query("m1_latest_quotes")
def _(i):
    return market.latest_quotes(
        i.quotes, ["product", "period", "node"], "consolidate_date", ["period_start", "period_end", "price"]
    )


@query("m2_quarter_to_date_payout")
def _(i):
    return cents(market.quarter_to_date_payout(i.trading, i.dates, TODAY), "qtd_swap_payout", "qtd_cap_payout")


@query("m3_quarterly_futures")
def _(i):
    return cents(futures(i), "swap", "cap", "energy", "swap_boq", "cap_boq", "energy_boq")


@query("m4_certificate_curve")
def _(i):
    return curve(i)


@query("m5_certificate_daily")
def _(i):
    return market.certificate_daily(curve(i), i.dates)


# Scenario and volume profiles


@query("p1_simulations_for")
def _(i):
    return profiles.simulations_for(i.sims, i.models, "base")


@query("p2_resolve_model")
def _(i):
    model = profiles.resolve_model(i.models, "base")
    return i.sims.join(model, "model_id").groupBy("model_id", "sample_id").agg(F.count(F.lit(1)).alias("intervals"))


@query("p3_sample_details")
def _(i):
    return profiles.sample_details(i.samples, i.models, "base")


@query("p4_regional_capacity_long")
def _(i):
    return profiles.regional_capacity_long(i.capacity)


@query("p5_unit_actuals")
def _(i):
    return profiles.unit_actuals(scada(i), i.units)


@query("p5_unit_availability")
def _(i):
    return profiles.unit_availability(availability(i), i.units)


@query("p6_latest_loss_factors")
def _(i):
    return profiles.latest_loss_factors(i.unit_detail, i.units)


@query("p6_average_loss_factors")
def _(i):
    return profiles.average_loss_factors(i.avg_loss)


@query("p7_generation_profiles")
def _(i):
    # Reference years 2022 to 2024; the clock has 2024.
    details = i.samples.withColumn("gen_reference_year", F.col("gen_reference_year") + 27)
    return cents(
        profiles.generation_profiles(i.clock, details, i.units, scada(i), availability(i), i.capacity, i.unit_detail),
        "generation_mwh",
    )


@query("p8_load_profiles")
def _(i):
    out = profiles.load_profiles(i.datetimes, i.samples, i.halfhour, i.avg_loss, i.jurisdiction)
    return out.withColumn("load_mwh", F.floor(F.col("load_mwh") * 1_000_000 + HALF) / 1_000_000)


@query("p9_sample_index")
def _(i):
    return profiles.sample_index(i.path, i.samples, "gen_reference_year")


@query("p10_scenario_generation")
def _(i):
    index = profiles.sample_index(i.path, i.samples, "gen_reference_year")
    return cents(profiles.scenario_generation(i.gen_profile, storage_rows(i), index), "generation_mwh")


@query("p11_scenario_load")
def _(i):
    index = profiles.sample_index(i.path, i.samples, "demand_reference_year")
    return cents(profiles.scenario_load(i.load_profile, index, i.jurisdiction), "load_mwh")


@query("p12_scenario_shapes")
def _(i):
    return profiles.scenario_shapes(i.shapes, i.terms, i.path)


@query("p13_storage_price_traces")
def _(i):
    return cents(profiles.storage_price_traces(i.sims, curve(i), i.storage), "rrp")


@query("p15_storage_profiles")
def _(i):
    return cents(storage_rows(i), "generation_mwh")


# Price path calibration


@query("a1_best_samples")
def _(i):
    return cents(calibrate.best_samples(i.sims, curve(i), futures(i), i.region, TODAY), "mse")


@query("a2_select_best_path")
def _(i):
    best = cut(calibrate.best_samples(i.sims, curve(i), futures(i), i.region, TODAY))
    return cents(calibrate.select_best_path(i.sims, best, TODAY), "rrp")


@query("a3_add_cap_spikes")
def _(i):
    return cents(calibrate.add_cap_spikes(path_ahead(i), futures(i), i.region), "rrp")


@query("a4_apply_certificate_floor")
def _(i):
    return cents(calibrate.apply_certificate_floor(path_ahead(i), curve(i)), "rrp")


@query("a5_apply_energy_adjustment")
def _(i):
    return cents(calibrate.apply_energy_adjustment(path_ahead(i), futures(i), i.region), "rrp")


@query("a6_scenario_prices")
def _(i):
    return cents(calibrate.scenario_prices(i.sims, curve(i), futures(i), i.region, TODAY), "rrp")


# Interval settlement


@query("e1_ppa_energy")
def _(i):
    return settled(settle.ppa_energy(book(i, "ppa_energy").drop("instrument", "buy"), i.generation, i.spot))


@query("e2_asset_toll_energy")
def _(i):
    return settled(settle.asset_toll_energy(book(i, "asset_toll_energy").drop("instrument", "buy"), i.generation, i.spot))


@query("e3_retail_energy")
def _(i):
    return settled(settle.retail_energy(book(i, "retail_energy").drop("instrument", "buy"), i.load, i.spot, i.rates))


@query("e4_flat_energy_swap")
def _(i):
    return settled(settle.flat_energy_swap(book(i, "flat_energy_swap").drop("instrument", "buy"), i.spot))


@query("e5_flat_energy_cap")
def _(i):
    return settled(settle.flat_energy_cap(book(i, "flat_energy_cap").drop("instrument", "buy"), i.spot))


@query("e6_profiled_energy_swap")
def _(i):
    return settled(settle.profiled_energy_swap(book(i, "profiled_energy_swap").drop("instrument", "buy"), i.shapes, i.spot))


@query("e7_profiled_energy_cap")
def _(i):
    return settled(settle.profiled_energy_cap(book(i, "profiled_energy_cap").drop("instrument", "buy"), i.shapes, i.spot))


@query("e8_generation_lgc")
def _(i):
    return settled(settle.generation_lgc(book(i, "generation_lgc").drop("instrument", "buy"), i.generation, i.cert_daily))


@query("e9_retail_lgc")
def _(i):
    return settled(settle.retail_lgc(book(i, "retail_lgc").drop("instrument", "buy"), i.load, i.cert_daily))


@query("e10_apply_turndown")
def _(i):
    return cents(settle.apply_turndown(i.generation, i.terms, i.spot), "generation_mwh")


@query("e11_orient")
def _(i):
    rows = settle.flat_energy_swap(book(i, "flat_energy_swap"), i.spot).unionByName(
        settle.flat_energy_cap(book(i, "flat_energy_cap"), i.spot)
    )
    return cents(settle.orient(rows.drop("instrument", "buy"), i.terms), "volume_mwh", "income", "cost")


@query("e12_settle_book")
def _(i):
    return cents(whole_book(i), "volume_mwh", "income", "cost")


# Aggregation and reporting


@query("r1_quarterly_earnings")
def _(i):
    return cents(report.quarterly_earnings(whole_book(i), TODAY), "volume_mwh", "income", "cost")


@query("r1_changed_contracts")
def _(i):
    """Earnings kept up to date: the book without some contracts, then all of it with other terms for some."""
    tables = revaluation.Tables(i.spark, scratch_path(i.spark, "incremental"))
    inputs = [cut(x) for x in (i.generation, i.load, i.shapes, i.spot, i.cert_daily, i.rates)]
    early = i.terms.where(F.col("deal_id") % 10 != 0).withColumn(
        "price", F.when(F.col("deal_id") % 7 == 0, F.col("price") + 1).otherwise(F.col("price"))
    )
    incremental.update_changed_earnings(tables, early, *inputs, slices=16)
    again = incremental.update_changed_earnings(tables, i.terms, *inputs, slices=16)
    rows = sinks.read_slices(i.spark, tables.path(incremental.EARNINGS))
    quarters = cents(report.quarterly_earnings(rows, TODAY), "volume_mwh", "income", "cost")
    settled = again.select("deal_id", "product_id", F.lit(True).alias("settled_again"))
    return quarters.join(settled, ["deal_id", "product_id"], "left").fillna({"settled_again": False})


@query("r2_filter_status")
def _(i):
    return report.filter_status(i.outlook)


@query("r3_exclude_deals")
def _(i):
    return report.exclude_deals(i.outlook, EXCLUDED)


@query("r4_exclude_group_quarter")
def _(i):
    return report.exclude_group_quarter(report.with_year_quarter(i.outlook), "BESS", 2, 1998)


@query("r5_override_earnings")
def _(i):
    return cents(report.override_earnings(i.outlook, RULES), "earnings")


@query("r6_outlook_simple")
def _(i):
    return outlook_cents(report.outlook_simple(clean(i), "hindcast"))


@query("r7_outlook_sample_mean")
def _(i):
    return outlook_cents(report.outlook_sample_mean(clean(i), "model"))


@query("r8_outlook_by_scenario")
def _(i):
    return outlook_cents(report.outlook_by_scenario(clean(i)))


@query("r8_outlook_by_scenario_month")
def _(i):
    return outlook_cents(report.outlook_by_scenario(clean(i), "month"))


@query("r9_sample_rank")
def _(i):
    return cents(report.sample_rank(i.outlook), "earnings")


@query("r10_outlook_at_rank")
def _(i):
    ranks = cut(report.sample_rank(outlook(i)))
    p90 = report.outlook_at_rank(clean(i), ranks, report.P90_RANK, "p90")
    p10 = report.outlook_at_rank(clean(i), ranks, report.P10_RANK, "p10")
    return outlook_cents(p90.unionByName(p10))


@query("r11_product_instrument")
def _(i):
    return report.product_instrument(i.outlook, i.product_instrument)


@query("r12_clean_and_aggregate")
def _(i):
    common = dict(
        rules=RULES, excluded_deals=EXCLUDED, excluded_group=("BESS", 2, 1998),
    )
    start, end = date(1996, 1, 1), date(2000, 12, 31)
    ranks = cut(report.sample_rank(outlook(i)))
    args = (outlook(i), i.product_instrument)
    return outlook_cents(
        report.combine_curves(
            [
                report.clean_and_aggregate(*args, "simple", start, end, **common),
                report.clean_and_aggregate(*args, "mean", start, end, mode="sample_mean", **common),
                report.clean_and_aggregate(*args, "ranked", start, end, ranks=ranks, rank=7, **common),
                report.clean_and_aggregate(*args, "", start, end, mode="scenario", **common),
            ]
        )
    )


@query("r13_combine_curves")
def _(i):
    return outlook_cents(combined(i))


@query("r14_outlook_report")
def _(i):
    return report_cents(report.outlook_report(combined(i), curve_names(i), 1996, PLACEHOLDERS))


@query("r15_monthly_report")
def _(i):
    rows = report.outlook_by_scenario(clean(i), "month")
    return report_cents(report.monthly_report(rows, "Central", 1996, PLACEHOLDERS))
