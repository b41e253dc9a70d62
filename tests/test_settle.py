from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wattledger.operators import settle

D = date(2024, 1, 2)
TERMS = """deal_id int, product_id int, instrument_id int, instrument string, buy boolean, region_number int,
    start_date date, end_date date, quantity double, price double, strike double, tolling_fee double, floor double,
    turndown double, lgc_price double, lgc_percentage double"""


def term(spark, *changes):
    base = dict(
        deal_id=1, product_id=10, instrument_id=4, instrument="ppa_energy", buy=True, region_number=1, start_date=D,
        end_date=D, quantity=0.5, price=50.0, strike=300.0, tolling_fee=288.0, floor=None, turndown=None,
        lgc_price=30.0, lgc_percentage=0.2,
    )
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes or ({},)], TERMS)


def prices(spark, *rrp):
    data = [(D, p, 1, float(v) if v is not None else None) for p, v in enumerate(rrp, 1)]
    return spark.createDataFrame(data, "interval_date date, period_id int, region_number int, rrp double")


def generation(spark, *mwh, product=10, day=D):
    return spark.createDataFrame(
        [(product, day, p, float(v)) for p, v in enumerate(mwh, 1)],
        "product_id int, interval_date date, period_id int, generation_mwh double",
    )


VALUES = ("volume_mwh", "buy_income", "sell_income")


def test_ppa_floor_edges(spark):
    gen, spot = generation(spark, 10, 10, 10), prices(spark, -20, 0, 80)
    no_floor = settle.ppa_energy(term(spark), gen, spot)
    assert rows(no_floor, "period_id", *VALUES) == [(1, 5, -100, 250), (2, 5, 0, 250), (3, 5, 400, 250)]
    floored = settle.ppa_energy(term(spark, {"floor": 0.0}), gen, spot)
    assert [r[0] for r in rows(floored, "buy_income")] == [0, 0, 400]


def test_contract_ends_on_the_day(spark):
    other = generation(spark, 10, day=date(2024, 1, 3))
    gen = generation(spark, 10).unionByName(other)
    spot = prices(spark, 10).unionByName(prices(spark, 10).withColumn("interval_date", F.lit(date(2024, 1, 3))))
    assert settle.ppa_energy(term(spark), gen, spot).count() == 1


def test_toll_is_paid_without_generation(spark):
    got = settle.asset_toll_energy(term(spark), generation(spark, 0), prices(spark, 40))
    assert rows(got, *VALUES) == [(0, 0, 1)]


@pytest.mark.parametrize("rrp, paid", [(299, 0.0), (300, 0.0), (420, 120.0 * 0.5), (None, None)])
def test_flat_cap_around_the_strike(spark, rrp, paid):
    got = settle.flat_energy_cap(term(spark, {"quantity": 6.0}), prices(spark, rrp))
    assert rows(got, *VALUES) == [(0.5, paid, 25)]


def test_null_strike_is_null(spark):
    got = settle.flat_energy_cap(term(spark, {"strike": None}), prices(spark, 400))
    assert rows(got, "buy_income") == [(None,)]


def test_profiled_cap_uses_the_strike_of_the_shape(spark):
    shapes = spark.createDataFrame(
        [(10, D, 1, 0.5, 1.0, 100.0)],
        "product_id int, interval_date date, period_id int, volume_factor double, price_factor double, strike double",
    )
    got = settle.profiled_energy_cap(term(spark, {"quantity": 24.0}), shapes, prices(spark, 150))
    assert rows(got, *VALUES) == [(1, 50, 50)]


def load(spark):
    return spark.createDataFrame(
        [(10, j, 1, D, 1, float(j)) for j in (1, 2)],
        "product_id int, jurisdiction_id int, region_number int, interval_date date, period_id int, load_mwh double",
    )


def test_retail_sums_jurisdictions_but_certificates_keep_them(spark):
    rates = spark.createDataFrame(
        [(10, j, D, 1, 100.0 * j) for j in (1, 2)],
        "product_id int, jurisdiction_id int, interval_date date, period_id int, rate double",
    )
    energy = settle.retail_energy(term(spark, {"region_number": 9}), load(spark), prices(spark, 10), rates)
    assert rows(energy, "region_number", *VALUES) == [(1, 3, 30, 500)]
    market = spark.createDataFrame([(D, 40.0)], "interval_date date, lgc_price double")
    certificates = settle.retail_lgc(term(spark), load(spark), market)
    assert [tuple(round(v, 9) for v in r) for r in rows(certificates, *VALUES)] == [(0.2, 8, 6), (0.4, 16, 12)]


def test_turndown(spark):
    limits = term(spark, {"turndown": 50.0}, {"turndown": 50.0, "start_date": date(2024, 1, 5), "end_date": date(2024, 1, 6)})
    gen = generation(spark, 1, 2, 3).unionByName(generation(spark, 7, day=date(2024, 1, 4))).unionByName(generation(spark, 9, product=11))
    got = settle.apply_turndown(gen, limits, prices(spark, 49, 50, 51))
    # The gap day of the limited product is dropped; the product without a limit is untouched.
    assert rows(got, "product_id", "generation_mwh") == [(10, 0), (10, 2), (10, 3), (11, 9)]


def test_sides_swap_income_and_cost(spark):
    terms = term(spark, {"deal_id": 1, "buy": True}, {"deal_id": 2, "buy": False})
    settled = settle.flat_energy_swap(terms, prices(spark, 80))
    both = rows(settle.orient(settled.drop("buy"), terms), "deal_id", "income", "cost")
    assert both[0][1:] == both[1][2:0:-1]


def test_dated_join_equals_broadcast_join(spark, inputs):
    """A book over the broadcast bound goes through the join on key and date, with the same rows."""
    args = (inputs.terms, inputs.generation, inputs.load, inputs.shapes, inputs.spot, inputs.cert_daily, inputs.rates)
    money = lambda df: df.select("deal_id", "product_id", "instrument_id", "interval_date", "period_id", F.round("income", 6), F.round("cost", 6))
    assert rows(money(settle.settle_book(*args))) == rows(money(settle.settle_book(*args, broadcast_rows=0)))


def test_dated_join_has_no_broadcast_of_terms(spark, inputs, capsys):
    settle.flat_energy_swap(inputs.terms, inputs.spot, broadcast_rows=0).explain()
    plan = capsys.readouterr().out
    swept = plan.split("MapInArrow _matches")[0]
    assert swept != plan and "Generate" not in plan and "region_number" in swept and "Join" not in swept


def test_book_is_additive_over_dates(spark, inputs):
    spot = inputs.spot
    cut_day = F.lit(date(1998, 1, 1))
    parts = [settle.flat_energy_swap(inputs.terms, spot.where(c)) for c in (F.col("interval_date") < cut_day, F.col("interval_date") >= cut_day)]
    whole = settle.flat_energy_swap(inputs.terms, spot)
    assert whole.count() == sum(p.count() for p in parts)


def test_both_plans_agree_on_missing_dates_and_empty_facts(spark):
    terms = spark.createDataFrame(
        [
            (1, 1, 0, 1, None, date(2030, 1, 1), 1.0, 2.0), (2, 1, 0, 1, date(2020, 1, 1), None, 1.0, 2.0),
            (3, 1, 0, 1, date(2020, 1, 2), date(9999, 12, 31), 1.0, 2.0), (4, 1, 0, 1, None, None, 1.0, 2.0),
        ],
        "deal_id int, product_id int, instrument_id int, region_number int, start_date date, end_date date, quantity double, price double",
    )
    prices = spark.createDataFrame(
        [(date(2020, 1, d), 1, 1, 10.0) for d in (1, 2, 3)], "interval_date date, period_id int, region_number int, rrp double"
    )
    for facts, expected in ((prices, [(3, date(2020, 1, 2)), (3, date(2020, 1, 3))]), (prices.limit(0), [])):
        for broadcast_rows in (200_000, 0):
            got = settle.flat_energy_swap(terms, facts, broadcast_rows)
            assert sorted((r.deal_id, r.interval_date) for r in got.collect()) == expected


def test_turndown_reads_generation_once(spark, inputs, tmp_path):
    path = str(tmp_path / "generation")
    inputs.generation.write.parquet(path)
    stored = spark.read.parquet(path)
    turned = settle.apply_turndown(stored, inputs.terms, inputs.spot)
    plan = turned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [product_id") == 1
