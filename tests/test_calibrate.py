from datetime import date, timedelta

import pytest

from conftest import rows
from wattledger.operators import calibrate

D = date(2024, 1, 1)
FUTURES = "regionid string, period_start date, swap_boq double, cap_boq double, energy_boq double"


@pytest.fixture(scope="module")
def regions(spark):
    return spark.createDataFrame([("A1", 1), ("B1", 2)], "regionid string, region_number int")


def path(spark, *rrp, region=1):
    data = [(1, 1, D + timedelta(days=n // 2), n % 2 + 1, region, float(v)) for n, v in enumerate(rrp)]
    return spark.createDataFrame(
        data, "model_id int, sample_id int, interval_date date, period_id int, region_number int, rrp double"
    )


def futures(spark, cap=None, energy=None):
    return spark.createDataFrame([("A1", D, None, cap, energy)], FUTURES)


def prices(df):
    return [r[2] for r in rows(df, "interval_date", "period_id", "rrp")]


def test_spikes_reach_the_cap_target(spark, regions):
    got = prices(calibrate.add_cap_spikes(path(spark, 100, 350, 20, -5), futures(spark, cap=100.0), regions))
    assert got == [100, 700, 20, -5]
    assert sum(max(p - 300, 0) for p in got) == 400


def test_spikes_overflow_to_the_next_dearest(spark, regions):
    got = prices(calibrate.add_cap_spikes(path(spark, 100, 350, 20, -5), futures(spark, cap=9000.0), regions))
    # 36000 in all: 50 there already, 19950 on the dearest, 16000 on the next.
    assert got == [16300, 20300, 20, -5]


def test_flattened_when_futures_pay_less(spark, regions):
    got = prices(calibrate.add_cap_spikes(path(spark, 400, 500), futures(spark, cap=10.0), regions))
    assert got == [300, 320]


def test_no_spikes_when_equal(spark, regions):
    assert prices(calibrate.add_cap_spikes(path(spark, 310, 300), futures(spark, cap=5.0), regions)) == [310, 300]


def test_target_beyond_all_headroom_stops_at_the_cap(spark, regions):
    got = prices(calibrate.add_cap_spikes(path(spark, 100, -50), futures(spark, cap=50000.0), regions))
    assert got == [20300, 20300]


def test_ties_go_by_date_and_period(spark, regions):
    got = prices(calibrate.add_cap_spikes(path(spark, 90, 90, 90), futures(spark, cap=100.0), regions))
    assert got == [600, 90, 90]


def test_null_cap_flattens(spark, regions):
    assert prices(calibrate.add_cap_spikes(path(spark, 400, 10), futures(spark), regions)) == [300, 10]


def test_region_without_futures_is_dropped(spark, regions):
    both = path(spark, 10).unionByName(path(spark, 10, region=2))
    assert calibrate.add_cap_spikes(both, futures(spark, cap=1.0), regions).count() == 1


def test_certificate_floor(spark):
    curve = spark.createDataFrame([(D, 30.0)], "period_start date, price double")
    assert prices(calibrate.apply_certificate_floor(path(spark, -50, -30, 5), curve)) == [-30, -30, 5]


def mean(values):
    return sum(values) / len(values)


def energy(values):
    return mean([min(max(p, 0), 300) for p in values]) + mean([min(p, 0) for p in values])


def test_energy_meets_futures(spark, regions):
    got = prices(calibrate.apply_energy_adjustment(path(spark, 40, 80, -10, 100), futures(spark, energy=70.0), regions))
    assert got[2] == -10 and energy(got) == pytest.approx(70)


@pytest.mark.parametrize("start, target", [((40, 80, -10, 1000), 120.0), ((10, 290, 0, 0), 100.0)])
def test_rounds_near_the_strike(spark, regions, start, target):
    """Prices at or over the strike count but do not move, so a round closes part of the gap; ten are the limit."""
    got = prices(calibrate.apply_energy_adjustment(path(spark, *start), futures(spark, energy=target), regions))
    expected = list(start)
    for _ in range(10):
        factor = (target - mean([min(p, 0) for p in expected])) / mean([min(max(p, 0), 300) for p in expected])
        expected = [min(p * factor, 300) if 0 <= p <= 300 else p for p in expected]
    assert got == pytest.approx(expected)


def test_energy_already_met_is_unchanged(spark, regions):
    both = path(spark, 50, 70).unionByName(path(spark, 10, region=2))
    assert sorted(prices(calibrate.apply_energy_adjustment(both, futures(spark, energy=60.0), regions))) == [10, 50, 70]


def test_energy_without_middle_prices_is_unchanged(spark, regions):
    got = calibrate.apply_energy_adjustment(path(spark, -10, -20), futures(spark, energy=60.0), regions)
    assert prices(got) == [-10, -20]


def test_adjustment_lowers_the_error_and_keeps_the_floor(spark, inputs):
    from checks import queries as q

    futures_ = q.futures(inputs)
    before = q.path_ahead(inputs)
    after = calibrate.apply_energy_adjustment(before, futures_, inputs.region)

    def error(df):
        target = {(r.year, r.quarter, r.region_number): r.target for r in calibrate._target(futures_, inputs.region, "energy_boq").collect()}
        groups = {}
        for r in df.collect():
            groups.setdefault((r.interval_date.year, (r.interval_date.month + 2) // 3, r.region_number), []).append(r.rrp)
        gaps = [abs(target[g] - mean([min(p, 300) for p in ps])) for g, ps in groups.items() if target.get(g) is not None]
        return mean(gaps)

    assert error(after) < error(before)
