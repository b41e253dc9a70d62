"""Choosing a simulated price path per quarter and bringing it into line with futures.

A path has one row per date, period and region, so a quarter of one region holds at most
92 x 288 rows: that is the largest group any window here works on.
"""

from __future__ import annotations

from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.functions.money import CAP_STRIKE, MARKET_PRICE_CAP, at_least, at_most
from wattledger.functions.plans import cut, first_in_group, sized
from wattledger.functions.timegrid import quarter_of, year_of

PATH = ["model_id", "sample_id", "interval_date", "period_id", "region_number", "rrp"]
GROUP = ["year", "quarter", "region_number"]


def _with_quarter(df: DataFrame) -> DataFrame:
    return df.select("*", year_of("interval_date"), quarter_of("interval_date"))


def _target(futures: DataFrame, regions: DataFrame, price: str) -> DataFrame:
    """One futures price per year, quarter and region number; regions without futures are absent."""
    return futures.join(regions.select("regionid", "region_number"), "regionid").select(
        year_of("period_start"), quarter_of("period_start"), "region_number", F.col(price).alias("target")
    )


def best_samples(
    sims: DataFrame,
    curve: DataFrame,
    futures: DataFrame,
    regions: DataFrame,
    as_of: date,
    strike: float = CAP_STRIKE,
) -> DataFrame:
    """The sample of each quarter whose energy price is closest to futures over the regions.

    Prices are taken between minus the certificate price and the cap strike. The simulations
    are averaged where they are read; only one row per sample, region and quarter moves on.
    """
    ahead = sims.where(F.col("interval_date") >= F.lit(as_of))
    certificate = curve.where(F.col("period_end") >= F.lit(as_of)).select(
        F.explode(F.sequence(F.greatest("period_start", F.lit(as_of)), "period_end")).alias("interval_date"),
        F.col("price").alias("lgc_price"),
    )
    # A missing certificate price is no floor.
    floor = F.coalesce(-F.col("lgc_price"), F.lit(float("-inf")))
    bounded = at_most(at_least(F.col("rrp"), floor), F.greatest(F.lit(strike), floor))
    modelled = (
        ahead.join(sized(certificate), "interval_date")
        .groupBy("sample_id", *[year_of("interval_date"), quarter_of("interval_date")], "region_number")
        .agg(F.avg(bounded).alias("modelled"))
    )
    gaps = (
        modelled.join(_target(futures, regions, "energy_boq"), GROUP)
        .groupBy("sample_id", "year", "quarter")
        .agg(F.avg(F.pow(F.col("modelled") - F.col("target"), F.lit(2))).alias("mse"))
    )
    return first_in_group(gaps, ["year", "quarter"], [F.col("mse"), F.col("sample_id")])


def select_best_path(sims: DataFrame, best: DataFrame, as_of: date) -> DataFrame:
    """The simulated prices of the chosen sample of each quarter, from `as_of` on.

    `best` has one row per quarter; its size is checked.
    """
    chosen = sized(best.select("sample_id", "year", "quarter"))
    return (
        _with_quarter(sims.where(F.col("interval_date") >= F.lit(as_of)))
        .join(chosen, ["sample_id", "year", "quarter"], "left_semi")
        .select(*PATH)
    )


def add_cap_spikes(
    path: DataFrame,
    futures: DataFrame,
    regions: DataFrame,
    strike: float = CAP_STRIKE,
    cap: float = MARKET_PRICE_CAP,
) -> DataFrame:
    """The path with its highest prices lifted until its payout over the strike equals cap futures.

    Where the path already pays more, prices over the strike are first flattened to it. All
    windows share one partitioning, so the path is shuffled once.
    """
    rrp = F.col("rrp")
    whole = Window.partitionBy(*GROUP)
    dearest_first = whole.orderBy(rrp.desc(), F.col("interval_date"), F.col("period_id"))
    running = dearest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = F.coalesce(F.sum("target").over(whole), F.lit(0.0))
    paid = F.coalesce(F.sum(at_least(rrp, F.lit(strike)) - strike).over(whole), F.lit(0.0))
    short = F.col("wanted") < F.col("paid")
    return (
        _with_quarter(path)
        .join(_target(futures, regions, "cap_boq"), GROUP)
        .withColumn("wanted", wanted)
        .withColumn("paid", paid)
        .withColumn("need", F.when(short, F.col("wanted")).otherwise(F.col("wanted") - F.col("paid")))
        .withColumn("level", F.when(short & (rrp > strike), F.lit(strike)).otherwise(rrp))
        .withColumn("headroom", at_most(cap - F.col("level"), F.lit(cap - strike)))
        .withColumn("left", F.col("need") - (F.sum("headroom").over(running) - F.col("headroom")))
        .withColumn("lift", F.when(F.col("left") > 0, F.least("headroom", "left")).otherwise(0.0))
        .withColumn(
            "rrp",
            F.when(F.col("lift") > 0, F.greatest(F.col("level"), F.lit(strike)) + F.col("lift"))
            .otherwise(F.col("level")),
        )
        .select(*PATH)
    )


def apply_certificate_floor(path: DataFrame, curve: DataFrame) -> DataFrame:
    """Prices not under minus the certificate price of their year; years without one are dropped."""
    yearly = sized(curve.select(year_of("period_start"), F.col("price").alias("lgc_price")))
    return (
        path.withColumn("year", F.year("interval_date"))
        .join(yearly, "year")
        .withColumn("rrp", at_least(F.col("rrp"), -F.col("lgc_price")))
        .select(*PATH)
    )


def _replayed(rrp: Column, factors: Column, strike: float) -> Column:
    """`rrp` after each factor in turn: prices from 0 to the strike are scaled, up to the strike."""
    return F.aggregate(
        factors,
        rrp,
        lambda price, factor: F.when(
            price.between(0, strike) & factor.isNotNull(), F.least(price * factor, F.lit(strike))
        ).otherwise(price),
    )


def _rounds(rounds: int, strike: float):
    """Of one quarter and region: the error ahead of each round and the factor of each round.

    Prices from 0 to the strike that have been scaled so far are min(price * scale, ceiling), so
    with prices sorted once and summed from the least up, a round's mean is one lookup: of the
    prices under ceiling / scale the sum counts, of the others the number.
    """

    def adjust(group: pa.Table) -> pa.Table:
        rrp = np.sort(np.asarray(group["rrp"].drop_null()))
        target = group["target"][0].as_py()
        scaled = rrp[(rrp >= 0) & (rrp <= strike)]
        sums = np.concatenate([[0.0], np.cumsum(scaled)])
        below, above = float(rrp[rrp < 0].sum()), int((rrp > strike).sum())
        scale, ceiling, sunk = 1.0, strike, None
        errors, factors = [], []
        for _ in range(rounds):
            error = factor = None
            if len(rrp):
                under = int(np.searchsorted(scaled, ceiling / scale, side="right")) if scale > 0 else len(scaled)
                inside = scale * float(sums[under]) + ceiling * (len(scaled) - under)
                # After a factor below zero these prices are negative, and stay as they are.
                middle = ((inside if sunk is None else 0.0) + strike * above) / len(rrp)
                negative = (below + (sunk or 0.0)) / len(rrp)
                if target is not None:
                    gap = target - negative
                    error, factor = abs(gap - middle), gap / middle if middle else None
            errors.append(error)
            factors.append(factor)
            if factor is not None and sunk is None:
                if factor < 0:
                    sunk = inside * factor
                else:
                    scale, ceiling = scale * factor, min(ceiling * factor, strike)
        doubles = pa.list_(pa.float64())
        keys = [group[c].slice(0, 1) for c in GROUP]
        return pa.table([*keys, pa.array([errors], doubles), pa.array([factors], doubles)], [*GROUP, "errors", "factors"])

    return adjust


def apply_energy_adjustment(
    path: DataFrame,
    futures: DataFrame,
    regions: DataFrame,
    max_iterations: int = 10,
    tolerance: float = 0.001,
    strike: float = CAP_STRIKE,
) -> DataFrame:
    """The path with prices between 0 and the strike scaled until its mean meets energy futures.

    The path is read once for the factors of all rounds, whatever their number: a quarter of one
    region holds a bounded number of prices, which are sorted and summed up once. The driver reads
    the mean error of each round and keeps the factors up to the first round that needs none;
    they are replayed on the path. Groups without futures leave with the first round; a path that
    already agrees is returned as it is.
    """
    target = _target(futures, regions, "energy_boq").withColumn("listed", F.lit(True))
    base = cut(_with_quarter(path.select(*PATH)).join(target, GROUP, "left"))
    listed, doubles = base.where("listed"), T.ArrayType(T.DoubleType())
    measured = cut(
        listed.select(*GROUP, "rrp", "target").groupBy(*GROUP).applyInArrow(
            _rounds(max_iterations, strike),
            T.StructType([listed.schema[c] for c in GROUP]).add("errors", doubles).add("factors", doubles),
        )
    )
    means = measured.select(F.posexplode("errors").alias("nth", "error")).groupBy("nth").agg(F.avg("error").alias("error"))
    error = {r.nth: r.error for r in means.collect()}  # one row per round
    needed = (n for n in range(max_iterations) if error.get(n) is None or error[n] < tolerance)
    rounds = next(needed, max_iterations)
    if not rounds:
        return base.select(*PATH)
    factors = sized(measured.select(*GROUP, F.slice("factors", 1, rounds).alias("factors")))
    return base.join(factors, GROUP).withColumn("rrp", _replayed(F.col("rrp"), F.col("factors"), strike)).select(*PATH)


def scenario_prices(
    sims: DataFrame, curve: DataFrame, futures: DataFrame, regions: DataFrame, as_of: date
) -> DataFrame:
    """The calibrated price path: best sample, cap spikes, certificate floor, energy scaling."""
    curve, futures = cut(curve), cut(futures)
    best = cut(best_samples(sims, curve, futures, regions, as_of))
    path = select_best_path(sims, best, as_of)
    spiked = add_cap_spikes(path, futures, regions)
    return apply_energy_adjustment(apply_certificate_floor(spiked, curve), futures, regions)
