"""Market curves from quotes and spot prices."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.money import CAP_STRIKE
from wattledger.functions.plans import first_in_group
from wattledger.functions.timegrid import quarter_of, year_of
from wattledger.operators.calendar import expand_to_dates, to_trading_interval


def latest_quotes(
    quotes: DataFrame, keys: list[str], newest_by: str, then_by: list[str | Column] = ()
) -> DataFrame:
    """The newest row per key; `then_by` settles rows of the same date."""
    return first_in_group(
        quotes, keys, [F.col(newest_by).desc(), *[F.col(c) if isinstance(c, str) else c for c in then_by]]
    )


def quarter_to_date_payout(
    spot: DataFrame, calendar: DataFrame, as_of: date, strike: float = CAP_STRIKE
) -> DataFrame:
    """Mean price and mean cap payout per region over the days of the current quarter before `as_of`."""
    opening = date(as_of.year, (as_of.month - 1) // 3 * 3 + 1, 1)
    lengths = calendar.groupBy("year", "quarter").agg(
        F.count_distinct("interval_date").alias("days_in_quarter")
    )
    ts = F.col("settlementdate")
    recent = spot.where((ts >= F.lit(opening)) & (ts < F.lit(as_of + timedelta(days=1))))
    return (
        to_trading_interval(recent, "settlementdate")
        .where((F.col("interval_date") >= F.lit(opening)) & (F.col("interval_date") < F.lit(as_of)))
        .groupBy(year_of("interval_date"), quarter_of("interval_date"), "regionid")
        .agg(
            F.avg("rrp").alias("qtd_swap_payout"),
            F.avg(F.when(F.col("rrp") > strike, F.col("rrp") - strike).otherwise(0.0)).alias("qtd_cap_payout"),
            F.count_distinct("interval_date").alias("days_qtd"),
        )
        .join(lengths, ["year", "quarter"])
        .select("year", "quarter", "regionid", "qtd_swap_payout", "qtd_cap_payout", "days_qtd", "days_in_quarter")
    )


def _balance_of_quarter(price: str, to_date: str) -> Column:
    """Price the rest of the quarter must average so that the whole quarter averages `price`."""
    done, whole = F.col("days_qtd"), F.col("days_in_quarter")
    rest = (F.col(price) - F.col(to_date) * done / whole) * whole
    return F.when(F.col(to_date).isNotNull(), F.try_divide(rest, whole - done)).otherwise(F.col(price))


def quarterly_futures(
    quotes: DataFrame, payout: DataFrame, as_of: date, split_by_quote_date: bool = False
) -> DataFrame:
    """Swap, cap and energy futures per region and quarter, and their balance-of-quarter values.

    `payout` is the output of `quarter_to_date_payout`. Swap and cap of one quarter meet in one
    row even when their newest quotes have different dates; with `split_by_quote_date` they
    stay apart, each row lacking the other price.
    """
    live = quotes.where(
        F.col("product").isin("Swap", "Cap")
        & (F.col("period_end") >= F.lit(as_of))
        & F.col("period").like("Q%")
        & (F.col("load") == "Flat")
    )
    newest = latest_quotes(live, ["product", "period", "node"], "consolidate_date", ["period_start", "period_end", "price"])
    keys = ["node", "period", "period_start", "period_end"]
    wide = (
        newest.groupBy(*keys, *(["consolidate_date"] if split_by_quote_date else []))
        .pivot("product", ["Swap", "Cap"]).agg(F.avg("price"))
        .withColumnsRenamed({"Swap": "swap", "Cap": "cap"})
        .withColumn("regionid", F.concat("node", F.lit("1")))
        .withColumn("year", F.year("period_start"))
        .withColumn("quarter", F.quarter("period_start"))
    )
    return (
        wide.join(payout, ["regionid", "year", "quarter"], "left")
        .withColumn("swap_boq", _balance_of_quarter("swap", "qtd_swap_payout"))
        .withColumn("cap_boq", _balance_of_quarter("cap", "qtd_cap_payout"))
        .select(
            "regionid", "period", "period_start", "period_end", "swap", "cap",
            (F.col("swap") - F.col("cap")).alias("energy"),
            "swap_boq", "cap_boq", (F.col("swap_boq") - F.col("cap_boq")).alias("energy_boq"),
        )
    )


def certificate_curve(quotes: DataFrame, as_of: date) -> DataFrame:
    """Newest forward certificate price per period that has not ended; spot quotes left out."""
    live = quotes.where(
        (F.col("product") == "LGC") & ~F.col("period").ilike("spot") & (F.col("period_end") >= F.lit(as_of))
    )
    return latest_quotes(live, ["product", "period"], "consolidate_date", ["price"]).select(
        "period", "period_start", "period_end", "price"
    )


def certificate_daily(curve: DataFrame, calendar: DataFrame) -> DataFrame:
    """Certificate price per calendar date."""
    return expand_to_dates(curve, calendar, "period_start", "period_end").select(
        "interval_date", F.col("price").alias("lgc_price")
    )
