"""Settlement terms: one typed row per contract, instrument and validity range.

Ranges of contracts, escalations and tolls are intersected as ranges; only their ends are looked
up in the calendar. Certificate rates, which come by date, are folded to ranges per product
before contracts are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattledger.functions.plans import sized, sized_all
from wattledger.operators.calendar import OPEN_END, DateLookup, clip_to_dates, compact_ranges, dates_of
from wattledger.operators.trades import with_region_number

TERM_VALUES = (
    "quantity", "price", "strike", "tolling_fee", "floor", "turndown", "lgc_price", "lgc_percentage",
)


def _terms(df: DataFrame, instrument: str | Column, **values: Column | str) -> DataFrame:
    """The settlement-terms columns; values not given are null."""
    label = F.lit(instrument) if isinstance(instrument, str) else instrument
    filled = [
        (F.col(v) if isinstance(v := values.get(name), str) else F.lit(v) if v is None else v)
        .cast("double").alias(name)
        for name in TERM_VALUES
    ]
    return df.select(
        "deal_id", "product_id", label.alias("instrument"), "buy_sell", "region_number",
        "start_date", "end_date", *filled,
    )


def _without_gaps(ranges: DataFrame, key: str, value: str) -> DataFrame:
    """The ranges of each key, and the times between, before and after them with a null value.

    A key has a range per factor change, so its window is small.
    """
    held = ranges.where(F.col("from_date") <= F.col("to_date"))
    ordered = Window.partitionBy(key).orderBy("from_date", "to_date", value)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, -1)
    day_before, day_after = F.date_sub("from_date", 1), F.date_add("_reached", 1)
    gaps = held.withColumn("_reached", F.max("to_date").over(so_far)).select(
        key, F.coalesce(day_after, F.to_date(F.lit("0001-01-01"))).alias("from_date"), day_before.alias("to_date"),
        F.lit(None).cast("double").alias(value),
    )
    after = held.groupBy(key).agg(F.max("to_date").alias("_reached")).where(F.col("_reached") < F.lit(OPEN_END)).select(
        key, day_after.alias("from_date"), F.lit(OPEN_END).alias("to_date"), F.lit(None).cast("double").alias(value)
    )
    every = held.select(key, "from_date", "to_date", value).unionByName(gaps).unionByName(after)
    return every.where(F.col("from_date") <= F.col("to_date"))


def _cut_by(contracts: DataFrame, ranges: DataFrame, value: str) -> DataFrame:
    """Contracts cut at the ranges of their deal; those of deals without ranges have a null value."""
    opens, closes = F.greatest("start_date", "from_date"), F.least("end_date", "to_date")
    # A missing date of the contract stays missing; `greatest` alone would replace it.
    dated = F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
    return (
        contracts.where(dated)
        .join(_without_gaps(ranges, "_deal", value), F.col("deal_id") == F.col("_deal"), "left")
        .withColumn("start_date", opens).withColumn("end_date", closes)
        .where(F.col("start_date") <= F.col("end_date"))
        .drop("_deal", "from_date", "to_date")
    )


def ppa_energy_terms(
    contracts: DataFrame, trades: DataFrame, factors: DataFrame, calendar: DataFrame | DateLookup,
    open_toll_to_month_end: bool = False,
) -> DataFrame:
    """Offtake energy: price times escalation, daily toll where a monthly one holds.

    A toll is spread evenly over the days it holds. One without an end holds for good, or with
    `open_toll_to_month_end` to the end of its first month.
    """
    priced = contracts.select(
        "deal_id", "product_id", "region_number", "start_date", "end_date", "quantity_factor", "floor", "turndown"
    ).join(
        trades.select("product_id", "deal_id", "buy_sell", "price").distinct(), ["product_id", "deal_id"]
    )
    escalation = factors.where(F.col("type") == "R").select(
        F.col("deal_id").alias("_deal"), "from_date", "to_date", F.col("factor").alias("escalation")
    )
    monthly = factors.where(F.col("type") == "M")
    if open_toll_to_month_end:
        open_end = F.col("to_date") == F.lit(OPEN_END)
        monthly = monthly.withColumn("to_date", F.when(open_end, F.last_day("from_date")).otherwise(F.col("to_date")))
    toll = monthly.select(
        F.col("deal_id").alias("_deal"), "from_date", "to_date",
        (F.col("factor") / (F.date_diff("to_date", "from_date") + 1)).alias("tolling_fee"),
    )
    valued = _cut_by(_cut_by(priced, escalation, "escalation"), toll, "tolling_fee").withColumn(
        "price", F.col("price") * F.coalesce("escalation", F.lit(1.0))
    )
    ranges = clip_to_dates(valued, calendar).groupBy(
        "deal_id", "product_id", "buy_sell", "region_number", "price", "quantity_factor", "floor", "turndown", "tolling_fee"
    ).agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))
    return _terms(
        ranges,
        F.when(F.col("tolling_fee").isNotNull(), "asset_toll_energy").otherwise("ppa_energy"),
        quantity="quantity_factor", price="price", tolling_fee="tolling_fee", floor="floor", turndown="turndown",
    )


def ppa_certificate_terms(
    contracts: DataFrame,
    trades: DataFrame,
    rates: DataFrame,
    calendar: DataFrame | DateLookup,
    zero_price_products: tuple[int, ...] = (),
) -> DataFrame:
    """Offtake certificates: contracts by the certificate rate of each of their dates.

    Rates are folded up per product and contract dates before the contracts are joined. The
    certificates of `zero_price_products` are settled at a price of zero.
    """
    sides = trades.select("product_id", "deal_id", "buy_sell").distinct()
    parties = contracts.select(
        "deal_id", "product_id", "region_number", "start_date", "end_date", "quantity_factor"
    ).join(sides, ["product_id", "deal_id"])
    dates = dates_of(calendar)
    zero = F.col("product_id").isin(list(zero_price_products)) if zero_price_products else F.lit(False)
    parties = parties.withColumnsRenamed({"start_date": "_opens", "end_date": "_closes"})
    held = ["product_id", "_opens", "_closes"]
    rated = (
        rates.join(sized(dates), "interval_date", "left_semi")
        .withColumn("lgc_price", F.when(zero, 0.0).otherwise(F.coalesce("lgc_price", F.lit(0.0))))
        .withColumn("lgc_percentage", F.coalesce("lgc_percentage", F.lit(0.0)))
        .join(sized(parties.select(*held).distinct()), "product_id")
        .where(F.col("interval_date").between(F.col("_opens"), F.col("_closes")))
    )
    folded = compact_ranges(rated, [*held, "lgc_price", "lgc_percentage"])
    ranges = parties.join(folded, held).groupBy(
        "deal_id", "product_id", "buy_sell", "region_number", "quantity_factor", "lgc_price", "lgc_percentage"
    ).agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))
    return _terms(
        ranges, "generation_lgc", quantity="quantity_factor", lgc_price="lgc_price", lgc_percentage="lgc_percentage"
    )


def _widest(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """First start and last end of each attribute combination."""
    return ranges.groupBy(*keys).agg(
        F.min("product_start_date").alias("start_date"), F.max("product_end_date").alias("end_date")
    )


def _retail(trades: DataFrame, regions: DataFrame) -> DataFrame:
    """The retail customers with region number and the dates of their product."""
    customers = (
        trades.where(F.col("instrument") == "Retail Customer")
        .select("deal_id", "product_id", "buy_sell", "regionid", "product_start_date", "product_end_date")
        .distinct()
    )
    return with_region_number(customers, regions)


def retail_energy_terms(trades: DataFrame, regions: DataFrame, calendar: DataFrame | DateLookup) -> DataFrame:
    """Retail energy: the product's dates, priced by the rate calendar."""
    ranges = clip_to_dates(_retail(trades, regions), calendar, "product_start_date", "product_end_date")
    return _terms(_widest(ranges, ["deal_id", "product_id", "buy_sell", "region_number"]), "retail_energy")


def retail_certificate_terms(
    trades: DataFrame, regions: DataFrame, rates: DataFrame, calendar: DataFrame | DateLookup
) -> DataFrame:
    """Retail certificates: one row per certificate price and percentage of the product.

    The dates belong to the product, so rates are folded up per product before its deals,
    however many, are joined.
    """
    customers = _retail(trades, regions)
    product = ["product_id", "product_start_date", "product_end_date"]
    days, products = sized_all(dates_of(calendar), customers.select(*product).distinct())
    rated = (
        rates.join(days, "interval_date", "left_semi")
        .join(products, "product_id")
        .where(F.col("interval_date").between(F.col("product_start_date"), F.col("product_end_date")))
        .withColumn("lgc_price", F.coalesce("lgc_price", F.lit(0.0)))
        .withColumn("lgc_percentage", F.coalesce("lgc_percentage", F.lit(0.0)))
    )
    ranges = compact_ranges(rated, [*product, "lgc_price", "lgc_percentage"])
    keys = ["deal_id", "product_id", "buy_sell", "region_number", "lgc_price", "lgc_percentage"]
    held = customers.join(ranges, product).groupBy(*keys).agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")
    )
    return _terms(held, "retail_lgc", lgc_price="lgc_price", lgc_percentage="lgc_percentage")


def wholesale_terms(
    trades: DataFrame, regions: DataFrame, shapes: DataFrame, calendar: DataFrame | DateLookup,
    escalation: DataFrame | None = None,
) -> DataFrame:
    """Firm swaps and caps, flat or profiled.

    The wholesale price is settled as traded, or times the deal's factor of type R where
    `escalation` (deal factors) is given. A product counts as profiled when it has a profile row
    with a volume.
    """
    firm = (
        trades.where(
            F.col("instrument_calculation").isin("Swap", "Cap")
            & ~F.col("product_name").like("%ACCU%")
            & (F.col("optionality") == "Firm")
        )
        .select(
            "product_id", "instrument_calculation", "deal_id", "buy_sell", "regionid", "quantity", "price",
            "strike_price", "product_start_date", "product_end_date",
        )
        .distinct()
    )
    if escalation is not None:
        factors = escalation.where(F.col("type") == "R").select(
            F.col("deal_id").alias("_deal"), "from_date", "to_date", F.col("factor").alias("_factor")
        )
        dates = {"product_start_date": "start_date", "product_end_date": "end_date"}
        firm = _cut_by(firm.withColumnsRenamed(dates), factors, "_factor").withColumnsRenamed({v: k for k, v in dates.items()})
        firm = firm.withColumn("price", F.col("price") * F.coalesce("_factor", F.lit(1.0))).drop("_factor")
    ranges = _widest(
        clip_to_dates(with_region_number(firm, regions), calendar, "product_start_date", "product_end_date"),
        ["product_id", "instrument_calculation", "deal_id", "buy_sell", "region_number", "quantity", "price", "strike_price"],
    )
    shaped = shapes.select("product_id", F.col("volume_factor").isNotNull().alias("shaped")).distinct()
    labelled = ranges.join(shaped, "product_id", "left")
    form = F.when(F.coalesce("shaped", F.lit(False)), "profiled").otherwise("flat")
    return _terms(
        labelled,
        F.concat(form, F.lit("_energy_"), F.lower("instrument_calculation")),
        quantity="quantity", price="price", strike="strike_price",
    )


def storage_terms(contracts: DataFrame) -> DataFrame:
    """Storage contracts as tolled assets: the hourly toll per MW over a day of the whole capacity."""
    return _terms(
        contracts,
        "asset_toll_energy",
        quantity=F.lit(1.0), tolling_fee=F.col("toll") * F.col("capacity") * 24,
    )


def settlement_terms(*branches: DataFrame) -> DataFrame:
    """All branches as one table; `buy` is true for bought contracts, false otherwise."""
    rows = branches[0]
    for branch in branches[1:]:
        rows = rows.unionByName(branch)
    return rows.select(
        "deal_id", "product_id", "instrument",
        F.coalesce(F.col("buy_sell") == "Buy", F.lit(False)).alias("buy"),
        "region_number", "start_date", "end_date", *TERM_VALUES,
    )
