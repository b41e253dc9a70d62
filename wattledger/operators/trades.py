"""Trade and contract reference data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.plans import first_in_group, numbered_in_chunks, sized, sized_all
from wattledger.operators.calendar import OPEN_END, effective_ranges

# Date buckets under which rates are filed.
DATE_BUCKETS = 512


def _named(lookup: DataFrame, key: str, name: str, *extra: str) -> DataFrame:
    """A lookup table reduced to its key, its name under `name`, and `extra` columns."""
    return lookup.select(F.col("id").alias(key), F.col("name").alias(name), *extra)


def trade_star(
    legs: DataFrame,
    deals: DataFrame,
    products: DataFrame,
    books: DataFrame,
    strategies: DataFrame,
    companies: DataFrame,
    calendars: DataFrame,
    instruments: DataFrame,
    markets: DataFrame,
    nodes: DataFrame,
    leg_order: tuple[str, ...] | None = None,
) -> DataFrame:
    """Every leg of every deal in an active book, with its deal, product and lookup names.

    The lookups are joined to deals and to products before the legs are, so the leg table
    is shuffled for two joins and the numbering only. `leg_number` counts a deal's legs by
    transfer date, then by `leg_order` (all leg columns by name when not given), numbered in
    per-date chunks. Lookups are sent to deals and products behind a check of their size.
    """
    if leg_order is None:
        leg_order = tuple(sorted(c for c in legs.columns if c not in ("dealid", "transferdate")))
    books, strategies, companies, calendars, instruments, markets, nodes = sized_all(
        books, strategies, companies, calendars, instruments, markets, nodes
    )
    deal = (
        deals.join(
            books.where(F.col("active") == "Y").select(F.col("id").alias("bookid"), F.col("name").alias("book")),
            "bookid",
        )
        .join(_named(strategies, "strategyid", "strategy"), "strategyid", "left")
        .join(_named(companies, "companyid", "counterparty"), "companyid", "left")
        .join(_named(companies, "tradingentityid", "trading_entity"), "tradingentityid", "left")
        .join(_named(companies, "brokerid", "broker"), "brokerid", "left")
        .join(_named(companies, "clearerid", "clearer"), "clearerid", "left")
        .join(_named(calendars, "calendarid", "settlement_calendar"), "calendarid", "left")
        .select(
            F.col("id").alias("deal_id"),
            F.col("name").alias("deal_name"),
            F.col("buysell").alias("buy_sell"),
            F.to_date("dealdate").alias("deal_date"),
            "status",
            "optionality",
            F.col("optioncode").alias("option_code"),
            F.col("optiontype").alias("option_type"),
            F.col("optionprice").alias("option_price"),
            "book", "strategy", "trading_entity", "counterparty", "broker", "clearer",
            "settlement_calendar",
        )
    )
    product = (
        products.join(
            _named(instruments, "instrumentid", "instrument", F.col("calculation").alias("instrument_calculation"), "marketid"),
            "instrumentid",
            "left",
        )
        .join(_named(markets, "marketid", "market"), "marketid", "left")
        .join(nodes.select(F.col("id").alias("nodeid"), F.col("code").alias("regionid")), "nodeid", "left")
        .select(
            F.col("id").alias("product_id"),
            F.col("name").alias("product_name"),
            F.col("schedule").alias("product_schedule"),
            F.to_date("startdate").alias("product_start_date"),
            F.to_date("enddate").alias("product_end_date"),
            F.col("term").alias("product_term"),
            F.col("strike").alias("strike_price"),
            "regionid",
            F.expr("substring(regionid, 1, length(regionid) - 1)").alias("region"),
            "instrument", "instrument_calculation", "market",
        )
    )
    # A deal is in an active book with all its legs or with none, so legs can be numbered alone.
    numbered = numbered_in_chunks(
        legs.where(F.col("dealid").isNotNull()),
        ["dealid"],
        # Legs without a date come first, as they would in the order itself.
        F.coalesce(F.to_date("transferdate"), F.to_date(F.lit("0001-01-01"))),
        [F.col("transferdate"), *[F.col(c) for c in leg_order]],
        "leg_number",
    )
    own = numbered.join(deal, F.col("dealid") == F.col("deal_id"))
    return own.join(product, F.col("productid") == F.col("product_id"), "left").select(
        "deal_id", "deal_name", "leg_number", "product_id", "product_name", "buy_sell", "deal_date",
        "status", "product_schedule", "product_start_date", "product_end_date", "product_term",
        "optionality", "option_code", "option_type", "option_price", "quantity", "price", "brokerage",
        "strike_price", "regionid", "region", "book", "strategy", "trading_entity", "counterparty",
        "broker", "clearer", "settlement_calendar", "instrument", "instrument_calculation", "market",
        F.to_date("transferdate").alias("transfer_date"),
        F.to_date("paymentdate").alias("payment_date"),
    )


def deal_factors(raw: DataFrame) -> DataFrame:
    """Deal factors with the dates they hold: type R escalates a price, type M is a monthly toll."""
    dated = raw.select(
        F.col("dealid").alias("deal_id"), "type", F.col("fromdate").cast("date").alias("from_date"), "factor"
    )
    return effective_ranges(dated, ["deal_id", "type"], "from_date").select(
        "deal_id", "type", "from_date", "to_date", "factor"
    )


def retail_rates(
    profiles: DataFrame, products: DataFrame, product_jurisdictions: DataFrame
) -> DataFrame:
    """5-minute retail rates (code R) with the dates they hold, for each jurisdiction of the product."""
    ends = products.select(
        F.col("id").alias("product_id"), F.to_date("enddate").alias("product_end_date")
    )
    rated = profiles.where((F.col("code") == "R") & (F.col("interval_minutes") == 5)).join(
        ends, "product_id"
    )
    ranged = effective_ranges(rated, ["product_id", "code", "day_type", "period_id"], "from_date", OPEN_END)
    spread = product_jurisdictions.select("product_id", "jurisdiction_id").distinct()
    return (
        ranged.withColumn("to_date", F.least("to_date", "product_end_date"))
        .join(spread, "product_id")
        .select("product_id", "from_date", "to_date", "jurisdiction_id", "day_type", "period_id", "rate")
    )


def rate_calendar(
    calendar: DataFrame,
    rates: DataFrame,
    start: date | None = None,
    end: date | None = None,
    buckets: int = DATE_BUCKETS,
) -> DataFrame:
    """Rate of every product, jurisdiction and interval, from `start` and to `end` where given.

    `calendar` is the output of `day_type_calendar`. Rates are cut to the calendar's dates and
    filed under date buckets that begin where rates begin or end, in equal shares, `buckets` at
    most. So a day meets the rates of its bucket, jurisdiction, period and day type, and a rate
    meets days outside its dates only in its first and last bucket, and none where the rates
    have no more different ends than there are buckets.
    """
    days = calendar
    if start is not None:
        days = days.where(F.col("interval_date") >= F.lit(start))
    if end is not None:
        days = days.where(F.col("interval_date") <= F.lit(end))
    days, live = _bucketed(days, rates, buckets)
    return (
        days.join(live, ["jurisdiction_id", "period_id", "day_type", "_bucket"])
        .where(F.col("interval_date").between(F.col("from_date"), F.col("to_date")))
        .select("product_id", "jurisdiction_id", "interval_date", "period_id", "rate")
    )


def _bucketed(days: DataFrame, rates: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Days with their date bucket, and rates in each bucket that they reach into."""
    dates = days.select("interval_date").distinct()
    span = dates.agg(F.min("interval_date").alias("a"), F.max("interval_date").alias("b")).first()
    if span.a is None:
        return days.withColumn("_bucket", F.lit(0)), rates.where(F.lit(False)).withColumn("_bucket", F.lit(0))
    opens, closes = F.greatest("from_date", F.lit(span.a)), F.least("to_date", F.lit(span.b))
    live = rates.where(F.col("from_date").isNotNull() & F.col("to_date").isNotNull() & (opens <= closes))
    edges = live.select(F.explode(F.array(F.unix_date(opens), F.unix_date(closes) + 1)).alias("edge"))
    shares = [i / buckets for i in range(1, buckets)]
    # Different edges: one for each day of the calendar at most.
    found = edges.agg(F.collect_set("edge").alias("each"), F.percentile_approx("edge", shares, 10 * buckets).alias("even")).first()
    edge = sorted(set(found.each if len(found.each) <= buckets else found.even or ()))
    ends = F.array(*[F.lit(e) for e in edge]).cast("array<int>")

    def bucket(date: Column) -> Column:
        return F.size(F.filter(ends, lambda e: e <= F.unix_date(date)))

    # Decided once per date of the calendar, which is one row there.
    days = days.join(sized(dates.withColumn("_bucket", bucket(F.col("interval_date")))), "interval_date")
    return days, live.withColumn("_bucket", F.explode(F.sequence(bucket(opens), bucket(closes))))


def shaped_product_profiles(profiles: DataFrame, products: DataFrame) -> DataFrame:
    """Interval profiles of products that are not on a flat schedule."""
    flat = (
        products.where(F.col("schedule").isin("Flat", "Base"))
        .select(F.col("id").cast("int").alias("product_id")).distinct()
    )
    return profiles.join(flat, "product_id", "left_anti")


def certificate_rates(raw: DataFrame) -> DataFrame:
    """One certificate price and percentage per product and date: the lowest where several are given."""
    return first_in_group(
        raw.select("product_id", "interval_date", "lgc_price", "lgc_percentage"),
        ["product_id", "interval_date"],
        [F.col("lgc_price"), F.col("lgc_percentage")],
    )


def with_region_number(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Adds `region_number` by `regionid`; rows of unknown regions are dropped."""
    return df.join(sized(regions.select("regionid", "region_number")), "regionid")


def with_jurisdiction(df: DataFrame, jurisdictions: DataFrame) -> DataFrame:
    """Adds `jurisdiction` and `region_number` by `jurisdiction_id`."""
    return df.join(
        sized(jurisdictions.select("jurisdiction_id", "jurisdiction", "region_number")), "jurisdiction_id"
    )
