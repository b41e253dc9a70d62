"""Interval settlement: what each contract earns in each interval.

Every operator takes settlement terms of its instrument (`deal_id`, `product_id`,
`instrument_id`, dates and values) and returns deal, product, instrument, date, period,
region, `volume_mwh`, `buy_income` (the market leg) and `sell_income` (the contract leg).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.money import at_least, excess_over
from wattledger.functions.plans import BROADCAST_ROWS, cut, fits, sized, sized_all
from wattledger.functions.sweep import sweep_join
from wattledger.functions.timegrid import INTERVALS_PER_DAY, INTERVALS_PER_HOUR

INTERVAL = ["interval_date", "period_id", "region_number"]
SETTLED = ["deal_id", "product_id", "instrument_id", *INTERVAL]


def _under_contract(
    facts: DataFrame, terms: DataFrame, key: str, values: list[str], small: bool
) -> DataFrame:
    """Fact rows with each contract that covers them: equal `key`, date inside the contract.

    A contract without a start or an end covers no date. A `small` list, counted by the caller, is
    broadcast and the facts are not shuffled. A larger one meets the facts in a sweep over both in
    the order of key and date, see `wattledger.functions.sweep`.
    """
    carried = [c for c in dict.fromkeys([*SETTLED, "instrument", "buy", *values]) if c in terms.columns]
    contract = terms.select(*carried, "start_date", "end_date")
    shared = {c for c in contract.columns if c in facts.columns and c != key}
    contract = contract.drop(*shared).where(F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
    covered = F.col("interval_date").between(F.col("start_date"), F.col("end_date"))
    if small:
        return facts.join(F.broadcast(contract), key).where(covered).drop("start_date", "end_date")
    return sweep_join(facts, contract, key, "interval_date", "start_date", "end_date")


def _settled(rows: DataFrame, volume: Column, buy: Column, sell: Column) -> DataFrame:
    carried = [c for c in ("instrument", "buy") if c in rows.columns]
    return (
        rows.withColumn("volume_mwh", volume)
        .select(*SETTLED, *carried, "volume_mwh", buy.alias("buy_income"), sell.alias("sell_income"))
    )


def _generation_energy(terms, generation, prices, buy, sell, small) -> DataFrame:
    values = ["quantity", "price", "floor", "tolling_fee"]
    rows = _under_contract(generation, terms, "product_id", values, small).join(prices, INTERVAL)
    return _settled(rows, F.col("generation_mwh") * F.col("quantity"), buy, sell)


def _floored_spot() -> Column:
    return at_least(F.col("rrp"), F.col("floor")) * F.col("volume_mwh")


def _spot() -> Column:
    return F.col("rrp") * F.col("volume_mwh")


def _spot_over(strike: str) -> Column:
    return excess_over(F.col("rrp"), F.col(strike)) * F.col("volume_mwh")


def _contract_price() -> Column:
    return F.col("volume_mwh") * F.col("price")


def _daily_fee() -> Column:
    return F.col("tolling_fee") / INTERVALS_PER_DAY


def ppa_energy(
    terms: DataFrame, generation: DataFrame, prices: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Offtake energy: a share of the generation, spot (not under the floor) against contract price."""
    return _generation_energy(
        terms, generation, prices, _floored_spot(), _contract_price(), fits(terms, broadcast_rows)
    )


def asset_toll_energy(
    terms: DataFrame, generation: DataFrame, prices: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Tolled asset: its generation at spot against a daily fee, an even part of it per interval."""
    return _generation_energy(
        terms, generation, prices, _spot(), _daily_fee(), fits(terms, broadcast_rows)
    )


def retail_energy(
    terms: DataFrame,
    load: DataFrame,
    prices: DataFrame,
    rates: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Retail energy: load at spot against load at the retail rate, summed over jurisdictions."""
    return _retail_energy(terms, load, prices, rates, fits(terms, broadcast_rows))


def _retail_energy(terms, load, prices, rates, small) -> DataFrame:
    # Contracts first: they keep only retail products before anything is shuffled. The region
    # of the load, not of the contract, decides the price.
    rows = (
        _under_contract(load, terms, "product_id", [], small)
        .join(rates, ["product_id", "jurisdiction_id", "interval_date", "period_id"])
        .join(prices, INTERVAL)
    )
    carried = [c for c in ("instrument", "buy") if c in rows.columns]
    return rows.groupBy(*SETTLED, *carried).agg(
        F.sum("load_mwh").alias("volume_mwh"),
        F.sum(F.col("load_mwh") * F.col("rrp")).alias("buy_income"),
        F.sum(F.col("load_mwh") * F.col("rate")).alias("sell_income"),
    )


def _flat(terms, prices, buy, small) -> DataFrame:
    rows = _under_contract(prices, terms, "region_number", ["quantity", "price", "strike"], small)
    return _settled(rows, F.col("quantity") / INTERVALS_PER_HOUR, buy, _contract_price())


def flat_energy_swap(
    terms: DataFrame, prices: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Flat swap: constant MW at spot against the contract price."""
    return _flat(terms, prices, _spot(), fits(terms, broadcast_rows))


def flat_energy_cap(
    terms: DataFrame, prices: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Flat cap: constant MW at the spot price above the strike against the premium."""
    return _flat(terms, prices, _spot_over("strike"), fits(terms, broadcast_rows))


def _profiled(terms, shapes, prices, buy, small) -> DataFrame:
    shape = shapes.select(
        "product_id", "interval_date", "period_id", "volume_factor", F.col("strike").alias("shape_strike")
    )
    rows = _under_contract(shape, terms, "product_id", ["quantity", "price"], small).join(prices, INTERVAL)
    volume = F.col("quantity") / INTERVALS_PER_HOUR * F.col("volume_factor")
    return _settled(rows, volume, buy, _contract_price())


def profiled_energy_swap(
    terms: DataFrame, shapes: DataFrame, prices: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Profiled swap: MW by the product's shape, at spot against the contract price."""
    return _profiled(terms, shapes, prices, _spot(), fits(terms, broadcast_rows))


def profiled_energy_cap(
    terms: DataFrame, shapes: DataFrame, prices: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Profiled cap: as the swap, paid above the strike of the shape."""
    return _profiled(terms, shapes, prices, _spot_over("shape_strike"), fits(terms, broadcast_rows))


def _certificates(rows: DataFrame, market: DataFrame, volume: Column) -> DataFrame:
    """Rows by the market price of their date; the caller has sized `market`, a row per date."""
    priced = rows.join(market.select("interval_date", F.col("lgc_price").alias("market_price")), "interval_date")
    return _settled(
        priced,
        volume,
        F.col("volume_mwh") * F.col("market_price"),
        F.col("volume_mwh") * F.col("lgc_price"),
    )


def generation_lgc(
    terms: DataFrame, generation: DataFrame, certificates: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Offtake certificates: a share of the generation at the market price against the contract's."""
    return _generation_lgc(terms, generation, sized(certificates), fits(terms, broadcast_rows))


def _generation_lgc(terms, generation, certificates, small) -> DataFrame:
    values = ["quantity", "lgc_price", "lgc_percentage"]
    rows = _under_contract(generation, terms, "product_id", values, small)
    volume = F.col("generation_mwh") * F.col("quantity") * F.col("lgc_percentage")
    return _certificates(rows, certificates, volume)


def _generation_book(terms, generation, prices, certificates, small) -> DataFrame:
    """Energy, tolls and certificates of generation in one pass over it.

    Energy rows need the price of their interval, certificate rows the market price of their
    date; each kind looks up its own and is dropped where that is missing.
    """
    name = F.col("instrument")
    green = name == "generation_lgc"
    values = ["quantity", "price", "floor", "tolling_fee", "lgc_price", "lgc_percentage"]
    rows = _under_contract(generation, terms, "product_id", values, small)
    spot = prices.select(*[F.col(c).alias(f"_{c}") for c in INTERVAL], "rrp", F.lit(True).alias("_priced"))
    same = [F.col(c) == F.col(f"_{c}") for c in INTERVAL]
    market = certificates.select(
        F.col("interval_date").alias("_date"), F.col("lgc_price").alias("market_price"), F.lit(True).alias("_marked")
    )
    rows = (
        rows.join(spot, same[0] & same[1] & same[2] & ~green, "left")
        .join(market, (F.col("interval_date") == F.col("_date")) & green, "left")
        .where(F.when(green, F.col("_marked")).otherwise(F.col("_priced")))
    )
    share = F.col("generation_mwh") * F.col("quantity")
    return _settled(
        rows,
        F.when(green, share * F.col("lgc_percentage")).otherwise(share),
        F.when(green, F.col("volume_mwh") * F.col("market_price"))
        .when(name == "ppa_energy", _floored_spot()).otherwise(_spot()),
        F.when(green, F.col("volume_mwh") * F.col("lgc_price"))
        .when(name == "ppa_energy", _contract_price()).otherwise(_daily_fee()),
    )


def retail_lgc(
    terms: DataFrame, load: DataFrame, certificates: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Retail certificates: a share of the load; one row per jurisdiction of the load."""
    return _retail_lgc(terms, load, sized(certificates), fits(terms, broadcast_rows))


def _retail_lgc(terms, load, certificates, small) -> DataFrame:
    rows = _under_contract(load, terms, "product_id", ["lgc_price", "lgc_percentage"], small)
    return _certificates(rows, certificates, F.col("load_mwh") * F.col("lgc_percentage"))


def apply_turndown(
    generation: DataFrame, turndowns: DataFrame, prices: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Generation with the intervals set to zero in which the price is under the turndown price.

    `turndowns` are the terms that have one. A product with a turndown keeps only the rows
    inside its dates; only rows of such products meet prices. `prices` has one per interval and
    region.
    """
    return _turned_down(generation, turndowns, prices, broadcast_rows)


def _turned_down(generation, turndowns, prices, broadcast_rows) -> DataFrame:
    limits = turndowns.where(F.col("turndown").isNotNull()).select(
        "product_id", "region_number", "start_date", "end_date", "turndown"
    )
    # Only prices under some turndown of their region and time can turn anything down.
    reach = limits.groupBy("region_number").agg(
        F.max("turndown").alias("_most"), F.min("start_date").alias("_first"), F.max("end_date").alias("_last")
    )
    limits, reach = sized_all(limits, reach, rows=broadcast_rows)
    low = cut(
        prices.select(*INTERVAL, "rrp").join(reach, "region_number")
        .where((F.col("rrp") < F.col("_most")) & F.col("interval_date").between(F.col("_first"), F.col("_last")))
        .select(*INTERVAL, "rrp")
    )
    inside = F.col("interval_date").between(F.col("start_date"), F.col("end_date"))
    limited = F.col("turndown").isNotNull()
    # Generation is read once: rows of products without a turndown find no limit.
    rows = generation.join(limits, "product_id", "left").where(~limited | inside)
    columns = ["product_id", "interval_date", "period_id"]
    turned = F.when(F.col("rrp") < F.col("turndown"), F.lit(0.0)).otherwise(F.col("generation_mwh")).alias("generation_mwh")
    if fits(low, broadcast_rows):
        return rows.join(F.broadcast(low), INTERVAL, "left").select(*columns, turned)
    # Many low prices: the rows are parted in the one pass that reads them, and only those with a
    # turndown are shuffled to prices.
    parted = cut(rows.select(*columns, "region_number", "turndown", "generation_mwh", limited.alias("_limited")), ["_limited"])
    cut_back = parted.where("_limited").join(low.hint("merge"), INTERVAL, "left").select(*columns, turned)
    return parted.where("not _limited").select(*columns, "generation_mwh").unionByName(cut_back)


def _sides(terms: DataFrame) -> DataFrame:
    return terms.select("deal_id", "product_id", "buy").distinct()


def _oriented(rows: DataFrame) -> DataFrame:
    bought = F.col("buy")
    return rows.select(
        *SETTLED[:3], "region_number", "buy", "interval_date", "period_id", "volume_mwh",
        F.when(bought, F.col("buy_income")).otherwise(F.col("sell_income")).alias("income"),
        F.when(bought, F.col("sell_income")).otherwise(F.col("buy_income")).alias("cost"),
    )


def orient(earnings: DataFrame, terms: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Income and cost from the side taken: a buyer receives the market leg, a seller the contract leg."""
    sides = sized(_sides(terms), broadcast_rows)
    return _oriented(earnings.drop("buy").join(sides, ["deal_id", "product_id"]))


def settle_book(
    terms: DataFrame,
    generation: DataFrame,
    load: DataFrame,
    shapes: DataFrame,
    prices: DataFrame,
    certificates: DataFrame,
    rates: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    turndowns: DataFrame | None = None,
) -> DataFrame:
    """Income and cost of the whole book per contract and interval.

    Instruments that use the same inputs are settled in one pass over them (five passes for
    nine instruments, one of them over generation), and the side of each contract is attached to the terms, not to the
    interval rows. `terms` carries `instrument` and `instrument_id`. A turndown holds for all
    contracts of its product; where `terms` are a part of the book, `turndowns` are those of the
    whole book.
    """
    # The book fits when all of it does: its parts are then small too.
    small = fits(terms, broadcast_rows)
    certificates = sized(certificates)
    sided = terms.drop("buy").join(_sides(terms), ["deal_id", "product_id"])
    # Turndown applies to generation before any contract sees it.
    metered = _turned_down(generation, terms if turndowns is None else turndowns, prices, broadcast_rows)

    def of(*instruments: str) -> DataFrame:
        return sided.where(F.col("instrument").isin(*instruments))

    name = F.col("instrument")
    passes = [
        _generation_book(
            of("ppa_energy", "asset_toll_energy", "generation_lgc"), metered, prices, certificates, small
        ),
        _retail_energy(of("retail_energy"), load, prices, rates, small),
        _retail_lgc(of("retail_lgc"), load, certificates, small),
        _flat(
            of("flat_energy_swap", "flat_energy_cap"), prices,
            F.when(name == "flat_energy_swap", _spot()).otherwise(_spot_over("strike")),
            small,
        ),
        _profiled(
            of("profiled_energy_swap", "profiled_energy_cap"), shapes, prices,
            F.when(name == "profiled_energy_swap", _spot()).otherwise(_spot_over("shape_strike")),
            small,
        ),
    ]
    book = _oriented(passes[0])
    for settled in passes[1:]:
        book = book.unionByName(_oriented(settled))
    return book
