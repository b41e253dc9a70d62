"""Daily revaluation: terms, calibrated prices, profiles, settlement, quarters.

Each stage writes a table and the next one reads it: a lost executor repeats at most one
stage, and no stage is planned on guesses about another one's size.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.operators import calendar as cal
from wattledger.operators import calibrate, market, profiles, report, settle, terms, trades
from wattledger.sources.checks import check_contract
from wattledger.sources.schemas import TABLES, instrument_dim, with_instrument
from wattledger.sources.sinks import Folder, read_slices, replace_slice, write_snapshot


STAR_COLUMNS = (
    "deal_id", "product_id", "product_name", "buy_sell", "optionality", "quantity", "price", "strike_price", "regionid",
    "product_start_date", "product_end_date", "instrument", "instrument_calculation",
)


@dataclass(frozen=True)
class Tables:
    """Where the stages write: a folder with one table per name.

    A stage fails when its table breaks a contract rule named in `enforced`. Keys that source
    data may repeat, such as terms of overlapping contracts, are enforced on request. Tables that
    are stored by a key are cut into `buckets`.
    """

    spark: SparkSession
    root: str
    enforced: tuple[str, ...] = ("not_null",)
    buckets: int = 200

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def bucketed(self, name: str) -> str:
        """The catalog's name of a table that is stored by a key."""
        return f"{name}_{hashlib.sha256(self.path(name).encode()).hexdigest()[:12]}"

    def read(self, name: str) -> DataFrame:
        """The table; with its buckets where this session's catalog knows them, else the same rows
        from its folder. A declared table that was stored without rows may have no files, and has
        its declared columns then."""
        if self.spark.catalog.tableExists(self.bucketed(name)):
            return self.spark.table(self.bucketed(name))
        reader, contract = self.spark.read, TABLES.get(name)
        if contract is not None and not Folder(self.spark, self.path(name)).files(""):
            reader = reader.schema(contract.schema)
        return reader.parquet(self.path(name))

    def store(
        self, name: str, df: DataFrame, partition_by: tuple[str, ...] = (), bucket_by: tuple[str, ...] = ()
    ) -> DataFrame:
        """Writes the table, in its declared columns and types where `TABLES` has it, and checks
        it against its contract; raises when an enforced rule is broken. With `bucket_by` its rows
        are shuffled once here, into sorted buckets, and not again by joins on those columns."""
        contract = TABLES.get(name)
        if contract is not None:
            declared = {f.name: F.col(f.name).cast(f.dataType) for f in contract.schema.fields}
            extra = [F.col(c) for c in df.columns if c not in declared]
            df = df.select(*[c.alias(n) for n, c in declared.items()], *extra)
        if bucket_by:
            dealt = df.repartition(self.buckets, *bucket_by).write.mode("overwrite").option("path", self.path(name))
            dealt.bucketBy(self.buckets, *bucket_by).sortBy(*bucket_by).saveAsTable(self.bucketed(name))
        else:
            write_snapshot(df, self.path(name), partition_by)
        stored = self.read(name)
        if contract is not None:
            rules = check_contract(stored, contract).where(F.col("rule").isin(*self.enforced))
            broken = rules.where("violations > 0").collect()
            if broken:
                raise ValueError(f"{name} breaks its contract: {[tuple(r) for r in broken]}")
        return stored


def update_terms(
    tables: Tables, star: DataFrame, contracts: DataFrame, storage: DataFrame, certificate_rates: DataFrame,
    factors: DataFrame, shapes: DataFrame, regions: DataFrame, calendar: DataFrame, as_of: date,
) -> DataFrame:
    """Stage 1: the settlement terms of the horizon that starts at `as_of`.

    The star, in the columns that terms need, and the lookup of the horizon's dates are stored and
    read from there by each of them.
    """
    horizon = cal.date_lookup(cal.horizon_filter(calendar, as_of))
    star = tables.store("trade_star", star.select(*STAR_COLUMNS))
    return tables.store(
        "settlement_terms",
        terms.settlement_terms(
            terms.ppa_energy_terms(contracts, star, factors, horizon),
            terms.ppa_certificate_terms(contracts, star, certificate_rates, horizon),
            terms.retail_energy_terms(star, regions, horizon),
            terms.retail_certificate_terms(star, regions, certificate_rates, horizon),
            terms.wholesale_terms(star, regions, shapes, horizon),
            terms.storage_terms(storage),
        ),
    )


def update_rate_calendar(
    tables: Tables, datetimes: DataFrame, jurisdictions: DataFrame, holidays: DataFrame, rates: DataFrame, as_of: date
) -> DataFrame:
    """Stage 2: interval rates from `as_of` on."""
    days = cal.day_type_calendar(datetimes.where(F.col("interval_date") >= F.lit(as_of)), jurisdictions, holidays)
    return tables.store("rate_calendar", trades.rate_calendar(days, rates, start=as_of))


def update_prices(
    tables: Tables, sims: DataFrame, models: DataFrame, model: int | str, quotes: DataFrame, spot: DataFrame,
    calendar: DataFrame, regions: DataFrame, as_of: date,
) -> DataFrame:
    """Stage 3: the calibrated price path of one model."""
    payout = market.quarter_to_date_payout(spot, calendar, as_of)
    futures = market.quarterly_futures(quotes, payout, as_of)
    curve = market.certificate_curve(quotes, as_of)
    chosen = profiles.simulations_for(sims, models, model)
    return tables.store("scenario_prices", calibrate.scenario_prices(chosen, curve, futures, regions, as_of))


def update_earnings(
    tables: Tables, generation: DataFrame, storage: DataFrame, load: DataFrame, details: DataFrame,
    shapes: DataFrame, jurisdictions: DataFrame, quotes: DataFrame, calendar: DataFrame, as_of: date,
) -> DataFrame:
    """Stage 4: interval earnings of the book, partitioned by year."""
    prices = tables.read("scenario_prices")
    book = with_instrument(tables.read("settlement_terms"), instrument_dim(tables.spark))
    index = profiles.sample_index(prices, details, "gen_reference_year")
    demand_index = profiles.sample_index(prices, details, "demand_reference_year")
    curve = market.certificate_curve(quotes, as_of)
    earnings = settle.settle_book(
        book,
        profiles.scenario_generation(generation, storage, index),
        profiles.scenario_load(load, demand_index, jurisdictions),
        profiles.scenario_shapes(shapes, book, prices),
        prices.select(*settle.INTERVAL, "rrp"),
        market.certificate_daily(curve, calendar),
        tables.read("rate_calendar"),
    )
    return tables.store("scenario_earnings", earnings.withColumn("year", F.year("interval_date")), ("year",))


def update_quarters(tables: Tables, run_date: date) -> DataFrame:
    """Stage 5: quarterly earnings; a second run on the same date replaces the first, whole or not at all."""
    quarters = report.quarterly_earnings(tables.read("scenario_earnings"), run_date)
    replace_slice(quarters, tables.path("quarterly_earnings"), ["run_date"], [(run_date,)])
    return read_slices(tables.spark, tables.path("quarterly_earnings"))


def update_profiles(
    tables: Tables, calendar: DataFrame, details: DataFrame, units: DataFrame, scada: DataFrame, dispatch: DataFrame,
    capacity: DataFrame, unit_detail: DataFrame, halfhours: DataFrame, published_loss: DataFrame,
    jurisdictions: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """The weekly refresh: generation and load profiles in the reference years of one model's samples.

    Both are stored by the columns on which they are replayed, so the daily stages that follow join
    them with the path where they lie.
    """
    generation = profiles.generation_profiles(calendar, details, units, scada, dispatch, capacity, unit_detail)
    load = profiles.load_profiles(calendar, details, halfhours, published_loss, jurisdictions)
    return (
        tables.store("generation_profiles", generation, bucket_by=profiles.REPLAY_KEY),
        tables.store("load_profiles", load, bucket_by=profiles.REPLAY_KEY),
    )


def revalue(tables: Tables, as_of: date, *, terms: dict, rates: dict, prices: dict, earnings: dict) -> DataFrame:
    """The daily job: all five stages in order, each with the inputs of its function by name."""
    update_terms(tables, as_of=as_of, **terms)
    update_rate_calendar(tables, as_of=as_of, **rates)
    update_prices(tables, as_of=as_of, **prices)
    update_earnings(tables, as_of=as_of, **earnings)
    return update_quarters(tables, as_of)
