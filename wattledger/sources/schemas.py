"""Schemas of the tables the engine makes, their keys, and the instrument dimension."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Instrument ids and names.
INSTRUMENTS = (
    (0, "flat_energy_swap"),
    (1, "flat_energy_cap"),
    (2, "profiled_energy_swap"),
    (3, "profiled_energy_cap"),
    (4, "ppa_energy"),
    (5, "asset_toll_energy"),
    (6, "generation_lgc"),
    (7, "retail_energy"),
    (8, "retail_lgc"),
)


@dataclass(frozen=True)
class TableContract:
    """Columns of a table, its primary key and its foreign keys (columns -> parent table name)."""

    ddl: str
    key: tuple[str, ...]
    parents: dict[tuple[str, ...], str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


_MODEL, _SAMPLE = ("model_id",), ("model_id", "sample_id")
_REGION, _JURISDICTION, _INSTRUMENT = ("region_number",), ("jurisdiction_id",), ("instrument_id",)

TABLES: dict[str, TableContract] = {
    "scenario_prices": TableContract(
        "model_id int not null, sample_id int not null, interval_date date not null, period_id int not null,"
        " region_number int not null, rrp double not null",
        ("interval_date", "period_id", "region_number"),
        {_MODEL: "models", _SAMPLE: "sample_details", _REGION: "regions"},
    ),
    "scenario_earnings": TableContract(
        "product_id int not null, deal_id int not null, instrument_id int not null, region_number int not null,"
        " buy boolean not null, interval_date date not null, period_id int not null, volume_mwh double not null,"
        " income double not null, cost double not null",
        ("product_id", "deal_id", "instrument_id", "region_number", "interval_date", "period_id"),
        {_REGION: "regions", _INSTRUMENT: "instruments"},
    ),
    "quarterly_earnings": TableContract(
        "run_date date not null, product_id int not null, deal_id int not null, instrument_id int not null,"
        " region_number int not null, buy boolean not null, calendar_year int not null,"
        " calendar_quarter int not null, volume_mwh double not null, income double not null, cost double not null",
        ("run_date", "product_id", "deal_id", "instrument_id", "region_number", "calendar_year", "calendar_quarter"),
        {_REGION: "regions", _INSTRUMENT: "instruments"},
    ),
    "generation_profiles": TableContract(
        "model_id int not null, product_id int not null, year int not null, month_id int not null,"
        " day_id int not null, period_id int not null, generation_mwh double not null",
        ("product_id", "year", "month_id", "day_id", "period_id"),
        {_MODEL: "models"},
    ),
    "storage_profiles": TableContract(
        "model_id int not null, product_id int not null, sample_id int not null, interval_date date not null,"
        " period_id int not null, generation_mwh double not null",
        ("model_id", "product_id", "sample_id", "interval_date", "period_id"),
        {_MODEL: "models"},
    ),
    "load_profiles": TableContract(
        "model_id int not null, product_id int not null, jurisdiction_id int not null, year int not null,"
        " month_id int not null, day_id int not null, period_id int not null, load_mwh double not null",
        ("product_id", "jurisdiction_id", "year", "month_id", "day_id", "period_id"),
        {_MODEL: "models", _JURISDICTION: "jurisdictions"},
    ),
    # Energy and certificate rows of one contract start on the same day, hence the wider key.
    "settlement_terms": TableContract(
        "deal_id int not null, product_id int not null, instrument string not null, buy boolean not null,"
        " region_number int not null, start_date date not null, end_date date not null, quantity double,"
        " price double, strike double, tolling_fee double, floor double, turndown double, lgc_price double,"
        " lgc_percentage double",
        ("deal_id", "product_id", "instrument", "region_number", "start_date"),
        {_REGION: "regions"},
    ),
    "rate_calendar": TableContract(
        "product_id int not null, jurisdiction_id int not null, interval_date date not null,"
        " period_id int not null, rate double not null",
        ("product_id", "jurisdiction_id", "interval_date", "period_id"),
        {_JURISDICTION: "jurisdictions"},
    ),
    "instruments": TableContract(
        "instrument_id int not null, instrument string not null", ("instrument_id",)
    ),
}


def instrument_dim(spark: SparkSession) -> DataFrame:
    """The nine instruments."""
    return spark.createDataFrame(list(INSTRUMENTS), TABLES["instruments"].schema)


def with_instrument(terms: DataFrame, dim: DataFrame) -> DataFrame:
    """Adds the instrument id to terms that carry the name, or the name to terms that carry the id.

    Terms of an instrument outside the dimension are dropped. The dimension has nine rows.
    """
    key = "instrument" if "instrument" in terms.columns else "instrument_id"
    return terms.join(F.broadcast(dim.select("instrument_id", "instrument")), key)
