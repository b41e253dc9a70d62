"""Small contract capture files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns and date formats of the two capture files.
GENERATION_COLUMNS = """deal_id int, product_id int, name string, duid string, fuel string, floor double,
    turndown double, size_mw double, rez string, regionid string, product_start_date date,
    product_end_date date, quantity_factor double"""
GENERATION_DATES = "d/M/yyyy"
STORAGE_COLUMNS = """deal_id int, product_id int, name string, duid string, buy_sell string, regionid string,
    start_date date, end_date date, capacity double, duration double, rte double, toll double"""
STORAGE_DATES = "yyyy-MM-dd"


def _read(spark: SparkSession, path: str, columns: str, dates: str) -> DataFrame:
    return spark.read.csv(
        path, schema=T.StructType.fromDDL(columns), header=True, dateFormat=dates, mode="FAILFAST"
    )


def read_generation_contracts(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """Offtake contracts (header, day-first dates) with their region number."""
    return (
        _read(spark, path, GENERATION_COLUMNS, GENERATION_DATES)
        .join(regions.select("regionid", "region_number"), "regionid")
        .select(
            "deal_id", "product_id", "name", "duid", "fuel", "floor", "turndown", "size_mw", "rez", "regionid",
            "region_number", F.col("product_start_date").alias("start_date"),
            F.col("product_end_date").alias("end_date"), "quantity_factor",
        )
    )


def read_storage_contracts(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """Storage contracts (header, ISO dates) with their region number."""
    return (
        _read(spark, path, STORAGE_COLUMNS, STORAGE_DATES)
        .join(regions.select("regionid", "region_number"), "regionid")
        .select(
            "deal_id", "product_id", "name", "duid", "buy_sell", "regionid", "region_number", "start_date",
            "end_date", "capacity", "duration", "rte", "toll",
        )
    )
