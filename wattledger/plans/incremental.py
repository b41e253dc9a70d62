"""Settling again only what changed: digests of contracts and of the inputs that they read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.plans import cut, sized
from wattledger.operators import settle
from wattledger.plans.revaluation import Tables
from wattledger.sources.sinks import COMMIT, Folder, read_slices, replace_slice

CONTRACT = ["deal_id", "product_id"]
# Slices of the earnings table; a slice is rewritten when one of its contracts changes.
SLICES = 1024
EARNINGS, DIGESTS = "contract_earnings", "contract_digests"


def _digest(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Per `keys` a digest of its rows in any order: their number and the sum of their hashes, which
    tasks combine before anything is shuffled."""
    values = [F.col(f"`{c}`") for c in sorted(rows.columns)]
    known = [F.isnull(v) for v in values]
    total = F.sum(F.xxhash64(*values, *known).cast("decimal(38,0)"))
    made = F.concat_ws(":", F.count(F.lit(1)).cast("string"), total.cast("string"))
    return rows.groupBy(*keys).agg(made.alias(name))


def contract_digests(
    terms: DataFrame, generation: DataFrame, load: DataFrame, shapes: DataFrame, prices: DataFrame,
    certificates: DataFrame, rates: DataFrame,
) -> DataFrame:
    """Per contract (deal and product) a digest of all it is settled from: deal_id, product_id, digest.

    That is its own terms, the turndowns, generation, load, shapes and rates of its product, and all
    prices and certificate prices. Each input is read once and gives a row per product.
    """
    limits = terms.where(F.col("turndown").isNotNull()).select("product_id", "region_number", "start_date", "end_date", "turndown")
    slices = {"limits": limits, "generation": generation, "load": load, "shapes": shapes, "rates": rates}
    common = [r for df in (prices, certificates) for r in _digest(df, [], "d").collect()]  # one row each
    whole = _digest(terms, CONTRACT, "_terms")
    for name, rows in slices.items():
        whole = whole.join(sized(_digest(rows, ["product_id"], f"_{name}")), "product_id", "left")
    own = [F.coalesce(F.col(f"_{n}"), F.lit("")) for n in ("terms", *slices)]
    return whole.select(*CONTRACT, F.sha2(F.concat_ws("|", *own, *[F.lit(r.d or "") for r in common]), 256).alias("digest"))


def _slice_of(slices: int) -> Column:
    return F.pmod(F.xxhash64(*CONTRACT), F.lit(slices)).cast("int").alias("slice")


def update_changed_earnings(
    tables: Tables, terms: DataFrame, generation: DataFrame, load: DataFrame, shapes: DataFrame, prices: DataFrame,
    certificates: DataFrame, rates: DataFrame, slices: int = SLICES,
) -> DataFrame:
    """Brings the earnings table in line with the book: deal_id, product_id of the contracts settled.

    Contracts whose digest is that of the last run keep their rows. The others are settled, and
    their slices are replaced as a whole, together with the slices of contracts that left the
    book. The digests are replaced after that, so a run that broke off in between settles its
    contracts once more, to the same rows. `terms` carry `instrument` and `instrument_id`. A table
    keeps its number of `slices` for good.
    """
    spark, known = tables.spark, tables.path(DIGESTS)
    inputs = (generation, load, shapes, prices, certificates, rates)
    current = cut(contract_digests(terms, *inputs).select("*", _slice_of(slices)))
    stored = Folder(spark, known)
    first = not stored.slices("", 1) and not stored.exists(COMMIT)
    before = current.limit(0) if first else cut(read_slices(spark, known, current.schema))
    earlier = before.select(*CONTRACT, F.col("digest").alias("_before"))
    changed = cut(
        current.join(sized(earlier), CONTRACT, "left").where(~F.col("digest").eqNullSafe(F.col("_before"))).select(*CONTRACT, "slice")
    )
    left = cut(before.join(sized(current.select(*CONTRACT)), CONTRACT, "left_anti").select(*CONTRACT, "slice"))
    touched = [r.slice for r in changed.unionByName(left).select("slice").distinct().collect()]  # `slices` at most
    if not touched:
        return changed.select(*CONTRACT)
    part = terms.join(sized(changed.select(*CONTRACT)), CONTRACT, "left_semi")
    settled = settle.settle_book(part, *inputs, turndowns=terms).select("*", _slice_of(slices))
    new = [settled]
    if not first:
        held = read_slices(spark, tables.path(EARNINGS), settled.schema).where(F.col("slice").isin(touched))
        out = changed.select(*CONTRACT).unionByName(left.select(*CONTRACT))
        new.append(held.join(sized(out), CONTRACT, "left_anti").select(*settled.columns))
    # Written beside the table before its slices are replaced, as the rows to keep are read from it.
    rows = cut(reduce(DataFrame.unionByName, new))
    digests = current.where(F.col("slice").isin(touched))
    for table, path in ((rows, tables.path(EARNINGS)), (digests, known)):
        # Few files a slice; a slice with many rows is divided over tasks at run time.
        replace_slice(table.hint("rebalance", F.col("slice")), path, ["slice"], [(s,) for s in touched])
    return changed.select(*CONTRACT)
