"""Storage profiles: dispatch at the reference node, one table slice per product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from wattledger.operators.profiles import storage_profiles
from wattledger.sources.sinks import replace_slice


def update_storage_profiles(
    path: str, dispatch: DataFrame, contracts: DataFrame, unit_detail: DataFrame, model_id: int,
    products: Sequence[int] = (),
) -> None:
    """Replaces the profiles of the products in `dispatch` at `path`, and clears those of `products`
    that have none. `dispatch` (product, sample, interval, metered_energy_mwh) comes from a solver
    that runs on `storage_price_traces`."""
    slices = [(product,) for product in products]
    replace_slice(storage_profiles(dispatch, contracts, unit_detail, model_id), path, ["product_id"], slices)
