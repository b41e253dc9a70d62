"""Column expressions for prices and payoffs. A null price always stays null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the market: cap contract strike and market price ceiling, $/MWh.
CAP_STRIKE = 300.0
MARKET_PRICE_CAP = 20300.0


def at_least(price: Column, floor: Column) -> Column:
    """`price` raised to `floor`; a null floor is no floor."""
    return F.when(price.isNotNull(), F.greatest(price, floor))


def at_most(price: Column, ceiling: Column) -> Column:
    """`price` lowered to `ceiling`; a null ceiling is no ceiling."""
    return F.when(price.isNotNull(), F.least(price, ceiling))


def excess_over(price: Column, strike: Column) -> Column:
    """max(price - strike, 0); null when either side is null."""
    return at_least(price - strike, F.lit(0.0))
