"""Contract check: the declared nulls and keys of a table, counted."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.plans import sized_all
from wattledger.sources.schemas import TableContract


def check_contract(
    df: DataFrame, contract: TableContract, parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row per rule: `rule` (not_null, unique, reference), `columns`, `violations`.

    `unique` counts keys with more than one row. `reference` counts rows whose (complete) key has
    no parent, for each parent table that is given. The table is read once for all rules: its
    rows are marked with the parents they find, counted up per key, and the keys added up.
    """
    given = {c: parent for c, parent in contract.parents.items() if parents and parent in parents}
    rows, orphans = df, {}
    known = sized_all(
        *[
            parents[parent].select(*[F.col(c).alias(f"_p{i}_{c}") for c in cols]).distinct()
            for i, (cols, parent) in enumerate(given.items())
        ]
    )
    for i, (cols, parent) in enumerate(given.items()):
        same = reduce(and_, [F.col(c) == F.col(f"_p{i}_{c}") for c in cols])
        rows = rows.join(known[i], same, "left")
        whole = reduce(and_, [F.col(c).isNotNull() for c in cols])
        orphans[f"{','.join(cols)}->{parent}"] = whole & F.col(f"_p{i}_{cols[0]}").isNull()
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(contract.required)]
    lost = [F.count_if(o).alias(f"_o{i}") for i, o in enumerate(orphans.values())]
    per_key = rows.groupBy(*contract.key).agg(F.count(F.lit(1)).alias("_rows"), *nulls, *lost)

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    rules = [("not_null", c, total(f"_n{i}")) for i, c in enumerate(contract.required)]
    rules.append(("unique", ",".join(contract.key), F.count_if(F.col("_rows") > 1)))
    rules += [("reference", name, total(f"_o{i}")) for i, name in enumerate(orphans)]
    listed = per_key.agg(
        F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), F.lit(columns).alias("columns"), n.cast("long").alias("violations"))
                for rule, columns, n in rules
            ]
        ).alias("_rules")
    )
    return listed.select(F.inline("_rules"))
