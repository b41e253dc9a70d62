"""Outlook reports: one curve per earnings table, with mean and ranked curves of sampled models."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from wattledger.functions.plans import cut
from wattledger.operators.report import (
    P10_RANK,
    P90_RANK,
    clean_and_aggregate,
    combine_curves,
    monthly_report,
    outlook_report,
    sample_rank,
)
from wattledger.sources.sinks import write_report_csv


def outlook(
    hindcast: DataFrame, sampled: dict[str, DataFrame], scenarios: DataFrame, deal_info: DataFrame,
    curve_names: DataFrame, start: date, end: date, *, hindcast_curve: str, ranked_start: date | None = None,
    ranks: dict[str, int] | None = None, from_year: int | None = None, placeholders: Sequence[int] = (),
    csv: str | None = None, **options,
) -> DataFrame:
    """The combined report of a hindcast, any number of sampled models and named scenarios.

    `sampled` has the earnings of each model by curve name; it gets a mean curve and one curve
    per entry of `ranks` (suffix: rank; P90 and P10 when not given). The ranked curves start at
    `ranked_start`, or with the others when it is not given. `csv` writes the report there.
    """
    names = cut(deal_info.select("product_id", "instrument").distinct())
    ranks = {"p90": P90_RANK, "p10": P10_RANK} if ranks is None else ranks

    def curve(df: DataFrame, name: str, opening: date = start, **more) -> DataFrame:
        return clean_and_aggregate(df, names, name, opening, end, **{**options, **more})

    curves = [curve(hindcast, hindcast_curve), curve(scenarios, "", mode="scenario")]
    for name, earnings in sampled.items():
        ranked = {f"{name}_{suffix}": rank for suffix, rank in ranks.items()}
        curves.append(curve(earnings, name, mode="sample_mean"))
        curves.append(
            curve(
                earnings, name, ranked_start or start, mode="ranked", ranks=cut(sample_rank(earnings)),
                ranked_curves=ranked,
            )
        )
    report = outlook_report(combine_curves(curves), curve_names, from_year, placeholders)
    if csv is not None:
        write_report_csv(report, csv)
    return report


def monthly_outlook(
    scenarios: DataFrame, deal_info: DataFrame, start: date, end: date, *, curve: str = "Central",
    statuses: Sequence[str] | None = None, from_year: int | None = None, placeholders: Sequence[int] = (),
    csv: str | None = None, **options,
) -> DataFrame:
    """The monthly report of one of the named scenarios, with a status list of its own."""
    names = cut(deal_info.select("product_id", "instrument").distinct())
    chosen = {} if statuses is None else {"statuses": statuses}
    rows = clean_and_aggregate(
        scenarios, names, "", start, end, mode="scenario", by_month=True, **{**options, **chosen}
    )
    report = monthly_report(rows, curve, from_year, placeholders)
    if csv is not None:
        write_report_csv(report, csv)
    return report
