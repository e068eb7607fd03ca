"""Clean records to engineered sales, and the daily rollup reports read."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallybook.config import COGS_RATE
from tallybook.operators import aggregates, features, validation
from tallybook.plans.observed import Figures
from tallybook.sources import files
from tallybook.sources.staging import stage_table


def run_features(clean: DataFrame, output_path: str, file_format: str = "parquet",
                 rates: Mapping[str, str] | DataFrame | None = None,
                 default_rate: str = COGS_RATE, versions: bool = False) -> DataFrame:
    """Engineer, check and write; Parquet is laid out by month.

    The checks' figures come from the pass that writes. A failed check raises
    and leaves the output as it was; an overall margin
    other than the rate implies only warns. The cost identity and the margin
    are checked for the flat rate alone; per-item rates have no single one.
    """
    figures = Figures(clean.sparkSession)
    partitions = ("year_month",) if file_format == "parquet" else ()
    rows = features.engineer(features.gathered_by_month(clean) if partitions else clean, rates, default_rate)
    rows = figures.watch(rows, "features", validation.feature_figures(rows, default_rate))
    rows = figures.watch(rows, "margin", validation.margin_figures())

    def check() -> None:
        report = validation.as_rows(figures.row("features"))
        if rates is not None:
            report = report.filter("check_name <> 'cost_identity'")
        validation.require(report)
        margin = None if rates is not None else validation.margin_row(figures.row("margin"), default_rate).first()
        if margin and margin.deviates:
            warnings.warn(f"margin {margin.actual_margin_pct:.2f}, expected {margin.expected_margin_pct:.2f}",
                          stacklevel=2)

    return files.publish_table(rows, output_path, check, file_format, partitions, versions, rebalance=False)


def sales_rollup(engineered: DataFrame) -> DataFrame:
    """The daily rollup with calendar columns, stored in the shared folder."""
    stored = stage_table(aggregates.daily_rollup(engineered), "daily-rollup")
    return features.add_calendar(stored)
