"""Stored rollups of several grains; a question reads the smallest that has its columns.

The grains between the daily rollup and the grand total form a lattice: one answers every question
whose columns it has. Storing all of them takes more room than the rollup, so the few that spare most
rows are chosen one after another, each by the rows it spares beyond those chosen before.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tallybook.functions.calendar import calendar_columns
from tallybook.operators.aggregates import ROLLUP_KEYS, totals
from tallybook.operators.cube import OF_MONTH, OF_YEAR
from tallybook.sources.staging import stage_table

CATEGORIES = ROLLUP_KEYS[1:]
# Each date column with the calendar columns it decides, fine to coarse.
DATES = {
    "transaction_date": ("transaction_date", "day", "day_of_week", "is_weekend", "week", "month_start", *OF_MONTH),
    "month_start": ("month_start", *OF_MONTH),
    "year": OF_YEAR,
}

Grain = frozenset[str]


class Stored(NamedTuple):
    rows: int
    table: DataFrame


def covers(grain: Grain, columns: Grain) -> bool:
    """Whether a rollup of ``grain`` has, or decides, all ``columns``."""
    decided = grain.union(*[DATES[d] for d in grain if d in DATES])
    return columns <= decided


def grains(categories: tuple[str, ...]) -> list[Grain]:
    """Every grain: a date column or none, and any of the categories."""
    return [frozenset((*date, *some)) for date in ((), *((d,) for d in DATES))
            for size in range(len(categories) + 1) for some in combinations(categories, size)]


def sizes(rollup: DataFrame, wanted: list[Grain]) -> dict[Grain, int]:
    """About how many rows each grain has: one pass, a sketch of constant size per grain."""
    counts = rollup.agg(*[
        (F.approx_count_distinct(F.struct(*sorted(g))) if g else F.lit(1)).alias(f"g{k}")
        for k, g in enumerate(wanted)]).first()
    return {g: max(counts[k], 1) for k, g in enumerate(wanted)}


def choose(rows: Mapping[Grain, int], finest: Grain, most: int,
           asked: Mapping[Grain, float] | None = None) -> list[Grain]:
    """Up to ``most`` grains besides ``finest``, each the one that then spares most rows.

    ``asked`` says how often each grain is asked for (default: all alike). Equal gains go to the smaller
    grain. Choosing stops when nothing is spared any more.
    """
    asked = asked or dict.fromkeys(rows, 1.0)
    cost = dict.fromkeys(asked, rows[finest])
    chosen: list[Grain] = []
    while len(chosen) < most:
        gains = {g: sum(often * max(0, cost[q] - rows[g]) for q, often in asked.items() if covers(g, q))
                 for g in rows if g != finest and g not in chosen}
        best = min(gains, key=lambda g: (-gains[g], rows[g], sorted(g)), default=None)
        if best is None or gains[best] <= 0:
            break
        chosen.append(best)
        cost = {q: min(n, rows[best]) if covers(best, q) else n for q, n in cost.items()}
    return chosen


class Lattice:
    """The daily rollup and up to ``most`` coarser ones, stored in the shared folder.

    ``rollup`` has calendar columns. Each chosen rollup is added up from the smallest stored one that
    covers it, coarse ones last.
    """

    def __init__(self, rollup: DataFrame, most: int = 6, asked: Mapping[Grain, float] | None = None):
        categories = tuple(c for c in CATEGORIES if c in rollup.columns)
        finest = frozenset(("transaction_date", *categories))
        rows = sizes(rollup, grains(categories))
        base = rollup.drop(*(c for c in calendar_columns(F.col("transaction_date")) if c in rollup.columns))
        self.stored = {finest: Stored(rows[finest], base)}
        for grain in sorted(choose(rows, finest, most, asked), key=lambda g: (-rows[g], sorted(g))):
            keys = sorted(grain)
            self.stored[grain] = Stored(rows[grain], stage_table(
                totals(self.rows(*keys), *keys), "rollup-" + ("-".join(keys) or "total")))

    def smallest(self, *columns: str) -> Grain:
        wanted = frozenset(columns)
        fitting = [g for g in self.stored if covers(g, wanted)]
        if not fitting:
            raise ValueError(f"no rollup has {', '.join(sorted(wanted))}")
        return min(fitting, key=lambda g: (self.stored[g].rows, sorted(g)))

    def rows(self, *columns: str) -> DataFrame:
        """The smallest rollup with ``columns``, for any operator that takes sales or a rollup.

        Name all columns the operator groups or filters by.
        """
        grain = self.smallest(*columns)
        table = self.stored[grain].table
        date = next((d for d in DATES if d in grain and d != "year"), None)
        if date:
            calendar = calendar_columns(F.col(date))
            table = table.withColumns({c: calendar[c] for c in DATES[date] if c not in grain})
        return table
