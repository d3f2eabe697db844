"""Checks of a relation while a job runs over it: observed metrics, no scan of their own.

A guard counts the rows that break a rule and keeps the first and the last of them by a
describing text. What it found is known once a job over the watched relation has ended;
tasks that ran twice may count their rows twice, so counts say at least that a rule is broken.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Guard:
    name: str
    broken: Column
    described: Column


@dataclass(frozen=True)
class Finding:
    name: str
    rows: int
    first: str | None
    last: str | None

    def __str__(self) -> str:
        return f"{self.name}: {self.rows} rows, such as {', '.join(dict.fromkeys(x for x in (self.first, self.last) if x is not None))}"


class Watch:
    """A relation with guards, and what they found."""

    def __init__(self, df: DataFrame, guards: list[Guard]) -> None:
        self.guards, self.seen = guards, Observation()
        broken = [F.coalesce(g.broken, F.lit(False)) for g in guards]
        metrics = [x for k, (g, b) in enumerate(zip(guards, broken, strict=True)) for x in (F.count_if(b).alias(f"rows_{k}"), F.min(F.when(b, g.described)).alias(f"first_{k}"), F.max(F.when(b, g.described)).alias(f"last_{k}"))]
        self.df = df.observe(self.seen, *metrics)

    def findings(self) -> list[Finding]:
        """Of a job that has ended."""
        found = self.seen.get
        return [Finding(g.name, found[f"rows_{k}"], found[f"first_{k}"], found[f"last_{k}"]) for k, g in enumerate(self.guards)]

    def refuse(self) -> None:
        if bad := [f for f in self.findings() if f.rows]:
            raise ValueError("; ".join(map(str, bad)))


def run_watched(df: DataFrame, guards: list[Guard], job: Callable[[DataFrame], None]) -> list[Finding]:
    """Run a job over df and refuse its result if a rule is broken."""
    watch = Watch(df, guards)
    job(watch.df)
    watch.refuse()
    return watch.findings()


def site_text() -> Column:
    return F.concat_ws(":", "contig", F.col("position").cast("string"))


def partly_missing(columns: list[str], test: str) -> Guard:
    """Rows of which some p-values of a test are there and some are not."""
    nulls = sum((F.col(f"`{c}`").isNull().cast("int") for c in columns), F.lit(0))
    return Guard(f"partly missing {test}", (nulls > 0) & (nulls < len(columns)), site_text())


def untested(columns: list[str], test: str) -> Guard:
    """Rows without any p-value of a test."""
    nulls = sum((F.col(f"`{c}`").isNull().cast("int") for c in columns), F.lit(0))
    return Guard(f"untested {test}", nulls == len(columns), site_text())


def several(of: str, columns: list[str]) -> tuple[Callable[[DataFrame], DataFrame], Guard]:
    """One row for each value of ``of``, and a guard for those with several values in one of the columns."""
    gather = lambda df: df.groupBy(of).agg(*[F.countDistinct(c).alias(c) for c in columns])
    broken = F.lit(False)
    for c in columns:
        broken = broken | (F.col(c) > 1)
    return gather, Guard(f"{of} with several {' or '.join(columns)}", broken, F.col(of))
