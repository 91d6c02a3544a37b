"""Checks of published figures: all of a table of checks in one pass, a row with the verdict for each."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

SCHEMA = "check string, low double, high double, found double"


class Check(NamedTuple):
    """An aggregate over the rows that must lie between two bounds, both included; nothing found is a failure."""

    name: str
    low: float
    high: float
    found: Column

    @classmethod
    def near(cls, name: str, expected: float, tolerance: float, found: Column) -> Check:
        return cls(name, expected - tolerance, expected + tolerance, found)


def verdict(low: Column, found: Column, high: Column) -> Column:
    return F.when(F.coalesce(found.between(low, high), F.lit(False)), "ok").otherwise("FAIL")


def gate(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """A row for each check, from one aggregate over the rows; distinct counts are allowed."""
    found = rows.agg(*(c.found.cast("double").alias(f"c{n}") for n, c in enumerate(checks)))
    each = F.array(*(F.struct(F.lit(c.name).alias("check"), F.lit(float(c.low)).alias("low"), F.lit(float(c.high)).alias("high"), F.col(f"c{n}").alias("found")) for n, c in enumerate(checks)))
    return found.select(F.inline(each)).withColumn("verdict", verdict(F.col("low"), F.col("found"), F.col("high")))


def watched(rows: DataFrame, checks: list[Check]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The rows with the checks' aggregates observed while they are written, and what gives the verdicts after that.

    No pass of its own: the figures come with the job that writes the table. Checks may not count distinct values.
    Call the second only after an action over the first has ended; before, it would wait for one.
    """
    seen = Observation()
    kept = rows.observe(seen, *(c.found.cast("double").alias(f"c{n}") for n, c in enumerate(checks)))

    def verdicts() -> DataFrame:
        figures = seen.get
        lines = [(c.name, float(c.low), float(c.high), figures[f"c{n}"]) for n, c in enumerate(checks)]
        made = rows.sparkSession.createDataFrame(lines, SCHEMA)
        return made.withColumn("verdict", verdict(F.col("low"), F.col("found"), F.col("high")))

    return kept, verdicts
