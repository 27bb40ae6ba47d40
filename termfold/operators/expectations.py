"""Declared checks of a table, counted in the pass that reads or writes it anyway."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from termfold.functions.text import norm, norm_text


@dataclass(frozen=True)
class Expectation:
    """What must hold in every row, or in all but ``at_most``; a test that gives NULL does not hold."""

    name: str
    holds: Column
    at_most: int = 0


class Unmet(ValueError):
    """Expectations that do not hold: ``failures`` has the number of rows by name."""

    def __init__(self, failures: dict[str, int], rows: int):
        self.failures, self.rows = failures, rows
        super().__init__(f"of {rows} rows " + ", ".join(f"{n} without {name}" for name, n in failures.items()))


def filled(column: str) -> Expectation:
    """The column has a value other than blanks."""
    return Expectation(f"value of {column}", F.trim(column) != "")


def listed(column: str, values: list[str]) -> Expectation:
    """The column has one of the values, whatever its case and trailing blanks."""
    return Expectation(f"known {column}", norm(column).isin([norm_text(v) for v in values]))


def within(expectation: Expectation, only: Column) -> Expectation:
    """The same, asked of some rows only."""
    return Expectation(expectation.name, ~F.coalesce(only, F.lit(False)) | F.coalesce(expectation.holds, F.lit(False)), expectation.at_most)


class Watch:
    """Counts of an observed table, known once an action on it has ended."""

    def __init__(self, expectations: Iterable[Expectation]):
        self.expectations, self.seen = list(expectations), Observation()
        names = [e.name for e in self.expectations]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"expectations of one name: {', '.join(twice)}")

    def _counts(self) -> list[Column]:
        failing = [F.count_if(~F.coalesce(e.holds, F.lit(False))).alias(f"c{i}") for i, e in enumerate(self.expectations)]
        return [F.count(F.lit(1)).alias("rows"), *failing]

    def on(self, df: DataFrame) -> DataFrame:
        """The same rows; the checks are counted as they pass. Put it where rows are no longer filtered."""
        return df.observe(self.seen, *self._counts()) if self.expectations else df

    def verify(self) -> None:
        """Raise if the rows that have passed do not meet the expectations."""
        if self.expectations:
            self._raise(self.seen.get)

    def _raise(self, got: dict) -> None:
        failing = {e.name: got[f"c{i}"] for i, e in enumerate(self.expectations) if got[f"c{i}"] > e.at_most}
        if failing:
            raise Unmet(failing, got["rows"])


def failures(df: DataFrame, expectations: Iterable[Expectation]) -> DataFrame:
    """A row per expectation: its name, the rows that do not meet it, and all rows; one pass over the columns asked for."""
    watch = Watch(expectations)
    each = [F.struct(F.lit(e.name).alias("expectation"), F.col(f"c{i}").alias("n_failing"), F.col("rows").alias("n_rows")) for i, e in enumerate(watch.expectations)]
    return df.agg(*watch._counts()).select(F.inline(F.array(*each)))


def verify(df: DataFrame, expectations: Iterable[Expectation]) -> None:
    """Check a table by itself, before a run."""
    watch = Watch(expectations)
    if watch.expectations:
        watch._raise(df.agg(*watch._counts()).first().asDict())


def repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often; none where they are unique.

    Keys meet in a shuffle of these columns alone, counted before it, so a key on a third of all rows costs a row for each task.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unmatched(df: DataFrame, column: str, lookup: DataFrame, key: str) -> DataFrame:
    """Distinct values of a column, in the comparison form, that a lookup's key lacks; blank ones aside."""
    asked = df.select(norm(column).alias("value")).where("value <> ''").distinct()
    known = lookup.select(norm(key).alias("value")).where("value <> ''").distinct()
    return asked.join(known, "value", "left_anti")
