"""Single-column operators, for use with ``DataFrame.transform``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfold.functions.text import head, regroup, revised_name
from termfold.operators import rules as R
from termfold.operators.coarsen import apply_rules, condition, duplicate


def dup_column(df: DataFrame, source: str, dest: str) -> DataFrame:
    """Copy a column; NULL becomes '' in both."""
    return duplicate(df, {dest: source})


def hatless(df: DataFrame, column: str) -> DataFrame:
    """Copy of a column with the text before the first ``^`` only."""
    return dup_column(df, column, column + "_HATLESS").withColumn(column + "_HATLESS", head(column))


def _one(df: DataFrame, column: str, kind: str, values: list[str], group: str, where: Column | None) -> DataFrame:
    rule = R.Rule("", column, 0, kind, group, tuple(values))
    holds = condition(rule, column, [rule])
    if where is not None:
        holds = holds & where
    return df.withColumn(column, F.when(holds, regroup(group, column)).otherwise(F.col(column)))


def apply_group(df: DataFrame, column: str, values: list[str], group: str, where: Column | None = None) -> DataFrame:
    """Put the group name in place of every head that is one of the values."""
    return _one(df, column, R.EQ, values, group, where) if values else df


def skip_values(df: DataFrame, column: str, values: list[str], group: str, where: Column | None = None) -> DataFrame:
    """Put the group name in place of every head that is none of the values."""
    return _one(df, column, R.EXCEPT_VALUES, values, group, where)


def skip_patterns(df: DataFrame, column: str, patterns: list[str], group: str, where: Column | None = None) -> DataFrame:
    """Put the group name in place of every head that is like none of the patterns."""
    return _one(df, column, R.EXCEPT_PATTERNS, patterns, group, where)


def apply_groups(df: DataFrame, column: str, spec: dict, where: Column | None = None) -> DataFrame:
    """Apply an ordered set of groups (see ``rules.groups``) in one pass."""
    gate = None if where is None else "where"
    step = R.groups(column, spec, gate, target=column)
    return apply_rules(df, R.rules_of("", [step]), {} if where is None else {"where": where})


def dup_and_group(df: DataFrame, source: str, spec: dict) -> DataFrame:
    """Coarsened copy of a column, named after it."""
    dest = revised_name(source)
    return apply_groups(dup_column(df, source, dest), dest, spec)
