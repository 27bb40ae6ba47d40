"""The older MICRO formulation: groups come from mapping tables, not rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold.functions.text import blank, class_key, like_any
from termfold.operators.classes import (
    CLASS, COUNT, KEY, add_class_counts, blank_rows, class_sizes, heading_rows, member_rows,
)
from termfold.operators.coarsen import duplicate
from termfold.operators.joins import mapping_table_group, override_by_core
from termfold.operators.staging import staged
from termfold.plans import fixed_values as V
from termfold.sources.terms import class_subset

KEY_COLUMNS = ["COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "METHOD_REV"]
COLUMNS = [
    KEY, "LOINC_NUM", "COMPONENT", "PROPERTY", "PROPERTY_REV", "SYSTEM", "SYSTEM_REV",
    "METHOD_TYP", "METHOD_REV", "LONG_COMMON_NAME",
]
COUNT_FIELD = "SYSTEM_REV"


@dataclass(frozen=True)
class Mappings:
    system: DataFrame       # Name, System_Rev_1, System_Rev_2
    property: DataFrame     # Name, Property_Rev
    method: DataFrame       # Name, Method_Rev
    groupers: DataFrame     # Name, STDGrouper
    detail: DataFrame       # LOINC_NUM, COMPONENTCORE


def legacy_coarsen(terms: DataFrame, m: Mappings) -> DataFrame:
    """MICRO terms with revised columns and EQUIV_CLS."""
    df = class_subset(terms, ["MICRO"])
    df = duplicate(df, {"SYSTEM_REV": "SYSTEM", "PROPERTY_REV": "PROPERTY", "METHOD_REV": "METHOD_TYP"})
    df = mapping_table_group(df, "SYSTEM_REV", m.system, "System_Rev_1")
    df = override_by_core(df, "SYSTEM", "SYSTEM_REV", m.system, "System_Rev_2", m.detail, m.groupers)
    df = mapping_table_group(df, "PROPERTY_REV", m.property, "Property_Rev")
    df = mapping_table_group(df, "METHOD_REV", m.method, "Method_Rev")
    alone = blank("METHOD_REV") & like_any("COMPONENT", V.ANTIBODY_PATTERNS)
    df = df.withColumn("METHOD_REV", F.when(alone, V.LEGACY_ANTIBODY_GROUP).otherwise(F.col("METHOD_REV")))
    return df.withColumn(KEY, class_key(KEY_COLUMNS))


def legacy_report(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Report of classes with several members; the count stands in SYSTEM_REV.

    Rows without COMPONENT, be they headings, spacers or terms, are blanked but for
    heading, count and sort order.
    """
    sizes = staged(class_sizes(df, []))
    df = df.select(*COLUMNS)
    several = sizes.where(F.col(COUNT) > 1)
    members = member_rows(add_class_counts(df, [], sizes).where(F.col(COUNT) > 1))
    rows = members
    for extra in (heading_rows(several), blank_rows(several)):
        rows = rows.unionByName(extra.withColumnRenamed("LONG_COMMON_NAME", COUNT_FIELD), allowMissingColumns=True)
    bare = F.col("COMPONENT").isNull()
    if ordered:
        rows = rows.orderBy(CLASS, "row_kind", "LOINC_NUM")
    return rows.select(
        "row_kind", "Heading",
        *[F.col(c) if c == COUNT_FIELD else F.when(bare, "").otherwise(F.col(c)).alias(c) for c in COLUMNS],
        "SORT_ORDER",
    )
