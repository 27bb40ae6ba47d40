"""Class key, class sizes and the rows of the review report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termfold.functions.text import norm, one_of
from termfold.operators.joins import join_counts
from termfold.operators.ranges import bounds, order_text, parts_for, place, salted
from termfold.operators.staging import staged, staged_and_measured
from termfold.plans import fixed_values as V

KEY = "EQUIV_CLS"
CLASS = "_class"            # comparison key of EQUIV_CLS
COUNT = "CLS_COUNT"
COUNT_FIELD = "LONG_COMMON_NAME"
HEADING, MEMBER, BLANK = 0, 1, 2
REVISED_PAIRS = {
    "PROPERTY_REV": "PROPERTY", "TIME_REV": "TIME_ASPCT", "SYSTEM_REV": "SYSTEM",
    "SCALE_REV": "SCALE_TYP", "METHOD_REV": "METHOD_TYP",
}


def add_warnings(df: DataFrame, warnings: list[tuple[str, dict]], where: Column | None = None) -> DataFrame:
    """WARNING: message of the last rule whose columns all hold a listed value."""
    text = F.lit(None).cast("string")
    for message, conditions in warnings:
        holds = F.lit(True) if where is None else where
        for column, values in conditions.items():
            holds = holds & one_of(column, values)
        text = F.when(holds, message).otherwise(text)
    return df.withColumn("WARNING", text)


def set_units(df: DataFrame, properties: list[str], units: str, where: Column | None = None) -> DataFrame:
    """EXAMPLE_UCUM_UNITS replaced where the original PROPERTY is one of the values."""
    holds = one_of("PROPERTY", properties)
    if where is not None:
        holds = holds & where
    return df.withColumn("EXAMPLE_UCUM_UNITS", F.when(holds, units).otherwise(F.col("EXAMPLE_UCUM_UNITS")))


def class_sizes(df: DataFrame, by: list[str]) -> DataFrame:
    """One row per class: size and one spelling of the key (the smallest)."""
    return df.groupBy(*by, norm(KEY).alias(CLASS)).agg(
        F.min(KEY).alias(KEY), F.count(F.lit(1)).alias(COUNT)
    )


def add_class_counts(df: DataFrame, by: list[str], sizes: DataFrame | None = None) -> DataFrame:
    """CLS_COUNT, the size of each term's class, beside every term.

    The sizes are aggregated before the shuffle and joined back; a window would
    put a whole class, however large, into one task.
    """
    sizes = staged(class_sizes(df, by)) if sizes is None else sizes
    return join_counts(df.withColumn(CLASS, norm(KEY)), sizes.select(*by, CLASS, COUNT), [*by, CLASS], COUNT)


def sections(count: Column) -> Column:
    """Report sections that a class of this size is listed in."""
    return F.when(count > 1, F.array(F.lit(V.SECTION_MULTI), F.lit(V.SECTION_ALL))).otherwise(
        F.array(F.lit(V.SECTION_ALL))
    )


def heading_rows(sizes: DataFrame) -> DataFrame:
    """Heading row of each class: the key, and the size as text."""
    return sizes.select(
        *[c for c in sizes.columns if c != KEY],
        F.lit(HEADING).alias("row_kind"),
        F.col(KEY).alias("Heading"),
        F.col(COUNT).cast("string").alias(COUNT_FIELD),
        F.col(KEY).alias("SORT_ORDER"),
    )


def blank_rows(sizes: DataFrame) -> DataFrame:
    """Spacer row that follows each class."""
    return sizes.select(
        *[c for c in sizes.columns if c != KEY],
        F.lit(BLANK).alias("row_kind"),
        F.lit("").alias("Heading"),
        F.lit("").alias(COUNT_FIELD),
        F.concat(F.col(KEY), F.lit(V.BLANK_ROW_SUFFIX)).alias("SORT_ORDER"),
    )


def member_rows(counted: DataFrame) -> DataFrame:
    return counted.withColumns({"row_kind": F.lit(MEMBER), "Heading": F.lit(""), "SORT_ORDER": F.col(KEY)})


def report_columns(df: DataFrame) -> list[str]:
    """Report columns in their order; revised pairs only where present."""
    out = [KEY, "LOINC_NUM", "COMPONENT"]
    out += [c for c in ("COMPONENT_REV",) if c in df.columns]
    out.append("EXAMPLE_UCUM_UNITS")
    for revised, source in REVISED_PAIRS.items():
        if revised in df.columns:
            out += [source, revised]
    out.append(COUNT_FIELD)
    out += [c for c in ("MOLECULAR_WEIGHT", "WARNING") if c in df.columns]
    return out


CARRIER = -1                # stands in for the heading where a class goes on in another partition


def report(df: DataFrame, by: list[str] | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Review report: heading, member and blank rows, in both sections.

    ``keys``: the key columns and LOINC_NUM of the same rows, if they can be had at less cost than from ``df``. They are
    written once, for the class sizes and for a sample of the report's order. All rows are then dealt once, by
    class, kind of row and LOINC_NUM, so a large class is split like any others, and sorted. The count comes from the
    class's first row in each partition: its heading, or a carrier of the count where the class began before. Rows are
    listed in their sections last, so each section, read by itself, is in order.
    """
    by = by or []
    columns = report_columns(df)
    keys = staged((df if keys is None else keys).select(*by, KEY, "LOINC_NUM"))
    sizes, size = staged_and_measured(class_sizes(keys, by), COUNT)
    rows = size.total + 2 * size.rows
    parts = parts_for(df.sparkSession, rows)

    def order(kind: int, last: Column) -> Column:
        return order_text(*[F.col(c) for c in by], F.col(CLASS), F.lit(kind), last)

    none = F.lit("")
    weighed = keys.withColumn(CLASS, norm(KEY)).select(order(MEMBER, F.col("LOINC_NUM")).alias("_order"), F.lit(1).alias("_weight")).unionByName(
        sizes.select(order(HEADING, none).alias("_order"), F.lit(2).alias("_weight")))
    cuts = bounds(weighed, rows, parts)

    def dealt(rows: DataFrame, text: Column) -> DataFrame:
        return rows.withColumn("_part", place(text, cuts))

    members = member_rows(df.select(*by, *columns).withColumn(CLASS, norm(KEY)))
    members = dealt(members, salted(order(MEMBER, F.col("LOINC_NUM")), members.columns))
    heads, blanks = dealt(heading_rows(sizes), order(HEADING, none)), dealt(blank_rows(sizes), order(BLANK, none))
    goes_on = F.sequence(place(order(HEADING, none), cuts) + 1, F.col("_to"))
    carriers = (
        sizes.withColumn("_to", place(order(BLANK, none), cuts)).where(F.col("_to") > place(order(HEADING, none), cuts))
        .select(*by, CLASS, COUNT, F.lit(CARRIER).alias("row_kind"), F.explode(goes_on).alias("_part"))
    )
    for extra in (heads, blanks, carriers):
        members = members.unionByName(extra, allowMissingColumns=True)
    in_order = Window.partitionBy("_part", *by, CLASS).orderBy("row_kind", F.col("LOINC_NUM").asc_nulls_first())
    counted = members.repartitionById(parts, F.col("_part")).withColumn(
        COUNT, F.first(COUNT).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    listed = F.explode(sections(F.col(COUNT))).alias("section")
    return counted.where(F.col("row_kind") >= 0).select(*by, listed, "row_kind", "Heading", *columns, "SORT_ORDER")
