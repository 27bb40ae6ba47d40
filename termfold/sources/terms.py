"""Term tables and lookup tables: reading, checking, writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termfold.functions.text import norm, norm_text

TERM_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "LOINC_NUM", "COMPONENT", "PROPERTY", "TIME_ASPCT", "SYSTEM", "SCALE_TYP", "METHOD_TYP",
        "CLASS", "STATUS",
    )]
    + [T.StructField(c, T.IntegerType()) for c in (
        "CLASSTYPE", "COMMON_TEST_RANK", "COMMON_SI_TEST_RANK", "COMMON_ORDER_RANK",
    )]
    + [T.StructField(c, T.StringType()) for c in ("EXAMPLE_UCUM_UNITS", "LONG_COMMON_NAME")]
)

DETAIL_SCHEMA = "LOINC_NUM string, COMPONENTCORE string"
PART_SCHEMA = "PART string, PART_NUM string, TYPE int"
WEIGHTS_SCHEMA = "PartNum string, Molecular_weight_COMBINED double"

# Written at ingest: equals norm(CLASS), so a class is found by partition pruning.
CLASS_KEY = "class_key"


def class_of(terms: DataFrame) -> Column:
    """Comparison key of the class, from storage where it is there."""
    return F.col(CLASS_KEY) if CLASS_KEY in terms.columns else norm("CLASS")


def class_subset(terms: DataFrame, class_values: list[str]) -> DataFrame:
    """All columns but ID of the terms of the given classes, whatever their status."""
    wanted = [norm_text(v) for v in class_values]
    return terms.where(class_of(terms).isin(wanted)).drop("ID", CLASS_KEY)


def write_terms(terms: DataFrame, path: str) -> None:
    """Store a term table partitioned by class, large classes in several files."""
    keyed = terms.withColumn(CLASS_KEY, norm("CLASS"))
    (
        keyed.repartitionByRange(CLASS_KEY, "LOINC_NUM")
        .write.mode("overwrite").partitionBy(CLASS_KEY).parquet(path)
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Term or lookup table from files or, with ``fmt='jdbc'``, from a database.

    A database is read over several connections: the options must say how the table is cut.
    """
    if fmt == "jdbc":
        lacking = [o for o in ("partitionColumn", "lowerBound", "upperBound", "numPartitions") if o not in options]
        if lacking:
            raise ValueError(f"reading from a database needs the options {', '.join(lacking)}")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if fmt != "jdbc" else reader.load()


def require_table(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """A catalog table that a run cannot do without; raises when it is not there."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"the table {name} is missing; load it first")
    return require_columns(spark.table(name), name, columns)


def require_columns(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the table {name} lacks {', '.join(missing)}")
    return df
