"""Released tables as CSV files: rows that do not fit the declared schema are set aside, none is lost."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termfold.operators.staging import new_path

LINE, PARSED, CORRUPT, FILE, PROBLEM, BAD = "_line", "_parsed", "_corrupt", "file", "problem", "_bad"

#: What can be wrong with a line, in the order in which it is looked for.
QUOTES = "quotes do not close"
FIELDS = "fields do not fit the columns"
HEADER = "header in another order"


@dataclass(frozen=True)
class Released:
    """A released table, read once and stored: its good rows, and one row for each line that is not one."""

    rows: DataFrame          # the declared columns
    quarantine: DataFrame    # file, record (the whole line), problem
    n_rows: int
    n_bad: int

    def require(self, share: float = 0.0) -> DataFrame:
        """The good rows; raises if more than this share of all lines was set aside."""
        if self.n_bad > share * (self.n_rows + self.n_bad):
            reasons = self.quarantine.groupBy(PROBLEM).count().orderBy(PROBLEM).collect()      # a row per kind of problem
            told = ", ".join(f"{r['count']} with {r[PROBLEM]}" for r in reasons)
            raise ValueError(f"{self.n_bad} of {self.n_rows + self.n_bad} lines are set aside: {told}")
        return self.rows


def read_released(
    spark: SparkSession, path: str, schema: T.StructType | str, required: list[str] = (), header: list[str] | None = None, sep: str = ",",
) -> Released:
    """Read CSV files by a declared schema, in one pass whatever the number of checks.

    Columns are found by name, wherever they stand; others are left out. ``header``: the names of all columns where
    files do not begin with them. A line is set aside whole, with its file and the first problem found: quotes that
    do not close, a number of fields other than that of the columns, a value of another type, a required column
    without value, a header that differs from that of the first file. Names that the header bears twice cannot be declared. A
    field may hold separators and doubled quotes but no line break: the lines of one that does are set aside. Blank
    lines are no rows; an empty field is NULL, quoted or not. No file, or an empty one, gives an empty table with ``header`` and
    an error without.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\ufeff|\r$", "").alias(LINE), F.col("_metadata.file_path").alias(FILE))
    lines = lines.where(F.trim(LINE) != "")
    names, heads = header, None
    if names is None:
        first = lines.select(LINE).first()
        if first is None:
            raise ValueError(f"no header in {path}")
        heads = first[LINE]
        names = next(csv.reader([heads], delimiter=sep))
    lacking = [f.name for f in declared if names.count(f.name) != 1]
    if lacking:
        raise ValueError(f"{path} does not have exactly one column {', '.join(lacking)}")
    if heads is not None:
        lines = lines.where(F.col(LINE) != heads)

    # columns by place, so that names of the file can clash with none of ours
    types = {f.name: f.dataType for f in declared}
    by_place = T.StructType([T.StructField(f"c{i}", types.get(n, T.StringType())) for i, n in enumerate(names)] + [T.StructField(CORRUPT, T.StringType())])
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "maxCharsPerColumn": "-1", "maxColumns": str(len(names) + 1)}
    parsed = lines.withColumn(PARSED, F.from_csv(LINE, by_place.simpleString(), options))
    value = {f.name: F.col(f"{PARSED}.c{names.index(f.name)}") for f in declared}
    problem = _first_problem(names, heads, required, value)
    columns = [value[f.name].alias(f"v{i}") for i, f in enumerate(declared)]
    tested = parsed.withColumn(PROBLEM, problem)
    bad = F.col(PROBLEM).isNotNull()
    kept = tested.select(*columns, F.when(bad, F.col(FILE)).alias(FILE), F.when(bad, F.col(LINE)).alias("record"), PROBLEM, bad.alias(BAD))

    seen, out = Observation(), new_path(spark)
    kept.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(BAD).alias("bad")).write.partitionBy(BAD).parquet(out)
    counts = seen.get
    stored = spark.read.schema(kept.schema).parquet(out)
    rows = stored.where(~F.col(BAD)).select(*[F.col(f"v{i}").alias(f.name) for i, f in enumerate(declared)])
    return Released(rows, stored.where(BAD).select(FILE, "record", PROBLEM), counts["lines"] - counts["bad"], counts["bad"])


def _first_problem(names: list[str], heads: str | None, required: list[str], value: dict[str, Column]) -> Column:
    quotes = F.length(LINE) - F.length(F.replace(F.col(LINE), F.lit('"')))
    tests = [(quotes % 2 == 1, F.lit(QUOTES)), (F.col(PARSED).isNull() | F.col(f"{PARSED}.{CORRUPT}").isNotNull(), F.lit(FIELDS))]
    if heads is not None:
        tests.append((F.col(f"{PARSED}.c0").cast("string").isin(names), F.lit(HEADER)))
    tests += [(value[c].isNull(), F.lit(f"no {c}")) for c in required]
    return reduce(lambda otherwise, t: F.when(t[0], t[1]).otherwise(otherwise), reversed(tests), F.lit(None).cast("string"))
