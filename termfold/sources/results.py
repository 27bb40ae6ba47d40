"""Report output: files by class and section, in committed versions."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termfold.functions.text import norm, working_name
from termfold.operators.classes import BLANK, MEMBER, REVISED_PAIRS
from termfold.operators.coarsen import PROFILE, local_table
from termfold.operators.expectations import Expectation, Unmet, Watch, within
from termfold.operators.shipping import ship_package
from termfold.operators.staging import file_system
from termfold.plans import fixed_values as V
from termfold.plans import pipeline
from termfold.plans.profiles import PROFILES, Profile
from termfold.sources import manifest, sheets
from termfold.sources.terms import class_of

SECTIONS = (V.SECTION_MULTI, V.SECTION_ALL)


# --- writing -------------------------------------------------------------------

def write_report(report: DataFrame, path: str, fmt: str = "parquet", classes: list[str] | None = None) -> None:
    """Write a report with one set of columns; the files of a class and section are in report order.

    Only the output of this report's classes is replaced, with all of its sections; that of others stays.
    ``classes``: names of the classes that were run, so that one without any row is emptied too. The new output
    becomes the current one when it is complete (see ``manifest``).

    The report is range partitioned in report order already: what is left is to put the sections of each
    partition one after the other.
    """
    spark, path, run = report.sparkSession, path.rstrip("/"), _new_run()
    _writer(_by_sheet(report), fmt).partitionBy(PROFILE, "section").format(fmt).save(f"{path}/{run}")
    files = _listed(spark, f"{path}/{run}")
    names = dict.fromkeys([*(f[0] for f in files), *(classes or [])])
    schema = report.drop(PROFILE, "section").schema
    _publish(spark, path, run, fmt, files, {name: schema for name in names}, {})


def write_reports(
    terms: DataFrame, path: str, profiles: list[Profile] = PROFILES,
    lookups: pipeline.Lookups = pipeline.Lookups(), fmt: str = "parquet", only_changed: bool = False,
    expectations: Sequence[Expectation] = (),
) -> list[str]:
    """Run all classes in one job and write each with its own columns and no others; gives the names of those run.

    Terms are read once, and lookups built once, for all classes together. ``only_changed``: leave out classes whose
    terms, rules and lookups are those that their current output was made from. The digests that tell cost a pass
    over the terms without joins. ``expectations``: checks of the report's member rows in the section of all groups,
    counted as they are written; if one does not hold, the run ends with ``Unmet`` and all current output stays.
    """
    pipeline.check_run(terms, profiles, lookups)
    spark, path, run = terms.sparkSession, path.rstrip("/"), _new_run()
    digests = class_digests(terms, profiles, lookups) if only_changed else {}
    if only_changed:
        now = manifest.version(spark, path).classes
        profiles = [p for p in profiles if p.name not in now or now[p.name].digest != digests[p.name]]
    if not profiles:
        return []
    report = pipeline.run(terms, profiles, lookups)
    columns = {p.name: columns_of(p) for p in profiles}
    ship_package(spark)
    spark.dataSource.register(sheets.Sheets)
    sheets.file_system_of(f"{path}/{run}")             # fails before the run where Python workers cannot write
    members = (F.col("section") == V.SECTION_ALL) & (F.col("row_kind") == MEMBER)
    watch = Watch(within(e, members) for e in expectations)
    (
        watch.on(_by_sheet(report)).write.format(sheets.NAME).mode("append")
        .options(path=f"{path}/{run}", fmt=fmt, columns=json.dumps(columns)).save()
    )
    try:
        watch.verify()
    except Unmet:
        fs, at = file_system(spark, f"{path}/{run}")
        fs.delete(at, True)                            # written by this run and named by no manifest
        raise
    files = json.loads(manifest.read_text(spark, f"{path}/{run}/{sheets.WRITTEN}"))
    schemas = {name: report.select(*own).schema for name, own in columns.items()}
    _publish(spark, path, run, fmt, files, schemas, digests)
    return [p.name for p in profiles]


def columns_of(profile: Profile) -> list[str]:
    """Columns of a class's report."""
    revised = profile.copies()
    out = ["row_kind", "Heading", "EQUIV_CLS", "LOINC_NUM", "COMPONENT", *[c for c in ("COMPONENT_REV",) if c in revised], "EXAMPLE_UCUM_UNITS"]
    for r, source in REVISED_PAIRS.items():
        out += [source, r] if r in revised else []
    out += ["LONG_COMMON_NAME", *(["MOLECULAR_WEIGHT"] if profile.weights else []), *(["WARNING"] if profile.warnings else [])]
    return [*out, "SORT_ORDER"]


def _new_run() -> str:
    return f"run-{uuid.uuid4().hex}"


def _by_sheet(report: DataFrame) -> DataFrame:
    return report.sortWithinPartitions(PROFILE, "section", sort_class("SORT_ORDER"), "row_kind", "LOINC_NUM")


def _writer(rows: DataFrame, fmt: str):
    if fmt != "csv":
        return rows.write
    return rows.write.options(header=True, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def _listed(spark: SparkSession, folder: str) -> list[list]:
    """[class, section, file below the folder, rows (unknown)] of what Spark wrote by class and section."""
    fs, at = file_system(spark, folder)
    out = []
    for c in sorted((s.getPath() for s in fs.listStatus(at) if s.isDirectory()), key=lambda p: p.getName()):
        for s in sorted((s.getPath() for s in fs.listStatus(c)), key=lambda p: p.getName()):
            names = sorted(f.getPath().getName() for f in fs.listStatus(s))
            values = [spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(p.getName().split("=", 1)[1]) for p in (c, s)]
            out += [[*values, f"{c.getName()}/{s.getName()}/{n}", None] for n in names if n.startswith("part-")]
    return out


def _publish(spark: SparkSession, path: str, run: str, fmt: str, files: list[list], schemas: dict, digests: dict) -> None:
    """Make the written files the current output of their classes, then remove what was replaced."""
    outputs = {}
    for name, schema in schemas.items():
        by_section = {s: [[f"{run}/{f[2]}", f[3]] for f in files if (f[0], f[1]) == (name, s)] for s in SECTIONS}
        outputs[name] = manifest.Output(run, fmt, schema.json(), by_section, digests.get(name))
    manifest.commit(spark, path, outputs)
    manifest.clean(spark, path)


def sort_class(order: str) -> Column:
    """Class of a report row, from its sort order."""
    end = -len(V.BLANK_ROW_SUFFIX)
    bare = F.when(F.col("row_kind") == BLANK, F.expr(f"left({order}, length({order}) {end})")).otherwise(F.col(order))
    return norm(bare)


# --- reading -------------------------------------------------------------------

def read_report(spark: SparkSession, path: str, classes: list[str] | None = None, number: int | None = None) -> DataFrame:
    """Current output of all or some classes (names or values): profile, section and each class's columns, NULL where
    a class lacks one. ``number``: that of an earlier version which is still kept."""
    now = manifest.version(spark, path, number)
    names = [working_name(c) for c in classes] if classes is not None else sorted(now.classes)
    lacking = [n for n in names if n not in now.classes]
    if lacking or not names:
        raise ValueError(f"no output of {', '.join(lacking) or 'any class'} in {path}")
    runs: dict[tuple, list[str]] = {}
    for n in names:
        output = now.classes[n]
        # the columns of CSV files are known by their place, so each class is read by itself
        runs.setdefault((output.run, output.fmt, n if output.fmt == "csv" else None), []).append(n)
    frames = [_run_rows(spark, path.rstrip("/"), run, fmt, {n: now.classes[n] for n in mine}) for (run, fmt, _), mine in runs.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _run_rows(spark: SparkSession, path: str, run: str, fmt: str, outputs: dict[str, manifest.Output]) -> DataFrame:
    """Classes of one run in one scan: their columns together, class and section from the folders."""
    columns: dict[str, T.StructField] = {}
    for o in outputs.values():
        columns |= {f.name: f for f in T.StructType.fromJson(json.loads(o.schema)).fields if f.name not in columns}
    schema = T.StructType([*columns.values(), T.StructField(PROFILE, T.StringType()), T.StructField("section", T.StringType())])
    files = [f"{path}/{f}" for o in outputs.values() for listed in o.sections.values() for f, _ in listed]
    if not files:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).format(fmt).option("basePath", f"{path}/{run}")
    return (reader.options(header=True) if fmt == "csv" else reader).load(files)


def read_sheet(spark: SparkSession, path: str, class_value: str, section: str) -> DataFrame:
    """One sheet, and ``row_number``: each row's place in it, from 1.

    A row's place is its index in its file plus the rows of the files before, which the manifest knows: no window,
    no sort.
    """
    name = working_name(class_value)
    output = manifest.version(spark, path).classes[name]
    files = output.sections[section]
    if output.fmt != "parquet" or any(rows is None for _, rows in files):
        raise ValueError("row numbers need Parquet output of write_reports")
    starts = [sum(rows for _, rows in files[:i]) for i in range(len(files))]
    table = local_table(spark, {"_file": [f.rsplit("/", 1)[1] for f, _ in files], "_bit_start": starts})
    rows = _rows(spark, path, output, files)
    placed = rows.withColumns({"_file": F.col("_metadata.file_name"), "_at": F.col("_metadata.row_index")}) if files else rows.withColumns({"_file": F.lit(""), "_at": F.lit(0)})
    return placed.join(F.broadcast(table), "_file").select(*rows.columns, (F.col("_bit_start") + F.col("_at") + 1).cast("long").alias("row_number"))


def _rows(spark: SparkSession, path: str, output: manifest.Output, files: list[list]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(output.schema))
    if not files:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).format(output.fmt)
    if output.fmt == "csv":
        reader = reader.options(header=True)
    return reader.load([f"{path.rstrip('/')}/{f}" for f, _ in files])


# --- what an output was made from ------------------------------------------------

def class_digests(terms: DataFrame, profiles: list[Profile], lookups: pipeline.Lookups) -> dict[str, str]:
    """A digest per class of its terms, its rules and the lookups it uses."""
    own = _content(terms.withColumn("_class", class_of(terms)), ["_class"], terms.columns).collect()
    by_class = {r["_class"]: tuple(r)[1:] for r in own}
    everything = sorted(by_class.items(), key=repr)
    tables = {n: _content(t, [], t.columns).first() for n in ("detail", "part", "weights") if (t := getattr(lookups, n)) is not None}
    out = {}
    for p in profiles:
        parts: list = [by_class.get(p.class_value.rstrip(" ").lower()), p, p.rule_list()]
        if any((r.gate or "").lstrip("!") == "std" for r in p.rule_list()):
            parts += [tuple(tables["detail"]), everything]                # the list of components is drawn from all classes
        if p.weights:
            parts += [tuple(tables["part"]), tuple(tables["weights"])]
        out[p.name] = hashlib.sha256(repr(parts).encode()).hexdigest()
    return out


def _content(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Number of rows and two sums of their hashes, whatever their order."""
    hashes = rows.select(*by, F.xxhash64(*columns).alias("_h"))
    return hashes.groupBy(*by).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.pmod("_h", F.lit(1 << 31))), F.lit(0)), F.coalesce(F.sum(F.shiftrightunsigned("_h", 33)), F.lit(0)))
