"""Rows dealt in order by sampled bounds, and the report's single shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from termfold.operators import classes as C
from termfold.operators import ranges as R
from termfold.operators import staging
from termfold.operators.staging import staged


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.mark.parametrize("n", [0, 1, 5, 32, 33, 100, 1024, 1025, 3000])
def test_place_is_a_search(spark, n):
    r = random.Random(n)
    cuts = sorted({f"{r.randrange(5000):05d}" for _ in range(n)})
    texts = spark.range(400).select(F.lpad((F.col("id") * 37 % 5100).cast("string"), 5, "0").alias("t"))
    for row in texts.select("t", R.place(F.col("t"), cuts).alias("at")).collect():
        assert row["at"] == R.place_of(row["t"], cuts)


def test_bounds_cut_a_repeated_key(spark):
    """Two thirds of the rows share one key; parts hold about as many rows all the same."""
    keys = staged(spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0"))).alias("_order"), F.lit(1).alias("_weight"), "id"))
    cuts = R.bounds(keys, 30_000, 12)
    placed = keys.select(R.place(R.salted(F.col("_order"), ["id"]), cuts).alias("p"))
    sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 30_000 / 12 * 1.6
    assert R.bounds(keys, 30_000, 1) == [] == R.bounds(keys.where("false"), 0, 5)


@pytest.fixture()
def many_parts(spark, monkeypatch):
    monkeypatch.setattr(R, "PART_ROWS", 50)
    monkeypatch.setattr(R, "FAN", 3)
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def some_terms(spark, n=4000):
    """Classes of all sizes, one with half of the terms, in several spellings; LOINC_NUM is null in a third of that one."""
    key = F.when(F.col("id") % 2 == 0, F.when(F.col("id") % 8 == 0, F.lit("BIG|class ")).otherwise(F.lit("big|Class"))).otherwise(F.concat(F.lit("k"), F.col("id") % 97))
    return spark.range(n).select(
        key.alias(C.KEY), F.when((F.col("id") % 2 == 0) & (F.col("id") % 3 == 0), F.lit(None)).otherwise(F.concat(F.col("id"), F.lit("-1"))).alias("LOINC_NUM"),
        F.concat(F.lit("c"), F.col("id")).alias("COMPONENT"), F.lit("u").alias("EXAMPLE_UCUM_UNITS"), F.lit("name").alias("LONG_COMMON_NAME"))


def expected(terms):
    """The report by plain Python, in order."""
    rows = terms.collect()
    classes = {}
    for r in rows:
        classes.setdefault(r[C.KEY].rstrip(" ").lower(), []).append(r)
    out = {"group size > 1": [], "all groups": []}
    for _, members in sorted(classes.items()):
        key = min(m[C.KEY] for m in members)
        listed = [(0, key, str(len(members)), None), *[(1, "", "name", m.LOINC_NUM) for m in sorted(members, key=lambda m: (m.LOINC_NUM is not None, m.LOINC_NUM or ""))], (2, "", "", None)]
        for section in out:
            if section == "all groups" or len(members) > 1:
                out[section] += listed
    return out


def test_report_in_order_over_many_partitions(spark, many_parts):
    terms = some_terms(spark)
    report = C.report(terms)
    assert report.rdd.getNumPartitions() == 16
    got = report.collect()
    want = expected(terms)
    for section, rows in want.items():
        assert [(r.row_kind, r.Heading, r.LONG_COMMON_NAME, r.LOINC_NUM) for r in got if r.section == section] == rows
    sizes = [r["count"] for r in report.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2.5 * sum(sizes) / 16


def test_one_wide_shuffle(spark, many_parts):
    text = plan(C.report(some_terms(spark)))
    assert text.count("Exchange") == text.count("shufflepartitionidpassthrough") == 1
    assert "Join" not in text and "rangepartitioning" not in text and "Python" not in text


def test_empty_report(spark):
    assert C.report(some_terms(spark, 0)).collect() == []
