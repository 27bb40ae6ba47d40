"""Expectations: counted in passing, a run that does not meet them leaves its output alone."""

import glob

import pytest
from pyspark.sql import functions as F

from termfold.operators import expectations as E
from termfold.plans import pipeline
from termfold.plans.profiles import BY_NAME
from termfold.sources import results as R
from termfold.sources.sample import Sample

ROWS = [("a", "CHEM"), ("", "chem "), (None, "MICRO"), ("a", None), ("b", "other")]


def table(spark, data=ROWS):
    return spark.createDataFrame(data, "code string, class string")


def test_counts_nulls_and_tolerance(spark):
    checks = [E.filled("code"), E.listed("class", ["Chem", "MICRO"]), E.within(E.filled("code"), F.col("class") == "CHEM")]
    with pytest.raises(ValueError, match="one name"):
        E.verify(table(spark), checks)
    checks[2] = E.Expectation("code of CHEM", checks[2].holds)
    assert [tuple(r) for r in E.failures(table(spark), checks).collect()] == [("value of code", 2, 5), ("known class", 2, 5), ("code of CHEM", 0, 5)]
    with pytest.raises(E.Unmet) as unmet:
        E.verify(table(spark), checks)
    assert unmet.value.failures == {"value of code": 2, "known class": 2} and unmet.value.rows == 5
    E.verify(table(spark), [E.Expectation("code", E.filled("code").holds, at_most=2)])
    E.verify(table(spark, []), checks)
    E.verify(table(spark), [])


def test_keys(spark):
    assert sorted(map(tuple, E.repeated(table(spark), ["code"]).collect())) == [("a", 2)]
    lookup = spark.createDataFrame([("A  ",), (None,), ("",)], "key string")
    assert [r.value for r in E.unmatched(table(spark), "code", lookup, "key").collect()] == ["b"]
    assert E.repeated(table(spark, []), ["code"]).collect() == []


def test_counted_while_written_without_another_job(spark, tmp_path):
    watch = E.Watch([E.filled("code")])
    df = watch.on(table(spark))
    tracker, before = spark.sparkContext.statusTracker(), None
    before = len(tracker.getJobIdsForGroup(None))
    df.write.parquet(str(tmp_path / "t"))
    jobs = len(tracker.getJobIdsForGroup(None)) - before
    with pytest.raises(E.Unmet, match="of 5 rows 2 without value of code"):
        watch.verify()
    assert jobs == len(tracker.getJobIdsForGroup(None)) - before


def test_a_run_that_fails_leaves_the_output(spark, sf_dir, tmp_path):
    sample = Sample(spark, sf_dir)
    profiles, path = [BY_NAME["UA"], BY_NAME["FERT"]], str(tmp_path / "out")
    met = [E.filled("LOINC_NUM"), E.Expectation("class key", F.col("EQUIV_CLS").isNotNull())]
    R.write_reports(sample.terms, path, profiles, expectations=met)
    want = pipeline.run(sample.terms, profiles).count()
    assert R.read_report(spark, path).count() == want
    half = sample.terms.withColumn("LONG_COMMON_NAME", F.lit(" "))
    blank = half.where("class_key = 'ua'").count()
    with pytest.raises(E.Unmet) as unmet:
        R.write_reports(half, path, [BY_NAME["UA"]], expectations=[*met, E.filled("LONG_COMMON_NAME")])
    assert unmet.value.failures == {"value of LONG_COMMON_NAME": blank} and blank > 0
    assert R.read_report(spark, path).count() == want
    assert R.read_report(spark, path, ["UA"]).where("trim(LONG_COMMON_NAME) <> ''").count() > 0
    assert len(glob.glob(f"{path}/run-*")) == 1
