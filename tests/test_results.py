"""Report output: sheets of each class in one job, committed versions, crashes at any step, repeat runs."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from termfold.plans import pipeline
from termfold.plans.profiles import BY_NAME, PROFILES
from termfold.sources import manifest as M
from termfold.sources import results as R
from termfold.sources import sheets
from termfold.sources.sample import Sample
from termfold.sources.terms import class_subset, write_terms


@pytest.fixture(scope="module")
def sample(spark, sf_dir):
    return Sample(spark, sf_dir)


@pytest.fixture(scope="module")
def lookups(sample):
    return pipeline.Lookups(sample.detail, sample.part, sample.weights)


def rows(df, columns=None):
    return sorted(map(str, df.select(*(columns or sorted(df.columns))).collect()))


def two(sample):
    return [BY_NAME["UA"], BY_NAME["FERT"]]


def test_all_classes_in_one_job(spark, sample, lookups, tmp_path):
    path = str(tmp_path / "out")
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    R.write_reports(sample.terms, path, PROFILES, lookups)
    together = len(jobs.getJobIdsForGroup(None)) - before
    assert together < 60                                        # one run, not one per class
    full = pipeline.run(sample.terms, PROFILES, lookups).toPandas()
    for p in PROFILES:
        got = R.read_report(spark, path, [p.class_value])
        want = full[full.profile == p.name]
        assert got.columns == [*R.columns_of(p), "profile", "section"]
        assert sorted(map(str, got.select(*want.columns.intersection(got.columns)).toPandas().fillna("-").values.tolist())) == sorted(
            map(str, want[want.columns.intersection(got.columns)].fillna("-").values.tolist()))
    for name in ("UA", "CHEM", "MICRO"):
        one = pipeline.run(sample.terms, [BY_NAME[name]], lookups)
        assert rows(R.read_report(spark, path, [name])) == rows(one)


def test_files_have_their_own_columns_in_report_order(spark, sample, lookups, tmp_path):
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        R.write_reports(sample.terms, path, [BY_NAME["HEMBC"], BY_NAME["FERT"]], lookups, fmt)
        R.write_reports(sample.terms, path, [BY_NAME["HEMBC"], BY_NAME["FERT"]], lookups, fmt)
        files = [f"{path}/{f}" for f, _ in M.version(spark, path).classes["HEMBC"].sections["all groups"]]
        assert files and len(glob.glob(f"{path}/run-*")) == 1
        reader = spark.read.format(fmt).option("header", True)
        assert reader.load(files[0]).columns == R.columns_of(BY_NAME["HEMBC"])
        stored = [r.SORT_ORDER for f in files for r in reader.load(f).coalesce(1).collect()]
        want = pipeline.run(sample.terms, [BY_NAME["HEMBC"]]).where("section = 'all groups'").toPandas()
        assert stored == want.SORT_ORDER.tolist()
        assert R.read_report(spark, path, ["HEM/BC"]).where("section = 'all groups'").count() == len(want)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_users_own_report(spark, sample, tmp_path, fmt):
    path = str(tmp_path / "own")
    report = pipeline.run(sample.terms, two(sample))
    R.write_report(report, path, fmt)
    R.write_report(pipeline.run(sample.terms, [BY_NAME["UA"]]), path, fmt)
    got = R.read_report(spark, path)
    assert got.groupBy("profile", "section").count().orderBy("profile", "section").collect() == (
        report.groupBy("profile", "section").count().orderBy("profile", "section").collect())
    with pytest.raises(ValueError, match="no output of MICRO"):
        R.read_report(spark, path, ["MICRO"])


def test_row_numbers(spark, sample, tmp_path):
    path = str(tmp_path / "out")
    R.write_reports(sample.terms, path, two(sample))
    for section in R.SECTIONS:
        want = pipeline.run(sample.terms, [BY_NAME["UA"]]).where(F.col("section") == section).toPandas()
        got = R.read_sheet(spark, path, "UA", section).orderBy("row_number").toPandas()
        assert got.row_number.tolist() == list(range(1, len(want) + 1)) and got.SORT_ORDER.tolist() == want.SORT_ORDER.tolist()


def test_writing_a_class_leaves_the_others(spark, sample, tmp_path):
    path = str(tmp_path / "out")
    R.write_reports(sample.terms, path, two(sample))
    before = rows(R.read_report(spark, path))
    R.write_reports(sample.terms, path, [BY_NAME["UA"]])
    assert rows(R.read_report(spark, path)) == before
    assert sorted(M.version(spark, path).classes) == ["FERT", "UA"]
    assert len(glob.glob(f"{path}/run-*/profile=*")) == 2       # what was replaced is gone
    assert len(glob.glob(f"{path}/_manifest/*.json")) == 1


def test_a_class_that_shrinks_leaves_nothing_stale(spark, sample, tmp_path):
    path = str(tmp_path / "out")
    R.write_reports(sample.terms, path, [BY_NAME["UA"]])
    single = class_subset(sample.derived_terms(), ["UA"]).limit(1)

    def sizes():
        return [R.read_report(spark, path, ["UA"]).where(F.col("section") == s).count() for s in ("group size > 1", "all groups")]

    R.write_reports(single, path, [BY_NAME["UA"]])
    assert sizes() == [0, 3]
    R.write_reports(single.where("false"), path, [BY_NAME["UA"]])
    assert sizes() == [0, 0]
    assert R.read_sheet(spark, path, "UA", "all groups").collect() == []


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["file_system_of", "read_text", "_publish", "_put", "write_text", "commit", "clean", "removal"])
def test_a_crash_leaves_the_old_or_the_new_output(spark, sample, tmp_path, monkeypatch, step):
    """Whatever step a run ends at, every class has its old or its new output, and the next run puts all right."""
    path = str(tmp_path / "out")
    old_terms = class_subset(sample.derived_terms(), ["UA", "FERT"])
    R.write_reports(old_terms.where("LOINC_NUM < 'T5'"), path, two(sample))
    old = rows(R.read_report(spark, path))
    assert old
    new = rows(pipeline.run(sample.terms, two(sample)), sorted(R.read_report(spark, path).columns))

    def crash(*args, **kwargs):
        raise Crash(step)

    with monkeypatch.context() as m:
        if step == "file_system_of":
            m.setattr(sheets, step, crash)
        elif step == "_publish":
            m.setattr(R, step, crash)
        elif step == "removal":                                 # after some folders of the old version are gone
            seen = []
            m.setattr(M, "_file", lambda p, n, f=M._file: crash() if n == 1 and len(seen) == 2 else (seen.append(n) if n == 1 else None) or f(p, n))
        else:
            m.setattr(M, step, crash)
        with pytest.raises(Crash):
            R.write_reports(sample.terms, path, two(sample))
    got = rows(R.read_report(spark, path))
    assert got == (new if step in ("clean", "removal") else old)
    R.write_reports(sample.terms, path, two(sample))
    assert rows(R.read_report(spark, path)) == new
    assert len(glob.glob(f"{path}/_manifest/*.json")) == 1
    M.abandoned(spark, path, hours=-1)
    assert len(glob.glob(f"{path}/run-*")) == 1


def test_a_failed_task_commits_nothing(spark, tmp_path):
    spark.dataSource.register(sheets.Sheets)
    path = str(tmp_path / "out")
    df = spark.range(0, 1000, 1, 4).select(
        F.lit("UA").alias("profile"), F.lit("s").alias("section"),
        F.when(F.col("id") == 900, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="broken row"):
        df.write.format(sheets.NAME).mode("append").options(path=path, columns='{"UA": ["x"]}').save()
    assert not os.path.exists(f"{path}/{sheets.WRITTEN}")


def test_two_writers_both_get_through(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    M.commit(spark, path, {"A": M.Output("run-a", "parquet", "{}")})
    put, raced = M._put, []

    def other_first(s, p, new):
        if not raced:
            raced.append(put(s, p, M.Version(new.number, {**M.version(s, p).classes, "B": M.Output("run-b", "parquet", "{}")})))
        return put(s, p, new)

    monkeypatch.setattr(M, "_put", other_first)
    got = M.commit(spark, path, {"C": M.Output("run-c", "parquet", "{}")})
    assert raced == [True] and got.number == 3 and sorted(M.version(spark, path).classes) == ["A", "B", "C"]


def test_versions_that_are_kept_can_be_read(spark, sample, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    clean = M.clean
    monkeypatch.setattr(M, "clean", lambda s, p, keep=2: clean(s, p, keep))
    few = class_subset(sample.derived_terms(), ["UA"]).limit(3)
    R.write_reports(few, path, [BY_NAME["UA"]])
    R.write_reports(sample.terms, path, [BY_NAME["UA"]])
    assert R.read_report(spark, path, number=1).where("row_kind = 1 AND section = 'all groups'").count() == 3
    assert R.read_report(spark, path).count() == pipeline.run(sample.terms, [BY_NAME["UA"]]).count()


def test_unchanged_classes_are_not_run_again(spark, sample, lookups, tmp_path):
    path, stored = str(tmp_path / "out"), str(tmp_path / "terms")
    profiles = [BY_NAME[n] for n in ("UA", "FERT", "MICRO", "CHEM")]
    terms = class_subset(sample.derived_terms(), [p.class_value for p in profiles])
    write_terms(terms, stored)
    first = spark.read.parquet(stored)
    assert R.write_reports(first, path, profiles, lookups, only_changed=True) == ["UA", "FERT", "MICRO", "CHEM"]
    assert R.write_reports(first.repartition(3), path, profiles, lookups, only_changed=True) == []
    changed = first.withColumn("SYSTEM", F.when((F.col("class_key") == "ua") & (F.col("SYSTEM").isNotNull()), F.lit("Urine")).otherwise(F.col("SYSTEM")))
    assert R.write_reports(changed, path, profiles, lookups, only_changed=True) == ["UA", "MICRO"]      # MICRO's list is drawn from all terms
    full = str(tmp_path / "full")
    R.write_reports(changed, full, profiles, lookups)
    assert rows(R.read_report(spark, path)) == rows(R.read_report(spark, full))
    other = pipeline.Lookups(lookups.detail, lookups.part, lookups.weights.limit(1))
    assert R.write_reports(changed, path, profiles, other, only_changed=True) == ["CHEM"]
