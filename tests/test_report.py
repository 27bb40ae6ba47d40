"""Report layout, skewed keys, and the plans behind them."""

import os
import re
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from termfold.operators import classes as C
from termfold.operators import coarsen
from termfold.operators import joins as J
from termfold.operators import staging
from termfold.plans import pipeline
from termfold.plans.profiles import BY_NAME, PROFILES
from termfold.sources.sample import Sample
from termfold.sources.terms import class_subset, write_terms


@pytest.fixture(scope="module")
def sample(spark, sf_dir):
    return Sample(spark, sf_dir)


@pytest.fixture(scope="module")
def lookups(sample):
    return pipeline.Lookups(sample.detail, sample.part, sample.weights)


@pytest.fixture(scope="module")
def full(sample, lookups):
    return pipeline.run(sample.terms, PROFILES, lookups).toPandas()


def plan(df, mode="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_rules_keep_every_term(sample, lookups):
    wanted = class_subset(sample.terms, [p.class_value for p in PROFILES]).count()
    out = pipeline.coarsen(sample.terms, PROFILES, lookups)
    assert (out.count(), out.select("LOINC_NUM").distinct().count()) == (wanted, wanted)


def test_headings_blanks_and_members_agree(full):
    for _, part in full.groupby(["profile", "section"]):
        heads = part[part.row_kind == C.HEADING]
        members = part[part.row_kind == C.MEMBER]
        keys = members.SORT_ORDER.str.rstrip(" ").str.lower()
        assert len(heads) == len(part[part.row_kind == C.BLANK]) == keys.nunique()
        assert heads.LONG_COMMON_NAME.astype(int).sum() == len(members)


def test_rows_follow_their_heading(full):
    ua = full[(full.profile == "UA") & (full.section == "group size > 1")]
    open_class = None
    for kind, heading, order in zip(ua.row_kind, ua.Heading, ua.SORT_ORDER):
        if kind == C.HEADING:
            assert open_class is None
            open_class = heading.rstrip(" ").lower()
        elif kind == C.MEMBER:
            assert order.rstrip(" ").lower() == open_class
        else:
            assert order.lower().startswith(open_class) and order.endswith("_BLANKROW")
            open_class = None


def test_one_class_equals_its_part_of_all(sample, lookups, full):
    one = pipeline.run(sample.terms, [BY_NAME["DRUGTOX"]], lookups).toPandas()
    same = full[full.profile == "DRUGTOX"][list(one.columns)]
    assert sorted(map(str, one.values.tolist())) == sorted(map(str, same.values.tolist()))


def test_terms_not_stored_by_class_take_one_pass(sample, lookups, full):
    terms = sample.derived_terms()
    assert len(pipeline.families(terms, PROFILES)) == 1 < len(pipeline.families(sample.terms, PROFILES))
    got = pipeline.run(terms, PROFILES, lookups).toPandas()
    assert sorted(map(str, got.values.tolist())) == sorted(map(str, full[list(got.columns)].values.tolist()))


def test_staged_tables_go_with_the_session(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from termfold.operators.staging import staged
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}").getOrCreate()
assert staged(s.range(5)).count() == 5
"""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=top, timeout=120, capture_output=True)
    def left():
        return [f for f in os.listdir(tmp_path) if f.startswith("termfold")]

    for _ in range(100):
        if not left():
            break
        time.sleep(0.2)
    assert left() == []


def test_stored_terms_are_pruned_by_class(spark, sample, tmp_path):
    path = str(tmp_path / "terms")
    write_terms(sample.derived_terms(), path)
    stored = spark.read.parquet(path)
    subset = class_subset(stored, ["UA"])
    assert subset.count() == class_subset(sample.derived_terms(), ["UA"]).count()
    pruned = [line for line in plan(subset, "formatted").split("\n") if line.startswith("PartitionFilters")]
    assert len(pruned) == 1 and "class_key" in pruned[0]


def test_coarsening_is_broadcast_lookups_only(sample):
    text = plan(pipeline.key_terms(sample.terms, [BY_NAME["SERO"]]))
    assert text.count("BroadcastHashJoin") == 3
    for bad in ("Python", "SortMergeJoin", "Exchange hashpartitioning", "CartesianProduct", "NestedLoop"):
        assert bad not in text


def test_generated_methods_can_be_compiled(spark, sample, lookups):
    """HotSpot interprets methods of 8,000 bytes and more."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(pipeline.run(sample.terms, PROFILES, lookups), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) > 3 and max(sizes) < 8000


def test_class_sizes_read_only_key_columns(sample):
    text = plan(C.class_sizes(pipeline.key_terms(sample.terms, [BY_NAME["UA"]]), ["profile"]))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"COMPONENT", "PROPERTY", "SYSTEM"}


def test_large_tables_take_the_shuffled_way(spark, sample, lookups, full, monkeypatch):
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(J, "HOT_SHARE", 50)
    monkeypatch.setattr(coarsen, "BROADCAST_RULES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = pipeline.run(sample.terms, PROFILES, lookups)
        assert "SortMergeJoin" in plan(out)
        got = out.toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(str, got.values.tolist())) == sorted(map(str, full.values.tolist()))


def test_hot_key_is_spread(spark, monkeypatch):
    """Two thirds of the rows share one key and no task gets more than its share."""
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(J, "HOT_SHARE", 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(30_000).select(
            F.col("id").cast("string").alias("row"),
            F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 30 == 0, F.lit(None))
            .otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"))
        right = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).union(
            spark.createDataFrame([("hot", -1)], "k string, v long"))
        out = J.lookup_join(left, right, ["k"])
        text = plan(out)
        assert "hashpartitioning(k" in text and "_slot" in text.split("hashpartitioning(k")[1].split("\n")[0]
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 30_000 / 8 * 1.5
        wrong = out.where(
            (F.col("k") == "hot") & (F.col("v") != -1) | F.col("k").isNull() & F.col("v").isNotNull()
            | F.col("k").startswith("k") & ~F.col("v").eqNullSafe(F.substring("k", 2, 9).cast("long")))
        assert wrong.count() == 0 and out.where("v = -1").count() == 20_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
