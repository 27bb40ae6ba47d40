"""Staged tables that a chain of steps no longer reads are deleted, not left until the application ends."""

import os

from pyspark.sql import functions as F

import corpus_pipeline as P
from termfold.llm import jaccard
from termfold.operators.staging import mark, new_path, release, staged


def _tables(spark) -> set[str]:
    folder = new_path(spark).rsplit("/", 1)[0].removeprefix("file:")
    return set(os.listdir(folder))


def _read_by(tables: set[str], *dfs) -> set[str]:
    files = [f for df in dfs for f in df.inputFiles()]
    return {t for t in tables if any(f"/{t}/" in f for f in files)}


def test_release_keeps_what_is_read(spark):
    since = mark()
    a, b = staged(spark.range(5)), staged(spark.range(7))
    release(spark, since, keep=(b,))
    assert b.count() == 7
    assert not _read_by(_tables(spark), a) and _read_by(_tables(spark), b)


def test_pipeline_leaves_only_the_table_its_result_reads(spark, sf_dir):
    before = _tables(spark)
    out = P.run(spark, sf_dir)
    left = _tables(spark) - before
    assert left == _read_by(left, out) and len(left) == 1
    assert out.count() > 0 and out.where(F.col("n_tokens") != F.size("ids")).count() == 0


def test_linked_classes_leave_their_rows_and_links(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = _tables(spark)
    rows, linked = jaccard.linked_classes(docs, 5, 80)
    left = _tables(spark) - before
    assert left == _read_by(left, rows, linked) and len(left) == 2
    assert rows.count() == docs.count() and linked.count() >= 0
