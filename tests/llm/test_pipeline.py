"""The pipeline: columns and decisions of each stage, and the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from termfold.llm import mixing, pii, quality
from tests.llm.messy import ROWS, empty
from tests.llm.test_jaccard import brute


def test_all_queries_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")} and "pipeline" in names
    assert set(E.oracle_sql()) <= names


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in P.STAGES:
        before, docs = docs, P.staged(stage(spark, docs, sf_dir))
        out.append((name, before, docs))
    return out


def test_columns(stages):
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes, name
    assert stages[-1][2].columns == ["doc_id", "n_tokens", "ids"]


def test_decisions(spark, sf_dir, stages):
    by = {name: (before, after) for name, before, after in stages}
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    before, after = by["quality"]
    scored = quality.scored(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(after) == ids(scored.where("predicted = 1"))

    before, after = by["near_duplicates"]
    groups = brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert ids(after) == sorted(i for i, (_, c) in groups.items() if i == c)

    before, after = by["personal_data"]
    assert ids(after) == ids(before) and pii.extract(after).where("spans <> ''").count() == 0
    assert after.where("n_chars <> length(text)").count() == 0

    before, after = by["mixing"]
    taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(before).collect()}
    copies = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert all(abs(copies.get(i, 0) * n - t) <= n / 2 for i, (t, n) in taken.items())

    before, after = by["token_ids"]
    assert ids(after) == ids(before) and after.where("n_tokens <> size(ids)").count() == 0


def test_odd_and_empty_tables(spark, sf_dir):
    for docs in (empty(spark), spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")):
        for _, stage in P.STAGES:
            docs = P.staged(stage(spark, docs, sf_dir))
        assert docs.columns == ["doc_id", "n_tokens", "ids"]


#: Names that the stages use on the way, in several spellings.
INNER = ["target", "epochs", "cut_key", "cut_words", "source_size", "_source", "_of_class", "_asked_id", "_ASKED_CLASS", "_stays", "_mix_key", "__size",
         "_copies", "_copy", "_hash", "_base", "_more", "class", "root", "bits", "score", "predicted", "stays", "_of", "held_out", "quality"]


def test_stages_keep_clashing_columns(spark, sf_dir):
    """Columns named like a stage's own come through, and the decisions are those without them."""
    plain = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long"))
    wide = plain.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in INNER})
    for name, stage in P.STAGES[:-1]:
        plain, wide = P.staged(stage(spark, plain, sf_dir)), P.staged(stage(spark, wide, sf_dir))
        assert wide.columns == [*plain.columns, *INNER], name
        assert sorted(map(str, wide.select(*plain.columns).collect())) == sorted(map(str, plain.collect())), name
        assert wide.where(" OR ".join(f"`{c}` <> concat('{c}', coalesce(CAST(doc_id AS STRING), ''))" for c in INNER)).count() == 0, name
    assert P.STAGES[-1][1](spark, wide, sf_dir).count() == wide.count()
