"""Mixing: SQL, targets by plain resharing, cuts, odd rows."""

from collections import defaultdict

import pytest

from termfold.llm import mixing
from tests.compare import connect, differences
from tests.llm.messy import check_shapes, documents, rows


def reshared(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by repeated resharing."""
    names = sorted(sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, share * sum(sizes.values())
    while True:
        left = total - sum(capped.values())
        free = [s for s in names if s not in capped]
        even = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if even[s] > most * sizes[s]]
        if not over:
            return capped | even
        capped |= {s: most * sizes[s] for s in over}


def test_query_equals_sql(spark, sf_dir):
    assert differences(mixing.op5_mixing(spark, sf_dir), connect(sf_dir), mixing.ORACLE) == ""


def test_targets_and_taken_words(spark, sf_dir):
    got = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    size, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in got:
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = reshared(size)
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


@pytest.mark.parametrize("range_rows", [1, 7, 4096])
def test_any_number_of_ranges_cuts_alike(spark, sf_dir, range_rows):
    keyed = mixing.sized(spark.read.parquet(f"{sf_dir}/documents.parquet")).cache()
    from pyspark.sql import functions as F
    sources = keyed.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    got = mixing.cuts(keyed, mixing.targets(sources), range_rows)
    assert rows(got) == rows(mixing.cuts(keyed, mixing.targets(sources)))


def test_odd_rows(spark):
    got = check_shapes(spark, lambda d: mixing.mix(d).select("doc_id", "size", "source_size", "target", "taken"),
                       ["doc_id", "size", "source_size", "target", "taken"])
    assert got[2]["size"] == got[3]["size"] == got[7]["size"] == 0 and got[7]["target"] >= 0
    assert got[None]["source_size"] == got[5]["source_size"] == 6


def test_documents_of_the_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = {r.doc_id: r for r in mixing.mix(docs).collect()}
    copies = defaultdict(int)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    for r in out.select("doc_id").collect():
        copies[r.doc_id] += 1
    for i, r in plan.items():
        if r["size"]:
            assert abs(copies[i] * r["size"] - r.taken) <= r["size"] / 2
    assert mixing.mixed_documents(documents(spark)).where("doc_id = 6").count() <= 2
