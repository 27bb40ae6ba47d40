"""Quality: held-out accuracy, trees by plain traversal, odd labels."""

import numpy as np

from termfold.llm import quality
from tests.llm.messy import check_shapes, documents, empty

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = [r for r in quality.op1_quality(spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert len(got) > 50 and sum(r.predicted == labels[r.doc_id] for r in got) > 0.95 * len(got)
    good = [r.score for r in got if labels[r.doc_id] == 1]
    bad = [r.score for r in got if labels[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_arrays_walk_like_a_tree():
    r = np.random.default_rng(3)
    x = r.normal(size=(600, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality.train(x, y)

    def walk(row):
        total = model.base
        for feature, threshold, value in zip(model.feature, model.threshold, model.value):
            node = 0
            for _ in range(quality.DEPTH):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node]
        return 1 / (1 + np.exp(-total))

    scores = model.score(x)
    assert np.allclose(scores, [walk(row) for row in x]) and ((scores > 0.5) == y).mean() > 0.95
    assert np.array_equal(quality.train(x, y).value, model.value)


def test_held_out_rows_are_those_of_the_checksum(spark):
    from zlib import crc32
    df = spark.range(200)
    got = {r.id: r.h for r in df.select("id", quality.held_out(df.id).alias("h")).collect()}
    assert got == {i: crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (4, None, 0), (None, 1, 0), (99, 0, 0), (6, 0, 1)], LABELS)
    got = check_shapes(spark, lambda d: quality.scored(d, labels), ["doc_id", "held_out", "score", "predicted"])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert got[2].score == got[3].score == got[7].score


def test_without_labels_or_with_one_class(spark):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.scored(documents(spark), none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(9)], LABELS)
    assert all(r.score > 0.99 for r in quality.scored(documents(spark), one).collect())
    assert quality.accepted_documents(documents(spark), one).count() == documents(spark).count()
    assert quality.accepted_documents(empty(spark), none).collect() == []
