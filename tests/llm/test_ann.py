"""Nearest neighbours: recall and scores against brute force, odd vectors."""

from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from termfold.llm import ann


def brute(ids, data, query, own, k):
    d = np.sqrt(((data - query) ** 2).sum(1))
    d[ids == own] = np.inf
    order = np.lexsort((ids, d))
    return [(int(ids[i]), d[i]) for i in order[:k] if d[i] < np.inf]


def test_recall_on_a_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, data = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), np.float64)
    got = {}
    for r in ann.op10_ann(spark, sf_dir).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(ids[ids % 100 == 0].tolist())
    hits = total = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 11))
        scores = [found[i][1] for i in range(1, 11)]
        assert scores == sorted(scores)
        want = brute(ids, data, data[ids == q][0], q, 10)
        true = dict(brute(ids, data, data[ids == q][0], q, len(ids)))
        assert all(s == pytest.approx(true[i], rel=1e-12) for i, s in found.values())
        hits += len({i for i, _ in want} & {i for i, _ in found.values()})
        total += 10
    assert hits >= 0.9 * total


def test_tree_holds_every_vector_and_opens_bins_by_distance():
    data = np.random.default_rng(1).normal(size=(3000, 8))
    tree = ann.Tree(data, 40)
    at = tree.assign(data)
    assert tree.leaves == 40 and set(at.tolist()) <= set(range(40)) and len(set(at.tolist())) > 30
    bins = list(tree.best_bins(data[0]))
    assert sorted(bins) == list(range(40))
    assert 1 <= ann.calibrate(tree, data, 3000, 0.9) <= ann.calibrate(tree, data, 3000, 0.99) <= 40


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (200, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "vec_id long, embedding array<float>, leaf string, score string")
    vectors = ann.usable(df)
    got = sorted(map(tuple, ann.search(vectors, vectors.where(F.col("vec_id") % 100 == 0)).collect()))
    assert [(q, r, v) for q, r, v, _ in got] == [
        (0, 1, 1), (0, 2, 2), (0, 3, 8), (0, 4, 8), (0, 5, 100), (100, 1, 8), (100, 2, 8), (100, 3, 0), (100, 4, 1), (100, 5, 2)]
    assert got[0][3] == 0.0 and got[4][3] == pytest.approx(2**0.5)
    none = vectors.where("false")
    assert ann.search(none, none).collect() == []


def test_one_vector_a_third_of_all(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(i % 17), float(i % 5), float(i % 29)]) for i in range(3000)]
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = ann.search(vectors, vectors.where("vec_id % 300 = 0")).collect()
    assert len(got) == 100 and all(r.score == 0.0 for r in got)


def asked_of(queries, leaves_of, kind):
    leaves = np.concatenate(leaves_of).astype("<i4")
    places = np.repeat(np.arange(len(leaves_of)), [len(x) for x in leaves_of]).astype("<i4")
    return [queries[0].astype("<i8").tobytes(), queries[1].astype(kind).tobytes(), leaves.tobytes(), places.tobytes()]


def test_many_visits_of_one_batch_of_queries(spark, monkeypatch):
    # 1,200 queries of one batch to some 480 leaves with 4 KB each: more than a column of an Arrow batch can hold
    rng = np.random.default_rng(3)
    ids, data = np.arange(2000), rng.normal(size=(2000, 512))
    vectors = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, data)], "vec_id long, v array<double>")
    monkeypatch.setattr(ann, "fit", partial(ann.fit, leaf_rows=4))
    got = {}
    for r in ann.search(vectors, vectors.where("vec_id < 1200"), recall=1.0).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(range(1200))
    hits = 0
    for q in range(0, 1200, 40):
        want = brute(ids, data, data[q], q, 10)
        hits += len({i for i, _ in want} & {i for i, _ in got[q]})
        true = dict(brute(ids, data, data[q], q, 2000))
        assert len(got[q]) == 10 and all(s == pytest.approx(true[i], rel=1e-12) for i, s in got[q])
    assert hits >= 0.98 * 300


def test_first_bins_are_the_queue_s():
    rng = np.random.default_rng(2)
    for data in (rng.normal(size=(3000, 12)), rng.normal(size=(30, 12))[rng.integers(0, 30, 3000)] + 0.1 * rng.normal(size=(3000, 12)),
                 np.repeat(rng.normal(size=(40, 12)), 75, axis=0)):
        tree = ann.Tree(data, 300)
        assert sorted(tree.in_order()) == list(range(tree.leaves))
        for visits in (1, 2, 17, 140, 299, 400):
            query, leaf = tree.first_bins(data[::50], visits)
            for q in range(0, 60):
                want = [x for x, _ in zip(tree.best_bins(data[50 * q]), range(visits))]
                assert len(leaf[query == q]) == len(want)
                if len(np.unique(data, axis=0)) == len(data):          # else equal distances may be opened in any order
                    assert set(leaf[query == q].tolist()) == set(want)


@pytest.mark.parametrize(("kind", "scale", "moved"), [("<f4", 1.0, 0.0), ("<f4", 1.0, 1e4), ("<f8", 1e30, 0.0), ("<f8", 1e160, 0.0), ("<f8", 1e-170, 0.0)])
def test_nearest_of_leaves_are_exact(kind, scale, moved):
    rng = np.random.default_rng(4)
    data = np.round(rng.normal(size=(3000, 6)), 1) + moved          # rounded: many equal vectors and distances
    data[500:1400] = data[0]
    data = (data * scale).astype(kind)
    ids = rng.integers(0, 1500, 3000)                                # repeated ids
    own = np.unique(ids[rng.choice(3000, 200, replace=False)])
    queries = np.array([data[np.flatnonzero(ids == i)[0]] for i in own])
    leaf = rng.integers(0, 5, 3000).astype("<i4")
    visited = [np.flatnonzero(x) for x in rng.random((len(own), 5)) < 0.6]
    nearest = ann.Nearest([asked_of((own, queries), visited, kind)], data.astype(np.float64).mean(0), kind, 10)
    for part in np.array_split(rng.permutation(3000), 3):
        nearest.search([[ids[part].astype("<i8").tobytes(), data[part].tobytes(), leaf[part].tobytes()]])
    got = {}
    for b in nearest.batches():
        for q, i, s in zip(*(c.to_pylist() for c in b.columns)):
            got.setdefault(q, []).append((i, s))
    for q, query, leaves in zip(own.tolist(), queries, visited):
        here = np.isin(leaf, leaves)
        with np.errstate(over="ignore"):
            d = np.sqrt(((data[here].astype(np.float64) - query.astype(np.float64)) ** 2).sum(1))
        other = np.flatnonzero(ids[here] != q)
        near = other[np.lexsort((ids[here][other], d[other]))[:10]]
        assert got.get(q, []) == list(zip(ids[here][near].tolist(), d[near].tolist()))


def test_slots_parts_and_hot_leaves(spark, monkeypatch):
    # a third of the vectors are one, some ids repeat; with all leaves visited the result is exact
    for name, value in (("SLOT_ROWS", 200), ("PART_BYTES", 400), ("ROUND_BYTES", 2000), ("BLOCK_BYTES", 300), ("LEAST_SLOTS", 12)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(6)
    data = rng.normal(size=(3000, 4)).astype(np.float32)
    data[::3] = data[0]
    ids = np.where(np.arange(3000) % 7 == 0, 77, np.arange(3000))
    vectors = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, data)], "vec_id long, v array<float>")
    monkeypatch.setattr(ann, "fit", lambda *a, fit=ann.fit, **b: (lambda x: (x[0], x[0].leaves, *x[2:]))(fit(*a, **b, leaf_rows=30)))
    got = {}
    for r in ann.search(vectors, vectors.where("vec_id % 40 = 0 and vec_id > 0")).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    asked = sorted(set(ids[(ids % 40 == 0) & (ids > 0)].tolist()))
    assert sorted(got) == asked
    for q in asked:
        mine = min(data[ids == q].tolist())
        assert got[q] == [(i, pytest.approx(d, rel=1e-12)) for i, d in brute(ids, data.astype(np.float64), np.array(mine), q, 10)]


def test_recall_with_a_sample_below_the_rows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    ids, data = np.arange(12_000), rng.normal(size=(12_000, 32)).astype(np.float32)
    vectors = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, data)], "vec_id long, v array<float>")
    monkeypatch.setattr(ann, "fit", partial(ann.fit, sample=800, leaf_rows=60))
    got = {}
    for r in ann.search(vectors, vectors.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    full = data.astype(np.float64)
    hits = sum(len(got[q] & {i for i, _ in brute(ids, full, full[q], q, 10)}) for q in range(0, 12_000, 50))
    assert hits >= 0.95 * 2400


def test_vector_of_another_length_is_an_error(spark):
    rows = [(i, [1.0, float(i), 2.0]) for i in range(30_000)] + [(30_000, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    with pytest.raises(Exception, match="a vector has 2 components, others have 3|inhomogeneous"):
        ann.search(vectors, vectors.where("vec_id = 0")).collect()
