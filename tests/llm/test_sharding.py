"""Sharding: whole groups, near-equal shards, gapless slots, hot groups, odd tables."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from termfold.llm import sharding as S
from tests.llm.messy import ROWS, clashing, documents, empty


def balance(p, column):
    sums = p.groupby("shard")[column].sum().reindex(range(S.SHARDS), fill_value=0)
    return sums.min() / sums.mean(), sums.max() / sums.mean()


def check_slots(p):
    for _, slots in p.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    p = S.op11_sharding(spark, sf_dir).toPandas()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted(p.doc_id) == sorted(texts) and set(p.law) == {"bytes"} and p.grown_shard.isna().all()
    assert p["size"].tolist() == [len(texts[i].encode()) + 16 for i in p.doc_id]
    assert p["text_crc32"].tolist() == [zlib.crc32(texts[i].encode()) for i in p.doc_id]
    check_slots(p)
    assert p.assign(t=p.doc_id.map(texts)).groupby("t").shard.nunique().max() == 1
    low, high = balance(p, "size")
    assert low > 0.97 and high < 1.03


def test_a_group_of_a_third_of_all_rows(spark):
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("one text that many share")).otherwise(
            F.concat(F.lit("text "), F.repeat(F.col("id").cast("string"), (F.col("id") % 17 + 1).cast("int")))).alias("text"))
    p = S.sharded(docs.repartition(7)).toPandas()
    check_slots(p)
    low, high = balance(p, "bytes")
    assert low > 0.95 and high < 1.06                      # though the shared text has most of the words
    shared = p[p.doc_id % 3 == 0].groupby("shard").bytes.count()
    assert shared.max() < 1.1 * shared.mean() and len(shared) < 35
    assert p[p.doc_id % 3 != 0].groupby("hash").shard.nunique().max() == 1


def test_one_id_and_one_text_in_all_rows(spark):
    p = S.sharded(spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))).toPandas()
    check_slots(p)
    assert len(p) == 4000 and p.groupby("shard").size().max() < 140


def test_odd_tables(spark):
    got = S.sharded(documents(spark)).toPandas()
    check_slots(got)
    assert len(got) == len(ROWS)
    assert sorted(got.bytes) == sorted(len((r[1] or "").encode()) + 16 for r in ROWS)
    other = S.sharded(clashing(spark)).toPandas()
    assert sorted(zip(other.bytes, other.shard)) == sorted(zip(got.bytes, got.shard))
    assert S.sharded(empty(spark)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_packing_against_least_loaded(seed):
    """The dot product spreads each measure about as evenly as always taking the emptiest shard spreads one."""
    rng = np.random.default_rng(seed)
    loads = rng.lognormal(0, 1, (2000, 3))
    loads *= 10 / loads.sum(axis=0)
    keys = np.stack([np.ones(2000, np.int64), np.arange(2000), np.zeros(2000, np.int64), np.zeros(2000, np.int64)], axis=1)
    at = S.pack(keys, loads, 10)
    sums = np.zeros((10, 3))
    np.add.at(sums, at, loads)
    plain = np.zeros(10)
    for x in sorted(loads[:, 0], reverse=True):
        plain[plain.argmin()] += x
    assert sums[:, 0].max() < plain.max() + 0.02 and sums.max() < 1.15
