"""Fingerprints: edited texts, neighbours, near pairs, by plain versions."""

import hashlib

from pyspark.sql import functions as F

from termfold.llm import simhash
from tests.llm.messy import check_shapes


def test_query_on_a_table(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    got = sorted(simhash.op9_simhash(spark, sf_dir).collect(), key=lambda r: r.doc_id)
    assert len(got) == len(texts)
    for i, (r, text) in enumerate(zip(got, texts)):
        n = len(text) // 4
        edited = text[: len(text) - n] + texts[(i + 1) % len(texts)][:n]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text)
        bits = lambda x: int(x, 16)
        assert r.near_next == 1 - bin(bits(r.fingerprint) ^ bits(got[(i + 1) % len(got)].fingerprint)).count("1") / 64
        assert r.near_edited == 1 - bin(bits(r.fingerprint) ^ bits(r.edited_fingerprint)).count("1") / 64
    assert sum(r.near_edited > r.near_next for r in got) > 0.97 * len(got)


def test_bits_are_votes(spark):
    """One text, bit by bit, from its terms."""
    df = spark.createDataFrame([("the quick brown fox jumps over the quick brown dog",)], "text string")
    terms = [(r.h, r.w) for r in df.select(F.explode(simhash.terms(F.col("text"))).alias("t")).select("t.*").collect()]
    assert len(terms) == 10
    want = 0
    for k in range(64):
        if 2 * sum(w for h, w in terms if (h >> k) & 1) > sum(w for _, w in terms):
            want |= 1 << k
    got = simhash.fingerprints(df.withColumn("k", F.lit(1)), ["k"]).first().bits
    assert got & (2**64 - 1) == want


def test_any_number_of_buckets_gives_the_same(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = sorted(map(tuple, simhash.compared(docs, 1).collect()))
    assert one == sorted(map(tuple, simhash.compared(docs, 13).collect()))


def test_near_pairs_equal_all_pairs(spark):
    prints = [(i, (i * 0x9E3779B97F4A7C15) % 2**62) for i in range(40)]
    prints += [(100 + i, v ^ (1 << (i % 60)) ^ (1 << (3 * i % 60))) for i, v in prints] + [(500, prints[0][1])]
    want = {(a, b) for _, a in prints for _, b in prints if a < b and bin(a ^ b).count("1") <= 3}
    pairs, members = simhash.near_fingerprints(spark.createDataFrame(prints, "doc_id long, bits long"), 3)
    assert {(r.a, r.b) for r in pairs.collect()} == want and members.count() == len(prints)


def test_odd_rows(spark):
    got = check_shapes(spark, lambda d: simhash.compared(d, 4), ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    assert got[2].fingerprint == got[3].fingerprint == got[7].fingerprint == "0" * 16
    assert got[4].fingerprint == got[5].fingerprint
    one = simhash.compared(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string"), 4).first()
    assert one.near_next == 1.0
