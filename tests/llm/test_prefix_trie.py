"""Prefix trie against a plain version, screening, hot groups, odd tables; running sums over partitions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from termfold.llm import prefix_trie as P
from termfold.llm.running import running
from termfold.operators.staging import staged

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v, key=lambda t: t[:3])] for c, v in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def plain(convs):
    nodes, kids, out = defaultdict(list), defaultdict(int), {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        leaves[k] = leaves[k] or 1
        saved[k] += (len(nodes[k]) - 1) * words
        ends = ",".join(map(str, sorted(c for c in nodes[k] if len(convs[c]) == len(k))))
        out[k] = (min(nodes[k]), len(k), min(nodes[k[:-1]]) if k else None, len(nodes[k]), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest())
        if k:
            kids[k[:-1]] += 1
            leaves[k[:-1]] += leaves[k]
            saved[k[:-1]] += saved[k]
    return sorted(out.values(), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_rows(seed, n=60):
    r, rows = random.Random(seed), []
    for c in r.sample(range(-25, 200), n):
        for turn in range(r.randint(1, 6)):
            rows.append((c, turn, r.choice(["user", "bot", None]), r.choice(["a b", "a b", "c", None, " x\ty "])))
    return rows


@pytest.mark.parametrize("cells", [P.CELLS, 1 << 12])
def test_against_plain_version(spark, cells):
    rows = random_rows(cells)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(P.trie(P.rebuilt(df), cells)) == plain(rebuilt(conversations(rows)))
    assert got(P.trie(P.turns(df), cells)) == plain(conversations(rows))


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert got(P.op12_prefix_trie(spark, sf_dir)) == plain(rebuilt(conversations(rows)))


def test_a_sketch_that_takes_all_for_shared(spark, monkeypatch):
    monkeypatch.setattr(P, "sketch", lambda digests, cells: np.full(P.HASHES * 4096 // 8, 255, np.uint8))
    rows = random_rows(3)
    assert got(P.trie(P.rebuilt(spark.createDataFrame(rows, SCHEMA)))) == plain(rebuilt(conversations(rows)))


def test_a_full_sketch_never_counts_too_low(spark):
    digests = spark.range(20_000).select(F.xxhash64(F.col("id") % 15_000).alias("da"), F.xxhash64(F.col("id") % 15_000, F.lit(1)).alias("db"))
    bits = P.sketch(digests.repartition(6), 1 << 12)
    a, b = (np.array([r[0] for r in digests.where("id < 5000").select(c).collect()], np.int64) for c in ("da", "db"))
    width = len(bits) * 8 // P.HASHES
    assert width == 1 << 12
    for cells in P._cells(a, b, width):
        assert ((bits[cells >> 3] >> (7 - (cells & 7))) & 1).all()


def test_hot_conversation_and_hot_copies(spark, monkeypatch):
    """One conversation with a third of all turns, and copies of one, many of them ending together."""
    monkeypatch.setattr(P, "PIECE", 7)
    rows = [(1000, t, "u", f"t{t % 5}") for t in range(400)]
    rows += [(2000 + i, t, "u", f"same {t}") for i in range(120) for t in range(3)]
    rows += [(5000 + i, 0, "u", "same 0") for i in range(50)]
    rows += [(1001, t, "u", f"t{t % 5}") for t in range(390)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(P.trie(P.turns(df))) == plain(conversations(rows))
    assert got(P.trie(P.rebuilt(df))) == plain(rebuilt(conversations(rows)))


def test_odd_tables(spark):
    rows = [(1, None, None, None), (1, 0, "", ""), (1, 0, "", ""), (2, 0, "a", "long words " * 30_000), (None, 0, "a", "b"), (3, 5, "ab", "c"),
            (4, 5, "a", "bc"), (40, 1, "x", "y"), (41, 1, "x", "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rebuilt(conversations(rows)))
    assert got(P.trie(P.rebuilt(df))) == want
    more = df.withColumns({c: F.lit("clash") for c in ("depth", "a", "b", "words", "ends", "row", "one", "at", "n", "h", "m", "owner", "da", "shared")})
    assert got(P.trie(P.rebuilt(more))) == want
    nothing = spark.createDataFrame([], SCHEMA)
    assert got(P.trie(P.rebuilt(nothing))) == [] == got(P.trie(P.turns(nothing)))


def test_running_sums_over_partitions(spark):
    rows = staged(spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id % 11 END AS k", "id AS o", "id * 7919 % 1000 AS v", "xxhash64(id) AS x"))
    want, state = {}, defaultdict(lambda: [0, 0])
    for r in sorted(rows.collect(), key=lambda r: (r.k, r.o)):
        state[r.k] = [state[r.k][0] + r.v, state[r.k][1] ^ r.x]
        want[r.o] = tuple(state[r.k])
    out = running(rows, "k", ["o"], sums=["v"], xors=["x"])
    assert {r.o: (r.run_v, r.run_x) for r in out.collect()} == want and out.columns == ["k", "o", "v", "x", "run_v", "run_x"]
