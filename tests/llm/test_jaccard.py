"""Jaccard join and components against brute force."""

import random
from collections import defaultdict

import pytest

from termfold.llm import jaccard
from termfold.llm.components import components
from tests.compare import connect, differences
from tests.llm.messy import check_shapes, documents, empty


def reachable(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(docs, n, percent):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                links.append((a, b))
    root = reachable(links, ids)
    return {i: (len(sets[i]), root[i]) for i in ids}


def joined(df, n, percent, **more):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df, n, percent, **more).collect()}


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_join_on_a_table(spark, sf_dir, n, percent):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert joined(docs, n, percent) == brute([(r.doc_id, r.text) for r in docs.collect()], n, percent)


def test_query_equals_sql(spark, sf_dir):
    assert differences(jaccard.op2_jaccard(spark, sf_dir), connect(sf_dir), jaccard.ORACLE) == ""


@pytest.mark.parametrize("block", [4, 1024])
def test_many_near_copies(spark, block):
    """A cloud of near copies around the threshold, common passages, copies; lists longer than a block."""
    r = random.Random(7)
    base = [f"w{r.randint(0, 400)}" for _ in range(60)]
    docs = []
    for i in range(260):
        words = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3])):
            words[r.randrange(60)] = f"x{r.randint(0, 30)}"
        docs.append((i, " ".join(words)))
    passage = " ".join(f"p{k}" for k in range(30))
    docs += [(1000 + i, passage + " " + " ".join(f"q{r.randint(0, 60)}" for _ in range(r.randint(0, 12)))) for i in range(80)]
    docs += [(2000 + i, docs[5 * i][1].upper() + "  ") for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    want = brute(docs, 3, 90)
    assert len({c for _, c in want.values()}) > 20
    assert joined(df, 3, 90, block=block) == want


def test_components_of_chains_stars_and_cycles(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + i) for i in range(1, 300)] + [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    links += [(r.randint(3000, 3400), r.randint(3000, 3400)) for _ in range(200)] + [(-5, -9), (-5, -5)]
    nodes = {x for link in links for x in link}
    df = spark.createDataFrame([(b, a) for a, b in links], "u long, v long").repartition(7)
    got = {row.node: row.root for row in components(df).collect()}
    want = reachable(links, nodes)
    assert {n: got.get(n, n) for n in nodes} == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_odd_rows(spark):
    got = check_shapes(spark, jaccard.join, ["doc_id", "n_shingles", "component_id"])
    assert [got[i].n_shingles for i in (2, 3, 7)] == [0, 0, 0] and [got[i].component_id for i in (2, 3, 7)] == [2, 3, 7]
    assert got[5].component_id == 4 and got[None].component_id is None


def test_one_document_of_each_group_stays(spark):
    kept = jaccard.distinct_documents(documents(spark))
    assert kept.columns == documents(spark).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is not None, i))
    assert ids == [None, 1, 2, 3, 4, 6, 7, 8]
    assert jaccard.distinct_documents(empty(spark)).collect() == []


def test_documents_are_told_apart_by_id_and_text(spark):
    """One id with several texts, also copied under other ids; copies without an id."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(12)) for x in "abcd")
    docs = [(1, a), (1, b), (2, b), (3, c), (1, d), (None, c), (None, "n o i d"), (None, "N o i d"), (9, b + " more"), (7, ""), (7, None), (None, ""), (None, " ")]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, place long").repartition(4)
    kept = sorted((r.doc_id or 0, (r.text or "").strip().lower()) for r in jaccard.distinct_documents(df).collect())
    assert kept == sorted([(1, a), (1, b), (3, c), (1, d), (0, "n o i d"), (7, ""), (0, ""), (0, "")])
