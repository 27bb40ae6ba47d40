"""The folded lookup against rules applied one after the other."""

import itertools
import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from termfold.operators import coarsen
from termfold.operators import rules as R
from termfold.plans.profiles import all_rules


def one_by_one(rules, value, truth):
    for r in rules:
        if r.gate and truth[r.gate.lstrip("!")] != ("0" if r.gate.startswith("!") else "1"):
            continue
        head, hat, parts = value.partition("^")
        if head.rstrip(" ").lower() in {v.rstrip(" ").lower() for v in r.values}:
            value = r.group + hat + parts
    return value


def folded(rules, value, truth):
    names = R.gate_names(rules)
    lookup = {(state, start): text for state, start, text in R.fold(rules)}
    head, hat, parts = value.partition("^")
    text = lookup.get(("".join(truth[n] for n in names), head.rstrip(" ").lower()))
    return value if text is None else text + hat + parts


TEXTS = st.text("abAB ^", max_size=3)
RULES = st.lists(
    st.tuples(st.text("abAB^", min_size=1, max_size=3), st.lists(TEXTS, min_size=1, max_size=3),
              st.sampled_from([None, "g", "!g"])),
    min_size=1, max_size=6,
)


@settings(max_examples=400, deadline=None)
@given(RULES, TEXTS, st.sampled_from("102"))
def test_fold_equals_sequence(specs, value, digit):
    rules = [R.Rule("p", "t", i, R.EQ, g, tuple(vs), gate) for i, (g, vs, gate) in enumerate(specs)]
    assert folded(rules, value, {"g": digit}) == one_by_one(rules, value, {"g": digit})


def test_many_rules_fold_quickly():
    rules = [R.Rule("p", "t", i, R.EQ, f"g{i}", tuple(f"v{i}.{k}" for k in range(4))) for i in range(5000)]
    start = time.perf_counter()
    assert len(R.fold(R.check(rules))) == 20_000
    assert time.perf_counter() - start < 5


def test_profile_rules_fold():
    rules = [r for r in all_rules() if r.kind == R.EQ]
    for place in {(r.profile, r.target) for r in rules}:
        own = [r for r in rules if (r.profile, r.target) == place]
        values = {v for r in own for v in r.values} | {r.group for r in own} | {"", "other"}
        for value in values | {v + "^x" for v in values} | {v.upper() + " " for v in values}:
            for digit in "102":
                truth = {n: digit for n in R.gate_names(own)}
                assert folded(own, value, truth) == one_by_one(own, value, truth)


def followed(rules, value, truth):
    names = R.gate_names(rules)
    head, hat, parts = value.partition("^")
    diagram = R.diagrams(rules, names).get(head.rstrip(" ").lower())
    if diagram is None:
        return value
    numbers, texts = diagram
    at = 0
    while numbers[4 * at] >= 0:
        at, before = numbers[4 * at + {"1": 1, "0": 2, "2": 3}[truth[names[numbers[4 * at]]]]], at
        assert at > before
    return value if texts[at] is None else texts[at] + hat + parts


MANY = st.lists(
    st.tuples(st.text("abAB^", min_size=1, max_size=3), st.lists(TEXTS, min_size=1, max_size=3),
              st.sampled_from([None, "g", "!g", "h", "!h", "i", "!i", "j"])),
    min_size=1, max_size=9,
)


@settings(max_examples=400, deadline=None)
@given(MANY, TEXTS)
def test_diagrams_equal_sequence(specs, value):
    rules = [R.Rule("p", "t", i, R.EQ, g, tuple(vs), gate) for i, (g, vs, gate) in enumerate(specs)]
    for digits in itertools.product("102", repeat=4):
        truth = dict(zip("ghij", digits))
        assert followed(rules, value, truth) == one_by_one(rules, value, truth)


def gated(count):
    """Values listed under many gates, chains from group to group, negated gates."""
    rules = [R.Rule("p", "t", i, R.EQ, f"G{i}", ("a", "b", f"g{i - 1}", f"own{i}"), ("!" if i % 3 == 2 else "") + f"q{i:02}") for i in range(count)]
    return rules + [R.Rule("p", "t", count, R.EQ, "End", ("g3", "c"), None)]


def test_many_gates_fold_quickly_into_few_nodes():
    rules = gated(12)
    start = time.perf_counter()
    found = R.diagrams(R.check(rules), R.gate_names(rules))
    assert time.perf_counter() - start < 1
    assert set(found) == {norm for r in rules for norm in r.values} and max(len(t) for _, t in found.values()) < 60
    r = random.Random(3)
    for _ in range(500):
        truth = {n: r.choice("102") for n in R.gate_names(rules)}
        for value in ["a", "B ^x", "c", "own4^y^z", "g3", "none"]:
            assert followed(rules, value, truth) == one_by_one(rules, value, truth)


def test_many_gates_on_a_table(spark, monkeypatch):
    rules, r = gated(12), random.Random(5)
    names = R.gate_names(rules)
    rows = [(i, r.choice(["a", "B ^x", "c", "own4^y^z", "g3", "none", "", None]), *(r.choice([True, False, None]) for _ in names)) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, t string, " + ", ".join(f"{n} boolean" for n in names))
    want = {i: None if t is None else one_by_one(rules, t, dict(zip(names, ({True: "1", False: "0", None: "2"}[g] for g in gs)))) for i, t, *gs in rows}
    gates = {n: F.col(n) for n in names}
    got = coarsen.apply_rules(df, rules, gates)
    assert got.columns == df.columns and {x.id: x.t for x in got.collect()} == want
    monkeypatch.setattr(coarsen, "BROADCAST_RULES", 0)
    assert {x.id: x.t for x in coarsen.apply_rules(df, rules, gates).collect()} == want


def test_few_gates_by_diagrams_give_the_same(spark, monkeypatch):
    rules = gated(2)
    names = R.gate_names(rules)
    rows = [(i, t, a, b) for i, (t, a, b) in enumerate(itertools.product(["a", "b^x", "c", "g0", "own1", None], [True, False, None], [True, False, None]))]
    df = spark.createDataFrame(rows, "id int, t string, " + ", ".join(f"{n} boolean" for n in names))
    gates = {n: F.col(n) for n in names}
    written = sorted(map(tuple, coarsen.apply_rules(df, rules, gates).collect()))
    monkeypatch.setattr(coarsen, "WRITTEN_GATES", 0)
    assert sorted(map(tuple, coarsen.apply_rules(df, rules, gates).collect())) == written


def test_key_terms_spread_over_tasks_by_rows(spark, monkeypatch):
    """Terms stored in one file are not keyed in one task: each task takes about PART_ROWS of them."""
    from termfold.plans import pipeline
    from termfold.plans.profiles import BY_NAME
    from termfold.sources.terms import TERM_SCHEMA

    monkeypatch.setattr(pipeline, "PART_ROWS", 50, raising=False)
    row = {c: None for c in TERM_SCHEMA.names}
    rows = [{**row, "LOINC_NUM": f"T{i}", "COMPONENT": "Glucose", "CLASS": "CHEM"} for i in range(1000)]
    terms = spark.createDataFrame(rows, TERM_SCHEMA).coalesce(1)
    keyed = pipeline.key_terms(terms, [BY_NAME["CHEM"]])
    sizes = keyed.rdd.glom().map(len).collect()
    assert sum(sizes) == 1000 and len(sizes) >= 20 and max(sizes) <= 100
