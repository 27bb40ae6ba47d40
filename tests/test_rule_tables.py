"""Rules in tables of any size: patterns, defaults and warnings against one by one."""

import random
import re

import pytest
from pyspark.sql import functions as F

from termfold.functions.text import like_regex
from termfold.operators import classes as C
from termfold.operators import columns as K
from termfold.operators import patterns as P
from termfold.operators import staging
from termfold.operators.coarsen import apply_rules
from termfold.operators.conjunctions import add_warning_table
from termfold.operators.rules import groups, rules_of


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def words(r, n):
    return "".join(r.choice("abcdeé .") for _ in range(n))


def some_patterns(seed, n):
    r, out = random.Random(seed), []
    for _ in range(n):
        body = words(r, r.randint(0, 6))
        out.append(r.choice(["%{}%", "{}%", "%{}", "{}", "_{}%", "{}%" + words(r, 2), "%[ab]{}", "{}[^c]%", "a\\{}%", "%{}[", "%{}.*"]).format(body))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_patterns_one_by_one(spark, seed):
    r = random.Random(seed)
    values = [words(r, r.randint(0, 9)).upper() if r.random() < 0.3 else words(r, r.randint(0, 9)) for _ in range(300)]
    values += ["", "a", "a\\b", "x\ny", "aÉb", "[", "abc[", "a.*"]
    patterns = some_patterns(seed, 120) + ["%", "_", "__", "[ab]", "[]x"][seed:]
    table = spark.createDataFrame([(i, p) for i, p in enumerate(patterns)] + [(999, None)], "seq long, pattern string")
    found = {x.value: x.seq for x in P.first_like(spark.createDataFrame([(v,) for v in values] + [(None,)], "value string"), table).collect()}
    # sets are compared by a regular expression, which ignores the case of A-Z only
    tests = [re.compile(like_regex(p).replace(r"\z", r"\Z").removeprefix("(?is)"), re.I | re.S | (re.A if re.search(P.SET, p) else 0)) if "[]" not in p else None
             for p in patterns]
    for v in values:
        seqs = [i for i, t in enumerate(tests) if t and t.search(v)]
        assert found.get(v) == (min(seqs) if seqs else None), v


def test_a_hundred_thousand_patterns(spark):
    """Equal to one by one where it can be told: each pattern is like exactly the names that hold its number."""
    patterns = spark.range(100_000).selectExpr("concat('%name ', id, CASE WHEN id % 2 = 0 THEN ' %' ELSE ' x_' END) AS pattern")
    names = spark.range(0, 200_000, 37).selectExpr("id", "concat('The Name ', id, CASE WHEN id % 3 = 0 THEN ' xy' ELSE ' z' END, CASE WHEN id % 5 = 0 THEN '^part' ELSE '' END) AS v")
    out = P.skip_pattern_table(names, "v", patterns, "Other")
    assert len(plan(out)) < 40_000
    for row in out.collect():
        kept = row.id < 100_000 and (row.id % 2 == 0 or row.id % 3 == 0)
        part = "^part" if row.id % 5 == 0 else ""
        assert row.v == (f"The Name {row.id} {'xy' if row.id % 3 == 0 else 'z'}{part}" if kept else "Other" + part)


def test_skip_pattern_table_is_skip_patterns(spark, sf_dir, monkeypatch):
    names = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name").unionByName(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, "^x"), (-4, "red^y")], "p_partkey long, p_name string"))
    patterns = ["RED%", "%bolt", "s_all%", "%[xyz]%"]
    want = sorted(map(str, K.skip_patterns(names, "p_name", patterns, "Plain").collect()))
    table = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    assert sorted(map(str, P.skip_pattern_table(names, "p_name", table, "Plain").collect())) == want
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    assert sorted(map(str, P.skip_pattern_table(names, "p_name", table, "Plain").collect())) == want
    none = table.where("false")
    assert {r.p_name for r in P.skip_pattern_table(names, "p_name", none, "Plain").collect()} == {None, "Plain", "Plain^x", "Plain^y"}


SIBLINGS = ["G1", "g2 ", "Wild%", "a_c", "Hat^x", "[xy]z", "Group é"]
VALUES = ["G1", "g1^a", "G1 ", "g1 ^a", "G2", "g2 ^b", "g2^b", "wild%", "Wildest^1", "wildest", "abc^", "abc", "a_c", "hat^x", "HAT^x^y", "hat", "xz^1", "xz", "[xy]z",
          "GROUP É^1", "keep me", "keep^z", "other", "other^z", "", "^q", None]


def test_defaults_beside_siblings_of_all_kinds(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i long, v string")
    spec = {**{g: ["no such value"] for g in SIBLINGS}, "Rest": {"default": True, "skipPatterns": ["keep%", "%zz%"]}}
    got = [r.v for r in K.apply_groups(df, "v", spec).orderBy("i").collect()]
    table = P.default_group_table(
        df, "v", spark.createDataFrame([(g,) for g in [*SIBLINGS, None]], "grp string"), spark.createDataFrame([("keep%",), ("%zz%",)], "pattern string"), "Rest")
    assert [r.v for r in table.orderBy("i").collect()] == got

    def taken(v):
        return any(v.rstrip(" ").lower() == g.rstrip(" ").lower() or re.search(like_regex(g + "^%").replace(r"\z", r"\Z").removeprefix("(?is)"), v, re.I | re.S) for g in SIBLINGS)

    for v, out in zip(VALUES, got):
        if v is not None:
            head, hat, rest = v.partition("^")
            stays = taken(v) or head.lower().startswith("keep")
            assert out == (v if stays else "Rest" + hat + rest), v


def test_five_thousand_siblings(spark):
    def rules(n):
        return rules_of("", [groups("v", {**{f"Group {i}": [f"value {i}"] for i in range(n)}, "Rest": {"default": True, "skipPatterns": ["keep%"]}}, target="v")])
    df = spark.range(6000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN concat('VALUE ', id, '^x') WHEN id % 3 = 1 THEN concat('group ', id) ELSE concat('keep ', id) END AS v")
    out = apply_rules(df, rules(5000))
    depth = [len(plan(apply_rules(df, rules(n))).split(" OR ")) for n in (50, 500)]
    assert depth[0] == depth[1]                                  # no condition per sibling
    for r in out.collect():
        want = {0: f"Group {r.id}^x" if r.id < 5000 else "Rest^x", 1: f"group {r.id}" if r.id < 5000 else "Rest", 2: f"keep {r.id}"}[r.id % 3]
        assert r.v == want


def some_rules(seed, n, columns=("A", "B", "C", "D")):
    r = random.Random(seed)
    return [(f"m{i}", {c: [r.choice("pqrstuvw") + str(r.randrange(6)) + r.choice(["", " "]) for _ in range(r.randint(1, 3))]
                       for c in r.sample(columns, r.randint(2, len(columns)))}) for i in range(n)]


def rule_rows(spark, rules):
    return spark.createDataFrame([(i, m, c, v) for i, (m, cond) in enumerate(rules) for c, vs in cond.items() for v in vs], "seq long, message string, col string, value string")


def cells(spark, seed, n):
    r = random.Random(seed)
    rows = [(i, *(None if r.random() < 0.05 else (r.choice("pqrstuvw") + str(r.randrange(6))).upper() for _ in range(4))) for i in range(n)]
    return spark.createDataFrame(rows + [(-1, "p0", "p0", "p0", "p0")] * 3, "i long, A string, B string, C string, D string")


@pytest.mark.parametrize("limit", [staging.BROADCAST_BYTES, -1])
def test_warnings_equal_the_case_chain(spark, monkeypatch, limit):
    monkeypatch.setattr(staging, "BROADCAST_BYTES", limit)
    rules, terms = some_rules(4, 60), cells(spark, 4, 800)
    want = sorted(map(str, C.add_warnings(terms, rules).collect()))
    assert sorted(map(str, add_warning_table(terms, rule_rows(spark, rules)).collect())) == want
    assert any("'m" in w for w in want)


def test_ten_thousand_rules(spark):
    rules, terms = some_rules(9, 10_000), cells(spark, 9, 400)
    out = add_warning_table(terms, rule_rows(spark, rules))
    assert len(plan(out)) < 20_000
    sets = [(m, {c: {v.rstrip(" ").lower() for v in vs} for c, vs in cond.items()}) for m, cond in rules]
    hits = 0
    for row in out.collect():
        want = next((m for m, cond in reversed(sets) if all((row[c] or "").lower() in vs for c, vs in cond.items())), None)
        assert row.WARNING == want
        hits += want is not None
    assert hits > 100


def test_odd_rules(spark):
    terms = spark.createDataFrame([(1, "a", None), (2, "b", "c"), (3, None, None)], "i long, A string, B string")
    rules = spark.createDataFrame([(1, "m", "A", "a"), (2, "n", "A", "b"), (2, "n", "nowhere", "c"), (3, "o", "A", None), (4, "p", "B", "x")], "seq long, message string, col string, value string")
    assert [r.WARNING for r in add_warning_table(terms, rules).orderBy("i").collect()] == ["m", None, None]
    assert [r.WARNING for r in add_warning_table(terms, rules.where("false")).collect()] == [None] * 3
    assert add_warning_table(terms.where("false"), rules).collect() == []
    assert [r.W for r in add_warning_table(terms, rules.where("col = 'nowhere'"), "W").collect()] == [None] * 3
    extra = terms.withColumns({"seq": F.lit("x"), "col": F.lit("x"), "value": F.lit("x"), "message": F.lit("x")})
    assert [r.WARNING for r in add_warning_table(extra, rules).orderBy("i").collect()] == ["m", None, None]
