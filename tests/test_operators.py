"""Operators on small hand-made tables, and worked examples of the class profiles."""

import pytest
from pyspark.sql import functions as F

from termfold.functions.text import class_key, like, revised_name, suffix, working_name
from termfold.operators import classes as C
from termfold.operators import columns as K
from termfold.operators import joins as J
from termfold.operators import rules as R
from termfold.plans import pipeline
from termfold.operators import staging
from termfold.plans.profiles import BY_NAME, PROFILES, Profile, all_rules, allergy
from termfold.sources import rulebook
from termfold.sources.terms import TERM_SCHEMA, read_table, require_columns, require_table

ROWS = [("Red paint", "North"), ("Red paint^matt", "South "), ("Blue ink", "south"), ("Chalk", "West")]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "COMPONENT string, SYSTEM_REV string")


def column(df, name):
    return {r[0]: r[1] for r in df.select("COMPONENT", name).collect()}


def test_apply_group_with_condition(spark):
    out = K.apply_group(table(spark), "SYSTEM_REV", ["north", "South"], "Pole", F.col("COMPONENT").ilike("red%"))
    assert list(column(out, "SYSTEM_REV").values()) == ["Pole", "Pole", "south", "West"]


def test_apply_group_without_values_changes_nothing(spark):
    df = table(spark)
    assert K.apply_group(df, "SYSTEM_REV", [], "Pole") is df


def test_dup_column(spark):
    df = spark.createDataFrame([("a",), (None,)], "s string")
    assert [tuple(r) for r in K.dup_column(df, "s", "t").collect()] == [("a", "a"), ("", "")]


def test_apply_groups_with_default(spark):
    rows = ROWS + [("Glue", "East"), ("Tape", "East")]
    spec = {"Rest": {"default": True, "skipPatterns": ["BLUE%"]}, "Wet": ["red paint", "Chalk "], "Dry": ["Tape"]}
    df = K.dup_column(table(spark, rows), "COMPONENT", "COMPONENT_REV")
    out = column(K.apply_groups(df, "COMPONENT_REV", spec), "COMPONENT_REV")
    assert list(out.values()) == ["Wet", "Wet^matt", "Blue ink", "Wet", "Rest", "Dry"]


def test_hatless_and_suffix(spark):
    df = spark.createDataFrame([("a^b^c",), ("a",), ("^x",), ("a^b   ",), (None,)], "s string")
    assert [r.s_HATLESS for r in K.hatless(df, "s").collect()] == ["a", "a", "", "a", ""]
    assert [r[0] for r in df.select(suffix("s")).collect()] == ["^b^c", "", "^x", "^b ", None]


def test_like_with_bracket_set(spark):
    df = spark.createDataFrame([("Virus Ab",), ("Virus+ag.x",), ("VirusAb",), ("Virus Ac",), ("a\\b",)], "s string")
    got = [r[0] for r in df.select(like("s", "%[+. ]A[bg]") | like("s", "%[+. ]A[bg][+. ]%")).collect()]
    assert got == [True, True, False, False, False]
    assert [r[0] for r in df.select(like("s", "a\\%")).collect()][-1] is True
    assert [r[0] for r in df.select(like("s", "%[^b-z]b")).collect()][0] is True


def test_class_key_keeps_empty_parts(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(class_key(["x", "y", "z"])).first()[0] == "a||c"


def test_names():
    assert [revised_name(c) for c in ("METHOD_TYP", "TIME_ASPCT", "SYSTEM")] == ["METHOD_REV", "TIME_REV", "SYSTEM_REV"]
    assert working_name("HEM/BC") == "HEMBC"


@pytest.mark.parametrize("spec, gate", [
    ({"Other": {"skip": ["a"]}}, None),
    ({"Other": {"default": True}}, None),
    ({"Other": {"default": True, "skipPatterns": ["a%"]}}, "g"),
    ({"A": {"default": True, "skipPatterns": ["a%"]}, "B": {"default": True, "skipPatterns": ["b%"]}}, None),
])
def test_wrong_specifications_raise(spec, gate):
    with pytest.raises(ValueError):
        R.groups("SYSTEM", spec, gate)


def test_rules_survive_their_long_form(spark):
    rules = all_rules()
    assert rulebook.read_rules(rulebook.rule_table(spark, rules)) == sorted(rules, key=lambda r: (r.profile, r.seq))


def test_rules_can_be_read_from_json(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"SYSTEM": {"G": ["a", "b"]}}')
    step = R.groups("SYSTEM", rulebook.read_spec(str(path))["SYSTEM"])
    assert R.rules_of("Y", [step]) == [R.Rule("Y", "SYSTEM_REV", 0, "eq", "G", ("a", "b"))]


def test_profiles_hold_so_many_rules():
    """Facts of the profiles that do not come from the value lists."""
    equal = [r for r in all_rules() if r.kind == R.EQ]
    count = lambda p, t: sum((r.profile, r.target) == (p, t) for r in equal)
    assert (count("MICRO", "METHOD_REV"), len({r.profile for r in all_rules()})) == (34, 13)


def test_long_rule_table_equals_rules_one_by_one(spark):
    """150,000 rows, some of them chained; the driver sees none of them."""
    n = 150_000
    rules = spark.range(n).selectExpr("id AS seq", "concat('V', id % 140000) AS value",
                                      "CASE WHEN id % 7 = 0 THEN concat('v', (id + 1) % 140000, '^z') ELSE concat('G', id % 11) END AS grp")
    names = [f"v{i}^p" if i % 2 else f" V{i}"[1:] + " " for i in range(0, n, 1501)] + ["x", "", None]
    df = spark.createDataFrame([(x,) for x in names], "a string").withColumn("b", F.col("a"))
    got = {r.a: r.b for r in rulebook.apply_rule_table(df, "b", rules).collect()}
    listed = {}
    for i in range(n):
        listed.setdefault(f"v{i % 140000}", []).append((i, f"v{(i + 1) % 140000}^z" if i % 7 == 0 else f"G{i % 11}"))
    for name in names:
        text, last = name, -1
        while text is not None:
            head, hat, parts = text.partition("^")
            step = next(((s, g) for s, g in listed.get(head.rstrip(" ").lower(), []) if s > last), None)
            if step is None:
                break
            last, text = step[0], step[1] + hat + parts
        assert got[name] == text


def test_a_run_without_its_tables_says_so(spark):
    terms = spark.createDataFrame([term("CHEM")], TERM_SCHEMA)
    with pytest.raises(ValueError, match="part is missing"):
        pipeline.run(terms, [BY_NAME["CHEM"]])
    with pytest.raises(ValueError, match="detail is missing"):
        pipeline.run(terms, [BY_NAME["MICRO"]])
    with pytest.raises(ValueError, match="terms lacks SYSTEM"):
        pipeline.run(terms.drop("SYSTEM"), [BY_NAME["UA"]])
    with pytest.raises(ValueError, match="ALLERGY"):
        pipeline.run(terms, [allergy(), allergy(strict=False)])
    with pytest.raises(ValueError, match="numPartitions"):
        read_table(spark, "", "jdbc", url="jdbc:none")


def test_more_profiles_than_share_a_pass(spark):
    many = [Profile(f"C{i}", ("COMPONENT", "SYSTEM_REV"), (R.groups("SYSTEM", {f"G{i}": ["a"]}),)) for i in range(70)]
    rows = [term(f"c{i}", f"n{i}", COMPONENT="x", SYSTEM="A") for i in range(70)]
    out = pipeline.run(spark.createDataFrame(rows, TERM_SCHEMA), many)
    got = {r.profile: r.EQUIV_CLS for r in out.where("LOINC_NUM IS NOT NULL").collect()}
    assert got == {f"C{i}": f"x|G{i}" for i in range(70)}


def test_few_listed_numbers_are_broadcast(spark, monkeypatch):
    terms = spark.createDataFrame([("1", "a"), (None, "b"), ("2", "c")], "LOINC_NUM string, COMPONENT string")
    detail = spark.createDataFrame([("1", "ax"), (None, "ax"), ("2", "y")], "LOINC_NUM string, COMPONENTCORE string")
    for size, join in ((64 << 20, "BroadcastHashJoin"), (-1, "SortMergeJoin")):
        monkeypatch.setattr(staging, "BROADCAST_BYTES", size)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            out = J.components_like(terms, detail, ["a%"])
            text = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
            assert join in text and [r.COMPONENT for r in out.collect()] == ["a"]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("words", [1, 64, 1 << 18])
def test_key_filter_loses_no_key(spark, monkeypatch, words):
    """All listed keys pass, of the others the stated share; hot, repeated and null keys too; nothing from an empty list."""
    monkeypatch.setattr(J, "FILTER_WORDS", words)
    keys = spark.range(500).select(F.concat(F.lit("k"), F.col("id") * 7).alias("k")).union(spark.createDataFrame([(None,), ("k0",)], "k string"))
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit("k7")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.lit("clash").alias("bits"))
    found = J.key_filter(keys, "k")
    assert found.count() <= words
    passed, share = J.prefiltered(rows, found, "k"), J.passed_share(found)
    assert passed.columns == rows.columns
    matches, known = rows.join(keys.distinct(), "k", "left_semi").count(), rows.where("k IS NOT NULL").count()
    assert passed.join(keys.distinct(), "k", "left_semi").count() == matches
    extra = (passed.count() - matches) / (known - matches)
    assert abs(extra - share) < 0.02 and (share < 0.001) == (words == 1 << 18)
    assert J.prefiltered(rows, J.key_filter(keys.where("false"), "k"), "k").count() == 0


def test_only_terms_that_pass_the_filter_are_shuffled(spark, monkeypatch):
    terms = spark.range(5000).select(F.col("id").cast("string").alias("LOINC_NUM"), F.concat(F.lit("c"), F.col("id") % 900).alias("COMPONENT"))
    detail = spark.range(5000).select(F.col("id").cast("string").alias("LOINC_NUM"), F.when(F.col("id") % 100 == 0, "ab").otherwise("x").alias("COMPONENTCORE"))
    want = sorted(map(tuple, J.components_like(terms, detail, ["a%"]).collect()))
    shuffled, plain = [], J.prefiltered

    def counted(*args):
        out = plain(*args)
        shuffled.append(out.count())
        return out

    monkeypatch.setattr(J, "prefiltered", counted)
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, J.components_like(terms, detail, ["a%"]).collect())) == want and len(want) == 9
    assert len(shuffled) == 1 and 50 <= shuffled[0] <= 55


def test_lint_lists_dead_values():
    found = {(p, v) for p, _, _, v, _ in R.lint(all_rules())}
    assert {("MICRO", "SerPl^bpu"), ("MICRO", "Bld^donor"), ("MOLPATH", "Tiss^Fetus"), ("MICRO", "Neisser stain")} <= found


def test_missing_inputs_raise(spark):
    with pytest.raises(ValueError, match="missing"):
        require_table(spark, "no_such_weights", ["PartNum"])
    with pytest.raises(ValueError, match="lacks TYPE"):
        require_columns(spark.createDataFrame([("a",)], "PART string"), "part", ["PART", "TYPE"])


# --- worked examples ---------------------------------------------------------

def term(cls, number="1-0", **attributes):
    row = {f.name: None for f in TERM_SCHEMA} | {"LOINC_NUM": number, "CLASS": cls} | attributes
    return tuple(row[f.name] for f in TERM_SCHEMA)


def coarse(spark, cls, profile=None, core=None, part=(), weights=(), **attributes):
    terms = spark.createDataFrame([term(cls, **attributes)], TERM_SCHEMA)
    lookups = pipeline.Lookups(
        spark.createDataFrame([("1-0", core)], "LOINC_NUM string, COMPONENTCORE string"),
        spark.createDataFrame(list(part), "PART string, PART_NUM string, TYPE int"),
        spark.createDataFrame(list(weights), "PartNum string, Molecular_weight_COMBINED double"),
    )
    profile = profile or next(p for p in PROFILES if p.class_value == cls)
    return pipeline.coarsen(terms, [profile], lookups).first().asDict()


EXAMPLES = [
    ("CHEM", dict(COMPONENT="Glucose", PROPERTY="SCnt", TIME_ASPCT="24h", SYSTEM="Ser/Plas"),
     "Glucose|MCntSCnt|TimedSpecimen|Intravascular-any|Method-Other"),
    ("CHEM", dict(COMPONENT="Oxygen saturation^during apnea", PROPERTY="MFr", TIME_ASPCT="Pt", SYSTEM="BldA"),
     "Oxygen saturation^during apnea|MFrSFr|Pt|Arterial*|Method-Other"),
    ("CHEM", dict(COMPONENT="Oxygen saturation", PROPERTY="SFr.DF", TIME_ASPCT="Pt", SYSTEM="Ser/Plas",
                  METHOD_TYP="Detection limit <= 5"),
     "Oxygen saturation|MFrSFr|Pt|Ser/Plas|Detection limit <= 5"),
    ("SERO", dict(COMPONENT="Virus Ab", PROPERTY="Titr", SYSTEM="Ser"),
     "Virus Ab|PrThrTitrACnc|Intravascular-any|IA-IF-Null*"),
    ("SERO", dict(COMPONENT="x", METHOD_TYP="Aggl.cord RBC^x"), "x|||Aggl^x"),
    ("SERO", dict(COMPONENT="x", METHOD_TYP="Foo 4 deg C"), "x|||Foo 4 deg C"),
    ("SERO", dict(COMPONENT="x", METHOD_TYP="Foo"), "x|||Method-Other"),
    ("MICRO", dict(COMPONENT="Chlamydia trachomatis", core="Chlamydia trachomatis", SYSTEM="Stool"),
     "Chlamydia trachomatis||AnalRectalStool|"),
    ("MICRO", dict(COMPONENT="Virus", core="Virus", SYSTEM="Stool"), "Virus||Stool|"),
    ("MICRO", dict(COMPONENT="Virus", SYSTEM="Bld^donor"), "Virus||Intravascular-any^donor|"),
    ("MOLPATH", dict(COMPONENT="x", SYSTEM="Tiss^Fetus"), "x|Tiss^Fetus"),
    ("MOLPATH", dict(COMPONENT="x", SYSTEM="Bone mar"), "x|Bld"),
    ("ABXBACT", dict(COMPONENT="x", SCALE_TYP="Ord"), "x|Scale-Other|Method-Other"),
    ("ABXBACT", dict(COMPONENT="x", SCALE_TYP="Nom"), "x|Nom|Method-Other"),
    ("ALLERGY", dict(COMPONENT="x", SCALE_TYP="Ord"), "x|||Ord"),
    ("DRUG/TOX", dict(COMPONENT="x", SCALE_TYP="Ord"), "x||||OrdNomNarDoc|Method-Other"),
    ("HEM/BC", dict(COMPONENT="x", SYSTEM="bldcoA "), "x||BLdCo-any"),
]


@pytest.mark.parametrize("cls, attributes, key", EXAMPLES)
def test_worked_examples(spark, cls, attributes, key):
    assert coarse(spark, cls, **attributes)["EQUIV_CLS"] == key


def test_chem_units_weight_and_warning(spark):
    got = coarse(
        spark, "CHEM", COMPONENT="Ammonia", SYSTEM="Ser", PROPERTY="MFr.DF", EXAMPLE_UCUM_UNITS="mg",
        part=[("ammonia", "LP2", 1), ("Ammonia", "LP1", 1), ("Ammonia", "LP0", 2)],
        weights=[("lp1 ", 17.0), ("LP2", 18.0), ("LP0", 19.0)],
    )
    assert (got["EXAMPLE_UCUM_UNITS"], got["MOLECULAR_WEIGHT"]) == ("%/100", 17.0)
    assert got["WARNING"].startswith("Most labs report Ammonia in")


def test_allergy_variant_groups_the_scale(spark):
    assert coarse(spark, "ALLERGY", allergy(strict=False), COMPONENT="x", SCALE_TYP="Ord")["SCALE_REV"] == "OrdNomNarDoc"
    for component in ("RAST x", "a.rast", None):
        got = coarse(spark, "ALLERGY", allergy(strict=False), COMPONENT=component, SCALE_TYP="Ord")
        assert got["SCALE_REV"] == "Ord"


def test_later_warning_wins(spark):
    df = spark.createDataFrame([("a",), ("b ",)], "c string")
    out = C.add_warnings(df, [("first", {"c": ["A", "b"]}), ("second", {"c": ["B"]})])
    assert [r.WARNING for r in out.collect()] == ["first", "second"]


def test_mapping_table_takes_whole_values(spark):
    df = spark.createDataFrame([("Bld",), ("bld ",), ("Bld^x",), ("y",)], "SYSTEM string")
    mapping = spark.createDataFrame([("BLD", "Blood"), ("y", None)], "Name string, G string")
    out = J.mapping_table_group(df, "SYSTEM", mapping, "G")
    assert sorted(r[0] for r in out.collect()) == ["Bld^x", "Blood", "Blood", "y"]


def test_stream_of_terms_takes_the_same_steps(spark, tmp_path):
    path = str(tmp_path / "terms")
    rows = [term("UA", str(i), COMPONENT="x", SYSTEM="Urine" if i % 2 else "y") for i in range(4)]
    spark.createDataFrame(rows, TERM_SCHEMA).write.parquet(path)
    stream = pipeline.key_terms(spark.readStream.schema(TERM_SCHEMA).parquet(path), [BY_NAME["UA"]])
    query = stream.writeStream.format("memory").queryName("ua_terms").start()
    query.processAllAvailable()
    query.stop()
    got = sorted(r.EQUIV_CLS for r in spark.table("ua_terms").collect())
    assert got == ["x||UrUrnS"] * 2 + ["x||y"] * 2
