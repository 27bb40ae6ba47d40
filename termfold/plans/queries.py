"""One query per operator and class profile, over the tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold.functions.text import class_key, head, like_any, suffix
from termfold.operators import classes as C
from termfold.operators import columns as K
from termfold.operators import expectations as E
from termfold.operators import joins as J
from termfold.operators.coarsen import apply_rules, duplicate
from termfold.operators.conjunctions import add_warning_table
from termfold.operators.patterns import default_group_table, skip_pattern_table
from termfold.operators.rules import assign, groups, rules_of
from termfold.plans import fixed_values as V
from termfold.plans import legacy, pipeline
from termfold.plans.profiles import BY_NAME, PROFILES, all_rules
from termfold.operators.staging import new_path
from termfold.sources.released import read_released
from termfold.sources.results import SECTIONS, read_report, read_sheet, write_reports
from termfold.sources.rulebook import apply_rule_table, rule_hits
from termfold.sources.sample import Sample
from termfold.sources.terms import class_subset

PRIORITY_GROUPS = {"Soon": ["1-urgent", "2-HIGH "], "Later": ["3-MEDIUM", "5-LOW"]}
TYPE_GROUPS = {"Big": ["LARGE", "medium"], "Other": {"default": True, "skipPatterns": ["promo%", "%CON%"]},
               "Small": ["SMALL"]}
DEFAULT_GROUPS = {"Other": {"default": True, "skipPatterns": ["Virus%", "%sat[u]ration"]},
                  "G1": ["Glucose", "C peptide"], "G2": ["Ammonia"]}
# Twelve conditions, each unknown for a remainder of 1, and what they allow: every group may lead to the next.
GATES = {f"part{k:02}": f"nullif(l_partkey % {k}, 1) = 0" for k in range(2, 14)}
GATED = [(("!" if i % 2 else "") + gate, f"Flag {i}", ["A", "N", f"flag {i - 1}"]) for i, gate in enumerate(GATES)]
UNGATED = {"End": ["R", "Flag 7"]}


def lookups(s: Sample) -> pipeline.Lookups:
    return pipeline.Lookups(s.detail, s.part, s.weights)


def mappings(s: Sample) -> legacy.Mappings:
    return legacy.Mappings(s.mapping("system"), s.mapping("property"), s.mapping("method"), s.groupers, s.detail)


def class_subset_q(s: Sample) -> DataFrame:
    return class_subset(s.terms, ["HEM/BC"])


def rule_table_q(s: Sample) -> DataFrame:
    sources = {revised: source for p in PROFILES for revised, source in p.copies().items()
               if revised != "COMPONENT_HATLESS"}
    return rule_hits(pipeline.tag(s.terms, PROFILES), all_rules(), sources)


def dup_column_q(s: Sample) -> DataFrame:
    return K.dup_column(s.terms.select("LOINC_NUM", "SYSTEM"), "SYSTEM", "SYSTEM_COPY")


def hatless_q(s: Sample) -> DataFrame:
    return K.hatless(s.terms.select("LOINC_NUM", "COMPONENT"), "COMPONENT")


def head_suffix_q(s: Sample) -> DataFrame:
    return s.terms.select("LOINC_NUM", head("METHOD_TYP").alias("head"), suffix("METHOD_TYP").alias("suffix"))


def apply_group_q(s: Sample) -> DataFrame:
    return K.apply_group(s.terms.select("LOINC_NUM", "COMPONENT", "SYSTEM"), "SYSTEM",
                         ["BldA", "bldv", "Ser/Plas"], "Changed", F.col("COMPONENT").ilike("Oxygen%"))


def apply_groups_q(s: Sample) -> DataFrame:
    return K.apply_groups(s.table("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", PRIORITY_GROUPS)


def default_group_q(s: Sample) -> DataFrame:
    return K.apply_groups(s.terms.select("LOINC_NUM", "COMPONENT"), "COMPONENT", DEFAULT_GROUPS)


def skip_patterns_q(s: Sample) -> DataFrame:
    return K.skip_patterns(s.table("part").select("p_partkey", "p_name"), "p_name", ["RED%", "%bolt", "s_all%"], "Plain")


def skip_values_q(s: Sample) -> DataFrame:
    return K.skip_values(s.table("events").select("event_id", "event_type"), "event_type", ["CLICK", "view "], "Event-Other")


def dup_and_group_q(s: Sample) -> DataFrame:
    return K.dup_and_group(s.table("part").select("p_partkey", "p_type"), "p_type", TYPE_GROUPS)


def gated_group_q(s: Sample) -> DataFrame:
    df = duplicate(s.terms.select("LOINC_NUM", "COMPONENT", "SYSTEM"), {"SYSTEM_REV": "SYSTEM"})
    df = K.hatless(df, "COMPONENT")
    steps = [groups("SYSTEM", {"Intravascular-any": V.SHARED_SYSTEM["Intravascular-any"]}, gate="!oxygen"),
             groups("SYSTEM", V.CHEM_SYSTEM_OXYGEN, gate="oxygen")]
    return apply_rules(df, rules_of("", steps), pipeline.gates({"oxygen"})).drop("COMPONENT_HATLESS")


def many_gates_q(s: Sample) -> DataFrame:
    """A column under twelve gates, whose states would be half a million."""
    df = duplicate(s.table("lineitem").select("l_orderkey", "l_partkey", "l_returnflag"), {"l_returnflag_REV": "l_returnflag"})
    steps = [groups("l_returnflag", {group: values}, gate=gate) for gate, group, values in GATED]
    return apply_rules(df, rules_of("", [*steps, groups("l_returnflag", UNGATED)]), {name: F.expr(cond) for name, cond in GATES.items()})


def rast_gate_q(s: Sample) -> DataFrame:
    rast = like_any("COMPONENT", V.RAST_PATTERNS)
    df = K.dup_column(s.terms.select("LOINC_NUM", "COMPONENT", "SCALE_TYP"), "SCALE_TYP", "SCALE_REV")
    return K.apply_groups(df, "SCALE_REV", V.SHARED_SCALE, ~rast)


def antibody_null_method_q(s: Sample) -> DataFrame:
    df = K.dup_column(s.terms.select("LOINC_NUM", "COMPONENT", "METHOD_TYP"), "METHOD_TYP", "METHOD_REV")
    return apply_rules(df, rules_of("", [assign("METHOD_TYP", V.ANTIBODY_GROUP, "antibody_without_method")]),
                       pipeline.gates({"antibody_without_method"}))


def std_components_q(s: Sample) -> DataFrame:
    return J.components_like(s.terms, s.detail, V.MICRO_STD_CORE_PATTERNS).select("COMPONENT")


def micro_std_system_q(s: Sample) -> DataFrame:
    listed = J.components_like(s.terms, s.detail, V.MICRO_STD_CORE_PATTERNS)
    df = J.flag_components(s.terms.select("LOINC_NUM", "COMPONENT", "SYSTEM"), listed, "std")
    df = K.dup_column(df, "SYSTEM", "SYSTEM_REV")
    return K.apply_groups(df, "SYSTEM_REV", V.MICRO_SYSTEM_STD, F.col("std"))


def class_key_q(s: Sample) -> DataFrame:
    return s.terms.select("LOINC_NUM", class_key(["COMPONENT", "PROPERTY", "SYSTEM", "METHOD_TYP"]).alias(C.KEY))


def report_columns_q(s: Sample) -> DataFrame:
    df = pipeline.coarsen(s.terms, [BY_NAME["DRUGTOX"]], lookups(s))
    return df.select(*C.report_columns(df))


def df_units_q(s: Sample) -> DataFrame:
    return C.set_units(s.terms.select("LOINC_NUM", "PROPERTY", "EXAMPLE_UCUM_UNITS"), V.CHEM_DF_PROPERTIES, V.CHEM_DF_UNITS)


def warnings_q(s: Sample) -> DataFrame:
    return C.add_warnings(s.terms.select("LOINC_NUM", "COMPONENT", "SYSTEM"), V.CHEM_WARNINGS)


def molecular_weights_q(s: Sample) -> DataFrame:
    return J.add_molecular_weights(s.terms.select("LOINC_NUM", "COMPONENT"), s.part, s.weights)


def mapping_table_group_q(s: Sample) -> DataFrame:
    df = K.dup_column(s.terms.select("LOINC_NUM", "METHOD_TYP"), "METHOD_TYP", "METHOD_REV")
    return J.mapping_table_group(df, "METHOD_REV", s.mapping("method"), "Method_Rev")


def legacy_system_override_q(s: Sample) -> DataFrame:
    df = K.dup_column(s.terms.select("LOINC_NUM", "COMPONENT", "SYSTEM"), "SYSTEM", "SYSTEM_REV")
    df = J.mapping_table_group(df, "SYSTEM_REV", s.mapping("system"), "System_Rev_1")
    return J.override_by_core(df, "SYSTEM", "SYSTEM_REV", s.mapping("system"), "System_Rev_2", s.detail, s.groupers)


def keyed(s: Sample) -> DataFrame:
    """All terms keyed by three attributes as they are."""
    return s.terms.select("LOINC_NUM", class_key(["COMPONENT", "PROPERTY", "SCALE_TYP"]).alias(C.KEY))


def class_counts_q(s: Sample) -> DataFrame:
    return C.add_class_counts(keyed(s), []).drop(C.CLASS)


def multi_member_q(s: Sample) -> DataFrame:
    return C.add_class_counts(keyed(s), []).where(F.col(C.COUNT) > 1).select("LOINC_NUM", C.KEY)


def heading_rows_q(s: Sample) -> DataFrame:
    return C.heading_rows(C.class_sizes(keyed(s), [])).drop(C.CLASS, C.COUNT)


def blank_rows_q(s: Sample) -> DataFrame:
    return C.blank_rows(C.class_sizes(keyed(s), [])).drop(C.CLASS, C.COUNT)


def report_q(s: Sample) -> DataFrame:
    """A user's own class run: an edit function and a key."""
    def edit(df: DataFrame) -> DataFrame:
        return K.dup_and_group(df, "SYSTEM", {"Blood": V.SHARED_SYSTEM["Bld-any"]})
    return pipeline.run_edited(s.terms, "RAD", ["COMPONENT", "SYSTEM_REV"], edit)


def legacy_report_q(s: Sample) -> DataFrame:
    """The older report over all terms, keyed by attributes as they are."""
    df = duplicate(s.terms, {"PROPERTY_REV": "PROPERTY", "SYSTEM_REV": "SYSTEM", "METHOD_REV": "METHOD_TYP"})
    return legacy.legacy_report(df.withColumn(C.KEY, class_key(["COMPONENT", "PROPERTY_REV"])))


def class_micro_legacy_q(s: Sample) -> DataFrame:
    return legacy.legacy_report(legacy.legacy_coarsen(s.terms, mappings(s)))


def rule_table_apply_q(s: Sample) -> DataFrame:
    """A rule table as long as the supplier table; some groups are values of later rules."""
    rules = s.table("supplier").selectExpr(
        "s_suppkey AS seq", "concat('ANALYTE ', s_suppkey, ' ') AS value",
        "CASE WHEN s_suppkey % 3 = 0 THEN concat('Analyte ', s_suppkey + 1, '^next') ELSE concat('Nation ', s_nationkey) END AS grp")
    return apply_rule_table(s.terms.select("LOINC_NUM", "COMPONENT"), "COMPONENT", rules)


def component_patterns(s: Sample) -> DataFrame:
    """A pattern for each supplier: with wildcards at either end, in the middle, or none."""
    return s.table("supplier").selectExpr(
        "CASE s_suppkey % 4 WHEN 0 THEN concat('%nalyte ', s_suppkey) WHEN 1 THEN concat('ANALYTE ', s_suppkey, '_') "
        "WHEN 2 THEN concat('An%te ', s_suppkey, '%') ELSE concat('analyte ', s_suppkey) END AS pattern")


def pattern_table_q(s: Sample) -> DataFrame:
    """As many patterns as there are suppliers; components like none of them are grouped."""
    return skip_pattern_table(s.terms.select("LOINC_NUM", "COMPONENT"), "COMPONENT", component_patterns(s), "Component-Other")


def default_group_table_q(s: Sample) -> DataFrame:
    """The default group beside as many groups as there are suppliers."""
    siblings = s.table("supplier").selectExpr("CASE WHEN s_suppkey % 5 = 0 THEN concat('Anal_te ', s_suppkey) ELSE concat('ANALYTE ', s_suppkey, ' ') END AS grp")
    return default_group_table(s.terms.select("LOINC_NUM", "COMPONENT"), "COMPONENT", siblings, s.table("region").selectExpr("concat('%', substring(r_name, 1, 2), '%') AS pattern"), "Component-Other")


def warning_table_q(s: Sample) -> DataFrame:
    """Rules of two columns, one for each supplier."""
    systems = F.expr("element_at(array('Ser', 'ser/plas ', 'Urine', 'BldA', 'Stool', 'CSF'), CAST(1 + s_suppkey % 6 AS INT))")
    other = F.expr("element_at(array('Bld', 'Plas', 'BldV', 'BldC'), CAST(1 + s_suppkey % 4 AS INT))")
    one, two = F.expr("concat('analyte ', s_suppkey % 40)"), F.expr("concat('Analyte ', s_suppkey % 7, ' ')")
    cell = lambda c, v: F.struct(F.lit(c).alias("col"), v.alias("value"))
    rules = s.table("supplier").select(
        F.col("s_suppkey").alias("seq"), F.concat(F.lit("warning "), F.col("s_suppkey")).alias("message"),
        F.inline(F.array(cell("SYSTEM", systems), cell("SYSTEM", other), cell("COMPONENT", one), cell("COMPONENT", two))))
    return add_warning_table(s.terms.select("LOINC_NUM", "COMPONENT", "SYSTEM"), rules)


def report_output_q(s: Sample) -> DataFrame:
    """All classes written in one job, one of them replaced, and the current output read back."""
    path = new_path(s.spark)
    write_reports(s.terms, path, PROFILES, lookups(s))
    write_reports(s.terms, path, [BY_NAME["UA"]])
    return read_report(s.spark, path)


def sheet_rows_q(s: Sample) -> DataFrame:
    """Place of each row in the sheets of one class, as they are written."""
    path = new_path(s.spark)
    write_reports(s.terms, path, [BY_NAME["CELLMARK"]])
    sheets = [read_sheet(s.spark, path, "CELLMARK", section).withColumn("section", F.lit(section)) for section in SECTIONS]
    return pipeline.together(sheets).select("section", "row_number", "row_kind", "Heading", "LOINC_NUM", "SORT_ORDER")


def expectations_q(s: Sample) -> DataFrame:
    """Rows of the terms that do not meet what is expected of them."""
    return E.failures(s.terms, [
        E.filled("LOINC_NUM"), E.filled("COMPONENT"), E.listed("CLASS", [p.class_value for p in PROFILES]),
        E.within(E.filled("METHOD_TYP"), F.col("CLASS") == "MICRO"), E.Expectation("unit with a number", F.col("EXAMPLE_UCUM_UNITS").rlike("[0-9]"))])


def unmatched_keys_q(s: Sample) -> DataFrame:
    """Components of the terms without a part of that name."""
    return E.unmatched(s.terms, "COMPONENT", s.part, "PART")


def repeated_keys_q(s: Sample) -> DataFrame:
    """Attributes that several terms share."""
    return E.repeated(s.terms, ["SYSTEM", "PROPERTY", "SCALE_TYP"])


def released_rows_q(s: Sample) -> DataFrame:
    """The part table as lines of a CSV file, some of them spoilt, read back: good rows, and the lines set aside."""
    path = new_path(s.spark)
    s.table("part").selectExpr(
        "CASE p_partkey % 10 WHEN 3 THEN concat(p_partkey, ',', p_name) WHEN 5 THEN concat(p_partkey, ',\"', p_name, ',', p_size) "
        "WHEN 7 THEN concat(p_partkey, ',', p_name, ',size') WHEN 9 THEN concat(',', p_name, ',', p_size) "
        "ELSE concat(p_partkey, ',\"', p_name, ', \"\"', p_brand, '\"\"\",', p_size) END AS line").write.text(path)
    got = read_released(s.spark, path, "p_name string, p_partkey long, p_size int", ["p_partkey"], ["p_partkey", "p_name", "p_size"])
    return got.rows.unionByName(got.quarantine.select("record", "problem"), allowMissingColumns=True)


def long_keys_q(s: Sample) -> DataFrame:
    """Keys longer than the 255 characters that a key column used to hold, by class; none is cut."""
    keyed = [pipeline.key_terms(s.terms, family, lookups(s)).select("profile", C.KEY) for family in pipeline.families(s.terms, PROFILES)]
    length = F.length(C.KEY)
    return pipeline.together(keyed).groupBy("profile").agg(
        F.count(F.when(length > 255, 1)).alias("long_keys"), F.max(length).cast("long").alias("longest"))


def all_classes_q(s: Sample) -> DataFrame:
    return pipeline.run(s.terms, PROFILES, lookups(s))


def _class_query(name: str):
    needs = any(r.gate == "std" for r in BY_NAME[name].rule_list()) or BY_NAME[name].weights

    def query(s: Sample) -> DataFrame:
        return pipeline.run(s.terms, [BY_NAME[name]], lookups(s) if needs else pipeline.Lookups())
    return query


SAMPLE_QUERIES = {
    name[:-2]: q for name, q in list(globals().items()) if name.endswith("_q") and callable(q)
} | {f"class_{name.lower()}": _class_query(name) for name in BY_NAME}


def queries() -> dict:
    def bind(q):
        return lambda spark, sf_dir: q(Sample(spark, sf_dir))
    return {name: bind(q) for name, q in SAMPLE_QUERIES.items()}
