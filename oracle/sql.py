"""The same results in SQL, one step per rule, without the folded lookup.

Every group is a CASE step of its own, in rule order, so that a comparison also
checks how the rules are folded on the driver.
"""

from __future__ import annotations

import itertools

from termfold.plans import fixed_values as V
from termfold.plans import queries as Q
from termfold.sources import sample as S

SECTIONS = [(V.SECTION_MULTI, "cnt > 1"), (V.SECTION_ALL, "true")]


def q(text) -> str:
    return "NULL" if text is None else "'" + str(text).replace("'", "''") + "'"


def n(x: str) -> str:
    return f"lower(rtrim({x}, ' '))"


def h(x: str) -> str:
    return f"split_part({x}, '^', 1)"


def suf(x: str) -> str:
    return f"CASE WHEN strpos({x}, '^') > 0 THEN substr({x}, strpos({x}, '^'), length(rtrim({x}, ' '))) ELSE '' END"


def inn(x: str, values) -> str:
    return f"{n(x)} IN ({', '.join(q(v.rstrip(' ').lower()) for v in values)})"


def regroup(group: str, c: str) -> str:
    return f"concat({q(group)}, {suf(c)})"


def likes(x: str, patterns) -> str:
    return "(" + " OR ".join(f"{x} ILIKE {q(p)}" for p in patterns) + ")"


ANTIBODY = "regexp_matches(COMPONENT, '(?is)[+. ]A[bg]($|[+. ])')"
BLANK_METHOD = "rtrim(coalesce({0}, ''), ' ') = ''"


class Chain:
    """A chain of CTEs, each a SELECT over the one before."""

    def __init__(self, base: str, tables: str = ""):
        self.steps = [("s0", base)]
        self.tables = tables

    @property
    def last(self) -> str:
        return self.steps[-1][0]

    def add(self, select: str) -> "Chain":
        self.steps.append((f"s{len(self.steps)}", f"{select} FROM {self.last}"))
        return self

    def put(self, column: str, expr: str) -> "Chain":
        """Replace a column."""
        return self.add(f"SELECT * REPLACE ({expr} AS {column})")

    def new(self, column: str, expr: str) -> "Chain":
        return self.add(f"SELECT *, {expr} AS {column}")

    def dup(self, source: str, dest: str) -> "Chain":
        return self.put(source, f"coalesce({source}, '')").new(dest, source)

    def group(self, c: str, spec: dict, gate: str = "true") -> "Chain":
        for group, values in spec.items():
            self.put(c, f"CASE WHEN {inn(h(c), values)} AND ({gate}) THEN {regroup(group, c)} ELSE {c} END")
        return self

    def others(self, c: str, group: str, keep: str, gate: str = "true") -> "Chain":
        return self.put(c, f"CASE WHEN NOT ({keep}) AND ({gate}) THEN {regroup(group, c)} ELSE {c} END")

    def ctes(self) -> str:
        return ", ".join(filter(None, [self.tables, *[f"{name} AS ({sql})" for name, sql in self.steps]]))

    def sql(self, select: str = "*") -> str:
        return f"WITH {self.ctes()} SELECT {select} FROM {self.last}"


def values(columns, rows) -> str:
    listed = ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {listed}) AS v({', '.join(columns)})"


TERMS = f"terms AS ({S.terms_sql('duckdb')})"
DETAIL = f"detail AS ({S.detail_sql()})"
PART = f"part_names AS ({S.part_sql('duckdb')})"
WEIGHTS = f"part_values AS ({S.weights_sql()})"
GROUPERS = f"groupers AS ({S.groupers_sql()})"
MAPS = {
    name: f"map_{name} AS ({values(S.MAPPING_COLUMNS[name], rows)})" for name, rows in S.mapping_rows().items()
}
STD = f"""std_list AS (
  SELECT {n('t.COMPONENT')} AS k, min(t.COMPONENT) AS COMPONENT FROM terms t
  JOIN detail d ON {n('t.LOINC_NUM')} = {n('d.LOINC_NUM')}
  WHERE {likes('d.COMPONENTCORE', V.MICRO_STD_CORE_PATTERNS)} AND t.COMPONENT IS NOT NULL GROUP BY 1)"""
MW = f"""mw AS (
  SELECT k, w AS MOLECULAR_WEIGHT FROM (
    SELECT {n('p.PART')} AS k, v.Molecular_weight_COMBINED AS w,
           row_number() OVER (PARTITION BY {n('p.PART')} ORDER BY p.PART_NUM, v.Molecular_weight_COMBINED) AS r
    FROM part_names p LEFT JOIN part_values v ON {n('p.PART_NUM')} = {n('v.PartNum')} WHERE p.TYPE = 1) x
  WHERE r = 1)"""
ALL_TABLES = ", ".join([TERMS, DETAIL, PART, WEIGHTS, STD, MW])
ATTRIBUTES = ("LOINC_NUM, COMPONENT, PROPERTY, TIME_ASPCT, SYSTEM, SCALE_TYP, METHOD_TYP, CLASS, STATUS, CLASSTYPE, "
              "COMMON_TEST_RANK, COMMON_SI_TEST_RANK, COMMON_ORDER_RANK, EXAMPLE_UCUM_UNITS, LONG_COMMON_NAME")


def from_terms(columns: str = ATTRIBUTES, tables: str = TERMS) -> Chain:
    return Chain(f"SELECT {columns} FROM terms", tables)


def of_class(value: str, tables: str = TERMS) -> Chain:
    return Chain(f"SELECT {ATTRIBUTES} FROM terms WHERE {n('CLASS')} = {q(value.lower())}", tables)


def key(*columns: str) -> str:
    return " || '|' || ".join(f"coalesce({c}, '')" for c in columns)


IV = {"Intravascular-any": V.SHARED_SYSTEM["Intravascular-any"]}


def shared(*names: str) -> dict:
    return {g: V.SHARED_SYSTEM[g] for g in names}


# --- the classes ---------------------------------------------------------------

def abxbact(c: Chain) -> tuple:
    c.dup("SCALE_TYP", "SCALE_REV").others("SCALE_REV", "Scale-Other", inn(h("SCALE_REV"), ["Nom"]))
    c.dup("METHOD_TYP", "METHOD_REV").others("METHOD_REV", "Method-Other", inn(h("METHOD_REV"), V.ABXBACT_METHOD_KEPT))
    return ("COMPONENT", "SCALE_REV", "METHOD_REV")


def allergy(c: Chain) -> tuple:
    c.dup("PROPERTY", "PROPERTY_REV").group("PROPERTY_REV", V.ALLERGY_PROPERTY)
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", IV)
    c.dup("SCALE_TYP", "SCALE_REV")
    c.group("SYSTEM_REV", V.SHARED_SCALE, "COMPONENT NOT ILIKE 'RAST%' AND COMPONENT NOT ILIKE '%.RAST%'")
    return ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "SCALE_REV")


def cellmark(c: Chain) -> tuple:
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", IV)
    c.dup("SCALE_TYP", "SCALE_REV").group("SCALE_REV", V.SHARED_SCALE)
    return ("COMPONENT", "SYSTEM_REV", "SCALE_REV")


def chem(c: Chain, scale: bool = False) -> tuple:
    c.dup("PROPERTY", "PROPERTY_REV").group("PROPERTY_REV", V.CHEM_PROPERTY)
    c.put("EXAMPLE_UCUM_UNITS", f"CASE WHEN {inn('PROPERTY', V.CHEM_DF_PROPERTIES)} THEN '%/100' ELSE EXAMPLE_UCUM_UNITS END")
    c.dup("TIME_ASPCT", "TIME_REV").group("TIME_REV", V.CHEM_TIME)
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", shared("DuodGastricFld", "OcularVitrFld"))
    c.dup("COMPONENT", "COMPONENT_HATLESS").put("COMPONENT_HATLESS", h("COMPONENT_HATLESS"))
    oxygen = inn("COMPONENT_HATLESS", V.OXYGEN_COMPONENTS)
    c.group("SYSTEM_REV", IV, f"NOT ({oxygen})").group("SYSTEM_REV", V.CHEM_SYSTEM_OXYGEN, oxygen)
    if scale:
        c.dup("SCALE_TYP", "SCALE_REV").group("SCALE_REV", V.SHARED_SCALE)
    c.dup("METHOD_TYP", "METHOD_REV")
    c.others("METHOD_REV", "Method-Other", likes(h("METHOD_REV"), V.CHEM_METHOD_KEPT_PATTERNS))
    return ("COMPONENT", "PROPERTY_REV", "TIME_REV", "SYSTEM_REV", *(["SCALE_REV"] if scale else []), "METHOD_REV")


def coag(c: Chain) -> tuple:
    c.dup("PROPERTY", "PROPERTY_REV").group("PROPERTY_REV", V.COAG_PROPERTY)
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", V.COAG_SYSTEM)
    c.dup("METHOD_TYP", "METHOD_REV").others("METHOD_REV", "Method-Other", inn(h("METHOD_REV"), V.COAG_METHOD_KEPT))
    return ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "METHOD_REV")


def cyto(c: Chain) -> tuple:
    c.dup("COMPONENT", "COMPONENT_REV").group("COMPONENT_REV", V.CYTO_COMPONENT)
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", V.CYTO_SYSTEM)
    return ("COMPONENT_REV", "SYSTEM_REV")


def fert(c: Chain) -> tuple:
    c.dup("SCALE_TYP", "SCALE_REV").group("SCALE_REV", V.SHARED_SCALE)
    return ("COMPONENT", "SCALE_REV")


def hembc(c: Chain) -> tuple:
    c.dup("PROPERTY", "PROPERTY_REV").group("PROPERTY_REV", V.HEMBC_PROPERTY)
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", shared("Bld-any", "BLdCo-any", "DuodGastricFld"))
    return ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV")


def micro(c: Chain) -> tuple:
    c.dup("PROPERTY", "PROPERTY_REV").group("PROPERTY_REV", V.MICRO_PROPERTY)
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", V.MICRO_SYSTEM)
    c.group("SYSTEM_REV", shared("Intravascular-any", "DuodGastricFld", "OcularVitrFld"))
    c.group("SYSTEM_REV", V.MICRO_SYSTEM_STD, f"{n('COMPONENT')} IN (SELECT k FROM std_list)")
    c.dup("METHOD_TYP", "METHOD_REV").group("METHOD_REV", V.MICRO_METHOD)
    c.put("METHOD_REV", f"CASE WHEN {BLANK_METHOD.format('METHOD_TYP')} AND {ANTIBODY} THEN 'IA-IF-Null*' ELSE METHOD_REV END")
    return ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "METHOD_REV")


def molpath(c: Chain) -> tuple:
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", V.MOLPATH_SYSTEM)
    return ("COMPONENT", "SYSTEM_REV")


def default_gate(c: str, names) -> str:
    return " AND ".join(f"{n(c)} <> {q(g.lower())} AND {c} NOT ILIKE {q(g + '^%')}" for g in names)


def sero(c: Chain) -> tuple:
    c.dup("PROPERTY", "PROPERTY_REV").group("PROPERTY_REV", V.SERO_PROPERTY)
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", IV)
    c.dup("METHOD_TYP", "METHOD_REV")
    c.put("METHOD_REV", f"CASE WHEN {BLANK_METHOD.format('METHOD_TYP')} AND {ANTIBODY} THEN 'IA-IF-Null*' ELSE METHOD_REV END")
    spec = {**V.SERO_METHOD, "IA-IF-Null*": V.MICRO_METHOD["IA-IF-Null*"]}
    c.group("METHOD_REV", spec)
    c.others("METHOD_REV", "Method-Other", likes(h("METHOD_REV"), V.SERO_METHOD_KEPT_PATTERNS),
             default_gate("METHOD_REV", spec))
    return ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "METHOD_REV")


def ua(c: Chain) -> tuple:
    c.dup("PROPERTY", "PROPERTY_REV").group("PROPERTY_REV", V.UA_PROPERTY)
    c.dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", V.UA_SYSTEM)
    return ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV")


CLASSES = {
    "ABXBACT": abxbact, "ALLERGY": allergy, "CELLMARK": cellmark, "CHEM": chem, "COAG": coag, "CYTO": cyto,
    "DRUG/TOX": lambda c: chem(c, True), "FERT": fert, "HEM/BC": hembc, "MICRO": micro, "MOLPATH": molpath,
    "SERO": sero, "UA": ua,
}
PAIRS = [("PROPERTY", "PROPERTY_REV"), ("TIME_ASPCT", "TIME_REV"), ("SYSTEM", "SYSTEM_REV"),
         ("SCALE_TYP", "SCALE_REV"), ("METHOD_TYP", "METHOD_REV")]


def warning(system: str = "SYSTEM", component: str = "COMPONENT") -> str:
    cases = [
        f"WHEN {inn(system, c['SYSTEM'])} AND {inn(component, c['COMPONENT'])} THEN {q(m)}"
        for m, c in reversed(V.CHEM_WARNINGS)
    ]
    return "CASE " + " ".join(cases) + " END"


def keyed_class(value: str) -> tuple[str, list[str]]:
    """CTE chain of one class up to key, weight and warning; report columns."""
    c = of_class(value, "")
    columns = CLASSES[value](c)
    c.new("EQUIV_CLS", key(*columns))
    own = set(columns)
    report = ["EQUIV_CLS", "LOINC_NUM", "COMPONENT", *(["COMPONENT_REV"] if "COMPONENT_REV" in own else []),
              "EXAMPLE_UCUM_UNITS", *itertools.chain(*[p for p in PAIRS if p[1] in own]), "LONG_COMMON_NAME"]
    if value in ("CHEM", "DRUG/TOX"):
        c.add(f"SELECT *, (SELECT MOLECULAR_WEIGHT FROM mw WHERE mw.k = {n('COMPONENT')}) AS MOLECULAR_WEIGHT")
        c.new("WARNING", warning())
        report += ["MOLECULAR_WEIGHT", "WARNING"]
    return c, report


def report_rows(source: str, columns: list[str], types: dict, all_columns: list[str], lead: str = "") -> str:
    """Heading, member and blank rows of both sections."""
    out = []
    for section, cond in SECTIONS:
        counted = f"(SELECT *, count(*) OVER (PARTITION BY {n('EQUIV_CLS')}) AS cnt FROM {source}) x WHERE {cond}"
        grouped = f"(SELECT min(EQUIV_CLS) AS k, count(*) AS cnt FROM {source} GROUP BY {n('EQUIV_CLS')}) x WHERE {cond}"

        def extra(first: str, count: str) -> str:
            return ", ".join(
                f"{count} AS {c}" if c == "LONG_COMMON_NAME" else f"CAST(NULL AS {types.get(c, 'VARCHAR')}) AS {c}"
                for c in all_columns)

        shown = ", ".join(c if c in columns else f"CAST(NULL AS {types.get(c, 'VARCHAR')}) AS {c}" for c in all_columns)
        head_cols = f"{lead}{q(section)} AS section, "
        out.append(f"SELECT {head_cols}1 AS row_kind, '' AS Heading, {shown}, EQUIV_CLS AS SORT_ORDER FROM {counted}")
        out.append(f"SELECT {head_cols}0 AS row_kind, k AS Heading, {extra('k', 'CAST(cnt AS VARCHAR)')}, k AS SORT_ORDER FROM {grouped}")
        out.append(f"SELECT {head_cols}2 AS row_kind, '' AS Heading, {extra('', q(''))}, k || '_BLANKROW' AS SORT_ORDER FROM {grouped}")
    return " UNION ALL ".join(out)


TYPES = {"MOLECULAR_WEIGHT": "DOUBLE"}
ALL_COLUMNS = ["EQUIV_CLS", "LOINC_NUM", "COMPONENT", "COMPONENT_REV", "EXAMPLE_UCUM_UNITS",
               *itertools.chain(*PAIRS), "LONG_COMMON_NAME", "MOLECULAR_WEIGHT", "WARNING"]


def class_sql(value: str) -> str:
    c, columns = keyed_class(value)
    name = value.replace("/", "")
    rows = report_rows("cls", columns, TYPES, columns, f"{q(name)} AS profile, ")
    return f"WITH {ALL_TABLES}, cls AS MATERIALIZED (WITH {c.ctes()} SELECT * FROM {c.last}) {rows}"


def all_classes_sql() -> str:
    tables, rows = [ALL_TABLES], []
    for value in CLASSES:
        c, columns = keyed_class(value)
        name = value.replace("/", "")
        tables.append(f"cls_{name} AS MATERIALIZED (WITH {c.ctes()} SELECT * FROM {c.last})")
        rows.append(report_rows(f"cls_{name}", columns, TYPES, ALL_COLUMNS, f"{q(name)} AS profile, "))
    return f"WITH {', '.join(tables)} {' UNION ALL '.join(rows)}"


# --- single operators ------------------------------------------------------------

def rule_table_sql() -> str:
    from termfold.operators.rules import EXCEPT_VALUES, EQ, to_rows
    from termfold.plans.profiles import PROFILES, all_rules
    rows = [r for r in to_rows(all_rules()) if r[4] in (EQ, EXCEPT_VALUES)]
    listed = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else q(v) for v in r) + ")" for r in rows)
    source = {rev: src for rev, src in [("COMPONENT_REV", "COMPONENT"), *[(b, a) for a, b in PAIRS]]}
    names = "CASE " + " ".join(f"WHEN {n('CLASS')} = {q(p.class_value.lower())} THEN {q(p.name)}" for p in PROFILES) + " END"
    heads = " UNION ALL ".join(
        f"SELECT {names} AS profile, {q(rev)} AS target_col, {n(h('coalesce(' + src + ', %s)' % q('')))} AS v FROM terms"
        for rev, src in source.items())
    return f"""WITH {TERMS}, rules AS (SELECT * FROM (VALUES {listed})
        AS r(profile, target_col, block, seq, kind, grp, value, pos, gate)),
      heads AS ({heads}), hits AS (SELECT profile, target_col, v, count(*) AS c FROM heads GROUP BY 1, 2, 3)
      SELECT r.profile, r.target_col, CAST(r.block AS INTEGER) AS block, CAST(r.seq AS INTEGER) AS seq, r.kind,
             r.grp, r.value, CAST(r.pos AS INTEGER) AS pos, CAST(r.gate AS VARCHAR) AS gate, coalesce(hits.c, 0) AS n_terms
      FROM rules r LEFT JOIN hits ON r.profile = hits.profile AND r.target_col = hits.target_col
        AND hits.v = {n('r.value')}"""


def legacy_rows(c: Chain, columns: list[str]) -> str:
    counted = f"(SELECT *, count(*) OVER (PARTITION BY {n('EQUIV_CLS')}) AS cnt FROM {c.last}) x WHERE cnt > 1"
    grouped = f"(SELECT min(EQUIV_CLS) AS k, count(*) AS cnt FROM {c.last} GROUP BY {n('EQUIV_CLS')}) x WHERE cnt > 1"
    shown = ", ".join(c if c == "SYSTEM_REV" else f"CASE WHEN COMPONENT IS NULL THEN '' ELSE {c} END AS {c}" for c in columns)

    def extra(count: str) -> str:
        return ", ".join(f"{count} AS {c}" if c == "SYSTEM_REV" else f"'' AS {c}" for c in columns)

    return (f"WITH {c.ctes()} SELECT 1 AS row_kind, '' AS Heading, {shown}, EQUIV_CLS AS SORT_ORDER FROM {counted}"
            f" UNION ALL SELECT 0, k, {extra('CAST(cnt AS VARCHAR)')}, k FROM {grouped}"
            f" UNION ALL SELECT 2, '', {extra(q(''))}, k || '_BLANKROW' FROM {grouped}")


LEGACY_COLUMNS = ["EQUIV_CLS", "LOINC_NUM", "COMPONENT", "PROPERTY", "PROPERTY_REV", "SYSTEM", "SYSTEM_REV",
                  "METHOD_TYP", "METHOD_REV", "LONG_COMMON_NAME"]


def mapped(c: Chain, column: str, table: str, group: str) -> Chain:
    return c.put(column, f"coalesce((SELECT min({group}) FROM map_{table} m WHERE {n('m.Name')} = {n(c.last + '.' + column)}), {column})")


def override(c: Chain) -> Chain:
    listed = f"""{n('LOINC_NUM')} IN (SELECT {n('d.LOINC_NUM')} FROM detail d JOIN groupers g
        ON {n('g.Name')} = {n('d.COMPONENTCORE')} WHERE g.STDGrouper IS NOT NULL)"""
    two = f"(SELECT min(System_Rev_2) FROM map_system m WHERE {n('m.Name')} = {n(c.last + '.SYSTEM')})"
    return c.put("SYSTEM_REV", f"CASE WHEN {listed} THEN coalesce({two}, SYSTEM_REV) ELSE SYSTEM_REV END")


LEGACY_TABLES = ", ".join([TERMS, DETAIL, GROUPERS, *MAPS.values()])


def micro_legacy_sql() -> str:
    c = of_class("MICRO", LEGACY_TABLES)
    c.dup("SYSTEM", "SYSTEM_REV")
    override(mapped(c, "SYSTEM_REV", "system", "System_Rev_1"))
    mapped(c.dup("PROPERTY", "PROPERTY_REV"), "PROPERTY_REV", "property", "Property_Rev")
    mapped(c.dup("METHOD_TYP", "METHOD_REV"), "METHOD_REV", "method", "Method_Rev")
    c.put("METHOD_REV", f"CASE WHEN {BLANK_METHOD.format('METHOD_REV')} AND {ANTIBODY} THEN 'IA_IF_Null*' ELSE METHOD_REV END")
    c.new("EQUIV_CLS", key("COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "METHOD_REV"))
    return legacy_rows(c, LEGACY_COLUMNS)


def legacy_report_sql() -> str:
    c = from_terms().dup("PROPERTY", "PROPERTY_REV").dup("SYSTEM", "SYSTEM_REV").dup("METHOD_TYP", "METHOD_REV")
    return legacy_rows(c.new("EQUIV_CLS", key("COMPONENT", "PROPERTY_REV")), LEGACY_COLUMNS)


def report_sql() -> str:
    c = of_class("RAD", TERMS).dup("SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", {"Blood": V.SHARED_SYSTEM["Bld-any"]})
    c.new("EQUIV_CLS", key("COMPONENT", "SYSTEM_REV"))
    columns = ["EQUIV_CLS", "LOINC_NUM", "COMPONENT", "EXAMPLE_UCUM_UNITS", "SYSTEM", "SYSTEM_REV", "LONG_COMMON_NAME"]
    return f"WITH {c.ctes()} {report_rows(c.last, columns, TYPES, columns)}"


def keyed_sql(select: str) -> str:
    k = key("COMPONENT", "PROPERTY", "SCALE_TYP")
    return f"WITH {TERMS}, s AS (SELECT LOINC_NUM, {k} AS EQUIV_CLS FROM terms) {select}"


def spec_steps(c: Chain, column: str, spec: dict) -> Chain:
    plain = {g: m for g, m in spec.items() if not isinstance(m, dict)}
    c.group(column, plain)
    for g, m in spec.items():
        if isinstance(m, dict):
            keep = " OR ".join(
                f"regexp_matches({h(column)}, '(?is)^.*sat[u]ration$')" if "[" in p else f"{h(column)} ILIKE {q(p)}"
                for p in m["skipPatterns"])
            c.others(column, g, keep, default_gate(column, plain))
    return c


def gated_group_sql() -> str:
    c = from_terms("LOINC_NUM, COMPONENT, SYSTEM").dup("SYSTEM", "SYSTEM_REV").put("COMPONENT", "coalesce(COMPONENT, '')")
    oxygen = inn(h("COMPONENT"), V.OXYGEN_COMPONENTS)
    return c.group("SYSTEM_REV", IV, f"NOT ({oxygen})").group("SYSTEM_REV", V.CHEM_SYSTEM_OXYGEN, oxygen).sql()


def many_gates_sql() -> str:
    c = Chain("SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem").dup("l_returnflag", "l_returnflag_REV")
    for gate, group, values_ in Q.GATED:
        condition = Q.GATES[gate.lstrip("!")]
        c.group("l_returnflag_REV", {group: values_}, f"NOT ({condition})" if gate.startswith("!") else condition)
    return c.group("l_returnflag_REV", Q.UNGATED).sql()


def rule_table_apply_sql() -> str:
    rules = """SELECT s_suppkey AS seq, concat('analyte ', s_suppkey) AS value, CASE WHEN s_suppkey % 3 = 0
        THEN concat('Analyte ', s_suppkey + 1, '^next') ELSE concat('Nation ', s_nationkey) END AS grp FROM supplier"""
    once = f"coalesce(a.grp || {suf('t.COMPONENT')}, t.COMPONENT)"
    return f"""WITH {TERMS}, rules AS ({rules}), one AS (
        SELECT t.LOINC_NUM, a.seq, {once} AS c FROM terms t LEFT JOIN rules a ON a.value = {n(h('t.COMPONENT'))})
        SELECT one.LOINC_NUM, coalesce(b.grp || {suf('one.c')}, one.c) AS COMPONENT
        FROM one LEFT JOIN rules b ON b.value = {n(h('one.c'))} AND b.seq > one.seq"""


def pattern_table_sql() -> str:
    patterns = """SELECT CASE s_suppkey % 4 WHEN 0 THEN concat('%nalyte ', s_suppkey) WHEN 1 THEN concat('ANALYTE ', s_suppkey, '_')
        WHEN 2 THEN concat('An%te ', s_suppkey, '%') ELSE concat('analyte ', s_suppkey) END AS pattern FROM supplier"""
    return f"""WITH {TERMS}, patterns AS ({patterns}),
        heads AS (SELECT v, EXISTS (SELECT 1 FROM patterns WHERE v ILIKE pattern) AS kept FROM (SELECT DISTINCT {h('COMPONENT')} AS v FROM terms))
        SELECT LOINC_NUM, CASE WHEN NOT kept THEN {regroup('Component-Other', 'COMPONENT')} ELSE COMPONENT END AS COMPONENT
        FROM terms LEFT JOIN heads ON v = {h('COMPONENT')}"""


def default_group_table_sql() -> str:
    groups = """SELECT CASE WHEN s_suppkey % 5 = 0 THEN concat('Anal_te ', s_suppkey) ELSE concat('ANALYTE ', s_suppkey, ' ') END AS grp FROM supplier"""
    kept = f"EXISTS (SELECT 1 FROM region WHERE {h('c')} ILIKE concat('%', substring(r_name, 1, 2), '%'))"
    return f"""WITH {TERMS}, groups AS ({groups}),
        found AS (SELECT c, {kept} OR EXISTS (SELECT 1 FROM groups WHERE {n('c')} = {n('grp')} OR c ILIKE concat(grp, '^%')) AS stays
                  FROM (SELECT DISTINCT COMPONENT AS c FROM terms))
        SELECT LOINC_NUM, CASE WHEN NOT stays THEN {regroup('Component-Other', 'COMPONENT')} ELSE COMPONENT END AS COMPONENT
        FROM terms LEFT JOIN found ON c = COMPONENT"""


def warning_table_sql() -> str:
    return f"""WITH {TERMS}, rules AS (SELECT s_suppkey AS seq,
          lower(rtrim(list_extract(['Ser', 'ser/plas', 'Urine', 'BldA', 'Stool', 'CSF'], 1 + s_suppkey % 6))) AS s1,
          lower(list_extract(['Bld', 'Plas', 'BldV', 'BldC'], 1 + s_suppkey % 4)) AS s2,
          concat('analyte ', s_suppkey % 40) AS c1, concat('analyte ', s_suppkey % 7) AS c2 FROM supplier),
        found AS (SELECT c, s, max(seq) AS seq FROM (SELECT DISTINCT {n('COMPONENT')} AS c, {n('SYSTEM')} AS s FROM terms) t
                  JOIN rules ON s IN (s1, s2) AND c IN (c1, c2) GROUP BY c, s)
        SELECT LOINC_NUM, COMPONENT, SYSTEM, CASE WHEN seq IS NOT NULL THEN concat('warning ', seq) END AS WARNING
        FROM terms LEFT JOIN found ON c = {n('COMPONENT')} AND s = {n('SYSTEM')}"""


def sheet_rows_sql() -> str:
    order = f"{n('CASE WHEN row_kind = 2 THEN left(SORT_ORDER, length(SORT_ORDER) - 9) ELSE SORT_ORDER END')}, row_kind, LOINC_NUM"
    return (f"SELECT section, row_number() OVER (PARTITION BY section ORDER BY {order}) AS row_number, row_kind, Heading, LOINC_NUM, SORT_ORDER "
            f"FROM ({class_sql('CELLMARK')})")


def released_rows_sql() -> str:
    return """
        SELECT p_partkey, concat(p_name, ', "', p_brand, '"') AS p_name,
               p_size, CAST(NULL AS VARCHAR) AS record, CAST(NULL AS VARCHAR) AS problem
        FROM part WHERE p_partkey % 10 NOT IN (3, 5, 7, 9)
        UNION ALL
        SELECT NULL, NULL, NULL, CASE p_partkey % 10 WHEN 3 THEN concat(p_partkey, ',', p_name) WHEN 5 THEN concat(p_partkey, ',"', p_name, ',', p_size)
                 WHEN 7 THEN concat(p_partkey, ',', p_name, ',size') ELSE concat(',', p_name, ',', p_size) END,
               CASE p_partkey % 10 WHEN 5 THEN 'quotes do not close' WHEN 9 THEN 'no p_partkey' ELSE 'fields do not fit the columns' END
        FROM part WHERE p_partkey % 10 IN (3, 5, 7, 9)"""


def expectations_sql() -> str:
    checks = {
        "value of LOINC_NUM": "trim(LOINC_NUM) <> ''", "value of COMPONENT": "trim(COMPONENT) <> ''", "known CLASS": inn("CLASS", CLASSES),
        "value of METHOD_TYP": "CLASS IS DISTINCT FROM 'MICRO' OR trim(METHOD_TYP) <> ''", "unit with a number": "regexp_matches(EXAMPLE_UCUM_UNITS, '[0-9]')"}
    return f"WITH {TERMS} " + " UNION ALL ".join(
        f"SELECT {q(name)} AS expectation, count(*) FILTER (NOT coalesce({test}, false)) AS n_failing, count(*) AS n_rows FROM terms"
        for name, test in checks.items())


def long_keys_sql() -> str:
    tables, rows = [ALL_TABLES], []
    for value in CLASSES:
        c, _ = keyed_class(value)
        name = value.replace("/", "")
        tables.append(f"keys_{name} AS (WITH {c.ctes()} SELECT EQUIV_CLS FROM {c.last})")
        rows.append(f"SELECT {q(name)} AS profile, count(*) FILTER (length(EQUIV_CLS) > 255) AS long_keys, "
                    f"max(length(EQUIV_CLS)) AS longest FROM keys_{name} GROUP BY 1")
    return f"WITH {', '.join(tables)} {' UNION ALL '.join(rows)}"


def operator_sql() -> dict[str, str]:
    drugtox, columns = keyed_class("DRUG/TOX")
    std = "coalesce({} IN (SELECT k FROM std_list), false)".format(n("COMPONENT"))
    std_tables = ", ".join([TERMS, DETAIL, STD])
    return {
        "class_subset": of_class("HEM/BC").sql(),
        "rule_table": rule_table_sql(),
        "dup_column": from_terms("LOINC_NUM, SYSTEM").dup("SYSTEM", "SYSTEM_COPY").sql(),
        "hatless": from_terms("LOINC_NUM, COMPONENT").dup("COMPONENT", "COMPONENT_HATLESS").put(
            "COMPONENT_HATLESS", h("COMPONENT_HATLESS")).sql(),
        "head_suffix": f"WITH {TERMS} SELECT LOINC_NUM, {h('METHOD_TYP')} AS head, "
                       f"CASE WHEN METHOD_TYP IS NULL THEN NULL ELSE {suf('METHOD_TYP')} END AS suffix FROM terms",
        "apply_group": from_terms("LOINC_NUM, COMPONENT, SYSTEM").group(
            "SYSTEM", {"Changed": ["BldA", "BldV", "Ser/Plas"]}, "COMPONENT ILIKE 'Oxygen%'").sql(),
        "apply_groups": spec_steps(Chain("SELECT o_orderkey, o_orderpriority FROM orders"), "o_orderpriority", Q.PRIORITY_GROUPS).sql(),
        "default_group": spec_steps(from_terms("LOINC_NUM, COMPONENT"), "COMPONENT", Q.DEFAULT_GROUPS).sql(),
        "skip_patterns": Chain("SELECT p_partkey, p_name FROM part").others(
            "p_name", "Plain", "p_name ILIKE 'red%' OR p_name ILIKE '%bolt' OR p_name ILIKE 's_all%'").sql(),
        "skip_values": Chain("SELECT event_id, event_type FROM events").others(
            "event_type", "Event-Other", inn("event_type", ["click", "view"])).sql(),
        "dup_and_group": spec_steps(Chain("SELECT p_partkey, p_type FROM part").dup("p_type", "p_type_REV"), "p_type_REV", Q.TYPE_GROUPS).sql(),
        "gated_group": gated_group_sql(),
        "many_gates": many_gates_sql(),
        "rast_gate": from_terms("LOINC_NUM, COMPONENT, SCALE_TYP").dup("SCALE_TYP", "SCALE_REV").group(
            "SCALE_REV", V.SHARED_SCALE, "COMPONENT NOT ILIKE 'RAST%' AND COMPONENT NOT ILIKE '%.RAST%'").sql(),
        "antibody_null_method": from_terms("LOINC_NUM, COMPONENT, METHOD_TYP").dup("METHOD_TYP", "METHOD_REV").put(
            "METHOD_REV", f"CASE WHEN {BLANK_METHOD.format('METHOD_TYP')} AND {ANTIBODY} THEN 'IA-IF-Null*' ELSE METHOD_REV END").sql(),
        "std_components": f"WITH {std_tables} SELECT COMPONENT FROM std_list",
        "micro_std_system": from_terms("LOINC_NUM, COMPONENT, SYSTEM", std_tables).new("std", std).dup(
            "SYSTEM", "SYSTEM_REV").group("SYSTEM_REV", V.MICRO_SYSTEM_STD, "std").sql(),
        "class_key": f"WITH {TERMS} SELECT LOINC_NUM, {key('COMPONENT', 'PROPERTY', 'SYSTEM', 'METHOD_TYP')} AS EQUIV_CLS FROM terms",
        "report_columns": f"WITH {ALL_TABLES}, {drugtox.ctes()} SELECT {', '.join(columns)} FROM {drugtox.last}",
        "df_units": from_terms("LOINC_NUM, PROPERTY, EXAMPLE_UCUM_UNITS").put(
            "EXAMPLE_UCUM_UNITS", f"CASE WHEN {inn('PROPERTY', V.CHEM_DF_PROPERTIES)} THEN '%/100' ELSE EXAMPLE_UCUM_UNITS END").sql(),
        "warnings": from_terms("LOINC_NUM, COMPONENT, SYSTEM").new("WARNING", warning()).sql(),
        "molecular_weights": f"WITH {', '.join([TERMS, PART, WEIGHTS, MW])} SELECT t.LOINC_NUM, t.COMPONENT, mw.MOLECULAR_WEIGHT "
                             f"FROM terms t LEFT JOIN mw ON mw.k = {n('t.COMPONENT')}",
        "mapping_table_group": mapped(from_terms("LOINC_NUM, METHOD_TYP", f"{TERMS}, {MAPS['method']}").dup(
            "METHOD_TYP", "METHOD_REV"), "METHOD_REV", "method", "Method_Rev").sql(),
        "legacy_system_override": override(mapped(from_terms("LOINC_NUM, COMPONENT, SYSTEM", LEGACY_TABLES).dup(
            "SYSTEM", "SYSTEM_REV"), "SYSTEM_REV", "system", "System_Rev_1")).sql(),
        "class_counts": keyed_sql(f"SELECT *, count(*) OVER (PARTITION BY {n('EQUIV_CLS')}) AS CLS_COUNT FROM s"),
        "multi_member": keyed_sql(f"SELECT LOINC_NUM, EQUIV_CLS FROM (SELECT *, count(*) OVER (PARTITION BY {n('EQUIV_CLS')}) AS c FROM s) x WHERE c > 1"),
        "heading_rows": keyed_sql(
            f"SELECT 0 AS row_kind, min(EQUIV_CLS) AS Heading, CAST(count(*) AS VARCHAR) AS LONG_COMMON_NAME, min(EQUIV_CLS) AS SORT_ORDER FROM s GROUP BY {n('EQUIV_CLS')}"),
        "blank_rows": keyed_sql(
            f"SELECT 2 AS row_kind, '' AS Heading, '' AS LONG_COMMON_NAME, min(EQUIV_CLS) || '_BLANKROW' AS SORT_ORDER FROM s GROUP BY {n('EQUIV_CLS')}"),
        "report": report_sql(),
        "legacy_report": legacy_report_sql(),
        "class_micro_legacy": micro_legacy_sql(),
        "all_classes": all_classes_sql(),
        "rule_table_apply": rule_table_apply_sql(),
        "report_output": all_classes_sql(),
        "sheet_rows": sheet_rows_sql(),
        "pattern_table": pattern_table_sql(),
        "default_group_table": default_group_table_sql(),
        "warning_table": warning_table_sql(),
        "long_keys": long_keys_sql(),
        "released_rows": released_rows_sql(),
        "expectations": expectations_sql(),
        "unmatched_keys": f"WITH {TERMS}, {PART} SELECT DISTINCT {n('COMPONENT')} AS value FROM terms WHERE {n('COMPONENT')} <> '' "
                          f"AND {n('COMPONENT')} NOT IN (SELECT {n('PART')} FROM part_names WHERE PART IS NOT NULL)",
        "repeated_keys": f"WITH {TERMS} SELECT SYSTEM, PROPERTY, SCALE_TYP, count(*) AS n_rows FROM terms GROUP BY ALL HAVING count(*) > 1",
    }


def oracle_sql() -> dict[str, str]:
    return operator_sql() | {f"class_{v.replace('/', '').lower()}": class_sql(v) for v in CLASSES}
