"""Term tables derived from the order and part tables, for queries and tests.

One term per order. The same SELECT, but for the array functions, runs on Spark
and in the SQL that the results are checked with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termfold.operators.coarsen import local_table
from termfold.operators.staging import new_path
from termfold.plans import fixed_values as V
from termfold.plans.profiles import PROFILES
from termfold.sources.terms import write_terms


def _quote(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _pick(dialect: str, values: list, index: str) -> str:
    listed = ", ".join(_quote(v) for v in values)
    if dialect == "spark":
        return f"element_at(array({listed}), CAST({index} AS INT) + 1)"
    return f"list_extract([{listed}], CAST({index} AS INT) + 1)"


def _turn(divisor: int, modulus: int) -> str:
    """A number below ``modulus`` that changes every ``divisor`` orders."""
    return f"(CAST(floor(o_orderkey / CAST({divisor} AS DOUBLE)) AS BIGINT) % {modulus})"


def _spread(divisor: int, dialect: str, values: list) -> str:
    return _pick(dialect, values, _turn(divisor, len(values)))


def _values(*targets: str) -> list[str]:
    """All values that rules list for the columns, in rule order."""
    return list(dict.fromkeys(
        v for p in PROFILES for r in p.rule_list() if r.target in targets for v in r.values if "%" not in v))


def _variants(values: list[str]) -> list[str | None]:
    """The values, and some of them with sub-parts, other case and blanks."""
    return (
        values + [v + "^sub part" for v in values[::3]] + [v.upper() + " " for v in values[::5]]
        + [v.lower() + "^x^y  " for v in values[::7]] + ["XXX", "XXX^y", "^z", "", None]
    )


CLASSES = [p.class_value for p in PROFILES] + ["RAD", "chem", "MICRO "]
COMMON_COMPONENTS = ["Glucose", "Virus Ab", "Oxygen saturation^during apnea", "Ammonia", "Chlamydia trachomatis"]
COMPONENTS = V.OXYGEN_COMPONENTS + [v for v in _values("COMPONENT_REV")] + [
    "oxygen CONTENT^x", "Deoxyhemoglobin", "Ammonium", "Ammonium ion ", "Folate", "folate^x", "C peptide",
    "Virus Ab.IgG", "Virus+Ag", "virus ab", "Virus.Ag.IgM", "Virus Ac", "VirusAb", "Ab", " Ab+x",
    "Class.RAST", "RAST test", "Peanut.rast class", "Peanut RAST", "Cytology report^x",
    "HPV E6+E7 mRNA", "Human papilloma virus 16", "Mycoplasma species", "Neisseria gonorrhoeae",
    "Neisseria gonorrhoeae.x", "Trichomonas sp", "TRICHOMONAS VAGINALIS", "Ureaplasma sp^2", "", None,
]
SYSTEMS = _variants(_values("SYSTEM_REV"))
COMMON_SYSTEMS = ["Ser", "Ser/Plas", "BldA", "BldV", "Bld", "Urine", "Stool", "bld ", "Vag", "Semen", "Bld^donor", None]
PROPERTIES = _variants(_values("PROPERTY_REV"))
METHODS = _variants(_values("METHOD_REV")) + [
    "Detection limit <= 5", "SCREEN", "Confirm^x", "High sensitivity method", "High sensitivity method x",
    "Foo 4 deg C", "Foo 4 DEG C^x", "Aggl^x", "Molecular-genetics", "Method-Other", "IA-IF-Null*^x", "  ",
]
SCALES = ["Ord", "Nom", "Nar", "Doc", "Qn", "ord ", "NOM", "Nom^x", "Ord^x", "", None]
TIMES = ["Pt", "24h", "12H", "8h^mean", "1 min", None]


def terms_sql(dialect: str, orders: str = "orders") -> str:
    """SELECT of the term table from the order table."""
    return f"""
    SELECT concat('T', CAST(o_orderkey AS VARCHAR(20))) AS LOINC_NUM,
           CASE WHEN {_turn(13, 8)} < 4 THEN {_spread(17, dialect, COMMON_COMPONENTS)}
                WHEN {_turn(13, 8)} < 7 THEN {_spread(29, dialect, COMPONENTS)}
                ELSE concat('Analyte ', CAST(o_custkey AS VARCHAR(20))) END AS COMPONENT,
           {_spread(7, dialect, PROPERTIES)} AS PROPERTY,
           {_spread(19, dialect, TIMES)} AS TIME_ASPCT,
           CASE WHEN {_turn(5, 2)} = 0 THEN {_spread(23, dialect, COMMON_SYSTEMS)}
                ELSE {_spread(3, dialect, SYSTEMS)} END AS SYSTEM,
           {_spread(31, dialect, SCALES)} AS SCALE_TYP,
           CASE WHEN {_turn(11, 3)} = 0 THEN {_spread(11, dialect, METHODS)} END AS METHOD_TYP,
           {_spread(1, dialect, CLASSES)} AS CLASS,
           {_spread(37, dialect, ["ACTIVE", "DEPRECATED", "TRIAL"])} AS STATUS,
           CAST({_turn(41, 4)} AS INT) AS CLASSTYPE,
           CAST({_turn(2, 3000)} AS INT) AS COMMON_TEST_RANK,
           CAST({_turn(3, 300)} AS INT) AS COMMON_SI_TEST_RANK,
           CAST({_turn(4, 30)} AS INT) AS COMMON_ORDER_RANK,
           {_spread(43, dialect, ["mg/dL", "%", "mmol/L", None])} AS EXAMPLE_UCUM_UNITS,
           concat('Term ', CAST(o_orderkey AS VARCHAR(20))) AS LONG_COMMON_NAME,
           CAST(o_orderkey AS BIGINT) AS ID
    FROM {orders}"""


def detail_sql(terms: str = "terms") -> str:
    """Core component of the terms; some rows belong to no term."""
    return f"""
    SELECT CASE WHEN ID % 10 = 9 THEN concat('other ', LOINC_NUM) ELSE LOINC_NUM END AS LOINC_NUM,
           CASE WHEN COMPONENT LIKE '%^%' THEN substr(COMPONENT, 1, instr(COMPONENT, '^') - 1)
                ELSE COMPONENT END AS COMPONENTCORE
    FROM {terms}"""


def part_sql(dialect: str, part: str = "part") -> str:
    """Part names: many parts share a name, and some are of another type."""
    names = [c for c in COMMON_COMPONENTS + COMPONENTS if c] + ["Unused"]
    return f"""
    SELECT CASE WHEN p_partkey % 4 = 0 THEN concat('analyte ', CAST(p_partkey AS VARCHAR(20)))
                ELSE {_pick(dialect, names, f"(p_partkey % {len(names)})")} END AS PART,
           concat('LP', CAST(p_partkey AS VARCHAR(20))) AS PART_NUM,
           CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END AS TYPE
    FROM {part}"""


def weights_sql(part: str = "part") -> str:
    """Weights in another spelling; some belong to no part."""
    return f"""
    SELECT concat(CASE WHEN p_partkey % 3 = 0 THEN 'xx' ELSE 'lp' END, CAST(p_partkey AS VARCHAR(20)), ' ') AS PartNum,
           p_retailprice AS Molecular_weight_COMBINED
    FROM {part}"""


def mapping_rows() -> dict[str, list[tuple]]:
    """Mapping tables of the older script, filled from the rules."""
    def first(table: dict) -> dict:
        out: dict[str, str] = {}
        for group, values in table.items():
            for v in values:
                out.setdefault(v, group)
        return out

    shared = {g: V.SHARED_SYSTEM[g] for g in ("Intravascular-any", "DuodGastricFld", "OcularVitrFld")}
    one, two = first({**V.MICRO_SYSTEM, **shared}), first(V.MICRO_SYSTEM_STD)
    return {
        "system": [(n, one.get(n), two.get(n)) for n in dict.fromkeys([*one, *two])],
        "property": list(first(V.MICRO_PROPERTY).items()),
        "method": list(first(V.MICRO_METHOD).items()),
    }


MAPPING_COLUMNS = {
    "system": ("Name", "System_Rev_1", "System_Rev_2"),
    "property": ("Name", "Property_Rev"),
    "method": ("Name", "Method_Rev"),
}


def groupers_sql(detail: str = "detail") -> str:
    """Core components with their grouper; most have none."""
    return f"""
    SELECT DISTINCT COMPONENTCORE AS Name,
           CASE WHEN lower(COMPONENTCORE) LIKE '%hpv%' OR lower(COMPONENTCORE) LIKE 'chlamydia%'
                  OR lower(COMPONENTCORE) LIKE 'trichomonas%' THEN 'STD' END AS STDGrouper
    FROM {detail} WHERE COMPONENTCORE IS NOT NULL"""


_stored: dict[tuple[str, str], dict] = {}


class Sample:
    """The derived tables of one data directory.

    They are derived once per application and stored like any ingested term
    table: terms partitioned by class, all in the session's shared folder.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.kept = _stored.setdefault((spark.sparkContext.applicationId, sf_dir), {})

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _keep(self, name: str, derive, store=lambda df, path: df.write.parquet(path)) -> DataFrame:
        if name not in self.kept:
            path = new_path(self.spark)
            store(derive(), path)
            self.kept[name] = (path, self.spark.read.parquet(path).schema)
        path, schema = self.kept[name]
        return self.spark.read.schema(schema).parquet(path)

    def derived_terms(self) -> DataFrame:
        return self.spark.sql(terms_sql("spark", "{orders}"), orders=self.table("orders"))

    @property
    def terms(self) -> DataFrame:
        return self._keep("terms", self.derived_terms, write_terms)

    @property
    def detail(self) -> DataFrame:
        return self._keep("detail", lambda: self.spark.sql(detail_sql("{terms}"), terms=self.terms))

    @property
    def part(self) -> DataFrame:
        return self._keep("part", lambda: self.spark.sql(part_sql("spark", "{part}"), part=self.table("part")))

    @property
    def weights(self) -> DataFrame:
        return self._keep("weights", lambda: self.spark.sql(weights_sql("{part}"), part=self.table("part")))

    @property
    def groupers(self) -> DataFrame:
        return self._keep("groupers", lambda: self.spark.sql(groupers_sql("{detail}"), detail=self.detail))

    def mapping(self, name: str) -> DataFrame:
        columns = zip(*mapping_rows()[name])
        return local_table(self.spark, dict(zip(MAPPING_COLUMNS[name], map(list, columns))))
