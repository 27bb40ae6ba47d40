"""Runs class profiles over a term table: one job, whatever the number of classes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termfold.functions.text import blank, class_key, head, like_any, norm_text, one_of
from termfold.operators import joins
from termfold.operators.classes import KEY, REVISED_PAIRS, add_warnings, report, set_units
from termfold.operators.coarsen import TOGETHER
from termfold.operators.coarsen import PROFILE, Profiles, apply_rules, duplicate, local_table
from termfold.operators.ranges import PART_ROWS
from termfold.operators.rules import EQ
from termfold.plans import fixed_values as V
from termfold.plans.profiles import PROFILES, Profile
from termfold.sources.terms import CLASS_KEY, TERM_SCHEMA, class_of, class_subset, require_columns


@dataclass(frozen=True)
class Lookups:
    """Tables read beside the terms."""

    detail: DataFrame | None = None        # LOINC_NUM, COMPONENTCORE
    part: DataFrame | None = None          # PART, PART_NUM, TYPE
    weights: DataFrame | None = None       # PartNum, Molecular_weight_COMBINED


def check_run(terms: DataFrame, profiles: list[Profile], lookups: Lookups) -> None:
    """Raise before any job if a run lacks a table or column, or has two profiles of one name."""
    names = [p.name for p in profiles]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"profiles of one name cannot run together: {', '.join(twice)}")
    carried = {"STATUS", "CLASSTYPE", "COMMON_TEST_RANK", "COMMON_SI_TEST_RANK", "COMMON_ORDER_RANK"}
    needed = [c for c in TERM_SCHEMA.names if c not in carried]
    require_columns(terms, "terms", [c for c in needed if c != "CLASS" or CLASS_KEY not in terms.columns])
    weighed = any(p.weights for p in profiles)
    std = any(r.gate and r.gate.lstrip("!") == "std" for p in profiles for r in p.rule_list())
    for wanted, name, columns in (
        (std, "detail", ["LOINC_NUM", "COMPONENTCORE"]), (weighed, "part", ["PART", "PART_NUM", "TYPE"]),
        (weighed, "weights", ["PartNum", "Molecular_weight_COMBINED"]),
    ):
        if wanted:
            given = getattr(lookups, name)
            if given is None:
                raise ValueError(f"the table {name} is missing; these classes need it")
            require_columns(given, name, columns)


GATES: dict[str, Callable[[], Column]] = {
    "oxygen": lambda: one_of("COMPONENT_HATLESS", V.OXYGEN_COMPONENTS),
    "rast": lambda: like_any("COMPONENT", V.RAST_PATTERNS),
    "std": lambda: F.col("_std"),
    "antibody_without_method": lambda: blank("METHOD_TYP") & like_any("COMPONENT", V.ANTIBODY_PATTERNS),
}


def gates(names: set[str]) -> dict[str, Column]:
    """Conditions that rules refer to by name."""
    return {name: GATES[name]() for name in sorted(names)}


def tag(terms: DataFrame, profiles: list[Profile]) -> DataFrame:
    """Terms of the profiles' classes, with the name (and bit) of their profile."""
    df = class_subset(terms.withColumn("_class", class_of(terms)), [p.class_value for p in profiles])
    if len(profiles) == 1:
        return df.drop("_class").withColumn(PROFILE, F.lit(profiles[0].name))
    table = local_table(df.sparkSession, {
        "_class": [norm_text(p.class_value) for p in profiles],
        PROFILE: [p.name for p in profiles],
        Profiles.BIT: list(run_of(profiles).bits.values()),
    })
    return df.join(F.broadcast(table), "_class").drop("_class")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over at least one task per PART_ROWS of them.

    A scan task takes a share of the files that grows with the table; the rules and keys that follow cost much more
    a row than the scan, so the longest task would grow with the input. A stream, which cannot be counted, stays as it is.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-df.count() // PART_ROWS))
    return df.repartition(tasks)


def run_of(profiles: list[Profile]) -> Profiles:
    return Profiles([p.name for p in profiles])


def _those(profiles: list[Profile], test: Callable[[Profile], object]) -> Column:
    return run_of(profiles).any_of([p.name for p in profiles if test(p)])


def equiv_key(profiles: list[Profile]) -> Column:
    """EQUIV_CLS of terms that follow different profiles.

    Where all keys are parts of one column order, the parts a profile lacks are
    NULL, which concat_ws leaves out.
    """
    if len(profiles) == 1:
        return class_key(profiles[0].key)
    order = [c for c in KEY_ORDER if any(c in p.key for p in profiles)]
    if any(list(p.key) != [c for c in order if c in p.key] for p in profiles):
        out = None
        for columns in dict.fromkeys(p.key for p in profiles):
            mine = _those(profiles, lambda p: p.key == columns)
            out = F.when(mine, class_key(columns)) if out is None else out.when(mine, class_key(columns))
        return out
    parts = [
        F.when(_those(profiles, lambda p: c in p.key), F.coalesce(F.col(c), F.lit(""))) for c in order
    ]
    return F.concat_ws("|", *parts)


KEY_ORDER = (
    "COMPONENT", "COMPONENT_REV", "PROPERTY_REV", "TIME_REV", "SYSTEM_REV", "SCALE_REV", "METHOD_REV",
)


def key_terms(terms: DataFrame, profiles: list[Profile] = PROFILES, lookups: Lookups = Lookups()) -> DataFrame:
    """Terms of the profiles' classes with revised columns and EQUIV_CLS.

    All classes take the same steps in one pass: projections and broadcast lookups.
    """
    df = spread(tag(terms, profiles))

    rules = [r for p in profiles for r in p.rule_list()]
    used = {r.gate.lstrip("!") for r in rules if r.gate}
    if "std" in used:
        listed = joins.components_like(terms, lookups.detail, V.MICRO_STD_CORE_PATTERNS)
        gated = _those(profiles, lambda p: any(r.gate == "std" for r in p.rule_list()))
        df = joins.flag_components(df, listed, "_std", gated)

    pairs = reduce(lambda a, b: a | b, [p.copies() for p in profiles])
    df = duplicate(df, pairs, {d: _those(profiles, lambda p: d in p.copies()) for d in pairs})
    if "COMPONENT_HATLESS" in pairs:
        df = df.withColumn("COMPONENT_HATLESS", head("COMPONENT_HATLESS"))

    df = apply_rules(df, rules, gates(used), run_of(profiles))
    return df.withColumn(KEY, equiv_key(profiles)).drop("_std")


def enrich(keyed: DataFrame, profiles: list[Profile] = PROFILES, lookups: Lookups = Lookups()) -> DataFrame:
    """Units, molecular weights and warnings: nothing here changes a class."""
    df = keyed
    for values, units in {(tuple(p.units[0]), p.units[1]) for p in profiles if p.units}:
        df = set_units(df, list(values), units, _those(profiles, lambda p: p.units == (list(values), units)))
    if any(p.weights for p in profiles):
        weighed = _those(profiles, lambda p: p.weights)
        df = joins.add_molecular_weights(df, lookups.part, lookups.weights, weighed)
    warned = [p.warnings for p in profiles if p.warnings]
    if warned:
        if any(w != warned[0] for w in warned):
            raise ValueError("profiles with different warnings cannot run together")
        df = add_warnings(df, warned[0], _those(profiles, lambda p: p.warnings))
    return df.drop(Profiles.BIT)


def coarsen(terms: DataFrame, profiles: list[Profile] = PROFILES, lookups: Lookups = Lookups()) -> DataFrame:
    """Keyed and enriched terms of profiles that run in one pass."""
    return enrich(key_terms(terms, profiles, lookups), profiles, lookups)


def families(terms: DataFrame, profiles: list[Profile]) -> list[list[Profile]]:
    """Profiles that share a pass: those with the same gates and kinds of rules.

    All conditions together make one generated method that is too large for the JVM
    to compile. Profiles with at most one gate or kind besides equality share a pass
    too. Terms stored by class are read once all the same, each family taking its own
    partitions; other terms would be read once per family, so there is one pass.
    """
    if CLASS_KEY not in terms.columns:
        return _batches(profiles)
    alike: dict[frozenset, list[Profile]] = {}
    for p in profiles:
        rules = p.rule_list()
        traits = {r.kind for r in rules if r.kind != EQ} | {r.gate.lstrip("!") for r in rules if r.gate}
        alike.setdefault(frozenset(traits if len(traits) > 1 else ()), []).append(p)
    return [batch for family in alike.values() for batch in _batches(family)]


def _batches(profiles: list[Profile]) -> list[list[Profile]]:
    """As many profiles at a time as can share a pass."""
    return [profiles[i : i + TOGETHER] for i in range(0, len(profiles), TOGETHER)]


def together(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def run(terms: DataFrame, profiles: list[Profile] = PROFILES, lookups: Lookups = Lookups()) -> DataFrame:
    """Review report of the profiles' classes.

    The keys come first, from the key columns alone; the report then reads the terms once more with everything it
    shows. Of several profiles, each shows an attribute only where it revises it.
    """
    check_run(terms, profiles, lookups)
    keyed = [(key_terms(terms, family, lookups), family) for family in families(terms, profiles)]
    keys = together([k.select(PROFILE, KEY, "LOINC_NUM") for k, _ in keyed])
    df = together([enrich(k, family, lookups) for k, family in keyed])
    if len(profiles) > 1:
        shown = {s: r for r, s in REVISED_PAIRS.items() if r in df.columns}
        df = df.withColumns({s: F.when(F.col(r).isNotNull(), F.col(s)) for s, r in shown.items()})
    return report(df, [PROFILE], keys)


def run_edited(
    terms: DataFrame, class_value: str, key: list[str], edit: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Review report of one class, coarsened by the caller's own function."""
    df = class_subset(terms, [class_value]).transform(edit)
    return report(df.withColumn(KEY, class_key(key)))
