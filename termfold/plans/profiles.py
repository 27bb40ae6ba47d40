"""The class profiles, declared as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from termfold.functions.text import working_name
from termfold.operators import rules as R
from termfold.plans import fixed_values as V


def pick(table: dict, *names: str) -> dict:
    return {name: table[name] for name in names}


@dataclass(frozen=True)
class Profile:
    """How one lab class is coarsened and keyed."""

    class_value: str
    key: tuple[str, ...]
    steps: tuple[R.Step, ...]
    hatless: bool = False                                    # COMPONENT_HATLESS is made
    units: tuple[list[str], str] | None = None               # (PROPERTY values, units)
    weights: bool = False                                    # MOLECULAR_WEIGHT is added
    warnings: list = field(default_factory=list)
    rules: tuple[R.Rule, ...] | None = None                  # in place of the steps' own

    @property
    def name(self) -> str:
        return working_name(self.class_value)

    def rule_list(self) -> list[R.Rule]:
        return list(self.rules) if self.rules is not None else R.rules_of(self.name, self.steps)

    def copies(self) -> dict[str, str]:
        """Duplicated columns: copy -> source."""
        own = {"COMPONENT_HATLESS": "COMPONENT"} if self.hatless else {}
        return own | {revised: source for source, revised in (
            (s.source, R.revised_name(s.source)) for s in self.steps)}


def _chem(class_value: str, scale: dict | None = None) -> Profile:
    """CHEM; with a scale grouping also DRUG/TOX."""
    steps = [
        R.groups("PROPERTY", V.CHEM_PROPERTY),
        R.groups("TIME_ASPCT", V.CHEM_TIME),
        R.groups("SYSTEM", pick(V.SHARED_SYSTEM, "DuodGastricFld", "OcularVitrFld")),
        R.groups("SYSTEM", pick(V.SHARED_SYSTEM, "Intravascular-any"), gate="!oxygen"),
        R.groups("SYSTEM", V.CHEM_SYSTEM_OXYGEN, gate="oxygen"),
        *([R.groups("SCALE_TYP", scale)] if scale else []),
        R.except_patterns("METHOD_TYP", V.METHOD_OTHER, V.CHEM_METHOD_KEPT_PATTERNS),
    ]
    key = ["COMPONENT", "PROPERTY_REV", "TIME_REV", "SYSTEM_REV", *(["SCALE_REV"] if scale else []), "METHOD_REV"]
    return Profile(
        class_value, tuple(key), tuple(steps), hatless=True,
        units=(V.CHEM_DF_PROPERTIES, V.CHEM_DF_UNITS), weights=True, warnings=V.CHEM_WARNINGS,
    )


def allergy(strict: bool = True) -> Profile:
    """ALLERGY. As published, the scale group is looked for in SYSTEM_REV, so that
    SCALE_REV is a plain copy; ``strict=False`` applies it to SCALE_REV."""
    return Profile(
        "ALLERGY", ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "SCALE_REV"),
        (
            R.groups("PROPERTY", V.ALLERGY_PROPERTY),
            R.groups("SYSTEM", pick(V.SHARED_SYSTEM, "Intravascular-any")),
            R.groups("SCALE_TYP", V.SHARED_SCALE, gate="!rast", target="SYSTEM_REV" if strict else "SCALE_REV"),
        ),
    )


PROFILES = [
    Profile(
        "ABXBACT", ("COMPONENT", "SCALE_REV", "METHOD_REV"),
        (
            R.except_values("SCALE_TYP", V.ABXBACT_SCALE_OTHER, V.ABXBACT_SCALE_KEPT),
            R.except_values("METHOD_TYP", V.METHOD_OTHER, V.ABXBACT_METHOD_KEPT),
        ),
    ),
    allergy(),
    Profile(
        "CELLMARK", ("COMPONENT", "SYSTEM_REV", "SCALE_REV"),
        (
            R.groups("SYSTEM", pick(V.SHARED_SYSTEM, "Intravascular-any")),
            R.groups("SCALE_TYP", V.SHARED_SCALE),
        ),
    ),
    _chem("CHEM"),
    Profile(
        "COAG", ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "METHOD_REV"),
        (
            R.groups("PROPERTY", V.COAG_PROPERTY),
            R.groups("SYSTEM", V.COAG_SYSTEM),
            R.except_values("METHOD_TYP", V.METHOD_OTHER, V.COAG_METHOD_KEPT),
        ),
    ),
    Profile(
        "CYTO", ("COMPONENT_REV", "SYSTEM_REV"),
        (R.groups("COMPONENT", V.CYTO_COMPONENT), R.groups("SYSTEM", V.CYTO_SYSTEM)),
    ),
    _chem("DRUG/TOX", V.SHARED_SCALE),
    Profile("FERT", ("COMPONENT", "SCALE_REV"), (R.groups("SCALE_TYP", V.SHARED_SCALE),)),
    Profile(
        "HEM/BC", ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV"),
        (
            R.groups("PROPERTY", V.HEMBC_PROPERTY),
            R.groups("SYSTEM", pick(V.SHARED_SYSTEM, "Bld-any", "BLdCo-any", "DuodGastricFld")),
        ),
    ),
    Profile(
        "MICRO", ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "METHOD_REV"),
        (
            R.groups("PROPERTY", V.MICRO_PROPERTY),
            R.groups("SYSTEM", V.MICRO_SYSTEM),
            R.groups("SYSTEM", pick(V.SHARED_SYSTEM, "Intravascular-any", "DuodGastricFld", "OcularVitrFld")),
            R.groups("SYSTEM", V.MICRO_SYSTEM_STD, gate="std"),
            R.groups("METHOD_TYP", V.MICRO_METHOD),
            R.assign("METHOD_TYP", V.ANTIBODY_GROUP, gate="antibody_without_method"),
        ),
    ),
    Profile(
        "MOLPATH", ("COMPONENT", "SYSTEM_REV"), (R.groups("SYSTEM", V.MOLPATH_SYSTEM),),
    ),
    Profile(
        "SERO", ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV", "METHOD_REV"),
        (
            R.groups("PROPERTY", V.SERO_PROPERTY),
            R.groups("SYSTEM", pick(V.SHARED_SYSTEM, "Intravascular-any")),
            R.assign("METHOD_TYP", V.ANTIBODY_GROUP, gate="antibody_without_method"),
            R.groups("METHOD_TYP", {
                **V.SERO_METHOD,
                V.METHOD_OTHER: {"default": True, "skipPatterns": V.SERO_METHOD_KEPT_PATTERNS},
                **pick(V.MICRO_METHOD, V.ANTIBODY_GROUP),
            }),
        ),
    ),
    Profile(
        "UA", ("COMPONENT", "PROPERTY_REV", "SYSTEM_REV"),
        (R.groups("PROPERTY", V.UA_PROPERTY), R.groups("SYSTEM", V.UA_SYSTEM)),
    ),
]

BY_NAME = {p.name: p for p in PROFILES}


def all_rules(profiles: list[Profile] = PROFILES) -> list[R.Rule]:
    return [r for p in profiles for r in p.rule_list()]
