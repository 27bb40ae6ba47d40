"""Group rules as data.

A rule says which values of one coarsened column become a group, for one class
profile. Rules of a column apply in order, each seeing what the earlier ones
left. The driver holds the (small) rule set and works out, per listed value,
where the whole chain of equality rules leads; the data then needs one lookup
per column instead of one pass per group.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import product

from termfold.functions.text import HAT, norm_text, revised_name

EQ = "eq"                                    # head equals one of the values
EXCEPT_VALUES = "except_values"              # head equals none of the values
EXCEPT_PATTERNS = "except_patterns"          # head is like none of the patterns
DEFAULT = "default_except_patterns"          # same, and no sibling group is in place
ASSIGN = "assign"                            # whole value set where the gate holds
KINDS = (EQ, EXCEPT_VALUES, EXCEPT_PATTERNS, DEFAULT, ASSIGN)


@dataclass(frozen=True)
class Rule:
    """One rule. ``gate`` names a boolean condition, ``!name`` its negation.

    ``block`` numbers the set of groups a rule was given in; the groups a
    default rule leaves alone are the equality groups of its own block.
    """

    profile: str
    target: str
    seq: int
    kind: str
    group: str
    values: tuple[str, ...] = ()
    gate: str | None = None
    block: int = 0


@dataclass(frozen=True)
class Step:
    """Rules for one attribute, as written in a profile."""

    source: str
    target: str
    rules: tuple[tuple[str, str, tuple[str, ...]], ...] = ()   # (kind, group, values)
    gate: str | None = None


def groups(source: str, spec: dict, gate: str | None = None, target: str | None = None) -> Step:
    """Groups of a column: ``{group: [values]}``, applied in order.

    One group may be ``{"default": True, "skipPatterns": [...]}``: it takes what no
    other group of the set took and no pattern protects, after all the others.
    """
    listed, default = [], []
    for group, members in spec.items():
        if not isinstance(members, dict):
            if members:                                        # no values: nothing to do
                listed.append((EQ, group, tuple(members)))
            continue
        if not members.get("default"):
            raise ValueError(f"group {group!r}: a specification without 'default' has no effect here")
        if not members.get("skipPatterns"):
            raise ValueError(f"group {group!r}: a default group needs 'skipPatterns'")
        default.append((DEFAULT, group, tuple(members["skipPatterns"])))
    if len(default) > 1:
        raise ValueError("only one default group is possible: " + ", ".join(d[1] for d in default))
    if default and gate and not listed:
        raise ValueError(f"group {default[0][1]!r}: a gated default group needs other groups beside it")
    return Step(source, target or revised_name(source), tuple(listed + default), gate)


def copy(source: str) -> Step:
    return Step(source, revised_name(source))


def except_values(source: str, group: str, values: list[str]) -> Step:
    return Step(source, revised_name(source), ((EXCEPT_VALUES, group, tuple(values)),))


def except_patterns(source: str, group: str, patterns: list[str], gate: str | None = None) -> Step:
    return Step(source, revised_name(source), ((EXCEPT_PATTERNS, group, tuple(patterns)),), gate)


def assign(source: str, group: str, gate: str) -> Step:
    return Step(source, revised_name(source), ((ASSIGN, group, ()),), gate)


def rules_of(profile: str, steps: tuple[Step, ...] | list[Step]) -> list[Rule]:
    """Numbered rules of a profile's steps."""
    out: list[Rule] = []
    for block, step in enumerate(steps):
        for kind, group, values in step.rules:
            out.append(Rule(profile, step.target, len(out), kind, group, values, step.gate, block))
    return out


# --- long form ---------------------------------------------------------------

LONG_SCHEMA = (
    "profile string, target_col string, block int, seq int, kind string, grp string, "
    "value string, pos int, gate string"
)


def to_rows(rules: list[Rule]) -> list[tuple]:
    """One row per listed value (one row with a NULL value for a rule without any)."""
    return [
        (r.profile, r.target, r.block, r.seq, r.kind, r.group, value, pos, r.gate)
        for r in rules
        for pos, value in enumerate(r.values or (None,))
    ]


def from_rows(rows: list) -> list[Rule]:
    """Rules from long rows, given in any order."""
    members: dict[tuple, list] = {}
    for profile, target, block, seq, kind, group, value, pos, gate in rows:
        rule = (profile, seq, target, kind, group, gate, block)
        members.setdefault(rule, [])
        if value is not None:
            members[rule].append((pos, value))
    rules = [
        Rule(profile, target, seq, kind, group, tuple(v for _, v in sorted(members[rule])), gate, block)
        for rule in members
        for profile, seq, target, kind, group, gate, block in [rule]
    ]
    return check(sorted(rules, key=lambda r: (r.profile, r.seq)))


# --- checks ------------------------------------------------------------------

def check(rules: list[Rule]) -> list[Rule]:
    """Raise on rules that could only be a mistake."""
    listed = {(r.profile, r.target, r.block) for r in rules if r.kind == EQ}
    for r in rules:
        if r.kind not in KINDS:
            raise ValueError(f"unknown kind of rule: {r.kind!r}")
        if r.kind == ASSIGN and not r.gate:
            raise ValueError(f"group {r.group!r}: a rule without values needs a gate")
        if r.kind != ASSIGN and not r.values:
            raise ValueError(f"group {r.group!r}: no values")
        if r.kind == DEFAULT and r.gate and (r.profile, r.target, r.block) not in listed:
            raise ValueError(f"group {r.group!r}: a gated default group needs other groups beside it")
    return rules


def siblings(rules: list[Rule], default: Rule) -> list[str]:
    """Groups that a default rule must leave in place."""
    return [
        r.group for r in rules
        if r.kind == EQ and (r.profile, r.target, r.block) == (default.profile, default.target, default.block)
    ]


def lint(rules: list[Rule]) -> list[tuple[str, str, str, str, str]]:
    """Values that never match: (profile, target, group, value, reason)."""
    found = []
    taken: dict[tuple, str] = {}
    for r in rules:
        if r.kind not in (EQ, EXCEPT_VALUES):
            continue
        for value in dict.fromkeys(r.values):
            place = (r.profile, r.target, r.gate, norm_text(value))
            if HAT in value:
                found.append((r.profile, r.target, r.group, value, "holds ^, only the head is compared"))
            elif r.kind == EQ and taken.setdefault(place, r.group) != r.group:
                found.append((r.profile, r.target, r.group, value, f"taken before by {taken[place]}"))
    return found


# --- folding -----------------------------------------------------------------

def runs(rules: list[Rule]) -> dict[int, list[Rule]]:
    """Rules of one column of one profile, cut into stages.

    Odd stages hold only equality rules (a lookup), even stages the others.
    """
    stage, out = 0, {}
    for r in sorted(rules, key=lambda r: r.seq):
        if (r.kind == EQ) != (stage % 2 == 1):
            stage += 1
        out.setdefault(stage, []).append(r)
    return out


def gate_names(rules: list[Rule]) -> list[str]:
    return sorted({r.gate.lstrip("!") for r in rules if r.gate})


def fold(rules: list[Rule]) -> list[tuple[str, str, str]]:
    """Equality rules as a lookup: (gate state, normalised head, replacement).

    The gate state has one digit per gate name: 1 true, 0 false, 2 unknown.
    """
    names = gate_names(rules)
    heads = list(dict.fromkeys(norm_text(v) for r in rules for v in r.values if HAT not in v))
    takers: dict[str, list[int]] = {}                          # head -> places of the rules that list it
    for place, r in enumerate(rules):
        for v in {norm_text(v) for v in r.values}:
            takers.setdefault(v, []).append(place)
    out = []
    for digits in product("102", repeat=len(names)):
        truth = dict(zip(names, digits))
        applies = [
            r.gate is None or truth[r.gate.lstrip("!")] == ("0" if r.gate.startswith("!") else "1") for r in rules
        ]
        for start in heads:
            text, place = None, -1
            while True:
                now, hat, parts = (start if text is None else text).partition(HAT)
                later = takers.get(norm_text(now), ())
                place = next((p for p in later[bisect_right(later, place):] if applies[p]), None)
                if place is None:
                    break
                text = rules[place].group + hat + parts
            if text is not None:
                out.append(("".join(digits), start, text))
    return out


Diagram = tuple[list[int], list[str | None]]


def diagrams(rules: list[Rule], names: list[str]) -> dict[str, Diagram]:
    """Equality rules with gates of any number: normalised head -> decision diagram over the gates.

    A node per gate that still matters to a head; equal tails are shared, so that n rules with n gates take about n
    nodes, not 3 to the power of n states. A diagram is (numbers, texts): four numbers a node, the place of its gate in
    ``names`` (-1 at an end) and the nodes that follow when it is true, false and unknown; one text a node, the
    replacement at an end (None: the value stays). The first node is the start, every node comes before those that follow it.
    """
    place_of = {name: i for i, name in enumerate(names)}
    takers: dict[str, list[int]] = {}
    for place, r in enumerate(rules):
        for v in {norm_text(v) for v in r.values}:
            takers.setdefault(v, []).append(place)

    def later(text: str, place: int) -> list[int]:
        found = takers.get(norm_text(text.partition(HAT)[0]), [])
        return found[bisect_right(found, place):]

    # what may still be asked, filled from the last rule to the first: taking a rule leads to rules after it only
    asked_after: list[frozenset[int]] = [frozenset()] * len(rules)

    def asked(text: str, place: int) -> frozenset[int]:
        return frozenset().union(*(asked_after[p] for p in later(text, place)))

    for p in range(len(rules) - 1, -1, -1):
        own = {place_of[rules[p].gate.lstrip("!")]} if rules[p].gate else set()
        asked_after[p] = asked(rules[p].group, p) | own

    nodes: dict[tuple, int] = {}
    known_nodes: dict[tuple, int] = {}

    def node(what: tuple) -> int:
        return nodes.setdefault(what, len(nodes))

    def build(start: str, text: str | None, place: int, known: dict[int, str]) -> int:
        while True:
            now = start if text is None else text
            needed = asked(now, place)
            state = (now, text is None, place, tuple(sorted((g, d) for g, d in known.items() if g in needed)))
            if state in known_nodes:
                return known_nodes[state]
            taken = None
            for p in later(now, place):
                if rules[p].gate is None:
                    taken = p
                    break
                gate = place_of[rules[p].gate.lstrip("!")]
                if gate not in known:
                    follow = tuple(build(start, text, p - 1, known | {gate: d}) for d in "102")
                    known_nodes[state] = follow[0] if len(set(follow)) == 1 else node((gate, *follow))
                    return known_nodes[state]
                if known[gate] == ("0" if rules[p].gate.startswith("!") else "1"):
                    taken = p
                    break
            if taken is None:
                return node((-1, text))
            _, hat, parts = now.partition(HAT)
            text, place = rules[taken].group + hat + parts, taken

    heads = list(dict.fromkeys(norm_text(v) for r in rules for v in r.values if HAT not in v))
    tops = {head: build(head, None, -1, {}) for head in heads}
    by_number = list(nodes)
    return {head: _laid_out(top, by_number) for head, top in tops.items()}


def _laid_out(top: int, by_number: list[tuple]) -> Diagram:
    """The nodes below ``top``: a node is numbered after those that follow it, so falling numbers are in order."""
    below, open_ = {top}, [top]
    while open_:
        what = by_number[open_.pop()]
        new = set(what[1:]) - below if what[0] >= 0 else set()
        below |= new
        open_ += new
    order = sorted(below, reverse=True)
    place = {n: i for i, n in enumerate(order)}
    numbers: list[int] = []
    texts: list[str | None] = []
    for n in order:
        what = by_number[n]
        numbers += [what[0], *(place[f] for f in what[1:])] if what[0] >= 0 else [-1] + 3 * [place[n]]
        texts.append(None if what[0] >= 0 else what[1])
    return numbers, texts
