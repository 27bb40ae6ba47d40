"""Applies group rules to columns: one broadcast lookup per column and stage."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termfold.functions.text import head, like, like_any, norm, one_of, regroup
from termfold.operators import rules as R
from termfold.operators.joins import lookup_join

PROFILE = "profile"

# Rules come from the driver, so the lookup is as small as they are; above this
# many rows it is measured and joined with care for hot heads.
BROADCAST_RULES = 50_000
# Gates on one column whose states are written out in the lookup (three to their power); beyond, diagrams.
WRITTEN_GATES = 3
# Profiles that run together: bits of a number.
TOGETHER = 63


def duplicate(df: DataFrame, pairs: dict[str, str], where: dict[str, Column] | None = None) -> DataFrame:
    """Copies of columns, NULL turned into '' in the copy and in the source.

    ``where`` limits a pair to some rows: elsewhere the source keeps its NULLs
    and the copy is NULL.
    """
    where = where or {}
    new: dict[str, Column] = {}
    for source in dict.fromkeys(pairs.values()):
        filled = F.coalesce(F.col(source), F.lit(""))
        dests = [d for d, s in pairs.items() if s == source]
        rows = [where.get(d, F.lit(True)) for d in dests]
        new[source] = F.when(reduce(lambda a, b: a | b, rows), filled).otherwise(F.col(source))
        new.update({d: F.when(r, filled) for d, r in zip(dests, rows)})
    return df.withColumns(new)


class Profiles:
    """The profiles of one run, each a bit of the ``_bit`` column.

    Testing a bit keeps the generated code short, however many profiles a
    condition names; with one profile there is nothing to test.
    """

    BIT = "_bit"

    def __init__(self, names: list[str]):
        if len(names) > TOGETHER:
            raise ValueError(f"at most {TOGETHER} profiles can share a pass; run() makes several passes of more")
        self.bits = {name: 1 << i for i, name in enumerate(names)}

    @property
    def several(self) -> bool:
        return len(self.bits) > 1

    def any_of(self, names: list[str]) -> Column:
        mask = sum(self.bits[n] for n in set(names))
        if mask == sum(self.bits.values()):
            return F.lit(True)
        return F.expr(f"({self.BIT} & {mask}L) <> 0")


def apply_rules(
    df: DataFrame,
    rules: list[R.Rule],
    gates: dict[str, Column] | None = None,
    profiles: Profiles | None = None,
) -> DataFrame:
    """Replace values of the target columns as the rules say.

    With several ``profiles`` the frame has their ``_bit`` column and each row follows
    the rules of its own profile; otherwise all rules apply to all rows.
    """
    R.check(rules)
    gates, columns = gates or {}, df.columns
    profiles = profiles or Profiles(list(dict.fromkeys(r.profile for r in rules)))
    staged: dict[int, dict[str, dict[str, list[R.Rule]]]] = {}
    for target, profile in dict.fromkeys((r.target, r.profile) for r in rules):
        own = [r for r in rules if (r.target, r.profile) == (target, profile)]
        for stage, run in R.runs(own).items():
            staged.setdefault(stage, {}).setdefault(target, {})[profile] = run
    for stage, by_target in sorted(staged.items()):
        if stage % 2:
            df = _look_up(df, by_target, gates, profiles)
        else:
            df = _other_rules(df, by_target, rules, gates, profiles)
    return df.select(*columns)


def gate_state(names: list[str], gates: dict[str, Column]) -> Column:
    """State of the gates as a number, one base-3 digit per gate."""
    state = F.lit(0)
    for name in names:
        state = state * 3 + F.when(gates[name], 1).when(~gates[name], 0).otherwise(2)
    return state


def _look_up(df, by_target, gates, profiles):
    """One broadcast lookup per column: head, profile and state of the gates."""
    keys: dict[str, Column] = {}
    texts: dict[str, Column] = {}
    lookups = []
    for target, by_profile in by_target.items():
        if any(len(R.gate_names(run)) > WRITTEN_GATES for run in by_profile.values()):
            lookup, own_keys, text, small = _diagram_lookup(df.sparkSession, target, by_profile, gates, profiles)
            keys.update(own_keys)
            lookups.append((lookup, [c for c in lookup.columns if c not in ("_nodes_" + target, "_texts_" + target)], small))
            texts[target] = text
            continue
        rows = [
            (start, profiles.bits[p], int(state or "0", 3), text)
            for p, run in by_profile.items() for state, start, text in R.fold(run)
        ]
        on = {"_head_" + target: 0}
        keys["_head_" + target] = norm(head(target))
        if profiles.several:
            on[Profiles.BIT] = 1
        gated: dict[tuple[str, ...], list[str]] = {}
        for p, run in by_profile.items():
            gated.setdefault(tuple(R.gate_names(run)), []).append(p)
        if any(gated):
            state = F.lit(0)
            for names, members in gated.items():
                if names:
                    state = F.when(profiles.any_of(members), gate_state(names, gates)).otherwise(state)
            on["_state_" + target] = 2
            keys["_state_" + target] = state
        found = "_text_" + target
        lookup = local_table(df.sparkSession, {
            **{name: [row[place] for row in rows] for name, place in on.items()},
            found: [row[3] for row in rows],
        })
        lookups.append((lookup, list(on), len(rows) <= BROADCAST_RULES))
        texts[target] = F.when(F.col(found).isNotNull(), regroup(F.col(found), target)).otherwise(F.col(target))
    df = df.withColumns(keys)
    for lookup, on, small in lookups:
        df = df.join(F.broadcast(lookup), on, "left") if small else lookup_join(df, lookup, on)
    return df.withColumns(texts)


def _diagram_lookup(spark, target, by_profile, gates, profiles):
    """(lookup, its key columns' values, new text, whether it is small): a head's diagram is followed in the row.

    A row of the lookup is a head (and profile) with its diagram, so gates of any number add no rows.
    """
    names = sorted({n for run in by_profile.values() for n in R.gate_names(run)})
    found = [(p, head_, *diagram) for p, run in by_profile.items() for head_, diagram in R.diagrams(run, names).items()]
    head_column, nodes, texts, digits = ("_" + c + "_" + target for c in ("head", "nodes", "texts", "digits"))
    columns = {head_column: [f[1] for f in found]}
    if profiles.several:
        columns[Profiles.BIT] = [profiles.bits[f[0]] for f in found]
    lookup = local_table(spark, {**columns, nodes: [f[2] for f in found], texts: [f[3] for f in found]})
    states = F.array(*[F.when(gates[n], 1).when(~gates[n], 2).otherwise(3) for n in names])
    gate = lambda i: F.get(nodes, 4 * i)
    last = F.aggregate(
        F.sequence(F.lit(0), F.size(texts) - 1), F.lit(0),
        lambda at, i: F.when((i == at) & (gate(i) >= 0), F.get(nodes, 4 * i + F.get(digits, gate(i)))).otherwise(at),
    )
    text = F.when(F.col(texts).isNotNull(), F.get(texts, last))
    new = F.when(text.isNotNull(), regroup(text, target)).otherwise(F.col(target))
    return lookup, {head_column: norm(head(target)), digits: states}, new, sum(len(f[3]) for f in found) <= BROADCAST_RULES


ARROW_TYPES = {"_bit": pa.int64(), "_state": pa.int32(), "_nodes": pa.list_(pa.int32()), "_texts": pa.list_(pa.string())}


def local_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A few driver-side rows as a DataFrame."""
    return spark.createDataFrame(pa.table({
        c: pa.array(v, next((t for start, t in ARROW_TYPES.items() if c.startswith(start)), pa.string()))
        for c, v in columns.items()
    }))


def _other_rules(df, by_target, rules, gates, profiles):
    """All rules that are no lookup, as CASE branches; profiles with the same rule share one."""
    rounds = max(len(run) for by_profile in by_target.values() for run in by_profile.values())
    for i in range(rounds):
        texts = {}
        for target, by_profile in by_target.items():
            same: dict[tuple, list[R.Rule]] = {}
            for run in by_profile.values():
                for rule in run[i:i + 1]:
                    beside = tuple(R.siblings(rules, rule)) if rule.kind == R.DEFAULT else ()
                    same.setdefault((rule.kind, rule.group, rule.values, rule.gate, beside), []).append(rule)
            text = None
            for members in same.values():
                rule = members[0]
                holds = profiles.any_of([r.profile for r in members]) & condition(rule, target, rules)
                if rule.gate:
                    holds = holds & _gate(gates, rule.gate)
                value = F.lit(rule.group) if rule.kind == R.ASSIGN else regroup(rule.group, target)
                text = F.when(holds, value) if text is None else text.when(holds, value)
            if text is not None:
                texts[target] = text.otherwise(F.col(target))
        df = df.withColumns(texts)
    return df


def _gate(gates: dict[str, Column], name: str) -> Column:
    return ~gates[name[1:]] if name.startswith("!") else gates[name]


def condition(rule: R.Rule, target: str, rules: list[R.Rule]) -> Column:
    """Where a rule applies, its gate left aside."""
    first = head(target)
    if rule.kind == R.EQ:
        return one_of(first, list(rule.values))
    if rule.kind == R.EXCEPT_VALUES:
        return ~one_of(first, list(rule.values))
    if rule.kind == R.ASSIGN:
        return F.lit(True)
    free = ~like_any(first, list(rule.values))
    if rule.kind == R.DEFAULT:
        free = free & ~in_a_group(target, R.siblings(rules, rule))
    return free


def in_a_group(target: str, names: list[str]) -> Column:
    """Is a value one of the names, or one of them followed by sub-parts?

    However many names there are, it is two membership tests: a value with sub-parts begins with a name if its head is the
    name. Names with wildcards are patterns, each tested by itself.
    """
    if not names:
        return F.lit(False)
    plain = [g for g in names if not any(c in g for c in "%_[^")]
    held = one_of(target, names)
    if plain:
        held = held | (F.col(target).contains("^") & F.lower(head(target)).isin(sorted({g.lower() for g in plain})))
    return reduce(lambda a, g: a | like(target, g + "^%"), [g for g in names if g not in plain], held)
