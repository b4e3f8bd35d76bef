"""Regime rules kept as rows of a table, compiled to one column expression.

A row is one rule of an ordered list; a null column sets no condition. Before a
list is used it is proved on every case it can tell apart: a rule that no row of
data can reach is rejected, and so are two rules that claim the same case with
different answers, where only their order would decide. A list that passes
gives the same answer in any order.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.filters import RegimeColumns, RegimeRule, regime_value

# A list of more rules is not one that people keep; nothing larger comes to the driver.
MOST_RULES = 1000
RULE_TABLE = """rule_list string, place int, since string, before string, products array<string>, other_than_products array<string>,
    systems array<string>, other_than_systems array<string>, cut string, blank_cut boolean, jurisdiction string, blank_jurisdiction boolean,
    crr2 boolean, keep boolean"""
_OTHER, _BLANK = "(any other)", ""


class RuleConflict(ValueError):
    """Raised with one line for each rule that cannot be reached or contradicts another."""

    def __init__(self, report: Sequence[str]):
        self.report = list(report)
        super().__init__("; ".join(self.report))


def flat(rules: Sequence[RegimeRule], outer: RegimeRule | None = None) -> Iterator[RegimeRule]:
    """The rules without nesting: a rule within another holds where both do."""
    for rule in rules:
        joined = rule if outer is None else replace(rule, **{k: v for k, v in vars(outer).items() if k in _CONDITIONS and v not in (None, False)})
        if rule.within:
            yield from flat(rule.within, joined)
        else:
            yield joined


_CONDITIONS = (
    "since", "before", "products", "other_than_products", "systems", "other_than_systems", "cut", "blank_cut", "jurisdiction", "blank_jurisdiction", "crr2",
)


def rule_rows(name: str, rules: Sequence[RegimeRule]) -> list[tuple]:
    """A list of rules as rows of a rule table."""
    def cell(value):
        return list(value) if isinstance(value, (tuple, frozenset, set)) else value

    return [(name, n, *(cell(getattr(rule, c)) for c in _CONDITIONS), bool(rule.keep)) for n, rule in enumerate(flat(rules))]


def rules_of(table: DataFrame, name: str) -> list[RegimeRule]:
    """The rules of one list, in order of their place."""
    rows = table.where(F.col("rule_list") == name).orderBy("place").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise RuleConflict([f"list {name} has more than {MOST_RULES} rules"])
    flags = ("blank_cut", "blank_jurisdiction")
    return [RegimeRule(**{c: bool(row[c]) if c in flags else row[c] for c in _CONDITIONS}, keep=bool(row.keep)) for row in rows]


@dataclass(frozen=True)
class Case:
    """One of the cases a list can tell apart; ``period`` counts the effective months that have begun."""

    period: int
    product: str
    system: str
    cut: str
    jurisdiction: str
    crr2: bool


def cases(rules: Sequence[RegimeRule], months: Sequence[str]) -> list[Case]:
    """Every combination of the values that the rules name, any other value, and a blank."""
    def named(*columns):
        found = {v for rule in rules for c in columns for v in ([getattr(rule, c)] if isinstance(getattr(rule, c), str) else getattr(rule, c) or ())}
        return [*sorted(found), _OTHER, _BLANK]

    return [
        Case(*values)
        for values in product(
            range(len(months) + 1), named("products", "other_than_products"), named("systems", "other_than_systems"), named("cut"), named("jurisdiction"), (True, False)
        )
    ]


def holds(rule: RegimeRule, case: Case, months: Sequence[str]) -> bool:
    """Whether a rule claims a case; the plain meaning of the column expression."""
    begun = {name: n < case.period for n, name in enumerate(months)}
    return (
        (not rule.since or begun[rule.since])
        and (not rule.before or not begun[rule.before])
        and (rule.products is None or case.product in rule.products)
        and (rule.other_than_products is None or case.product not in rule.other_than_products)
        and (rule.systems is None or case.system in rule.systems)
        and (rule.other_than_systems is None or case.system not in rule.other_than_systems)
        and (rule.cut is None or case.cut == rule.cut)
        and (not rule.blank_cut or case.cut == _BLANK)
        and (rule.jurisdiction is None or case.jurisdiction == rule.jurisdiction)
        and (not rule.blank_jurisdiction or case.jurisdiction == _BLANK)
        and (rule.crr2 is None or case.crr2 == rule.crr2)
    )


def conflicts(rules: Sequence[RegimeRule], months: Sequence[str]) -> list[str]:
    """Rules that are never the first to claim a case, and pairs that claim one with different answers."""
    reached, against = set(), {}
    for case in cases(rules, months):
        claimed = [n for n, rule in enumerate(rules) if holds(rule, case, months)]
        if claimed:
            reached.add(claimed[0])
        for n in claimed[1:]:
            if rules[n].keep != rules[claimed[0]].keep:
                against.setdefault((claimed[0], n), case)
    report = [f"rule {n} cannot be reached" for n in range(len(rules)) if n not in reached]
    return report + [f"rules {a} and {b} answer differently for {case}" for (a, b), case in sorted(against.items(), key=lambda x: x[0])]


def compiled(table: DataFrame, name: str, months: Mapping[str, object], order: Sequence[str], otherwise=False, columns: RegimeColumns | None = None) -> Column:
    """One column for a rule list of a table: the answer of the rule that holds, else ``otherwise``.

    ``months`` gives the effective months, ``order`` names them from the
    earliest on. An unknown month, an unreachable rule and a contradiction are
    errors.
    """
    rules = rules_of(table, name)
    unknown = {m for rule in rules for m in (rule.since, rule.before) if m and m not in order}
    report = [f"month {m} is not known" for m in sorted(unknown)] or conflicts(rules, order)
    if report:
        raise RuleConflict(report)
    return regime_value(rules, dict(months), otherwise, columns)
