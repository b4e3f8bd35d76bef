"""Row filters: validity on a date, and ordered regime rules kept as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import column, equals, first_match, is_blank, one_of


def is_valid_on(date, valid_from: str = "valid_from_date", valid_to: str = "valid_to_date") -> Column:
    """Half-open validity: the start day counts, the end day does not."""
    d = F.to_date(F.lit(date)) if isinstance(date, str) else date
    return (F.col(valid_from) <= d) & (F.col(valid_to) > d)


def valid_on(df: DataFrame, date, valid_from: str = "valid_from_date", valid_to: str = "valid_to_date") -> DataFrame:
    """Rows of an effective-dated frame that hold on a date."""
    return df.where(is_valid_on(date, valid_from, valid_to))


def latest_snapshot(df: DataFrame, snapshot: str, date=None, **validity: str) -> DataFrame:
    """Rows of the newest snapshot, optionally also valid on a date.

    The newest snapshot is one scalar, so nothing but a filter reaches the scan.
    """
    newest = df.select(F.max(snapshot)).scalar()
    rows = df.where(F.col(snapshot) == newest)
    return rows if date is None else valid_on(rows, date, **validity)


def latest_day(df: DataFrame, timestamp: str) -> DataFrame:
    """Rows of the newest day of a timestamp.

    The stored column itself is compared with the begin of that day, so files
    and row groups that end before it are skipped.
    """
    newest = df.select(F.date_trunc("day", F.max(timestamp)).cast(df.schema[timestamp].dataType)).scalar()
    return df.where(F.col(timestamp) >= newest)


@dataclass(frozen=True)
class RegimeRule:
    """One rule of an ordered list; every condition that is set must hold.

    ``since`` and ``before`` name effective months of the run, so the same
    list serves every reporting date. ``keep`` may be a plain yes/no, or
    nested rules that decide within this one.
    """

    since: str | None = None
    before: str | None = None
    products: Sequence[str] | None = None
    other_than_products: Sequence[str] | None = None
    systems: Sequence[str] | None = None
    other_than_systems: Sequence[str] | None = None
    cut: str | None = None
    blank_cut: bool = False
    jurisdiction: str | None = None
    blank_jurisdiction: bool = False
    crr2: bool | None = None
    keep: object = True
    within: Sequence["RegimeRule"] = field(default_factory=tuple)


@dataclass(frozen=True)
class RegimeColumns:
    """Names of the columns a regime rule looks at."""

    month: str = "year_month_rk"
    product: str = "aclm_product_type"
    system: str = "sys_code"
    cut: str = "capital_cuts"
    jurisdiction: str = "jurisdiction_flag"
    crr2: str = "crr2_flag"


def _condition(rule: RegimeRule, months: dict, names: RegimeColumns) -> Column:
    def limit(name: str) -> Column:
        value = months[name]
        return value if isinstance(value, Column) else F.lit(value)

    parts: list[Column] = []
    if rule.since:
        parts.append(F.coalesce(column(names.month) >= limit(rule.since), F.lit(False)))
    if rule.before:
        parts.append(F.coalesce(column(names.month) < limit(rule.before), F.lit(False)))
    if rule.products is not None:
        parts.append(one_of(names.product, rule.products))
    if rule.other_than_products is not None:
        parts.append(~one_of(names.product, rule.other_than_products))
    if rule.systems is not None:
        parts.append(one_of(names.system, rule.systems))
    if rule.other_than_systems is not None:
        parts.append(~one_of(names.system, rule.other_than_systems))
    if rule.cut is not None:
        parts.append(equals(names.cut, rule.cut))
    if rule.blank_cut:
        parts.append(is_blank(names.cut))
    if rule.jurisdiction is not None:
        parts.append(equals(names.jurisdiction, rule.jurisdiction))
    if rule.blank_jurisdiction:
        parts.append(is_blank(names.jurisdiction))
    if rule.crr2 is not None:
        flagged = equals(names.crr2, "Y")
        parts.append(flagged if rule.crr2 else ~flagged)
    result = F.lit(True)
    for part in parts:
        result = result & part
    return result


def regime_value(rules: Sequence[RegimeRule], months: dict, otherwise, names: RegimeColumns | None = None) -> Column:
    """The ``keep`` of the first rule that holds, else ``otherwise``."""
    names = names or RegimeColumns()
    chain = [
        (
            _condition(rule, months, names),
            regime_value(rule.within, months, otherwise, names)
            if rule.within
            else (rule.keep if isinstance(rule.keep, Column) else F.lit(rule.keep)),
        )
        for rule in rules
    ]
    return first_match(chain, otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def regime_filter(
    df: DataFrame, rules: Sequence[RegimeRule], months: dict, names: RegimeColumns | None = None
) -> DataFrame:
    """Rows for which the first matching rule says keep; no match excludes."""
    return df.where(regime_value(rules, months, False, names))
