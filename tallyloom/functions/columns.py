"""Small column helpers shared by all rule packs.

All of them are null-safe: a comparison with a null input counts as "no", so
``negated`` tests read the same as they are written.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def z(c: ColumnOrName) -> Column:
    """An amount, with null read as zero."""
    return F.coalesce(column(c), F.lit(0.0))


def text(c: ColumnOrName, default: str = "") -> Column:
    """A code, with null read as ``default``."""
    return F.coalesce(column(c), F.lit(default))


def equals(c: ColumnOrName, value) -> Column:
    """Equality that is false, never null, for a null input."""
    return column(c).eqNullSafe(F.lit(value))


def one_of(c: ColumnOrName, values: Iterable) -> Column:
    """Membership that is false, never null, for a null input."""
    return F.coalesce(column(c).isin(*values), F.lit(False))


def is_blank(c: ColumnOrName) -> Column:
    """Null, empty or only spaces."""
    return F.trim(text(c)) == ""


def differs(c: ColumnOrName, value, default) -> Column:
    """Inequality after replacing null by ``default``."""
    return F.coalesce(column(c), F.lit(default)) != F.lit(value)


def first_match(rules: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """The value of the first rule whose condition holds."""
    chain = None
    for condition, value in rules:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(otherwise)


def pick(flag: Column, yes: ColumnOrName, no: ColumnOrName) -> Column:
    """One of two columns, by a condition."""
    return F.when(flag, column(yes)).otherwise(column(no))


def amount_if(condition: Column, amount: ColumnOrName) -> Column:
    """The amount where the condition holds, else zero."""
    return F.when(condition, column(amount)).otherwise(F.lit(0.0))


def total(columns: Iterable[ColumnOrName]) -> Column:
    """Sum of several amounts in one row, null counting as zero."""
    return reduce(lambda a, b: a + b, [z(c) for c in columns])


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Quotient that is null, not an error, for a zero denominator."""
    return F.try_divide(column(numerator), column(denominator))


def capped_by(amount: ColumnOrName, ceiling: ColumnOrName) -> Column:
    """A positive amount limited by a ceiling.

    A non-positive ceiling replaces the amount; a non-positive amount gives 0.
    """
    a, c = z(amount), z(ceiling)
    return F.when(a > 0, F.when(c <= 0, c).otherwise(F.least(a, c))).otherwise(F.lit(0.0))


def limited_to(ceiling: ColumnOrName, amount: ColumnOrName) -> Column:
    """The amount, never above a positive ceiling; the ceiling if it is not positive."""
    c, a = z(ceiling), z(amount)
    return F.when(c <= 0, c).otherwise(F.least(a, c))


def pro_rata(part: ColumnOrName, whole: Column, amount: Column) -> Column:
    """The part's share of an amount; 0 where the whole is 0."""
    return F.when(whole != 0, z(part) * amount / whole).otherwise(F.lit(0.0))


def factor_or_one(factor: ColumnOrName) -> Column:
    """A divisor: null and zero count as 1."""
    f = column(factor).cast("double")
    return F.when(f.isNull() | (f == 0), F.lit(1.0)).otherwise(f)


def support_divisor(infra_flag, infra_factor, sme_flag, sme_factor) -> Column:
    """Divisor that undoes a support factor: infrastructure first, then SME."""
    return first_match(
        [(equals(infra_flag, "Y"), factor_or_one(infra_factor)), (equals(sme_flag, "Y"), factor_or_one(sme_factor))],
        F.lit(1.0),
    )


def first_valid_key(*keys: ColumnOrName, sentinel: int = -1) -> Column:
    """The first key that is neither null nor the sentinel, else the sentinel."""
    return F.coalesce(*[F.nullif(column(k), F.lit(sentinel)) for k in keys], F.lit(sentinel))


def without_prefix(identifier: ColumnOrName, prefix: ColumnOrName) -> Column:
    """An identifier with a per-row prefix cut off; no prefix leaves it as it is."""
    return F.substring(column(identifier), F.length(text(prefix)) + F.lit(1), F.length(column(identifier)))


def code_lookup(c: ColumnOrName, table: dict[str, str], otherwise: Column | None = None) -> Column:
    """Map a code through a fixed table; unknown codes give ``otherwise`` (null)."""
    literal_map = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(literal_map, column(c))
    return found if otherwise is None else F.coalesce(found, otherwise)
