"""Declared layouts and contracts: what a layer must look like before it is written.

Layers are some hundreds of columns wide, but their names follow rules: the end
of a name tells its type. A contract states these rules, the columns that must
be there and not be null, and the key.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, layout: T.StructType, fill: Mapping[str, object] | None = None) -> DataFrame:
    """Select the layout's columns in its order and types.

    A missing column is an error unless ``fill`` names a value for it; names
    compare without case.
    """
    have = {c.lower(): c for c in df.columns}
    extra = {k.lower(): v for k, v in (fill or {}).items()}
    missing = [f.name for f in layout.fields if f.name.lower() not in have and f.name.lower() not in extra]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(
        *[
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(extra[f.name.lower()]))
            .cast(f.dataType)
            .alias(f.name)
            for f in layout.fields
        ]
    )


class ContractViolation(ValueError):
    """Raised with the whole report, one line for each violation."""

    def __init__(self, layer: str, report: Sequence[str]):
        self.report = list(report)
        super().__init__(f"{layer}: " + "; ".join(self.report))


@dataclass(frozen=True)
class Contract:
    """What a layer promises.

    ``kinds`` are (pattern of a name, type) in order, the first one that
    matches counts; ``columns`` names columns that must be there, with their
    types, and ``not_null`` those without nulls; ``key`` tells rows apart.
    """

    layer: str
    columns: Mapping[str, str]
    kinds: Sequence[tuple[str, str]] = ()
    not_null: Sequence[str] = ()
    key: Sequence[str] = ()
    # Columns whose type departs from the rules.
    others: Mapping[str, str] = field(default_factory=dict)

    def wanted(self, name: str) -> str | None:
        """Type a column must have, None where no rule names it."""
        known = {**self.others, **self.columns}.get(name)
        return known or next((kind for pattern, kind in self.kinds if re.search(pattern, name)), None)

    def schema_report(self, df: DataFrame) -> list[str]:
        """Violations that need no row: missing and repeated columns, wrong types."""
        have: dict[str, str] = {}
        report = []
        for name, kind in df.dtypes:
            if name.lower() in have:
                report.append(f"column {name.lower()} occurs more than once")
            have[name.lower()] = kind
        report += [f"column {name} is missing" for name in self.columns if name not in have]
        for name, kind in have.items():
            wanted = self.wanted(name)
            if wanted and kind not in (wanted, "void"):
                report.append(f"column {name} is {kind}, not {wanted}")
        return report

    def null_counts(self) -> list[Column]:
        """Metrics that are gathered while rows are written."""
        return [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in self.not_null]

    def row_report(self, written: DataFrame, nulls: Mapping[str, int]) -> list[str]:
        """Violations of the rows; the key is checked on the written key columns alone."""
        report = [f"column {c} is null in {nulls[f'null_{c}']} rows" for c in self.not_null if nulls.get(f"null_{c}")]
        if self.key:
            again = written.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("keys")).first().keys
            if again:
                report.append(f"key ({', '.join(self.key)}) is not unique: {again} keys occur more than once")
        return report

    def check(self, df: DataFrame) -> DataFrame:
        """A frame that is not written: its names and types, and its nulls by a scan of the columns that may hold none."""
        report = self.schema_report(df)
        if not report and self.not_null:
            some = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.not_null])
            report = self.row_report(df, df.where(some).agg(*self.null_counts()).first().asDict())
        if report:
            raise ContractViolation(self.layer, report)
        return df
