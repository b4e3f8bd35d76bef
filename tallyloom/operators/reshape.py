"""Unpivot to report cells, routing to rows, and cell skeletons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import first_match


@dataclass(frozen=True)
class CellRow:
    """One report row: its id, its measures, and which input rows feed it.

    ``row_id`` may be a column, for rows routed by value or class. ``blank``
    names measures and a condition under which their value is left out.
    """

    row_id: str | Column
    measures: Sequence[str]
    where: Column | None = None
    sheet: str = "sheet_id"
    blank: tuple[Sequence[str], Column] | None = None


def strip_suffix(c: Column, separator: str = "_") -> Column:
    """``C0010_ONBAL`` becomes ``C0010``."""
    return F.substring_index(c, separator, 1)


def route_by_value(value: Column, routes: Mapping[float, str], otherwise: str, scale: int = 3) -> Column:
    """Row id for a rounded value; values outside the list share one row."""
    rounded = F.round(value, scale)
    return first_match([(rounded == F.lit(v), F.lit(r)) for v, r in routes.items()], F.lit(otherwise))


def unpivot_rows(df: DataFrame, ids: Sequence[str], rows: Sequence[CellRow]) -> DataFrame:
    """All report rows from one pass over the input.

    Each input row builds an array with one struct per report row it feeds;
    two explodes then give (sheet, row, column, value). The input is read
    once however many report rows there are.
    """
    blocks = []
    for row in rows:
        row_id = F.lit(row.row_id) if isinstance(row.row_id, str) else row.row_id
        cells = []
        for m in row.measures:
            value = F.col(m).cast("double")
            if row.blank is not None and m in row.blank[0]:
                value = F.when(~F.coalesce(row.blank[1], F.lit(False)), value)
            cells.append(
                F.struct(
                    row_id.alias("row_id"),
                    F.col(row.sheet).alias("sheet_id"),
                    F.lit(m).alias("measure"),
                    value.alias("value"),
                )
            )
        block = F.array(*cells)
        blocks.append(block if row.where is None else F.when(F.coalesce(row.where, F.lit(False)), block))
    spread = df.select(*ids, F.explode(F.filter(F.array(*blocks), lambda b: b.isNotNull())).alias("_block"))
    cells = spread.select(*ids, F.explode("_block").alias("_cell"))
    return cells.select(
        *ids,
        F.col("_cell.sheet_id").alias("sheet_id"),
        F.col("_cell.row_id").alias("row_id"),
        strip_suffix(F.col("_cell.measure")).alias("column_id"),
        F.col("_cell.value").alias("value"),
    )


def route_rows(df: DataFrame, keep: Sequence[str], rows: Sequence[CellRow]) -> DataFrame:
    """One wide row for each report row that an input row feeds, its measures untouched.

    ``_row`` is the place of the report row in the list, ``_blank`` whether its
    blank measures are left out; ``row_id`` and ``sheet_id`` are resolved. Sums
    by these columns can then be taken before any cell exists.
    """
    routes = []
    for n, row in enumerate(rows):
        route = F.struct(
            F.lit(n).alias("_row"),
            (F.lit(row.row_id) if isinstance(row.row_id, str) else row.row_id).alias("row_id"),
            F.col(row.sheet).alias("sheet_id"),
            (F.lit(False) if row.blank is None else F.coalesce(row.blank[1], F.lit(False))).alias("_blank"),
        )
        routes.append(route if row.where is None else F.when(F.coalesce(row.where, F.lit(False)), route))
    routed = df.select(*keep, F.explode(F.array_compact(F.array(*routes))).alias("_route"))
    return routed.select(*keep, "_route.*")


def measures_of(rows: Sequence[CellRow]) -> list[str]:
    """All measures that some report row shows."""
    return list(dict.fromkeys(m for row in rows for m in row.measures))


def spread_cells(wide: DataFrame, ids: Sequence[str], rows: Sequence[CellRow]) -> DataFrame:
    """Wide rows of ``route_rows`` to cells (row, sheet, column, value): each shows the measures of its report row."""
    shown = None
    for n, row in enumerate(rows):
        hidden = set(row.blank[0]) if row.blank is not None else set()
        cells = F.array(
            *[
                F.struct(
                    strip_suffix(F.lit(m)).alias("column_id"),
                    (F.when(~F.col("_blank"), F.col(m)) if m in hidden else F.col(m)).cast("double").alias("value"),
                )
                for m in row.measures
            ]
        )
        shown = F.when(F.col("_row") == n, cells) if shown is None else shown.when(F.col("_row") == n, cells)
    return wide.select(*ids, "row_id", "sheet_id", F.explode(shown).alias("_cell")).select(*ids, "row_id", "sheet_id", "_cell.*")


def unpivot_measures(
    df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str = "column_id", value: str = "value"
) -> DataFrame:
    """Plain unpivot of one measure list."""
    typed = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in measures])
    return typed.unpivot(list(ids), list(measures), name, value)


def mask_value(df: DataFrame, condition: Column, value: str = "value") -> DataFrame:
    """Leave a value out where a condition holds, keeping its row."""
    return df.withColumn(value, F.when(~F.coalesce(condition, F.lit(False)), F.col(value)))


def skeleton_values(df: DataFrame, applicable: str, value: str = "value") -> DataFrame:
    """0 for an applicable cell, null for the others."""
    return df.withColumn(value, F.when(F.col(applicable) == "Y", F.lit(0.0)))
