"""Month and quarter arithmetic on dates and yyyymm keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import ColumnOrName, column


def month_key(date: ColumnOrName) -> Column:
    """Integer yyyymm of a date."""
    d = column(date)
    return F.year(d) * 100 + F.month(d)


def month_end(date: ColumnOrName) -> Column:
    return F.last_day(column(date))


def key_to_date(key: ColumnOrName) -> Column:
    """First day of a yyyymm key."""
    k = column(key)
    return F.make_date((k / 100).cast("int"), k % 100, F.lit(1))


def quarter_end(date: ColumnOrName) -> Column:
    """Last day of the quarter that holds a date."""
    return F.last_day(F.add_months(F.trunc(column(date), "quarter"), 2))


def previous_quarter_key(date: ColumnOrName) -> Column:
    """yyyymm of the quarter end three months before a date."""
    return month_key(quarter_end(F.add_months(column(date), -3)))


def quarter_key(date: ColumnOrName) -> Column:
    """yyyymm of the end of the quarter that holds a date."""
    return month_key(quarter_end(date))


def quarter_months(date: ColumnOrName) -> Column:
    """Array of month ends of the quarter, up to the date's own month."""
    d = column(date)
    starts = F.sequence(F.to_date(F.trunc(d, "quarter")), F.to_date(F.trunc(d, "month")), F.expr("interval 1 month"))
    return F.transform(starts, F.last_day)


def quarter_months_from_calendar(calendar: DataFrame, run_key: int) -> DataFrame:
    """Months of the run's quarter, up to the run month, from a date table.

    ``calendar`` has ``year_month_rk``, ``year``, ``year_quarter_number`` and
    ``month_end_date``.
    """
    run = calendar.where(F.col("year_month_rk") == run_key).select(
        F.col("year").alias("_y"), F.col("year_quarter_number").alias("_q"), F.col("month_end_date").alias("_end")
    ).distinct()
    return (
        calendar.join(
            run,
            (F.col("year") == F.col("_y"))
            & (F.col("year_quarter_number") == F.col("_q"))
            & (F.col("month_end_date") <= F.col("_end")),
            "inner",
        )
        .select(F.date_format("month_end_date", "yyyyMM").cast("int").alias("curr_qtr_month"), "month_end_date")
        .distinct()
    )


def calendar_from_months(months: DataFrame, key: str = "year_month") -> DataFrame:
    """A date table for the distinct yyyymm keys of a frame."""
    start = key_to_date(key)
    return (
        months.select(key)
        .distinct()
        .select(
            F.col(key).alias("year_month_rk"),
            F.year(start).alias("year"),
            F.quarter(start).alias("year_quarter_number"),
            F.last_day(start).alias("month_end_date"),
            quarter_end(start).alias("quarter_end_date"),
        )
    )


def run_variables(reporting_date: str) -> dict[str, Column]:
    """Month key, day key and date of a run, as columns for ``withColumns``.

    They fold to literals, so no one-row table is joined.
    """
    d = F.to_date(F.lit(reporting_date))
    return {
        "run_month": month_key(d),
        "run_day": F.date_format(d, "yyyyMMdd").cast("int"),
        "run_date": d,
    }
