"""Scans: partition-filtered layers, parameters, literal rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.columns import equals


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan(
    df: DataFrame,
    year_month: int,
    adjust_flag: str | None = None,
    valid_only: bool = True,
    month: str = "year_month",
) -> DataFrame:
    """Rows of one month and dataset; both predicates reach the scan."""
    rows = df.where(F.col(month) == year_month)
    if adjust_flag is not None:
        rows = rows.where(F.col("adjust_flag") == adjust_flag)
    return rows.where(F.col("valid_flag") == "Y") if valid_only else rows


def parameter_month(parameters: DataFrame, name: str, pattern: str = "dd-MMM-yyyy"):
    """yyyymm of a named date parameter, as a scalar column."""
    return (
        parameters.where(F.col("parameter_name") == name)
        .select(F.date_format(F.to_date("parameter_value", pattern), "yyyyMM").cast("int"))
        .scalar()
    )


def parameter_value(parameters: DataFrame, name: str, key: str = "param_code", value: str = "param_value"):
    """Value of a named parameter, as a scalar column."""
    return parameters.where(equals(key, name)).select(value).scalar()


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A fixed list as a frame with a declared schema; empty lists are fine."""
    return spark.createDataFrame(list(rows), schema)


def run_date(value: str | date) -> date:
    """The run parameter as a date: ISO text with or without a time part."""
    return value if isinstance(value, date) else date.fromisoformat(value[:10])
