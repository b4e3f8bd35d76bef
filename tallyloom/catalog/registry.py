"""Registry of queries and the oracle text of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a key, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def exact(text: str) -> str:
    """Oracle text in which every ``sum`` adds whole millionths, so that no order of rows matters.

    A ``round`` to cents around a sum is left out with it.
    """
    out, at = [], 0
    while True:
        begin = text.find("sum(", at)
        if begin < 0:
            return "".join(out) + text[at:]
        depth, end = 1, begin + 4
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        inner = exact(text[begin + 4 : end - 1])
        scaled = f"(({inner}) * 1e6)"
        upper = f"floor({scaled} / 1048576e0)"
        lower = f"floor({scaled} - {upper} * 1048576e0 + 0.5)"
        out += [text[at:begin], f"CAST(sum(CAST({upper} AS HUGEINT)) * 1048576 + sum(CAST({lower} AS BIGINT)) AS DOUBLE) / 1e6"]
        at = end


def sums_query(name: str, sql: str) -> Callable[[Query], Query]:
    """As ``query``, for results whose sums are exact."""
    return query(name, exact(sql))
