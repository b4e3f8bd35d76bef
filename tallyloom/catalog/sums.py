"""Queries on aggregation, report cells and sinks."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tallyloom.catalog.inputs import derive
from tallyloom.catalog.registry import query, sums_query
from tallyloom.catalog.rows import MONTHLY_ORDERS, plain
from tallyloom.functions.columns import equals
from tallyloom.operators.aggregates import (
    conditional_sums,
    group_attributes,
    group_max,
    group_sum,
    grouping_sets_total,
    rollup_to,
)
from tallyloom.operators.audit import layer_row_counts
from tallyloom.operators.reshape import (
    CellRow,
    mask_value,
    route_by_value,
    skeleton_values,
    strip_suffix,
    unpivot_measures,
    unpivot_rows,
)
from tallyloom.operators.setops import union_branches
from tallyloom.operators.sizing import broadcast_if_small
from tallyloom.session import scratch_path
from tallyloom.sources.sinks import insert_overwrite, save_table, write_partitioned
from tallyloom.sources.tables import table

_WIDE = """SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS year_month, l_returnflag, l_linestatus, l_linenumber, l_discount, l_tax,
    CASE WHEN l_quantity > 25 THEN 'Y' ELSE 'N' END AS large_flag, CASE l_returnflag WHEN 'N' THEN 'U' ELSE 'A' END AS adjust_flag,
    l_quantity AS quantity, l_extendedprice AS price, CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice - l_quantity END AS net FROM {lineitem}"""
_WIDE_KEYS = ["year_month", "l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax", "large_flag", "adjust_flag"]
_MEASURES = ["quantity", "price", "net"]


_SUMS = "sum(quantity) AS quantity, sum(price) AS price, sum(net) AS net"


@sums_query("agg_sum_wide", f"WITH w AS ({plain(_WIDE)}) SELECT {', '.join(_WIDE_KEYS)}, {_SUMS} FROM w GROUP BY ALL")
def agg_sum_wide(spark, folder):
    return group_sum(derive(spark, folder, _WIDE), _WIDE_KEYS, _MEASURES)


@sums_query(
    "agg_reaggregate",
    f"WITH w AS ({plain(_WIDE)}) SELECT {', '.join(k for k in _WIDE_KEYS if k != 'adjust_flag')}, {_SUMS} FROM w GROUP BY ALL",
)
def agg_reaggregate(spark, folder):
    """Partial sums summed again without the dataset flag."""
    first = group_sum(derive(spark, folder, _WIDE), _WIDE_KEYS, _MEASURES)
    return group_sum(first, [k for k in _WIDE_KEYS if k != "adjust_flag"], _MEASURES)


@sums_query(
    "agg_rollup_two_levels",
    f"""WITH w AS ({plain(_WIDE)}) SELECT year_month, l_returnflag, large_flag, sum(quantity) AS quantity, sum(price) AS price,
    coalesce(sum(net), 0) AS net FROM w GROUP BY ALL""",
)
def agg_rollup_two_levels(spark, folder):
    fine = group_sum(derive(spark, folder, _WIDE), _WIDE_KEYS, _MEASURES)
    return rollup_to(fine, ["year_month", "l_returnflag", "large_flag"], _MEASURES)


@sums_query(
    "agg_max",
    "SELECT o_custkey, max(o_orderkey) AS o_orderkey, max(CAST(o_orderdate AS DATE)) AS last_date FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1",
)
def agg_max(spark, folder):
    orders = table(spark, folder, "orders").withColumn("last_date", F.to_date("o_orderdate"))
    return group_max(orders, ["o_custkey"], ["o_orderkey", "last_date"], F.col("o_orderstatus") != "P")


_FLAGS = ("A", "R", "N")
_STATES = ("O", "F")
_BASES = ("l_quantity", "l_extendedprice", "l_linenumber", "l_suppkey")
_MANY = {f"{b}_{f}_{s}".lower(): (b, f, s) for b in _BASES for f in _FLAGS for s in _STATES}


@sums_query(
    "agg_many_measures",
    "SELECT l_orderkey, "
    + ", ".join(
        f"sum(CASE WHEN l_returnflag = '{f}' AND l_linestatus = '{s}' THEN {b} ELSE 0 END)::DOUBLE AS {n}"
        for n, (b, f, s) in _MANY.items()
    )
    + " FROM lineitem GROUP BY 1",
)
def agg_many_measures(spark, folder):
    """24 sums per deal in one pass."""
    measures = {
        n: (F.col(b), (F.col("l_returnflag") == f) & (F.col("l_linestatus") == s)) for n, (b, f, s) in _MANY.items()
    }
    return conditional_sums(table(spark, folder, "lineitem"), ["l_orderkey"], measures)


@sums_query(
    "agg_attr_in_key",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, sum(l_extendedprice) AS l_extendedprice
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def agg_attr_in_key(spark, folder):
    """Attributes the key determines are carried, not grouped by."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice")
    per_order = group_sum(lines, ["l_orderkey"], ["l_extendedprice"])
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return group_attributes(
            joined, ["o_orderkey"], ["o_orderstatus", "o_orderpriority", "o_totalprice"], ["l_extendedprice"]
        )


_COND_KEYS = ["l_returnflag", "l_linestatus", "year_month"]
_COND_SQL = f"""SELECT l_returnflag, l_linestatus, year_month,
    sum(price + quantity * 0.5) AS c0010, sum(CASE WHEN large_flag = 'Y' THEN price ELSE 0 END) AS c0010_onbal, sum(CASE WHEN large_flag = 'N' THEN price ELSE 0 END) AS c0010_ofbal,
    sum(-quantity) AS c0030, sum(CASE WHEN coalesce(net, 0) > 50000 THEN net ELSE 0 END) AS c0040, sum(CASE WHEN l_discount IN (0.01, 0.05) THEN price ELSE 0 END) AS c0210
    FROM ({plain(_WIDE)}) GROUP BY ALL"""
_COND_NAMES = ["c0010", "c0010_onbal", "c0010_ofbal", "c0030", "c0040", "c0210"]


def _conditional(spark, folder):
    c = F.col
    measures = {
        "c0010": (c("price") + c("quantity") * 0.5, None),
        "c0010_onbal": (c("price"), c("large_flag") == "Y"),
        "c0010_ofbal": (c("price"), c("large_flag") == "N"),
        "c0030": (-c("quantity"), None),
        "c0040": (c("net"), F.coalesce(c("net"), F.lit(0.0)) > 50000),
        "c0210": (c("price"), c("l_discount").isin(0.01, 0.05)),
    }
    return conditional_sums(derive(spark, folder, _WIDE), _COND_KEYS, measures)


@sums_query(
    "agg_conditional_measures",
    f"SELECT l_returnflag, l_linestatus, year_month, {', '.join(_COND_NAMES)} FROM ({_COND_SQL})",
)
def agg_conditional_measures(spark, folder):
    return _conditional(spark, folder)


@sums_query(
    "agg_grouping_sets_total",
    f"""WITH w AS ({plain(_WIDE)}), k AS (SELECT *, CASE l_linenumber WHEN 7 THEN NULL ELSE 'L' || l_linenumber END AS sheet_id FROM w)
    SELECT year_month, l_returnflag, sheet_id, sum(price) AS price FROM k GROUP BY ALL
    UNION ALL SELECT year_month, l_returnflag, 'TOTAL', sum(price) FROM k GROUP BY ALL""",
)
def agg_grouping_sets_total(spark, folder):
    """Detail and total rows as two grouping sets; a null detail stays its own row."""
    rows = derive(spark, folder, _WIDE).withColumn(
        "sheet_id", F.when(F.col("l_linenumber") != 7, F.concat(F.lit("L"), F.col("l_linenumber")))
    )
    return grouping_sets_total(rows, ["year_month", "l_returnflag"], "sheet_id", "price", "TOTAL")


@sums_query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@sums_query(
    "layer_row_counts",
    """SELECT 'orders' AS layer, count(*) AS n_rows FROM orders UNION ALL SELECT 'lines', count(*) FROM lineitem
    UNION ALL SELECT 'open', count(*) FROM orders WHERE o_orderstatus = 'O'""",
)
def layer_row_counts_query(spark, folder):
    orders = table(spark, folder, "orders")
    return layer_row_counts(
        {"orders": orders, "lines": table(spark, folder, "lineitem"), "open": orders.where(F.col("o_orderstatus") == "O")}
    )


def _unpivot_sql(names, where="TRUE", row="NULL"):
    return " UNION ALL ".join(
        f"SELECT l_returnflag, l_linestatus, year_month, {row} AS row_id, '{n}' AS measure, {n} AS value FROM c WHERE {where}" for n in names
    )


@sums_query(
    "unpivot_measures",
    f"""WITH c AS ({_COND_SQL}), u AS ({_unpivot_sql(_COND_NAMES)})
    SELECT l_returnflag, l_linestatus, year_month, measure AS column_id, value FROM u""",
)
def unpivot_measures_query(spark, folder):
    return unpivot_measures(_conditional(spark, folder), _COND_KEYS, _COND_NAMES)


@sums_query(
    "unpivot_strip_suffix",
    f"""WITH c AS ({_COND_SQL}), u AS ({_unpivot_sql(['c0010_onbal', 'c0010_ofbal', 'c0030'])})
    SELECT l_returnflag, year_month, split_part(measure, '_', 1) AS column_id, sum(value) AS value FROM u GROUP BY ALL""",
)
def unpivot_strip_suffix(spark, folder):
    cells = unpivot_measures(_conditional(spark, folder), _COND_KEYS, ["c0010_onbal", "c0010_ofbal", "c0030"])
    stripped = cells.withColumn("column_id", strip_suffix(F.col("column_id")))
    return group_sum(stripped, ["l_returnflag", "year_month", "column_id"], ["value"])


_ROUTES = {0.0: "R0140", 0.02: "R0150", 0.04: "R0160", 0.1: "R0170"}
_ROUTE_SQL = "CASE round(l_discount, 3) WHEN 0.0 THEN 'R0140' WHEN 0.02 THEN 'R0150' WHEN 0.04 THEN 'R0160' WHEN 0.1 THEN 'R0170' ELSE 'R0280' END"


@sums_query(
    "route_by_value",
    f"""SELECT {_ROUTE_SQL} AS row_id, l_returnflag, sum(l_extendedprice) AS price,
    sum(CASE WHEN round(l_discount, 3) = 0.02 THEN NULL ELSE l_quantity END) AS quantity FROM lineitem GROUP BY ALL""",
)
def route_by_value_query(spark, folder):
    """Rows routed by a rounded rate; one measure is left out at one rate."""
    rate = F.col("l_discount")
    rows = table(spark, folder, "lineitem").select(
        route_by_value(rate, _ROUTES, "R0280").alias("row_id"),
        "l_returnflag",
        F.col("l_extendedprice").alias("price"),
        F.when(F.round(rate, 3) != 0.02, F.col("l_quantity")).alias("quantity"),
    )
    return group_sum(rows, ["row_id", "l_returnflag"], ["price", "quantity"])


@sums_query(
    "route_by_class",
    """SELECT CASE WHEN l_returnflag = 'R' THEN 'R0310' ELSE 'R0290' END AS row_id, CASE WHEN l_linestatus = 'O' THEN 'MEMO' || l_linenumber ELSE 'SHEET' END AS sheet_id,
    sum(l_extendedprice) AS value FROM lineitem WHERE l_quantity BETWEEN 10 AND 40 GROUP BY ALL""",
)
def route_by_class(spark, folder):
    rows = (
        table(spark, folder, "lineitem")
        .where(F.col("l_quantity").between(10, 40))
        .select(
            F.when(equals("l_returnflag", "R"), F.lit("R0310")).otherwise(F.lit("R0290")).alias("row_id"),
            F.when(equals("l_linestatus", "O"), F.concat(F.lit("MEMO"), F.col("l_linenumber")))
            .otherwise(F.lit("SHEET"))
            .alias("sheet_id"),
            F.col("l_extendedprice").alias("value"),
        )
    )
    return group_sum(rows, ["row_id", "sheet_id"], ["value"])


@sums_query(
    "mask_value_sum",
    "SELECT l_linenumber, l_linestatus, sum(CASE WHEN l_linestatus = 'F' AND l_linenumber <= 3 THEN NULL ELSE l_extendedprice END) AS value FROM lineitem GROUP BY ALL",
)
def mask_value_sum(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_linenumber", "l_linestatus", F.col("l_extendedprice").alias("value"))
    masked = mask_value(rows, (F.col("l_linestatus") == "F") & (F.col("l_linenumber") <= 3))
    return group_sum(masked, ["l_linenumber", "l_linestatus"], ["value"])


_CELL_SQL = f"""WITH c AS ({_COND_SQL}), u AS (
    {_unpivot_sql(['c0010', 'c0030', 'c0210'], row="'R0010'")} UNION ALL
    {_unpivot_sql(['c0010', 'c0030'], "l_returnflag = 'R'", "'R0040'")} UNION ALL
    {_unpivot_sql(['c0010_onbal', 'c0030'], row="'R0070'")} UNION ALL
    {_unpivot_sql(['c0010_ofbal'], "l_linestatus = 'O'", "CASE WHEN l_returnflag = 'A' THEN 'R0300' ELSE 'R0320' END")})"""


def _cells(spark, folder):
    rows = [
        CellRow("R0010", ["c0010", "c0030", "c0210"]),
        CellRow("R0040", ["c0010", "c0030"], equals("l_returnflag", "R")),
        CellRow("R0070", ["c0010_onbal", "c0030"]),
        CellRow(
            F.when(equals("l_returnflag", "A"), F.lit("R0300")).otherwise(F.lit("R0320")),
            ["c0010_ofbal"],
            equals("l_linestatus", "O"),
        ),
    ]
    measures = _conditional(spark, folder).withColumn("sheet_id", F.concat(F.lit("S"), F.col("l_returnflag")))
    return unpivot_rows(measures, _COND_KEYS, rows)


@sums_query(
    "cells_sum",
    f"{_CELL_SQL} SELECT year_month, 'S' || l_returnflag AS sheet_id, row_id, split_part(measure, '_', 1) AS column_id, sum(value) AS value FROM u GROUP BY ALL",
)
def cells_sum(spark, folder):
    """Several report rows from one pass over the measures."""
    keys = ["year_month", "sheet_id", "row_id", "column_id"]
    return group_sum(_cells(spark, folder), keys, ["value"])


_UNIT_MAP = """SELECT * FROM (VALUES ('A', 'O', 'G1', 'External'), ('A', 'F', 'G1', 'Inter Group'), ('R', 'O', 'G2', 'Inter Group'), ('R', 'F', 'G2', 'External'), ('N', 'O', 'G1', 'Inter Group'))
    AS t(flag, status, entity, reporting_desc)"""
_ENTITY_SQL = f"""{_CELL_SQL}, j AS (SELECT u.*, entity, reporting_desc FROM u JOIN ({_UNIT_MAP}) ON l_returnflag = flag AND l_linestatus = status),
    k AS (SELECT 'INTRA' AS category, * FROM j WHERE reporting_desc = 'Inter Group' UNION ALL SELECT 'ALL', * FROM j)"""


def _entity(spark, folder):
    cells = group_sum(_cells(spark, folder), [*_COND_KEYS, "sheet_id", "row_id", "column_id"], ["value"])
    units = broadcast_if_small(spark.sql(_UNIT_MAP))
    joined = cells.join(
        units, (F.col("l_returnflag") == F.col("flag")) & (F.col("l_linestatus") == F.col("status")), "inner"
    )
    member = F.array(F.when(F.col("reporting_desc") == "Inter Group", F.lit("INTRA")), F.lit("ALL"))
    tagged = joined.withColumn("category", F.explode(F.array_compact(member)))
    return grouping_sets_total(tagged, ["category", "entity", "row_id", "column_id"], "sheet_id", "value", "STD0001")


_ENTITY_CELLS = f"""{_ENTITY_SQL} SELECT category, entity, row_id, split_part(measure, '_', 1) AS column_id, 'S' || l_returnflag AS sheet_id, sum(value) AS value FROM k GROUP BY ALL
    UNION ALL SELECT category, entity, row_id, split_part(measure, '_', 1), 'STD0001', sum(value) FROM k GROUP BY ALL"""


@sums_query("cells_entity_sum", _ENTITY_CELLS)
def cells_entity_sum(spark, folder):
    return _entity(spark, folder)


_SKELETON = """SELECT n_name AS entity, r.row_id, c.column_id, s.sheet_id, CASE WHEN r.row_id = 'R0040' AND c.column_id = 'C0030' THEN 'N' ELSE 'Y' END AS applicable
    FROM {nation} CROSS JOIN (VALUES ('R0010'), ('R0040')) AS r(row_id) CROSS JOIN (VALUES ('C0010'), ('C0030')) AS c(column_id) CROSS JOIN (VALUES ('STD0001'), ('STD0002')) AS s(sheet_id)"""


@sums_query(
    "cell_skeleton",
    f"SELECT entity, row_id, column_id, sheet_id, CASE WHEN applicable = 'Y' THEN CAST(0 AS DOUBLE) END AS value FROM ({plain(_SKELETON)})",
)
def cell_skeleton_query(spark, folder):
    return skeleton_values(derive(spark, folder, _SKELETON), "applicable").drop("applicable")


@sums_query(
    "cells_full_return",
    f"""WITH full_cells AS ({_ENTITY_CELLS}) SELECT category, entity, row_id, upper(column_id) AS column_id, sheet_id, value, CAST(NULL AS VARCHAR) AS for_adjust_flag FROM full_cells
    UNION ALL SELECT 'ALL', entity, row_id, column_id, sheet_id, CASE WHEN applicable = 'Y' THEN CAST(0 AS DOUBLE) END, 'A' FROM ({plain(_SKELETON)})""",
)
def cells_full_return(spark, folder):
    """Cells and totals with the skeleton of every cell the template names."""
    cells = _entity(spark, folder).withColumns(
        {"column_id": F.upper("column_id"), "for_adjust_flag": F.lit(None).cast("string")}
    )
    skeleton = skeleton_values(derive(spark, folder, _SKELETON), "applicable").select(
        F.lit("ALL").alias("category"), "entity", "row_id", "column_id", "sheet_id", "value", F.lit("A").alias("for_adjust_flag")
    )
    return union_branches([cells, skeleton])


@query(
    "sink_partitioned",
    f"SELECT year_month, adjust_flag, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM ({plain(MONTHLY_ORDERS)}) GROUP BY ALL",
)
def sink_partitioned(spark, folder):
    """Write by month and dataset, then read the layer back."""
    path = scratch_path(spark, "sink_partitioned")
    write_partitioned(derive(spark, folder, MONTHLY_ORDERS), path, ["year_month", "adjust_flag"])
    return (
        spark.read.parquet(path)
        .groupBy("year_month", "adjust_flag")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query(
    "sink_roundtrip_dynamic",
    f"""SELECT year_month, count(*) AS n_rows, round(sum(CASE WHEN year_month >= 200101 THEN 2 * o_totalprice ELSE o_totalprice END), 2) AS total
    FROM ({plain(MONTHLY_ORDERS)}) GROUP BY ALL""",
)
def sink_roundtrip_dynamic(spark, folder):
    """Overwrite some months of a layer; the other months stay."""
    path = scratch_path(spark, "sink_roundtrip")
    rows = derive(spark, folder, MONTHLY_ORDERS)
    write_partitioned(rows, path, ["year_month"])
    changed = rows.where(F.col("year_month") >= 200101).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_partitioned(changed, path, ["year_month"])
    return (
        spark.read.parquet(path)
        .groupBy("year_month")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


_MONTH_TOTALS = "SELECT year_month, adjust_flag, count(*) AS n_rows, sum(floor(o_totalprice)) AS total FROM ({rows}) GROUP BY ALL"


def _month_totals(spark, path):
    rows = spark.read.parquet(path).groupBy("year_month", "adjust_flag")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.floor("o_totalprice").cast("double")).alias("total"))


@query("sink_insert_overwrite", _MONTH_TOTALS.format(rows=plain(MONTHLY_ORDERS)).replace("floor(o_totalprice)", "CAST(floor(o_totalprice) AS DOUBLE)"))
def sink_insert_overwrite(spark, folder):
    """Months of a table replaced by name: all months first with other amounts, then all again."""
    path, name = scratch_path(spark, "insert_overwrite"), f"months_{uuid4().hex}"
    rows = derive(spark, folder, MONTHLY_ORDERS)
    save_table(rows.withColumn("o_totalprice", F.lit(0.0)), name, ["year_month", "adjust_flag"], path)
    insert_overwrite(rows.select(*reversed(rows.columns)), name)
    spark.sql(f"DROP TABLE {name}")
    return _month_totals(spark, path)
