"""Queries on joins, unions and merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.inputs import derive
from tallyloom.catalog.registry import query
from tallyloom.catalog.rows import MONTHLY_ORDERS, VERSIONS, plain
from tallyloom.functions import periods
from tallyloom.functions.columns import equals, without_prefix
from tallyloom.operators import joins
from tallyloom.operators.setops import merge_upsert, union_branches
from tallyloom.session import scratch_path
from tallyloom.sources.sinks import merge_layer, write_partitioned
from tallyloom.sources.tables import table

_LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
_LINE_SQL = ", ".join(_LINE)


@query(
    "join_inner_keys",
    """WITH s AS (SELECT ps.l_partkey AS partkey, ps.l_suppkey AS suppkey, sum(l_quantity) AS quantity FROM lineitem ps GROUP BY ALL)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, quantity AS pair_quantity FROM lineitem JOIN s ON l_partkey = partkey AND l_suppkey = suppkey""",
)
def join_inner_keys(spark, folder):
    """Inner join on a key list; the right side is summed to one row per key first."""
    lines = table(spark, folder, "lineitem")
    pairs = lines.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("pair_quantity"))
    return lines.select(*_LINE, "l_quantity").join(pairs, ["l_partkey", "l_suppkey"], "inner")


@query(
    "join_left_keys",
    """SELECT o_orderkey, o_custkey, coalesce(n, 0) AS n_lines, coalesce(q, 0) AS quantity FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
)
def join_left_keys(spark, folder):
    """Totals imposed on their deal; deals without rows get zeros."""
    totals = (
        table(spark, folder, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.lookup(orders, totals, ["o_orderkey"], {"n_lines": 0, "quantity": 0.0})


@query(
    "join_effective_dated",
    f"""WITH v AS ({plain(VERSIONS)}) SELECT o_orderkey, a.version AS version, a.segment AS segment, r.version AS run_version, r.segment AS run_segment FROM orders
    LEFT JOIN v a ON o_custkey = a.c_custkey AND a.valid_from_date <= CAST(o_orderdate AS DATE) AND a.valid_to_date > CAST(o_orderdate AS DATE)
    LEFT JOIN v r ON o_custkey = r.c_custkey AND r.valid_from_date <= DATE '1998-12-31' AND r.valid_to_date > DATE '1998-12-31'""",
)
def join_effective_dated(spark, folder):
    """The version on each row's own date, and the version on one run date."""
    versions = derive(spark, folder, VERSIONS)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    keep = ("version", "segment")
    own = joins.effective_dated_join(orders, versions, {"o_custkey": "c_custkey"}, F.col("d"), keep)
    run = joins.effective_dated_join(own, versions, {"o_custkey": "c_custkey"}, "1998-12-31", keep, prefix="run_")
    return run.drop("d", "o_custkey")


# Rates of two lists, one priority each: thousands of versions of a key, with
# gaps after every seventh version and, for one key, versions that overlap.
_RATES = """SELECT side, CAST(o_orderkey AS INT) AS version, o_totalprice AS rate, date_add(DATE '1900-01-01', CAST(o_orderkey AS INT)) AS valid_from_date,
    date_add(DATE '1900-01-01', CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey + 1 WHEN side = 2 THEN o_orderkey + 40 ELSE next END AS INT)) AS valid_to_date
    FROM (SELECT o_orderkey, o_totalprice, CAST(o_orderkey % 3 AS INT) AS side, coalesce(lead(o_orderkey) OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey), o_orderkey + 30) AS next FROM {orders})"""
_ASKED = """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN l_suppkey % 2 = 0 THEN 0 WHEN l_quantity = 1 THEN NULL ELSE l_partkey % 4 END AS INT) AS side,
    CASE WHEN l_linenumber < 7 THEN date_add(DATE '1900-01-01', CAST((l_orderkey * 7 + l_partkey) % 60000 AS INT)) END AS asked FROM {lineitem}"""


def _as_of_sql() -> str:
    def oracle(text):
        return plain(text).replace("date_add(DATE '1900-01-01', ", "(DATE '1900-01-01' + ")

    return f"""WITH r AS ({oracle(_RATES)}), a AS ({oracle(_ASKED)}) SELECT l_orderkey, l_linenumber, l_partkey, a.side, version, rate FROM a
    LEFT JOIN r ON a.side = r.side AND valid_from_date <= asked AND valid_to_date > asked"""


@query("join_as_of", _as_of_sql())
def join_as_of(spark, folder):
    """The version on each row's own day, of keys with thousands of versions; a third of all rows ask for one key."""
    rows = joins.effective_dated_join(derive(spark, folder, _ASKED), derive(spark, folder, _RATES), {"side": "side"}, F.col("asked"), ("version", "rate"))
    return rows.drop("asked")


@query(
    "join_role_playing",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, cn.n_name AS cust_n_name, cn.n_regionkey AS cust_n_regionkey, sn.n_name AS supp_n_name,
    sn.n_regionkey AS supp_n_regionkey FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""",
)
def join_role_playing(spark, folder):
    """One nation table in the roles of the customer's and the supplier's country."""
    lines = table(spark, folder, "lineitem").select(*_LINE)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    # The order's country is looked up per order, which is the smaller side.
    of_order = joins.lookup(orders, customers, {"o_custkey": "c_custkey"}).select("o_orderkey", "c_nationkey")
    rows = joins.lookup(lines, of_order, {"l_orderkey": "o_orderkey"})
    rows = joins.lookup(rows, suppliers, {"l_suppkey": "s_suppkey"})
    nations = table(spark, folder, "nation")
    roles = {"cust_": "c_nationkey", "supp_": "s_nationkey"}
    return joins.role_join(rows, nations, "n_nationkey", roles, ("n_name", "n_regionkey")).drop(
        "c_nationkey", "s_nationkey"
    )


_BANDS = """SELECT CAST(lo AS DOUBLE) AS lower_value, CAST(hi AS DOUBLE) AS upper_value, li AS lower_val_inclusive, ui AS upper_val_inclusive, code FROM
    (VALUES (0.0, 0.02, 'Y', 'N', 'A'), (0.02, 0.05, 'Y', 'N', 'B'), (0.05, 0.07, 'N', 'Y', 'C'), (0.07, 0.1, 'N', 'N', 'D')) AS t(lo, hi, li, ui, code)"""
_VALUES = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linestatus = 'O' AND l_tax = 0 THEN NULL ELSE l_discount END AS rate FROM {lineitem}"


_BAND_SQL = f"""WITH b AS ({_BANDS}), v AS ({plain(_VALUES)}) SELECT v.*, b.code FROM v LEFT JOIN b
    ON (coalesce(rate, 0.02501) > lower_value AND coalesce(rate, 0.02501) < upper_value) OR (coalesce(rate, 0.02501) = lower_value AND lower_val_inclusive = 'Y')
    OR (coalesce(rate, 0.02501) = upper_value AND upper_val_inclusive = 'Y')"""


@query("join_band_inclusive", _BAND_SQL)
def join_band_inclusive(spark, folder):
    """A value to the band that holds it: a band list of checked size is broadcast."""
    return joins.band_join(derive(spark, folder, _VALUES), spark.sql(_BANDS), "rate", ["code"], default=0.02501)


@query("join_band_segments", _BAND_SQL)
def join_band_segments(spark, folder):
    """The same join as it runs for a band list that is too large to broadcast."""
    return joins.band_join(derive(spark, folder, _VALUES), spark.sql(_BANDS), "rate", ["code"], default=0.02501, limit=0)


@query(
    "join_expr_key",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, k.category FROM lineitem LEFT JOIN
    (VALUES ('RETURNED', 'back'), ('UNKNOWN', 'none')) AS k(code, category) ON (CASE WHEN upper(l_returnflag) = 'R' THEN 'RETURNED' WHEN upper(l_returnflag) = 'N' THEN 'UNKNOWN' ELSE upper(l_returnflag) END) = k.code""",
)
def join_expr_key(spark, folder):
    flag = F.upper("l_returnflag")
    key = F.when(flag == "R", F.lit("RETURNED")).when(flag == "N", F.lit("UNKNOWN")).otherwise(flag)
    categories = spark.sql("SELECT * FROM (VALUES ('RETURNED', 'back'), ('UNKNOWN', 'none')) AS k(code, category)")
    return joins.join_on_expression(
        table(spark, folder, "lineitem").select(*_LINE, "l_returnflag"), key, categories, "code", ["category"]
    ).drop("l_returnflag")


_PREFIXED = """SELECT CASE o_orderstatus WHEN 'O' THEN 'NLP' WHEN 'F' THEN '' END AS prefix,
    coalesce(CASE o_orderstatus WHEN 'O' THEN 'NLP' WHEN 'F' THEN '' END, '') || 'D' || CAST(o_orderkey AS STRING) AS deal_id, o_custkey FROM {orders}"""
_UNPREFIXED = "SELECT 'D' || CAST(l_orderkey AS STRING) AS deal, l_partkey, l_suppkey, l_linenumber FROM {lineitem}"


@query(
    "join_prefix_stripped_key",
    f"""WITH p AS ({plain(_PREFIXED)}), u AS ({plain(_UNPREFIXED)}) SELECT p.deal_id, p.o_custkey, u.l_partkey, u.l_suppkey, u.l_linenumber
    FROM u JOIN p ON u.deal = substring(p.deal_id, length(coalesce(p.prefix, '')) + 1)""",
)
def join_prefix_stripped_key(spark, folder):
    deals = derive(spark, folder, _PREFIXED).withColumn("deal", without_prefix("deal_id", "prefix")).drop("prefix")
    return derive(spark, folder, _UNPREFIXED).join(deals, "deal", "inner").drop("deal")


@query(
    "join_implicit_multiway",
    """SELECT r_name, n_name, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS total FROM lineitem, orders, customer, nation, region
    WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey AND o_orderstatus <> 'P' GROUP BY ALL""",
)
def join_implicit_multiway(spark, folder):
    """A comma join as explicit equi-joins; lines are summed per order before they meet it."""
    per_order = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("s"))
    )
    orders = table(spark, folder, "orders").where(F.col("o_orderstatus") != "P").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "inner"
    )
    return (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "inner")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .groupBy("r_name", "n_name")
        .agg(F.sum("n").alias("n_lines"), F.round(F.sum("s"), 2).alias("total"))
    )


@query(
    "join_broadcast_lookup",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(s_name, 'none') AS s_name, coalesce(s_acctbal, 0) AS s_acctbal
    FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey""",
)
def join_broadcast_lookup(spark, folder):
    """Lookup with defaults; it is broadcast only while its planned size is small."""
    suppliers = table(spark, folder, "supplier").where(F.col("s_acctbal") > 0).select("s_suppkey", "s_name", "s_acctbal")
    return joins.lookup(
        table(spark, folder, "lineitem").select(*_LINE),
        suppliers,
        {"l_suppkey": "s_suppkey"},
        {"s_name": "none", "s_acctbal": 0.0},
    )


@query(
    "join_semi",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN
    (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE'))))""",
)
def join_semi(spark, folder):
    regions = table(spark, folder, "region").where(F.col("r_name").isin("ASIA", "EUROPE"))
    nations = joins.semi_join(table(spark, folder, "nation"), regions, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = joins.semi_join(table(spark, folder, "customer"), nations, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.semi_join(orders, customers, F.col("o_custkey") == F.col("c_custkey"))


_A_SIDE = "SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status, o_orderpriority, o_orderkey FROM {orders}"
_B_SIDE = "SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status, o_orderpriority FROM {orders} WHERE o_totalprice > 250000"


@query(
    "join_anti",
    f"""WITH a AS ({plain(_A_SIDE)}), b AS ({plain(_B_SIDE)}) SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.o_custkey = b.o_custkey
    AND a.status IS NOT DISTINCT FROM b.status AND a.o_orderpriority = b.o_orderpriority)""",
)
def join_anti(spark, folder):
    """Rows without a partner on a key list with nulls; the partner keys are made distinct first."""
    keys = ["o_custkey", "status", "o_orderpriority"]
    return joins.anti_join_null_safe(derive(spark, folder, _A_SIDE), derive(spark, folder, _B_SIDE).distinct(), keys)


_OVERRIDES = """SELECT * FROM (VALUES ('AUTOMOBILE', 'EXC', 'Y', DATE '1990-01-01', DATE '9999-12-31'), ('BUILDING', 'OTHER', 'Y', DATE '1990-01-01', DATE '9999-12-31'),
    ('MACHINERY', 'EXC', 'N', DATE '1990-01-01', DATE '2000-01-01')) AS t(code, override_rule, override_value, valid_from_date, valid_to_date)"""


@query(
    "join_left_filtered_dim",
    f"""SELECT c_custkey, override_value FROM customer LEFT JOIN ({_OVERRIDES}) o ON c_mktsegment = o.code AND o.override_rule = 'EXC'
    AND o.valid_from_date <= DATE '2001-08-31' AND o.valid_to_date > DATE '2001-08-31'""",
)
def join_left_filtered_dim(spark, folder):
    return joins.effective_dated_join(
        table(spark, folder, "customer").select("c_custkey", "c_mktsegment"),
        spark.sql(_OVERRIDES),
        {"c_mktsegment": "code"},
        "2001-08-31",
        ["override_value"],
        where=equals("override_rule", "EXC"),
    ).drop("c_mktsegment")


@query(
    "fanout_codes",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, r.code FROM lineitem CROSS JOIN (VALUES ('DE-BBK'), ('NL-DNB'), ('CBI')) AS r(code) WHERE l_returnflag = 'A'
    UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'UK-FSA' FROM lineitem""",
)
def fanout_codes(spark, folder):
    """Copies of some rows for three codes, next to all rows under their own."""
    lines = table(spark, folder, "lineitem").select(*_LINE, "l_returnflag", F.lit("UK-FSA").alias("code"))
    copies = joins.fan_out(lines, "code", ("DE-BBK", "NL-DNB", "CBI"), F.col("l_returnflag") == "A")
    return lines.unionByName(copies).drop("l_returnflag")


@query(
    "scalar_lookup_correlated",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce((SELECT min(p.p_partkey) FROM part p WHERE p.p_type = q.p_type
    AND p.p_brand = CASE WHEN q.p_type = 'PROMO' THEN 'Brand#1' ELSE q.p_brand END AND p.p_size > 25), -1) AS report_key
    FROM lineitem LEFT JOIN part q ON l_partkey = q.p_partkey""",
)
def scalar_lookup_correlated(spark, folder):
    """The smallest candidate of a row-dependent predicate, else -1."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    rows = joins.lookup(table(spark, folder, "lineitem").select(*_LINE), part, ["l_partkey"])
    wanted = F.when(F.col("p_type") == "PROMO", F.lit("Brand#1")).otherwise(F.col("p_brand"))
    candidates = table(spark, folder, "part").where(F.col("p_size") > 25).select(
        F.col("p_type").alias("c_type"), F.col("p_brand").alias("c_brand"), F.col("p_partkey").alias("c_key")
    )
    return joins.scalar_lookup(
        rows.withColumn("_wanted", wanted),
        {"p_type": "c_type", "_wanted": "c_brand"},
        candidates,
        {"c_key": "report_key"},
        {"report_key": -1},
    ).drop("p_type", "p_brand", "_wanted")


# Two versions of the nation dimension: keys change, one attribute is null, one nation ends.
_NATION_VERSIONS = """SELECT n_nationkey AS nation_rk, CASE WHEN n_nationkey % 8 = 0 THEN NULL ELSE n_name END AS nation_name, n_regionkey AS region, DATE '1990-01-01' AS valid_from_date,
    DATE '1998-01-01' AS valid_to_date FROM {nation} UNION ALL
    SELECT n_nationkey + 1000, CASE WHEN n_nationkey % 8 = 0 THEN NULL ELSE n_name END, n_regionkey, DATE '1998-01-01', DATE '9999-12-31' FROM {nation} WHERE n_nationkey <> 7"""


@query(
    "rekey_prior_current",
    f"""WITH v AS ({plain(_NATION_VERSIONS)}), m AS (SELECT o.nation_rk AS old_key, min(c.nation_rk) AS new_key FROM v o LEFT JOIN v c
      ON o.nation_name IS NOT DISTINCT FROM c.nation_name AND o.region IS NOT DISTINCT FROM c.region AND c.valid_from_date <= DATE '2001-08-31' AND c.valid_to_date > DATE '2001-08-31' GROUP BY 1),
    f AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey % 27 AS INTEGER) END AS taker_rk, s_nationkey AS on_rk
      FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(a.new_key, -1) AS taker_rk, coalesce(b.new_key, -1) AS on_rk
    FROM f LEFT JOIN m a ON taker_rk = a.old_key LEFT JOIN m b ON on_rk = b.old_key""",
)
def rekey_prior_current(spark, folder):
    """Two roles re-keyed to the current versions through their natural attributes."""
    successors = joins.successor_map(
        derive(spark, folder, _NATION_VERSIONS), "nation_rk", ["nation_name", "region"], "2001-08-31"
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("on_rk"))
    lines = table(spark, folder, "lineitem").select(
        *_LINE, F.when(F.col("l_linenumber") != 7, (F.col("l_partkey") % 27).cast("int")).alias("taker_rk")
    )
    rows = joins.lookup(lines, suppliers, {"l_suppkey": "s_suppkey"})
    return joins.rekey(rows, {"taker_rk": "taker_rk", "on_rk": "on_rk"}, successors, -1)


@query(
    "prior_period_compare",
    """WITH q AS (SELECT o_custkey, CAST(strftime(last_day(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE)), '%Y%m') AS INTEGER) AS quarter_rk,
      CAST(strftime(last_day(CAST(date_trunc('quarter', o_orderdate) - INTERVAL 1 MONTH AS DATE)), '%Y%m') AS INTEGER) AS previous_rk,
      count(*) AS n_orders, max(CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END) AS in_default FROM orders GROUP BY ALL)
    SELECT a.o_custkey, a.quarter_rk, a.n_orders, a.in_default, b.n_orders AS prior_orders, coalesce(b.in_default, 'N') AS prior_default,
    CASE WHEN a.in_default = 'Y' AND coalesce(b.in_default, 'N') <> 'Y' THEN 'Y' ELSE 'N' END AS new_default
    FROM q a LEFT JOIN q b ON a.o_custkey = b.o_custkey AND a.previous_rk = b.quarter_rk""",
)
def prior_period_compare(spark, folder):
    """New defaults: in default this quarter and not in the one before."""
    d = F.to_date("o_orderdate")
    quarters = (
        table(spark, folder, "orders")
        .groupBy(
            "o_custkey", periods.quarter_key(d).alias("quarter_rk"), periods.previous_quarter_key(d).alias("previous_rk")
        )
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.max(F.when(F.col("o_orderstatus") == "F", F.lit("Y")).otherwise(F.lit("N"))).alias("in_default"),
        )
    )
    compared = joins.prior_period_join(
        quarters,
        quarters,
        ["o_custkey"],
        "quarter_rk",
        F.col("previous_rk"),
        {"n_orders": "prior_orders", "in_default": "prior_default"},
    )
    prior = F.coalesce(F.col("prior_default"), F.lit("N"))
    is_new = (F.col("in_default") == "Y") & (prior != "Y")
    return compared.drop("previous_rk").withColumns(
        {"prior_default": prior, "new_default": F.when(is_new, F.lit("Y")).otherwise(F.lit("N"))}
    )


@query(
    "union_branches",
    """SELECT o_orderkey, 'open' AS branch, o_totalprice AS amount FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, 'filled', -o_totalprice FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'partial', CAST(0 AS DOUBLE) FROM orders WHERE o_orderstatus = 'P'""",
)
def union_branches_query(spark, folder):
    orders = table(spark, folder, "orders")

    def branch(status, name, amount):
        return orders.where(F.col("o_orderstatus") == status).select(
            "o_orderkey", F.lit(name).alias("branch"), amount.alias("amount")
        )

    price = F.col("o_totalprice")
    return union_branches(
        [branch("O", "open", price), branch("F", "filled", -price), branch("P", "partial", F.lit(0.0))]
    )


_TARGET = "SELECT CASE WHEN c_custkey = 5 THEN NULL ELSE c_custkey END AS party, c_mktsegment AS segment, c_acctbal AS amount, c_name AS name FROM {customer} WHERE c_nationkey < 20"
_SOURCE = "SELECT CASE WHEN c_custkey = 5 THEN NULL ELSE c_custkey END AS party, c_mktsegment AS segment, c_acctbal * 2 AS amount FROM {customer} WHERE c_nationkey > 10 OR c_custkey = 5"


@query(
    "merge_upsert",
    f"""WITH t AS ({plain(_TARGET)}), s AS ({plain(_SOURCE)}) SELECT coalesce(t.party, s.party) AS party, coalesce(t.segment, s.segment) AS segment,
    CASE WHEN s.segment IS NOT NULL THEN s.amount ELSE t.amount END AS amount, CASE WHEN t.segment IS NULL THEN 'new' ELSE t.name END AS name
    FROM t FULL JOIN s ON t.party IS NOT DISTINCT FROM s.party AND t.segment IS NOT DISTINCT FROM s.segment""",
)
def merge_upsert_query(spark, folder):
    return merge_upsert(
        derive(spark, folder, _TARGET), derive(spark, folder, _SOURCE), ["party", "segment"], ["amount"], {"name": "new"}
    )


_CORRECTED = f"""SELECT order_date, year_month, adjust_flag, valid_flag, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_totalprice * 2 AS o_totalprice,
    o_orderstatus, o_orderpriority FROM ({MONTHLY_ORDERS}) AS m WHERE year_month = 199508 AND o_orderkey % 3 > 0"""


@query(
    "merge_touched_months",
    f"""WITH t AS ({plain(MONTHLY_ORDERS)}), s AS ({plain(_CORRECTED)}) SELECT coalesce(t.year_month, s.year_month) AS year_month, coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
    coalesce(t.o_custkey, s.o_custkey) AS o_custkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
    FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey AND t.year_month = s.year_month""",
)
def merge_touched_months(spark, folder):
    """A month's corrections merged into a layer of all months: only that month is read and replaced."""
    path = scratch_path(spark, "merge_months")
    write_partitioned(derive(spark, folder, MONTHLY_ORDERS), path, ["year_month"])
    merged = merge_layer(derive(spark, folder, _CORRECTED), path, ["year_month", "o_orderkey"], ["o_totalprice"], ["year_month"])
    return merged.select("year_month", "o_orderkey", "o_custkey", "o_totalprice")
