"""Queries on scans, filters, projections and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.inputs import INPUTS, ORACLE_FAN, RUN_DATE, derive
from tallyloom.catalog.registry import query
from tallyloom.functions import codes as K
from tallyloom.functions import periods
from tallyloom.functions.columns import (
    amount_if,
    code_lookup,
    differs,
    equals,
    first_match,
    first_valid_key,
    is_blank,
    one_of,
    pick,
    z,
)
from tallyloom.operators.filters import RegimeColumns, is_valid_on, latest_day, regime_value
from tallyloom.operators.joins import lookup
from tallyloom.operators.rules import RULE_TABLE, compiled, rule_rows
from tallyloom.operators.setops import align_union
from tallyloom.plans.staging import DUTCH_RULES, IRISH_RULES, OTHER_RULES, UK_RULES, basel_rules
from tallyloom.session import scratch_path
from tallyloom.sources.sinks import write_layer
from tallyloom.sources.tables import literal_rows, parameter_month, parameter_value, scan, table

# Three versions per customer, with a one-day gap and an open end.
VERSIONS = """SELECT c_custkey, c_nationkey, version,
    CASE version WHEN 1 THEN DATE '1995-01-01' WHEN 2 THEN DATE '1997-07-01' ELSE DATE '1999-01-01' END AS valid_from_date,
    CASE version WHEN 1 THEN DATE '1997-06-30' WHEN 2 THEN DATE '1999-01-01' ELSE DATE '9999-12-31' END AS valid_to_date,
    CASE version WHEN 1 THEN c_mktsegment ELSE c_mktsegment || ' V' || CAST(version AS STRING) END AS segment
    FROM (SELECT c_custkey, c_nationkey, c_mktsegment, {fan}(1, 2, 3)) AS version FROM {customer}) AS v"""

MONTHLY_ORDERS = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS order_date,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS year_month,
    CASE o_orderstatus WHEN 'P' THEN 'U' ELSE 'A' END AS adjust_flag, 'Y' AS valid_flag FROM {orders}"""


def plain(text_: str) -> str:
    """A shared text with plain table names, for the oracle."""
    names = ("orders", "lineitem", "customer", "nation", "part", "supplier", "region", "events", "documents")
    return text_.format(**{n: n for n in names}, fan=ORACLE_FAN)


@query(
    "scan_partition_filter",
    f"SELECT o_orderkey, o_totalprice, year_month, adjust_flag FROM ({plain(MONTHLY_ORDERS)}) WHERE year_month = 199805 AND adjust_flag = 'A' AND valid_flag = 'Y'",
)
def scan_partition_filter(spark, folder):
    """One month and dataset of a layer that is partitioned by both: other folders are not read."""
    path = scratch_path(spark, "monthly_orders")
    layer = write_layer(derive(spark, folder, MONTHLY_ORDERS), path, ["year_month", "adjust_flag"])
    return scan(layer, 199805, "A").select("o_orderkey", "o_totalprice", "year_month", "adjust_flag")


@query(
    "latest_snapshot",
    "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS snap_dt FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)",
)
def latest_snapshot_query(spark, folder):
    events = latest_day(table(spark, folder, "events"), "ts").withColumn("snap_dt", F.to_date("ts"))
    return events.select("event_id", "user_id", "event_type", "snap_dt")


@query(
    "scalar_param_lookup",
    f"""WITH m AS ({plain(MONTHLY_ORDERS)})
    SELECT year_month, CASE WHEN year_month >= 200101 THEN 'after' WHEN year_month >= 199807 THEN 'dual' ELSE 'before' END AS regime,
    CAST(0.75 AS DOUBLE) AS infra_factor, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM m GROUP BY ALL""",
)
def scalar_param_lookup(spark, folder):
    parameters = spark.sql(INPUTS["etl_parameter"])
    engine = spark.sql(INPUTS["engine_parameter"])
    divergence = parameter_month(parameters, "PRA_DIVERGENCE_EFF_DATE")
    dual = parameter_month(parameters, "CRR2_DUAL_REP_EFF_DATE")
    month = F.col("year_month")
    regime = first_match([(month >= divergence, F.lit("after")), (month >= dual, F.lit("dual"))], F.lit("before"))
    factor = parameter_value(engine, "INFRADISCOUNTFACTOR").cast("double")
    return (
        derive(spark, folder, MONTHLY_ORDERS)
        .groupBy("year_month")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
        .withColumns({"regime": regime, "infra_factor": factor})
    )


@query(
    "run_vars_crossjoin",
    """SELECT o_orderkey, 200108 AS run_month, 20010831 AS run_day, DATE '2001-08-31' AS run_date,
    CAST(o_orderdate AS DATE) <= DATE '2001-06-30' AS before_quarter_end FROM orders""",
)
def run_vars_crossjoin(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return orders.withColumns(periods.run_variables(RUN_DATE)).select(
        "o_orderkey",
        "run_month",
        "run_day",
        "run_date",
        (F.col("d") <= periods.quarter_end(F.add_months("run_date", -3))).alias("before_quarter_end"),
    )


@query(
    "literal_rows_lookup",
    """SELECT l_returnflag, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE 'No Data Found' END AS meaning,
    'No Data Found' AS none_found, count(*) AS n_rows FROM lineitem GROUP BY ALL""",
)
def literal_rows_lookup(spark, folder):
    names = literal_rows(spark, [("A", "accepted"), ("R", "returned")], "l_returnflag string, meaning string")
    nothing = literal_rows(spark, [], "l_returnflag string, none_found string")
    counts = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))
    known = lookup(counts, names, ["l_returnflag"], {"meaning": "No Data Found"})
    return lookup(known, nothing, ["l_returnflag"], {"none_found": "No Data Found"})


@query(
    "filter_compound",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
    WHERE (l_returnflag = 'R' AND l_quantity > 40) OR (l_linestatus = 'O' AND l_discount >= 0.09 AND l_tax < 0.02)""",
)
def filter_compound(spark, folder):
    c = F.col
    return (
        table(spark, folder, "lineitem")
        .where(
            ((c("l_returnflag") == "R") & (c("l_quantity") > 40))
            | ((c("l_linestatus") == "O") & (c("l_discount") >= 0.09) & (c("l_tax") < 0.02))
        )
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    )


_SPARSE = "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS code, o_orderstatus FROM {orders}"


@query(
    "filter_in_notin_nulls",
    f"""WITH s AS ({plain(_SPARSE)}) SELECT o_orderkey, code, coalesce(code IN ('1-URGENT', '2-HIGH'), false) AS listed,
    coalesce(code, 'X') <> '5-LOW' AS differs FROM s WHERE coalesce(code, 'X') NOT IN ('3-MEDIUM', '4-NOT SPECIFIED')""",
)
def filter_in_notin_nulls(spark, folder):
    rows = derive(spark, folder, _SPARSE)
    return rows.where(~one_of("code", ("3-MEDIUM", "4-NOT SPECIFIED"))).select(
        "o_orderkey",
        "code",
        one_of("code", ("1-URGENT", "2-HIGH")).alias("listed"),
        differs("code", "5-LOW", "X").alias("differs"),
    )


_BLANKS = "SELECT doc_id, CASE WHEN lang = 'en' THEN text WHEN lang = 'fr' THEN '' WHEN lang = 'de' THEN '  ' END AS body, lang FROM {documents}"


@query("filter_blank", f"SELECT doc_id, lang FROM ({plain(_BLANKS)}) WHERE body IS NULL OR trim(body) = ''")
def filter_blank(spark, folder):
    return derive(spark, folder, _BLANKS).where(is_blank("body")).select("doc_id", "lang")


@query(
    "filter_like",
    """SELECT doc_id, contains(text, '_') AS literal_underscore, text LIKE '%the%' AS has_the, starts_with(text, 'E') AS starts_e
    FROM documents WHERE text LIKE '% is %' OR source LIKE 'src1%'""",
)
def filter_like(spark, folder):
    body = F.col("text")
    return (
        table(spark, folder, "documents")
        .where(body.like("% is %") | F.col("source").like("src1%"))
        .select(
            "doc_id",
            body.contains("_").alias("literal_underscore"),
            body.like("%the%").alias("has_the"),
            body.startswith("E").alias("starts_e"),
        )
    )


@query(
    "project_subset",
    "SELECT o_orderkey AS deal_key, o_custkey AS party_key, round(o_totalprice / 2, 4) AS amount, o_orderstatus AS status FROM orders",
)
def project_subset(spark, folder):
    """Rename, drop a column, and put its final version in its place."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    named = orders.withColumnsRenamed({"o_orderkey": "deal_key", "o_custkey": "party_key", "o_orderstatus": "status"})
    final = named.withColumn("amount_final", F.round(F.col("o_totalprice") / 2, 4))
    return final.drop("o_totalprice").withColumnRenamed("amount_final", "amount")


@query(
    "const_and_null_columns",
    """SELECT c_custkey, 'INFLOW' AS flow_type, CAST(NULL AS VARCHAR) AS group_text, CAST(0 AS DOUBLE) AS amount,
    CAST(NULL AS DOUBLE) AS missing_amount, 7 AS run_rk FROM customer""",
)
def const_and_null_columns(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.lit("INFLOW").alias("flow_type"),
        F.lit(None).cast("string").alias("group_text"),
        F.lit(0.0).alias("amount"),
        F.lit(None).cast("double").alias("missing_amount"),
        F.lit(7).alias("run_rk"),
    )


_GAPS = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS amount,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS code,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS party_rk FROM {orders}"""


@query(
    "fillna_defaults",
    f"""SELECT o_orderkey, coalesce(amount, 0) AS amount, coalesce(code, 'X') AS code, coalesce(party_rk, -1) AS party_rk,
    CASE WHEN amount IS NULL THEN 0.02501 ELSE amount END AS pd FROM ({plain(_GAPS)})""",
)
def fillna_defaults(spark, folder):
    rows = derive(spark, folder, _GAPS).withColumn("pd", F.coalesce("amount", F.lit(K.DEFAULT_PD)))
    return rows.fillna({"amount": 0.0, "code": "X", "party_rk": -1})


@query(
    "align_union_flows",
    """SELECT o_orderkey AS deal, 'EXPOSURE' AS flow_type, o_totalprice AS ead, CAST(0 AS DOUBLE) AS coll_amt, CAST(NULL AS INTEGER) AS mitigant, o_orderpriority AS priority FROM orders
    UNION ALL SELECT l_orderkey, 'INFLOW', NULL, l_extendedprice, l_linenumber, NULL FROM lineitem""",
)
def align_union_flows(spark, folder):
    exposures = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("deal"),
        F.lit("EXPOSURE").alias("flow_type"),
        F.col("o_totalprice").alias("EAD"),
        F.col("o_orderpriority").alias("priority"),
    )
    inflow = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("DEAL"),
        F.lit("INFLOW").alias("flow_type"),
        F.col("l_extendedprice").alias("coll_amt"),
        F.col("l_linenumber").alias("mitigant"),
    )
    return align_union(exposures, inflow, ["coll_amt", "b2_irb_coll_amt"]).drop("b2_irb_coll_amt").withColumnsRenamed(
        {"EAD": "ead"}
    )


@query(
    "pack_struct_lookup",
    """SELECT o_orderkey, c_name, c_mktsegment, coalesce(c_acctbal, 0) AS c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def pack_struct_lookup(spark, folder):
    """A lookup whose attributes travel as one struct column."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    packed = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.struct("c_name", "c_mktsegment", "c_acctbal").alias("party")
    )
    return lookup(orders, packed, ["o_custkey"]).select(
        "o_orderkey", "party.c_name", "party.c_mktsegment", z("party.c_acctbal").alias("c_acctbal")
    )


@query(
    "scd_valid_on",
    f"""WITH v AS ({plain(VERSIONS)}) SELECT d.on_date, v.c_custkey, v.version, v.segment
    FROM v JOIN (VALUES (DATE '1997-06-29'), (DATE '1997-06-30'), (DATE '1999-01-01')) AS d(on_date)
    ON v.valid_from_date <= d.on_date AND v.valid_to_date > d.on_date""",
)
def scd_valid_on(spark, folder):
    """Half-open validity on three dates: last day, gap day, first day of a version."""
    versions = derive(spark, folder, VERSIONS)
    days = ("1997-06-29", "1997-06-30", "1999-01-01")
    dated = versions.withColumn("on_date", F.explode(F.array(*[F.to_date(F.lit(d)) for d in days])))
    return dated.where(is_valid_on(F.col("on_date"))).select("on_date", "c_custkey", "version", "segment")


_REGIME_ROWS = """SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS year_month_rk,
    CASE o_orderkey % 5 WHEN 0 THEN 'BASEL-OTC' WHEN 1 THEN 'REPO' WHEN 2 THEN 'RETAIL' WHEN 3 THEN 'NCA' END AS aclm_product_type,
    CASE o_orderkey % 9 WHEN 0 THEN 'SABFUKOR' WHEN 1 THEN 'MUREUKOR' WHEN 2 THEN 'SABFI2OR' WHEN 3 THEN 'MUREX2OR' WHEN 4 THEN 'MTH_OTH'
      WHEN 5 THEN 'DAY_OTH' WHEN 6 THEN 'SABFIMOR' WHEN 7 THEN 'LEDGER' END AS sys_code,
    CASE o_custkey % 4 WHEN 0 THEN '4' WHEN 1 THEN '' WHEN 2 THEN '3' END AS capital_cuts,
    CASE o_custkey % 7 WHEN 0 THEN 'UK' WHEN 1 THEN 'EU' WHEN 2 THEN '' WHEN 3 THEN 'UK' WHEN 4 THEN 'EU' END AS jurisdiction_flag,
    CASE o_orderkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'Y' END AS crr2_flag,
    CASE WHEN o_custkey % 3 = 0 THEN 'N' ELSE 'Y' END AS basel_data_flag FROM {orders}"""

_OTC = "coalesce(aclm_product_type, 'XX') IN ('BASEL-OTC', 'REPO')"
_BLANK_CUT = "(capital_cuts IS NULL OR capital_cuts = '')"
_BLANK_JUR = "(jurisdiction_flag IS NULL OR jurisdiction_flag = '')"
_EU = "('SABFI2OR', 'MUREX2OR', 'MTH_OTH', 'DAY_OTH')"
_EU_DUAL_SQL = f"""CASE WHEN sys_code IN ('SABFI2OR', 'MUREX2OR') AND crr2_flag = 'Y' AND capital_cuts = '4' THEN 'TRUE'
    WHEN coalesce(sys_code, 'XX') NOT IN ('SABFIMOR', 'MUREXOR', 'SABFI2OR', 'MUREX2OR') AND coalesce(crr2_flag, 'N') <> 'Y' AND {_BLANK_CUT} THEN 'TRUE' END"""


def _since(systems: str, jurisdiction: str) -> str:
    return f"""WHEN year_month_rk >= 200001 AND {_OTC} THEN CASE
      WHEN sys_code IN {systems} AND capital_cuts = '4' AND jurisdiction_flag = '{jurisdiction}' THEN 'TRUE'
      WHEN coalesce(sys_code, 'XX') NOT IN {systems} AND {_BLANK_CUT} AND {_BLANK_JUR} THEN 'TRUE' END
    WHEN year_month_rk >= 200001 AND NOT {_OTC} THEN 'TRUE'"""


_REGIME_SQL = f"""WITH r AS ({plain(_REGIME_ROWS)}), t AS (SELECT *,
    coalesce(CASE {_since("('SABFUKOR', 'MUREUKOR', 'MTH_OTH', 'DAY_OTH')", 'UK')}
      WHEN year_month_rk >= 199801 AND year_month_rk < 200001 AND coalesce(crr2_flag, 'N') <> 'Y' AND {_BLANK_CUT} THEN 'TRUE'
      WHEN year_month_rk < 199801 THEN 'TRUE' END = 'TRUE', false) AS uk,
    coalesce(CASE {_since(_EU, 'EU')} WHEN year_month_rk >= 199801 AND year_month_rk < 200001 THEN {_EU_DUAL_SQL}
      WHEN year_month_rk < 199801 THEN 'TRUE' END = 'TRUE', false) AS dutch,
    coalesce(CASE WHEN year_month_rk >= 200001 AND {_OTC} THEN CASE WHEN coalesce(sys_code, 'XX') NOT IN {_EU} AND {_BLANK_CUT} THEN 'TRUE' END
      WHEN year_month_rk >= 200001 AND NOT {_OTC} THEN 'TRUE'
      WHEN year_month_rk >= 199801 AND year_month_rk < 200001 THEN {_EU_DUAL_SQL} WHEN year_month_rk < 199801 THEN 'TRUE' END = 'TRUE', false) AS other,
    coalesce(CASE {_since(_EU, 'EU')} WHEN year_month_rk < 200001 THEN {_EU_DUAL_SQL} END = 'TRUE', false) AS irish,
    CASE WHEN year_month_rk >= 200001 AND {_OTC} THEN CASE WHEN sys_code IN {_EU} AND jurisdiction_flag = 'EU' AND capital_cuts = '4' THEN 'Y' ELSE basel_data_flag END
      WHEN year_month_rk < 200001 AND year_month_rk >= 199801 THEN CASE WHEN sys_code IN ('SABFI2OR', 'MUREX2OR') AND crr2_flag = 'Y' AND capital_cuts = '4' THEN 'Y' ELSE basel_data_flag END
      ELSE basel_data_flag END AS basel FROM r)
    SELECT o_orderkey, uk, dutch, other, irish, basel FROM t WHERE uk OR dutch OR other OR irish"""


@query("regime_filter", _REGIME_SQL)
def regime_filter_query(spark, folder):
    """Four ordered rule lists and the basel flag override, as data."""
    months = {"divergence": 200001, "dual": 199801}
    rows = derive(spark, folder, _REGIME_ROWS)
    given = F.col("basel_data_flag")
    tested = rows.select(
        "o_orderkey",
        regime_value(UK_RULES, months, False).alias("uk"),
        regime_value(DUTCH_RULES, months, False).alias("dutch"),
        regime_value(OTHER_RULES, months, False, RegimeColumns()).alias("other"),
        regime_value(IRISH_RULES, months, False).alias("irish"),
        regime_value(basel_rules(given), months, given).alias("basel"),
    )
    return tested.where(F.col("uk") | F.col("dutch") | F.col("other") | F.col("irish"))


@query("regime_rule_table", _REGIME_SQL)
def regime_rule_table(spark, folder):
    """The same lists as rows of a written rule table, proved and compiled."""
    lists = {"uk": UK_RULES, "dutch": DUTCH_RULES, "other": OTHER_RULES, "irish": IRISH_RULES}
    path = scratch_path(spark, "rules")
    literal_rows(spark, [row for name, rules in lists.items() for row in rule_rows(name, rules)], RULE_TABLE).write.parquet(path)
    table_, months, given = spark.read.parquet(path), {"dual": 199801, "divergence": 200001}, F.col("basel_data_flag")
    tested = derive(spark, folder, _REGIME_ROWS).select(
        "o_orderkey",
        *[compiled(table_, name, months, tuple(months)).alias(name) for name in lists],
        regime_value(basel_rules(given), months, given).alias("basel"),
    )
    return tested.where(F.col("uk") | F.col("dutch") | F.col("other") | F.col("irish"))


_LINE_CODES = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS reporting_type,
    CASE l_linenumber WHEN 1 THEN 'n/a' WHEN 2 THEN 'retail' WHEN 3 THEN 'Nca_SI' WHEN 4 THEN 'nca_DTA' ELSE NULL END AS product FROM {lineitem}"""


@query(
    "case_flags",
    f"""WITH l AS ({plain(_LINE_CODES)}) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CASE WHEN l_linenumber IN (2, 3) THEN 'Y' ELSE 'N' END AS override_flag,
    CASE WHEN l_linenumber IN (2, 3) THEN l_extendedprice ELSE l_quantity END AS picked,
    CASE WHEN reporting_type = 'R' AND l_linestatus <> 'O' THEN 'Other items' ELSE l_linestatus END AS class_name,
    CASE WHEN reporting_type IS NOT NULL THEN 'Y' ELSE 'N' END AS has_type,
    CASE WHEN coalesce(product, 'X') NOT IN ('n/a', 'retail') THEN l_extendedprice - l_quantity ELSE 0 END AS netted,
    upper(product) AS product_upper, CASE WHEN upper(product) = 'N/A' THEN 'UNKNOWN' ELSE upper(product) END AS product_normal,
    CASE WHEN contains(product, '_SI') THEN 'SI' WHEN contains(product, '_DTA') THEN 'DT' END AS deal_type,
    nullif(l_returnflag, 'N') AS known_flag,
    CASE WHEN reporting_type = 'A' THEN l_linestatus END AS a_status FROM l""",
)
def case_flags(spark, folder):
    rows = derive(spark, folder, _LINE_CODES)
    override = one_of("l_linenumber", (2, 3))
    product = F.upper("product")
    return rows.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.when(override, F.lit("Y")).otherwise(F.lit("N")).alias("override_flag"),
        pick(override, "l_extendedprice", "l_quantity").alias("picked"),
        F.when(equals("reporting_type", "R") & ~equals("l_linestatus", "O"), F.lit(K.OTHER_ITEMS))
        .otherwise(F.col("l_linestatus"))
        .alias("class_name"),
        F.when(F.col("reporting_type").isNotNull(), F.lit("Y")).otherwise(F.lit("N")).alias("has_type"),
        amount_if(~one_of("product", ("n/a", "retail")), F.col("l_extendedprice") - F.col("l_quantity")).alias("netted"),
        product.alias("product_upper"),
        F.when(product == "N/A", F.lit("UNKNOWN")).otherwise(product).alias("product_normal"),
        F.when(F.col("product").contains("_SI"), F.lit("SI"))
        .when(F.col("product").contains("_DTA"), F.lit("DT"))
        .alias("deal_type"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("known_flag"),
        F.when(equals("reporting_type", "A"), F.col("l_linestatus")).alias("a_status"),
    )


@query(
    "case_nested_classify",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN
      CASE WHEN l_quantity > 40 THEN 'Qualifying Revolving Exposures' ELSE CASE WHEN l_discount < 0.03 OR p_size > 40 THEN
        CASE WHEN l_tax < 0.04 THEN 'Secured - SME' ELSE 'Secured - Non-SME' END
        ELSE CASE WHEN l_tax < 0.04 THEN 'Other - SME' ELSE 'Other - Non-SME' END END END ELSE p_type END AS sub_class,
    CASE WHEN p_type = 'PROMO' AND l_discount = 0.05 AND l_quantity > 25 THEN 'PD/LGD' WHEN p_brand = 'Brand#4' THEN 'Equity' WHEN p_brand = 'Brand#8' THEN 'PD/LGD'
      WHEN p_type = 'LARGE' AND l_returnflag IN ('A', 'N') THEN 'Object' WHEN p_type = 'LARGE' AND l_returnflag = 'R' THEN 'Slotting' ELSE 'Standard' END AS method,
    CASE WHEN l_quantity = 1 THEN 'NULL EAD' WHEN p_size = 1 THEN 'RETAIL' ELSE 'CORP' END AS obligor
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def case_nested_classify(spark, folder):
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand", "p_size")
    rows = lookup(table(spark, folder, "lineitem"), part, ["l_partkey"])
    sme = F.col("l_tax") < 0.04
    secured = (F.col("l_discount") < 0.03) | F.coalesce(F.col("p_size") > 40, F.lit(False))
    retail = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    large = equals("p_type", "LARGE")
    return rows.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        first_match(
            [
                (~retail, F.col("p_type")),
                (F.col("l_quantity") > 40, F.lit("Qualifying Revolving Exposures")),
                (secured & sme, F.lit("Secured - SME")),
                (secured, F.lit("Secured - Non-SME")),
                (sme, F.lit("Other - SME")),
            ],
            F.lit("Other - Non-SME"),
        ).alias("sub_class"),
        first_match(
            [
                (equals("p_type", "PROMO") & (F.col("l_discount") == 0.05) & (F.col("l_quantity") > 25), F.lit("PD/LGD")),
                (equals("p_brand", "Brand#4"), F.lit("Equity")),
                (equals("p_brand", "Brand#8"), F.lit("PD/LGD")),
                (large & one_of("l_returnflag", ("A", "N")), F.lit("Object")),
                (large & equals("l_returnflag", "R"), F.lit("Slotting")),
            ],
            F.lit("Standard"),
        ).alias("method"),
        first_match(
            [(F.col("l_quantity") == 1, F.lit("NULL EAD")), (equals("p_size", 1), F.lit("RETAIL"))], F.lit("CORP")
        ).alias("obligor"),
    )


_KEYS = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(-1 AS BIGINT) WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS first_rk,
    CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(-1 AS BIGINT) WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_custkey + 1000000 END AS second_rk,
    CASE WHEN o_totalprice < 200000 THEN CAST(-1 AS BIGINT) ELSE o_orderkey END AS third_rk FROM {orders}"""


@query(
    "coalesce_sentinel_keys",
    f"SELECT o_orderkey, coalesce(nullif(first_rk, -1), nullif(second_rk, -1), nullif(third_rk, -1), -1) AS child_rk FROM ({plain(_KEYS)})",
)
def coalesce_sentinel_keys(spark, folder):
    return derive(spark, folder, _KEYS).select(
        "o_orderkey", first_valid_key("first_rk", "second_rk", "third_rk").alias("child_rk")
    )


_CLASSES = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'Retail exposures' WHEN 2 THEN 'Equity Claims'
    WHEN 3 THEN 'Other items' WHEN 4 THEN 'Unlisted' WHEN 5 THEN 'Exposures in default' WHEN 6 THEN NULL ELSE 'Equities' END AS class_name FROM {lineitem}"""


@query(
    "code_map_lookup",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE class_name WHEN 'Retail exposures' THEN 'STD0009' WHEN 'Equity Claims' THEN 'STD0016'
    WHEN 'Other items' THEN 'STD0017' WHEN 'Exposures in default' THEN 'STD0011' END AS sheet_id,
    CASE class_name WHEN 'Equities' THEN 'Equity Claims' ELSE class_name END AS standard_name FROM ({plain(_CLASSES)})""",
)
def code_map_lookup(spark, folder):
    name = F.col("class_name")
    return derive(spark, folder, _CLASSES).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        code_lookup(name, K.SHEET_OF_CLASS).alias("sheet_id"),
        code_lookup(name, K.STANDARD_CLASS_OF, otherwise=name).alias("standard_name"),
    )


@query(
    "period_arithmetic",
    """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, CAST(year(d) * 100 + month(d) AS INTEGER) AS month_key, last_day(d) AS month_end,
    last_day(CAST(date_trunc('quarter', d) + INTERVAL 2 MONTH AS DATE)) AS quarter_end,
    CAST(strftime(last_day(CAST(date_trunc('quarter', CAST(d - INTERVAL 3 MONTH AS DATE)) + INTERVAL 2 MONTH AS DATE)), '%Y%m') AS INTEGER) AS previous_quarter,
    CAST((month(d) - 1) % 3 + 1 AS INTEGER) AS months_so_far,
    last_day(CAST(date_trunc('quarter', d) AS DATE)) AS first_month_end FROM d""",
)
def period_arithmetic(spark, folder):
    d = F.to_date("o_orderdate")
    months = periods.quarter_months(d)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        periods.month_key(d).alias("month_key"),
        periods.month_end(d).alias("month_end"),
        periods.quarter_end(d).alias("quarter_end"),
        periods.previous_quarter_key(d).alias("previous_quarter"),
        F.size(months).alias("months_so_far"),
        F.element_at(months, 1).alias("first_month_end"),
    )
