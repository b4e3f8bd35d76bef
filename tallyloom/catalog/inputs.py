"""Inputs of the reporting jobs, derived from the shared test tables.

An order is a deal of the book at the reporting date, its lines are the
mitigants, customers are counterparties and nations stand for units,
divisions and countries. Each input is one SELECT that both Spark and the
oracle database read, so inputs agree by construction and only the jobs
themselves are compared. Every input covers its whole tables.
"""

from __future__ import annotations

from collections import ChainMap
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources.tables import table

RUN_DATE = "2001-08-31"
RUN_MONTH = 200108
RUN_DAY = 20010831
PRIOR_QUARTER = 200106
FIRST_DAY, LAST_DAY = "DATE '1990-01-01'", "DATE '9999-12-31'"

# A deal id without prefix; lines use the same expression on their order key.
DEAL_ID = """CASE {k} % 11 WHEN 0 THEN 'AR2956' WHEN 1 THEN 'LNAWM' WHEN 2 THEN 'LNA_SI' WHEN 3 THEN 'LNA_DTA'
  WHEN 4 THEN 'LNA_NSI' ELSE 'LNABX' END || '-' || CAST({k} AS STRING)"""

_PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
_WEIGHT = (
    "CAST(CASE o_orderkey % 6 WHEN 0 THEN 0.0 WHEN 1 THEN 0.2 WHEN 2 THEN 0.35 WHEN 3 THEN 0.5 WHEN 4 THEN 1.0"
    " ELSE 1.5 END AS DOUBLE)"
)


# Amounts are whole numbers, so that their sums do not depend on the order of rows.
_PRICE = "CAST(floor(o_totalprice) AS DOUBLE)"
_BALANCE = "CAST(floor(c_acctbal) AS DOUBLE)"


def _share(factor: str) -> str:
    return f"CAST(floor(o_totalprice * CAST({factor} AS DOUBLE)) AS DOUBLE)"


FACT_COLUMNS: dict[str, str] = {
    "_source": "CASE n_regionkey WHEN 2 THEN 'exposures_dnb' WHEN 3 THEN 'exposures_oth' ELSE 'exposures' END",
    "deal_id": DEAL_ID.format(k="o_orderkey"),
    "deal_id_prefix": "CASE WHEN n_regionkey = 2 THEN 'NLP' END",
    "reporting_regulator_code": "CASE WHEN n_regionkey = 3 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'UK-FSA' ELSE 'DE-BBK' END END",
    "year_month_rk": str(RUN_MONTH),
    "day_rk": str(RUN_DAY),
    "valid_flag": "'Y'",
    "adjust_flag": "CASE o_orderstatus WHEN 'P' THEN 'U' ELSE 'A' END",
    "counterparty_rk": f"CASE WHEN {_PRIORITY} = 5 AND o_orderstatus = 'O' THEN CAST(-1 AS BIGINT) ELSE o_custkey END",
    "rru_rk": "c_nationkey",
    "risk_on_rru_rk": f"(c_nationkey + {_PRIORITY}) % 25",
    "b2_irb_asset_class_rk": "CAST(100 + (o_custkey + o_orderkey) % 9 AS INT)",
    "b2_std_asset_class_rk": "CAST(200 + o_orderkey % 18 AS INT)",
    "corep_asset_class_rk": "CAST(300 + o_orderkey % 3 AS INT)",
    "b2_std_pre_dflt_asset_class_rk": "CAST(200 + o_custkey % 18 AS INT)",
    "division_rk": "c_nationkey",
    "pd_model_rk": _PRIORITY,
    "ead_model_rk": f"{_PRIORITY} + 1",
    "product_rk": _PRIORITY,
    "cost_centre_rk": "c_nationkey % 10",
    "incorp_country_rk": "c_nationkey",
    "op_country_rk": "(c_nationkey + 1) % 25",
    "gl_account_rk": _PRIORITY,
    "industry_rk": "CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'HOUSEHOLD' THEN 3 WHEN 'FURNITURE' THEN 4 ELSE 5 END",
    "corep_product_category_rk": "CAST(o_orderkey % 10 - 1 AS INT)",
    "std_rw_priority_order_rule_rk": "CAST(o_orderkey % 7 AS INT)",
    "sys_code": "CASE o_orderkey % 8 WHEN 0 THEN 'SABFUKOR' WHEN 1 THEN 'MUREUKOR' WHEN 2 THEN 'SABFI2OR' WHEN 3 THEN 'MUREX2OR' WHEN 4 THEN 'MTH_OTH' WHEN 5 THEN 'ACBCNTNW' WHEN 6 THEN 'LEDGER' END",
    "aclm_product_type": "CASE o_orderkey % 9 WHEN 0 THEN 'RETAIL' WHEN 1 THEN 'ON_BALANCE' WHEN 2 THEN 'OFF_BALANCE' WHEN 3 THEN 'UNDRAWN-COMM' WHEN 4 THEN 'BASEL-OTC' WHEN 5 THEN 'REPO' WHEN 6 THEN 'EQUITY' WHEN 7 THEN 'NCA' ELSE 'N/A' END",
    "jurisdiction_flag": "CASE o_orderkey % 5 WHEN 0 THEN 'UK' WHEN 1 THEN 'EU' WHEN 2 THEN '' END",
    "capital_cuts": "CASE o_custkey % 4 WHEN 0 THEN '4' WHEN 1 THEN '' END",
    "crr2_flag": "CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
    "basel_data_flag": "CASE WHEN o_orderkey % 13 = 0 THEN 'N' ELSE 'Y' END",
    "reporting_type_code": "CASE o_orderkey % 17 WHEN 0 THEN 'NC' WHEN 1 THEN 'MR' WHEN 2 THEN 'OR' WHEN 3 THEN 'SR' WHEN 4 THEN 'LS' WHEN 5 THEN NULL ELSE 'CR' END",
    "approved_approach_code": f"CASE {_PRIORITY} WHEN 1 THEN 'AIRB' WHEN 2 THEN 'AIRB' WHEN 3 THEN 'STD' WHEN 4 THEN 'STD' ELSE CASE WHEN o_orderstatus <> 'O' THEN 'STD' END END",
    "type": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'RET' ELSE 'CORP' END",
    "qual_rev_exp_flag": "CASE WHEN o_orderkey % 5 = 1 THEN 'Y' ELSE 'N' END",
    "comm_real_estate_sec_flag": "CASE WHEN o_orderkey % 4 = 1 THEN 'Y' END",
    "pers_acc_flag": "CASE o_custkey % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' END",
    "definitive_slot_category_calc": "CASE WHEN o_orderkey % 2 = 0 THEN 'N' ELSE 'Y' END",
    "internal_transaction_flag": "CASE o_orderkey % 3 WHEN 0 THEN 'Y' ELSE 'N' END",
    "risk_taker_group_structure": "CASE o_custkey % 4 WHEN 0 THEN 'UKIG' WHEN 1 THEN 'wig' WHEN 2 THEN 'NIG' END",
    "risk_on_group_structure": "CASE o_orderkey % 4 WHEN 0 THEN 'WIG' WHEN 1 THEN 'NIG' WHEN 2 THEN 'UKIG' END",
    "risk_taker_gs_code": "CASE o_custkey % 5 WHEN 0 THEN 'CORE' WHEN 1 THEN 'NONCORE' WHEN 2 THEN 'ConnectedC' WHEN 3 THEN 'OTHER' END",
    "risk_on_gs_code": "CASE o_orderkey % 7 WHEN 0 THEN 'CORE' WHEN 1 THEN 'NONCORE' WHEN 2 THEN 'CONNECTEDC' WHEN 3 THEN 'connectedc_xref' WHEN 4 THEN 'OTHER' ELSE 'CORE' END",
    "retail_off_bal_sheet_flag": "CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
    "bank_base_role_code": "CASE o_custkey % 3 WHEN 0 THEN 'P' WHEN 1 THEN 'A' END",
    "grdw_pool_id": "CASE o_orderkey % 4 WHEN 0 THEN 'POOL' WHEN 1 THEN '' END",
    "b3_sme_discount_flag": "CASE o_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
    "crr2_501a_discount_flag": "CASE o_custkey % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
    "b3_sme_rp_flag": "CASE o_custkey % 2 WHEN 0 THEN 'Y' ELSE 'N' END",
    "retail_pool_sme_flag": "CASE WHEN o_custkey % 7 = 0 THEN 'Y' END",
    "transitional_portfolio_flag": "CASE WHEN o_custkey % 6 = 0 THEN 'Y' END",
    "b2_app_adjusted_pd_ratio": "CAST(CASE o_orderkey % 5 WHEN 0 THEN 1.0 WHEN 1 THEN NULL WHEN 2 THEN 0.02 WHEN 3 THEN 0.15 ELSE 0.0003 END AS DOUBLE)",
    "b2_app_adjusted_lgd_ratio": "CAST(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 0.45 END AS DOUBLE)",
    "b2_irb_effective_maturity_yrs": "CAST(o_orderkey % 8 AS DOUBLE) * CAST(0.75 AS DOUBLE)",
    "residual_maturity_days": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey % 40 AS INT) * 50 END",
    "obligors_count": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS INT) END",
    "b2_std_risk_weight_ratio": _WEIGHT,
    "sme_discount_factor": "CAST(CASE o_orderkey % 4 WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE 0.7619 END AS DOUBLE)",
    "b2_std_ccf": "CAST(CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 20 WHEN 3 THEN 50 ELSE 100 END AS DOUBLE)",
    "b2_irb_ccf": "CAST(0.75 AS DOUBLE)",
    "b2_std_ead_post_crm_amt": f"CASE WHEN o_orderkey % 23 = 0 THEN {_BALANCE} ELSE {_PRICE} END",
    "b2_app_ead_post_crm_amt": f"CASE o_orderkey % 19 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE) WHEN 2 THEN {_BALANCE} ELSE {_PRICE} - 100 END",
    "b2_std_ead_pre_crm_amt": _share("1.1"),
    "b2_app_ead_pre_crm_amt": _share("1.05"),
    "b2_std_rwa_post_crm_amt": f"{_PRICE} * {_WEIGHT}",
    "b2_app_rwa_post_crm_amt": f"CASE o_orderkey % 21 WHEN 0 THEN NULL WHEN 1 THEN -{_PRICE} ELSE ({_PRICE} - 100) * {_WEIGHT} END",
    "b2_irb_rwa_post_crm_amt": _share("0.4"),
    "b2_std_drawn_rwa": f"CASE WHEN o_orderkey % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE {_share('0.75')} END",
    "b2_std_undrawn_rwa": f"CASE WHEN o_orderkey % 2 = 0 THEN CAST(0 AS DOUBLE) ELSE {_share('0.25')} END",
    "b2_irb_drawn_ead": _share("0.5"),
    "b2_irb_undrawn_ead": _share("0.25"),
    "b2_irb_drawn_rwa": _share("0.3"),
    "b2_irb_undrawn_rwa": _share("0.15"),
    "b2_irb_drawn_expected_loss": _share("0.01"),
    "b2_irb_undrawn_expected_loss": f"CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE {_share('0.005')} END",
    "b2_app_expected_loss_amt": f"CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE {_share('0.02')} END",
    "b2_std_orig_exp_pre_con_factor": _share("1.2"),
    "b2_irb_orig_exp_pre_con_factor": _share("1.3"),
    "off_bal_led_exp_gbp_post_sec": _share("0.05"),
    "undrawn_commitment_amt_pst_sec": _share("0.15"),
    "off_balance_exposure": f"CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE {_share('0.4')} END",
    "undrawn_commitment_amt": f"CASE o_orderkey % 4 WHEN 0 THEN CAST(0 AS DOUBLE) WHEN 1 THEN NULL ELSE {_share('1.5')} END",
    "comm_less_than_1_year": _share("0.02"),
    "comm_more_than_1_year": _share("0.03"),
    "net_exposure": _share("0.8"),
    "drawn_ledger_balance": _share("0.7"),
    "e_star_gross_exposure": _share("0.6"),
    "accrued_interest_gbp": _share("0.004"),
    "b2_irb_interest_at_default_gbp": f"CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE {_share('0.003')} END",
    "ifrs9_tot_regu_ecl_amt_gbp": _share("0.01"),
    "ifrs9_prov_write_off_amt_gbp": f"CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {_share('0.001')} END",
    "provision_amount_gbp": _share("0.006"),
    "b3_cva_provision_amt": f"CASE WHEN o_orderkey % 4 = 2 THEN NULL ELSE {_share('0.002')} END",
    "b3_cva_cc_rwa_amt": f"CASE WHEN o_orderkey % 5 = 0 THEN {_share('0.1')} END",
    "gross_dep_utilisation_amt": _share("0.03"),
    "net_dep_utilisation_amt": f"CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE {_share('0.01')} END",
    "b2_irb_netted_coll_gbp": f"CASE WHEN o_orderkey % 2 = 1 THEN NULL ELSE {_share('0.015')} END",
    "unsettled_amount": _share("0.002"),
    "unsettled_price_difference_amt": f"CASE WHEN o_orderkey % 7 = 0 THEN {_share('0.0005')} END",
    "unsettled_period_code": "CASE WHEN o_orderkey % 7 = 0 THEN 'D1' END",
    "trading_book_flag": "CASE WHEN o_orderkey % 11 = 0 THEN 'Y' ELSE 'N' END",
    "irb_sme_discount_app_flag": "CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
    "sts_securitisation": "CASE WHEN o_custkey % 5 = 0 THEN 'STS' END",
    "sts_sec_qual_cap_trtmnt": "CASE o_custkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
    "sts_sec_approach_code": "CASE WHEN o_custkey % 5 = 0 THEN 'SEC-SA' WHEN o_custkey % 7 = 0 THEN 'SEC-IRBA' END",
    "ifrs9_final_stage": "'STAGE ' || CAST(o_orderkey % 3 + 1 AS STRING)",
    "ifrs9_stage_3_type": "CASE WHEN o_orderkey % 3 = 2 THEN 'INDIVIDUAL' END",
    "ifrs9_ecl_currency_code": "CASE c_nationkey % 3 WHEN 0 THEN 'GBP' WHEN 1 THEN 'EUR' ELSE 'USD' END",
    "ile_counterparty_ciscode": "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'ILE' || CAST(o_custkey AS STRING) END",
    "ile_risk_class": "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'RC' || CAST(o_custkey % 4 AS STRING) END",
    "unsettled_factor_code": "CASE WHEN o_orderkey % 7 = 0 THEN 'F1' END",
    "b3_cva_cc_adv_flag": "CASE WHEN o_orderkey % 5 = 0 THEN 'Y' ELSE 'N' END",
    "crd4_sov_substitution_flag": "CASE WHEN o_orderkey % 12 = 0 THEN 'Y' ELSE 'N' END",
    "unlikely_pay_flag": "CASE WHEN o_orderkey % 14 = 0 THEN 'Y' END",
    "std_exposure_default_flag": "CASE WHEN o_orderkey % 15 = 0 THEN 'Y' ELSE 'N' END",
    "crd4_std_rp_sme_flag": "CASE WHEN o_custkey % 8 = 0 THEN 'Y' END",
    "crd4_irb_rp_sme_flag": "CASE WHEN o_custkey % 8 = 1 THEN 'Y' END",
    "corep_crm_reporting_flag": "CASE WHEN o_orderkey % 4 = 3 THEN 'Y' ELSE 'N' END",
    "new_in_default_flag": "CASE WHEN o_orderkey % 16 = 0 THEN 'Y' ELSE 'N' END",
    "cs_proxy_used_flag": "CASE WHEN o_orderkey % 18 = 0 THEN 'Y' END",
    "market_risk_sub_type": "CASE WHEN o_orderkey % 20 = 0 THEN 'FX' END",
}

_ASSET_CLASSES = [
    # key, type, regulatory class, regulatory sub-class, class, sub-class
    (100, "B2_IRB", "Corporates", "Income Producing Real Estate", "Corporate", "Corporate - SL"),
    (101, "B2_IRB", "Corporates", "Object Finance", "Corporate", "Corporate - SL"),
    (102, "B2_IRB", "Corporates", "Corporates with turnover < Eur 50M", "Corporate", "Corporate - SME"),
    (103, "COREP_IRB", "Institutions", "N/A", "Institutions", "Institutions"),
    (104, "COREP_IRB", "Equities", "N/A", "Equity", "Equity"),
    (105, "B2_IRB", "Retail", "Retail SME", "Retail", "N/A"),
    (106, "COREP_IRB", "Central governments and central banks", None, "Exposures in default", "Sovereign"),
    (107, "COREP_IRB", "Non-credit Obligation Assets", "N/A", "Other", "Other"),
    (200, "B2_STD", "Central governments", None, "Exposures to central governments or central banks", "S0"),
    (201, "B2_STD", "Regional governments", None, "Exposures to regional governments or local authorities", "S1"),
    (202, "B2_STD", "Public sector", None, "Exposures to public sector entities", "S2"),
    (203, "B2_STD", "Development banks", None, "Exposures to multilateral development banks", "S3"),
    (204, "B2_STD", "International", None, "Exposures to international organisations", "S4"),
    (205, "B2_STD", "Institutions", None, "Exposures to institutions", "S5"),
    (206, "B2_STD", "Corporates", None, "Exposures to corporates", "S6"),
    (207, "B2_STD", "Retail", None, "Retail exposures", "S7"),
    (208, "B2_STD", "Secured by mortgages on residential property", None, "Exposures Secured by Immovable Property", "S8"),
    (209, "B2_STD", "In default", None, "Exposures in default", "S9"),
    (210, "B2_STD", "High risk", None, "Exposures associated with particularly high risk", "S10"),
    (211, "B2_STD", "Covered bonds", None, "Exposures in the form of covered bonds", "S11"),
    (212, "B2_STD", "Collective Investment Undertakings", None, "Exposures in the form of units or shares in collective investment undertakings ('CIUs')", "S12"),
    (213, "B2_STD", "Equity", None, "Equity Claims", "S13"),
    (214, "B2_STD", "Other", None, "Other items", "S14"),
    (215, "B2_STD", "Securitisation", None, "Items representing securitisation positions", "S15"),
    (216, "B2_STD", "Not applicable", None, "N/A", "S16"),
    (217, "B2_STD", "Short-term", None, "Exposures to institutions and corporates with a  short-term credit assessment", "S17"),
    (300, "COREP", "Retail", None, "Retail", "N/A"),
    (301, "COREP", "Retail", None, "Retail", "Other"),
    (302, "COREP", "Corporates", None, "Corporate", "Corporate - SME"),
    (400, "COREP_IRB", "Corporates", None, "Corporate", "RWA Calc Under AIRB - SL PD/LGD"),
    (401, "COREP_IRB", "Corporates", None, "Corporate", "RWA Calc Under AIRB - SL Slotting"),
    (402, "COREP_IRB", "Corporates", None, "Corporate", "Corporate - SME"),
    (403, "COREP_IRB", "Retail", None, "Retail", "Qualifying Revolving Exposures"),
    (404, "COREP_IRB", "Retail", None, "Retail", "Other Retail Exposures - SME"),
    (405, "COREP_IRB", "Retail", None, "Retail", "Other Retail Exposures - Non-SME"),
]


def _literal(value) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    quoted = str(value).replace("'", "''")
    return f"'{quoted}'" if isinstance(value, str) else quoted


def values(rows, names: str) -> str:
    """A literal list as a SELECT both engines read."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


def _always(select: str) -> str:
    return f"SELECT s.*, {FIRST_DAY} AS valid_from_date, {LAST_DAY} AS valid_to_date FROM ({select}) AS s"


_CLASS_ROWS = values(
    [(k, t, "Y", r, rs, b, s) for k, t, r, rs, b, s in _ASSET_CLASSES],
    "asset_class_rk, type, valid_flag, reg_exposure_type, reg_exposure_sub_type, basel_exposure_type, basel_exposure_sub_type",
)
_BOOK_JOIN = "{orders} LEFT JOIN {customer} ON o_custkey = c_custkey LEFT JOIN {nation} ON c_nationkey = n_nationkey"
_SEGMENT_KEY = FACT_COLUMNS["industry_rk"]
_CIS = "CASE WHEN c_custkey % 37 = 0 THEN 'Z6VROIT' WHEN c_custkey % 41 = 0 THEN 'Z6VR0IT' WHEN c_custkey % 31 = 0 THEN 'UnKnown' WHEN c_custkey % 23 = 0 THEN NULL ELSE 'CIS' || CAST(c_custkey AS STRING) END"
_LINE_SHARE = "CAST(floor(l_extendedprice * CAST({f} AS DOUBLE)) AS DOUBLE)"

INPUTS: dict[str, str] = {
    "facts": "SELECT " + ", ".join(f"{e} AS {n}" for n, e in FACT_COLUMNS.items()) + f" FROM {_BOOK_JOIN}",
    "exposures_rec": f"""SELECT {DEAL_ID.format(k='o_orderkey')} AS deal_id, {RUN_MONTH} AS year_month_rk, {RUN_DAY} AS day_rk,
        'Y' AS valid_flag, CASE WHEN o_orderkey % 3 = 1 THEN 'Y' END AS mortgages_flag, o_orderpriority AS product_family_code,
        CAST(0.2 AS DOUBLE) AS b2_std_ccf_less_than_year, CAST(0.5 AS DOUBLE) AS b2_std_ccf_more_than_year FROM {{orders}}""",
    "counterparties": f"""SELECT c_custkey AS counterparty_rk, {RUN_MONTH} AS year_month_rk, {RUN_DAY} AS day_rk, 'Y' AS valid_flag,
        {_SEGMENT_KEY} AS ec92_industry_rk, CAST(floor(c_custkey / 2) AS BIGINT) AS branch_parent_counterparty_rk,
        CASE c_custkey % 4 WHEN 0 THEN 'Q' WHEN 1 THEN 'C' WHEN 2 THEN 'S' END AS bsd_marker,
        CAST(200 + c_custkey % 16 AS INT) AS b2_std_asset_class_rk FROM {{customer}}""",
    "counterparty": f"""SELECT c_custkey AS counterparty_rk, {{fan}}(DATE '2001-07-31', DATE '2001-08-31')) AS snap_dt, {FIRST_DAY} AS valid_from_date,
        CASE WHEN c_custkey % 29 = 0 THEN DATE '2000-01-01' ELSE {LAST_DAY} END AS valid_to_date,
        {_CIS} AS cis_code,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'Bank' WHEN 'MACHINERY' THEN 'Corporate' WHEN 'HOUSEHOLD' THEN 'Fund' END AS risk_entity_class,
        CASE c_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS qccp,
        CASE c_custkey % 2 WHEN 0 THEN 'Y' ELSE 'N' END AS group_internal_flag,
        CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'S' || CAST(c_custkey AS STRING) END AS sys_id, 'CS' AS sys_code,
        CAST(c_custkey % 4 AS STRING) AS fi_avc_category
        FROM {{customer}}""",
    "unit": _always(
        """SELECT n_nationkey AS rru_rk,
        CASE n_nationkey WHEN 3 THEN 'NWBDEUAI' WHEN 8 THEN 'NWMDEUAI' WHEN 5 THEN 'ULSTERAI' ELSE 'UNIT' || CAST(n_nationkey AS STRING) END AS ll_rru,
        n_name AS ll_rru_desc,
        CASE WHEN n_regionkey = 1 THEN 'XUBIL' || CAST(n_nationkey AS STRING) WHEN n_regionkey = 4 THEN NULL ELSE 'LLP' END AS llp_rru
        FROM {nation}"""
    ),
    "division": _always(
        """SELECT n_nationkey AS division_rk, 'S1' AS sub1,
        CASE n_nationkey WHEN 1 THEN 'CITIZENS2001' WHEN 6 THEN 'CITIZENS2003_NC' WHEN 10 THEN 'CITIZENS2002' ELSE 'SUB' || CAST(n_regionkey AS STRING) END AS sub2,
        'S3' AS sub3, 'S4' AS sub4, 'S5' AS sub5,
        CASE WHEN n_nationkey IN (1, 6) THEN 'CITIZENS' ELSE 'DIV' || CAST(n_regionkey AS STRING) END AS division FROM {nation}"""
    ),
    "country": _always(
        """SELECT n_nationkey AS country_rk, CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE 'P3 ' || n_name END AS p3_country_desc,
        CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE n_name END AS country_desc FROM {nation}"""
    ),
    "asset_class": _always(_CLASS_ROWS),
    "model": _always(values([(1, "LC"), (2, "SG"), (3, "SRW"), (4, "PM"), (5, "PM5"), (6, "PM6")], "model_rk, model_code")),
    "product": _always(
        values(
            [
                (1, "Term Loan", "PR_EQ_CIU", "H1"),
                (2, "Revolver Receivable", "PR_DFP_ESTAR", "H2"),
                (3, "Overdraft", "PR_DFC_ESTAR", "H3"),
                (4, None, "PR_LOAN", "H4"),
                (5, "Lease", None, "H5"),
            ],
            "product_rk, aiml_product_type, regulatory_product_type, high_prod",
        )
    ),
    "industry": _always(
        values(
            [
                (1, "ST1", "SEC1", "G", "Sovereigns &", "Local Authorities"),
                (2, "ST2", "SEC2", "J", " Quasi Sovereigns", "Central Government"),
                (3, "ST3", "SEC3", "UNKNOWN", "Property", "Other public bodies"),
                (4, "ST4", "SEC4", "H", None, None),
                (5, "ST5", "SEC5", "A", "Retail", "Central Government"),
            ],
            "industry_rk, sector_type, sector, uk_sic_code, sector_cluster, sub_sector",
        )
    ),
    "cost_centre": _always(
        values(
            [(i, f"CC{i}" if i > 3 else ("OVERSGMPF", "RBSSUBR", "GREENCAPP", "NCOREZUE1")[i], "T", "Y", i * 3, i * 7 if i else -1) for i in range(10)],
            "cost_centre_rk, cost_centre, cost_centre_type, valid_flag, le_counterparty_rk, wbu_counterparty_rk",
        )
    ),
    "ledger": _always(
        values(
            [
                (1, "18013100000", "XCONTLIAB", "B1"),
                (2, "18013100000", "OTHER", "B2"),
                (3, "000", "XCONTLIAB", "B1"),
                (4, "001", "OTHER", "B9"),
            ],
            "gl_rk, bspl_900_gl_code, bspl_60_gl_code, bspl_800_gl_code",
        )
    ),
    "ledger_map": values([("B1", "AMC"), ("B2", "FVTPL")], "bspl800_code, ias39_class"),
    "product_category": values(
        [
            (-1, "UNKNOWN", "NONE"),
            (0, "RETAIL", "ON BALANCE SHEET"),
            (1, "ON_BALANCE", "ON BALANCE SHEET"),
            (2, "OFF_BALANCE", "OFF BALANCE SHEET"),
            (3, "UNDRAWN-COMM", "OFF BALANCE SHEET"),
            (4, "BASEL-OTC", "DERIVATIVES"),
            (5, "REPO", "SECURITIES FINANCING"),
            (6, "EQUITY", "ON BALANCE SHEET"),
            (7, "NCA", "N/A"),
        ],
        "corep_product_category_rk, aclm_product_type, corep_product_category",
    ),
    "rule": values(
        [
            (1, "RW set for Regional Government or Local Authority where valid rating exists for the counterparty (CQS Risk Weight Mapping RDS table)"),
            (2, "RW set for Admin and Non Commercial Undertaking where counterparty is unrated so Central government rating is used (CQS Risk Weight Mapping RDS table)"),
            (3, "Other rule"),
        ],
        "rule_rk, rule_desc",
    ),
    "maturity_band": "SELECT t.*, "
    + f"{FIRST_DAY} AS valid_from_date, {LAST_DAY} AS valid_to_date FROM (VALUES "
    + "(CAST(0 AS DOUBLE), CAST(1 AS DOUBLE), 'Y', 'N', 'S', '< 1Y'), (CAST(1 AS DOUBLE), CAST(3 AS DOUBLE), 'Y', 'N', 'S', '1-3Y'), "
    + "(CAST(3 AS DOUBLE), CAST(4.5 AS DOUBLE), 'Y', 'Y', 'S', '3-4.5Y'), (CAST(0 AS DOUBLE), CAST(9 AS DOUBLE), 'Y', 'Y', 'L', 'ALL')) "
    + "AS t(lower_value, upper_value, lower_val_inclusive, upper_val_inclusive, type, maturity_band_desc)",
    "pd_band": "SELECT t.*, "
    + f"{FIRST_DAY} AS valid_from_date, {LAST_DAY} AS valid_to_date FROM (VALUES "
    + "(CAST(0 AS DOUBLE), CAST(0.02 AS DOUBLE), 'Y', 'N', 'MGS', 1, 'A'), (CAST(0.02 AS DOUBLE), CAST(0.1 AS DOUBLE), 'Y', 'N', 'MGS', 2, 'B'), "
    + "(CAST(0.1 AS DOUBLE), CAST(1 AS DOUBLE), 'Y', 'N', 'MGS', 3, 'C'), (CAST(1 AS DOUBLE), CAST(9 AS DOUBLE), 'Y', 'Y', 'MGS', 27, 'D'), "
    + "(CAST(0 AS DOUBLE), CAST(9 AS DOUBLE), 'Y', 'Y', 'OTHER', 99, 'Z')) "
    + "AS t(lower_value, upper_value, lower_val_inclusive, upper_val_inclusive, type, mgs, pd_band_code)",
    "override": _always(
        values(
            [
                ("CIS7", "EXC_IG_CIS", "CIS EXCLUSION", "Y"),
                ("CIS8", "EXC_IG_CIS", "CIS EXCLUSION", "N"),
                ("CIS9", "OTHER_RULE", "CIS EXCLUSION", "Y"),
                ("Z6VROIT", "EXC_IG_CIS", "CIS EXCLUSION", "Y"),
            ],
            "overridden_value, override_rule, override_reason, override_value",
        )
    ),
    "etl_parameter": values(
        [
            ("PRA_DIVERGENCE_EFF_DATE", "01-Jan-2001"),
            ("CRR2_DUAL_REP_EFF_DATE", "01-Jul-1998"),
            ("ICB_EFFECTIVE_DATE", "01-Jan-2000"),
            ("CORE_TO_CORE_IG_EXP_EFF_DATE", "01-Mar-2001"),
        ],
        "parameter_name, parameter_value",
    ),
    "engine_parameter": values([("INFRADISCOUNTFACTOR", "0.75"), ("OTHER", "1")], "param_code, param_value"),
    "history": f"""SELECT {PRIOR_QUARTER} AS year_month, 'A' AS adjust_flag, 'EXPOSURE' AS flow_type,
        CASE n_regionkey WHEN 2 THEN 'NL-DNB' WHEN 3 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'UK-FSA' ELSE 'DE-BBK' END ELSE 'UK-FSA' END AS reporting_regulator_code,
        CASE WHEN n_regionkey = 2 THEN 'NLP' ELSE '' END || {DEAL_ID.format(k='o_orderkey')} AS deal_id,
        CASE WHEN {_PRIORITY} <= 2 THEN 'AIRB' ELSE 'STD' END AS rwa_approach_code,
        CASE WHEN o_orderkey % 4 = 0 THEN 'Exposures in default' ELSE 'Exposures to corporates' END AS memo_b2_std_basel_exposure_type,
        CAST(CASE WHEN o_orderkey % 10 = 0 THEN 1.0 ELSE 0.02 END AS DOUBLE) AS b2_app_adjusted_pd_ratio
        FROM {_BOOK_JOIN} WHERE o_orderdate <= DATE '2001-06-30'""",
    "sub_exposures": f"""SELECT {DEAL_ID.format(k='l_orderkey')} AS deal_id, 'Y' AS valid_flag, {RUN_MONTH} AS year_month_rk, {RUN_DAY} AS day_rk,
        l_partkey AS mitigant_id, l_suppkey AS provider_counterparty_rk,
        CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS mitigant_type_rk,
        CASE WHEN l_linenumber % 3 = 0 THEN 1 WHEN l_linenumber % 3 = 1 THEN 2 END AS collateral_type_rk,
        CASE l_linenumber WHEN 1 THEN 'GUARANTEES' WHEN 2 THEN 'CREDIT DERIVATIVES' WHEN 3 THEN 'ELIGIBLE FINANCIAL COLLATERAL'
          WHEN 4 THEN 'OTHER FUNDED CREDIT PROTECTION' WHEN 5 THEN 'REAL ESTATE' WHEN 6 THEN CASE WHEN l_linestatus = 'O' THEN 'RECEIVABLES' ELSE 'OTHER PHYSICAL COLLATERAL' END
          ELSE CASE WHEN l_linestatus = 'O' THEN '' END END AS corep_crm_category,
        CASE WHEN l_quantity > 20 THEN 'WG' ELSE 'SG' END AS type,
        CASE CAST(l_quantity AS INT) % 5 WHEN 0 THEN 'Y' WHEN 1 THEN NULL ELSE 'N' END AS double_default_flag,
        CASE WHEN l_linestatus = 'F' THEN {_LINE_SHARE.format(f='1')} END AS b2_std_eff_gtee_amt,
        CASE WHEN l_returnflag = 'A' THEN {_LINE_SHARE.format(f='0.5')} END AS b2_std_eff_cds_amt,
        {_LINE_SHARE.format(f='0.25')} AS b2_std_gtee_cds_rwa,
        {_LINE_SHARE.format(f='0.6')} AS b2_irb_gtee_amt,
        {_LINE_SHARE.format(f='0.7')} AS b2_irb_coll_amt,
        CASE WHEN l_tax > 0.04 THEN CAST(0 AS DOUBLE) ELSE {_LINE_SHARE.format(f='0.55')} END AS sec_discntd_b2_irb_garntee_amt,
        CASE WHEN l_tax > 0.05 THEN CAST(0 AS DOUBLE) WHEN l_tax > 0.03 THEN NULL ELSE {_LINE_SHARE.format(f='0.65')} END AS sec_discntd_b2_irb_colltrl_amt,
        {_LINE_SHARE.format(f='0.8')} AS b2_std_eff_coll_amt_post_hcut,
        {_LINE_SHARE.format(f='0.9')} AS b2_std_elig_coll_amt,
        CASE WHEN l_discount > 0.05 THEN NULL ELSE l_discount END AS b2_std_fx_haircut,
        {_LINE_SHARE.format(f='0.02')} AS b2_std_coll_volatility_amt,
        {_LINE_SHARE.format(f='0.01')} AS b2_std_coll_mty_mismatch_amt,
        l_discount * 10 AS b2_std_gtor_rw_ratio,
        {_LINE_SHARE.format(f='0.03')} AS b2_irb_colltrl_amt_ttc,
        {_LINE_SHARE.format(f='0.04')} AS b2_irb_garntee_amt_ttc,
        {_LINE_SHARE.format(f='0.05')} AS sec_discnt_b2_irb_coll_amt_ttc,
        {_LINE_SHARE.format(f='0.06')} AS sec_discnt_b2_irb_gtee_amt_ttc
        FROM {{lineitem}}""",
    "sub_exposures_oth": f"""SELECT {DEAL_ID.format(k='o_orderkey')} AS deal_id, 'Y' AS valid_flag, {RUN_MONTH} AS year_month_rk, {RUN_DAY} AS day_rk,
        o_custkey AS mitigant_id, CAST(1 AS BIGINT) AS provider_counterparty_rk, 1 AS mitigant_type_rk, 2 AS collateral_type_rk,
        'GUARANTEES' AS corep_crm_category, 'WG' AS type, 'N' AS double_default_flag,
        {_share('0.01')} AS b2_std_eff_gtee_amt, CAST(NULL AS DOUBLE) AS b2_std_eff_cds_amt, {_share('0.005')} AS b2_std_gtee_cds_rwa,
        {_share('0.02')} AS b2_irb_gtee_amt, CAST(NULL AS DOUBLE) AS b2_irb_coll_amt, CAST(NULL AS DOUBLE) AS sec_discntd_b2_irb_garntee_amt,
        CAST(NULL AS DOUBLE) AS sec_discntd_b2_irb_colltrl_amt, CAST(NULL AS DOUBLE) AS b2_std_eff_coll_amt_post_hcut,
        CAST(NULL AS DOUBLE) AS b2_std_elig_coll_amt, CAST(NULL AS DOUBLE) AS b2_std_fx_haircut, CAST(NULL AS DOUBLE) AS b2_std_coll_volatility_amt,
        CAST(NULL AS DOUBLE) AS b2_std_coll_mty_mismatch_amt, CAST(0.5 AS DOUBLE) AS b2_std_gtor_rw_ratio, CAST(NULL AS DOUBLE) AS b2_irb_colltrl_amt_ttc,
        CAST(NULL AS DOUBLE) AS b2_irb_garntee_amt_ttc, CAST(NULL AS DOUBLE) AS sec_discnt_b2_irb_coll_amt_ttc,
        CAST(NULL AS DOUBLE) AS sec_discnt_b2_irb_gtee_amt_ttc, 'DE-BBK' AS reporting_regulator_code
        FROM {{orders}}""",
    "mitigants": f"""SELECT p_partkey AS mitigant_id, 'Y' AS valid_flag, {RUN_MONTH} AS year_month_rk, {RUN_DAY} AS day_rk,
        CASE WHEN p_size % 3 = 0 THEN 'OTH' ELSE 'RMP' END AS sys_code, 'A' AS adjust_flag,
        CASE WHEN p_size % 4 = 0 THEN 'XX' ELSE 'EP' END AS sys_protection_type, p_type AS basel_security_sub_type FROM {{part}}""",
    "mitigant_type": _always(values([(1, "GU"), (2, "CD"), (3, "CO")], "mitigant_type_rk, mitigant_type")),
    "collateral_type": _always(values([(1, "CO"), (2, "LP")], "collateral_type_rk, collateral_type_code")),
    "dpm_parameter": _always(
        values(
            [
                ("DIVISION", "CITIZENS", "Y"),
                ("DIVISION", "DIV0", "Y"),
                ("DIVISION", "DIV1", "Y"),
                ("DIVISION", "DIV3", "Y"),
                ("DIVISION", "DIV4", "N"),
                ("REGULATOR_REP_ENTITY_MAP", "UK-FSA", "GROUP0"),
                ("REGULATOR_REP_ENTITY_MAP", "UK-FSA", "GROUP1"),
                ("REGULATOR_REP_ENTITY_MAP", "CBI", "GROUP0"),
            ],
            "param_code, parameter1_value, parameter2_value",
        )
    ),
    "unit_versions": """SELECT n_nationkey AS unit_rk, CASE WHEN n_nationkey % 9 = 8 THEN NULL ELSE n_name END AS unit_name, n_regionkey AS unit_region,
        DATE '1990-01-01' AS valid_from_date, DATE '2001-08-01' AS valid_to_date FROM {nation}
        UNION ALL SELECT n_nationkey + 1000, CASE WHEN n_nationkey % 9 = 8 THEN NULL ELSE n_name END, n_regionkey, DATE '2001-08-01', DATE '9999-12-31' FROM {nation} WHERE n_nationkey <> 12""",
    # Versions of the dimensions: every key ends on the first of August and has a successor, with gaps.
    "unit_codes": """SELECT CASE n_nationkey WHEN 3 THEN 'NWBDEUAI' WHEN 8 THEN 'NWMDEUAI' WHEN 5 THEN 'ULSTERAI' ELSE 'UNIT' || CAST(n_nationkey AS STRING) END AS code,
        CASE WHEN n_nationkey % 9 = 8 THEN NULL ELSE n_name END AS unit_name, DATE '1990-01-01' AS valid_from_date, DATE '2001-08-01' AS valid_to_date FROM {nation}
        UNION ALL SELECT 'NEW' || CAST(n_nationkey AS STRING), CASE WHEN n_nationkey % 9 = 8 THEN NULL ELSE n_name END, DATE '2001-08-01', DATE '9999-12-31' FROM {nation} WHERE n_nationkey <> 12""",
    "country_versions": """SELECT n_nationkey AS country_rk, CASE WHEN n_nationkey % 9 = 7 THEN NULL ELSE n_name END AS country_name,
        DATE '1990-01-01' AS valid_from_date, DATE '2001-08-01' AS valid_to_date FROM {nation}
        UNION ALL SELECT n_nationkey + 1000, CASE WHEN n_nationkey % 9 = 7 THEN NULL ELSE n_name END, DATE '2001-08-01', DATE '9999-12-31' FROM {nation} WHERE n_nationkey <> 14""",
    "division_versions": """SELECT n_nationkey AS division_rk, n_name AS division_name, n_regionkey AS division_region, DATE '1990-01-01' AS valid_from_date, DATE '2001-08-01' AS valid_to_date FROM {nation}
        UNION ALL SELECT n_nationkey + 1000, n_name, n_regionkey, DATE '2001-08-01', DATE '9999-12-31' FROM {nation} WHERE n_regionkey <> 2""",
    "class_versions": f"""SELECT asset_class_rk, type AS class_type, basel_exposure_type AS class_name, basel_exposure_sub_type AS class_sub_name,
        DATE '1990-01-01' AS valid_from_date, DATE '2001-08-01' AS valid_to_date FROM ({_CLASS_ROWS}) AS a
        UNION ALL SELECT asset_class_rk + 1000, type, basel_exposure_type, basel_exposure_sub_type, DATE '2001-08-01', DATE '9999-12-31' FROM ({_CLASS_ROWS}) AS b WHERE asset_class_rk <> 208""",
    "band_versions": """SELECT band_code, mgs, band_type, valid_from_date, valid_to_date FROM (VALUES ('A', 1, 'MGS', DATE '1990-01-01', DATE '2001-08-01'), ('A2', 1, 'MGS', DATE '2001-08-01', DATE '9999-12-31'),
        ('B', 2, 'MGS', DATE '1990-01-01', DATE '2001-08-01'), ('C', 3, 'MGS', DATE '1990-01-01', DATE '2001-08-01'), ('C2', 3, 'MGS', DATE '2001-08-01', DATE '9999-12-31'),
        ('D', 27, 'MGS', DATE '1990-01-01', DATE '9999-12-31')) AS t(band_code, mgs, band_type, valid_from_date, valid_to_date)""",
    "calendar": """SELECT year_month_rk, year, year_quarter_number, month_end_date FROM (VALUES (200106, 2001, 2, DATE '2001-06-30'), (200107, 2001, 3, DATE '2001-07-31'),
        (200108, 2001, 3, DATE '2001-08-31'), (200109, 2001, 3, DATE '2001-09-30')) AS t(year_month_rk, year, year_quarter_number, month_end_date)""",
    "group_map": f"""SELECT a.n_nationkey AS risk_taker_rru_rk, b.n_nationkey AS risk_on_rru_rk, {RUN_MONTH} AS year_month_rk,
        f.flag AS internal_transaction_flag,
        CASE WHEN a.n_nationkey % 13 = 12 THEN 'UNIT DECON' ELSE 'UNIT' || CAST(a.n_nationkey AS STRING) END AS risk_taker_ll_rru,
        CASE WHEN a.n_nationkey % 11 = 10 THEN NULL ELSE 'GROUP' || CAST(a.n_regionkey % 2 AS STRING) END AS risk_taker_group,
        CASE WHEN f.flag = 'Y' AND a.n_regionkey = b.n_regionkey THEN 'Intra Group' WHEN f.flag = 'Y' THEN 'Inter Group' ELSE 'External' END AS reporting_desc
        FROM {{nation}} AS a CROSS JOIN {{nation}} AS b CROSS JOIN (VALUES ('Y'), ('N')) AS f(flag)""",
    "template_cells": f"""SELECT 7 AS template_rk, r.row_id, c.column_id, {RUN_MONTH} AS year_month_rk, 'UK-FSA' AS reporting_regulator_code,
        CASE WHEN r.row_id = 'R0290' AND c.column_id = 'C0090' THEN 'N' ELSE 'Y' END AS appl_data_point_flag
        FROM (VALUES ('R0010'), ('R0070'), ('R0140'), ('R0280'), ('R0290')) AS r(row_id)
        CROSS JOIN (VALUES ('C0010'), ('C0090'), ('C0200'), ('C0220')) AS c(column_id)""",
    "members": _always(
        values(
            [(1, "UK-FSA"), (1, "CBI"), (2, "GROUP0"), (2, "GROUP1"), (2, "GROUP9"), (4, "OLD")],
            "domain_rk, member_code",
        )
    ),
    "sheets": f"SELECT 3 AS domain_rk, {RUN_MONTH} AS year_month_rk, r.reporting_regulator_code, s.member_code "
    + "FROM (VALUES ('UK-FSA'), ('CBI')) AS r(reporting_regulator_code) "
    + "CROSS JOIN (VALUES ('STD0001'), ('STD0002'), ('STD0009'), ('STD0017')) AS s(member_code)",
    "domains": _always(values([(1, "REG_CODE"), (2, "REP_ENTITY"), (3, "EC_COREP_STD"), (4, "OTHER")], "domain_rk, domain_code")),
    "returns": _always(values([(70, "C 07.00", 7), (80, "C 08.00", 8)], "return_rk, return_code, template_rk")),
    "templates": values([(7, "T7"), (8, "T8")], "template_rk, template_name"),
}
# Copies of a row, one per listed value: a narrow explode in both engines.
SPARK_FAN, ORACLE_FAN = "explode(array", "unnest(list_value"
BASE_TABLES = ("orders", "lineitem", "customer", "nation", "part", "supplier", "region", "events", "documents")


def base_tables(spark: SparkSession, folder: str, text: str) -> dict[str, DataFrame]:
    """The test tables a text mentions."""
    return {n: table(spark, folder, n) for n in BASE_TABLES if "{" + n + "}" in text}


def derive(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """Run a SELECT whose placeholders name test tables."""
    return spark.sql(text.replace("{fan}", SPARK_FAN), **base_tables(spark, folder, text))


# Source rows of the wide inputs and the key their deal is made of.
DEAL_SOURCES = {
    "facts": (_BOOK_JOIN, "o_orderkey"),
    "sub_exposures": ("{lineitem}", "l_orderkey"),
    "sub_exposures_oth": ("{orders}", "o_orderkey"),
}


def derive_by_deal(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An input whose rows lie by deal: the narrow source rows are shuffled, then the wide columns derived."""
    source, key = DEAL_SOURCES[name]
    deal = DEAL_ID.format(k=key)
    rows = derive(spark, folder, f"SELECT *, {deal} AS _deal FROM {source}").repartition("_deal")
    return spark.sql(INPUTS[name].replace(deal, "_deal").replace(source, "{rows}"), rows=rows)


class JobInputs(dict):
    """Inputs by name, each derived when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        self[name] = derive(self.spark, self.folder, INPUTS[name])
        return self[name]

    def by_deal(self) -> ChainMap:
        """The same inputs, the wide ones by deal."""
        return ChainMap({name: derive_by_deal(self.spark, self.folder, name) for name in DEAL_SOURCES}, self)

    def layer(self, name: str, build) -> DataFrame:
        """A derived layer, built when it is first asked for."""
        if name not in self:
            self[name] = build()
        return self[name]


@lru_cache(maxsize=None)
def oracle_inputs(names: tuple[str, ...]) -> str:
    """The same inputs as common table expressions for the oracle."""
    plain = {n: n for n in BASE_TABLES} | {"fan": ORACLE_FAN}
    return ",\n".join(f"{n} AS ({INPUTS[n].format(**plain)})" for n in names)
