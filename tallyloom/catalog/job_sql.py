"""Oracle text of the reporting jobs, written as plain SQL.

Each block is one common table expression; a query chains the blocks it
needs. The text follows the rules as they are described, not the Spark code:
nested CASE, one select per branch, joins in the order of the description.
"""

from __future__ import annotations

from tallyloom.catalog.inputs import oracle_inputs

_RUN = "DATE '2001-08-31'"
_OVERRIDE = "('CITIZENS2001', 'CITIZENS2002', 'CITIZENS2003', 'CITIZENS2001_NC', 'CITIZENS2002_NC', 'CITIZENS2003_NC')"
_DRAWN, _UNDRAWN, _OTC = "('RETAIL', 'ON_BALANCE')", "('UNDRAWN-COMM', 'OFF_BALANCE')", "('BASEL-OTC', 'REPO')"
_ANY = "('UNDRAWN-COMM', 'OFF_BALANCE', 'RETAIL', 'ON_BALANCE')"
_GOV = "Exposures to central governments or central banks"
_SPECIALISED = "('Income Producing Real Estate', 'Project Finance')"
_EU = "('SABFI2OR', 'MUREX2OR', 'MTH_OTH', 'DAY_OTH')"
_UK = "('SABFUKOR', 'MUREUKOR', 'MTH_OTH', 'DAY_OTH')"


def _valid(t: str) -> str:
    return f"{t}.valid_from_date <= {_RUN} AND {t}.valid_to_date > {_RUN}"


def _kept(systems: str, jurisdiction: str | None) -> str:
    own = "" if jurisdiction is None else f"(sys_code IN {systems} AND capital_cuts = '4' AND jurisdiction_flag = '{jurisdiction}') OR "
    blank = "" if jurisdiction is None else " AND (jurisdiction_flag IS NULL OR jurisdiction_flag = '')"
    return f"""(coalesce(aclm_product_type, 'XX') NOT IN {_OTC} OR coalesce({own}(coalesce(sys_code, 'XX') NOT IN {systems}
      AND (capital_cuts IS NULL OR capital_cuts = ''){blank}), false))"""


def _branch(source: str, regulator: str, kept: str, basel: str, extra: str = "TRUE") -> str:
    return f"""SELECT f.* REPLACE ({regulator} AS reporting_regulator_code, coalesce(deal_id_prefix, '') || deal_id AS deal_id, 'A' AS adjust_flag, {basel} AS basel_data_flag),
      f.deal_id AS fact_deal, u.ll_rru AS risk_taker_ll_rru, u.ll_rru_desc AS risk_taker_ll_rru_desc, u.llp_rru
      FROM facts f LEFT JOIN unit u ON f.rru_rk = u.rru_rk AND {_valid('u')} WHERE _source = '{source}' AND {kept} AND {extra}"""


_RAISED = f"CASE WHEN aclm_product_type IN {_OTC} AND sys_code IN {_EU} AND jurisdiction_flag = 'EU' AND capital_cuts = '4' THEN 'Y' ELSE basel_data_flag END"

_ROUTED = "routed AS (" + " UNION ALL ".join(
    [
        _branch("exposures", "'UK-FSA'", _kept(_UK, "UK"), "basel_data_flag"),
        _branch("exposures_dnb", "'NL-DNB'", _kept(_EU, "EU"), _RAISED),
        _branch(
            "exposures_oth",
            "reporting_regulator_code",
            _kept(_EU, None),
            "basel_data_flag",
            "reporting_regulator_code IN ('DE-BBK', 'UK-FSA', 'NL-DNB') AND u.ll_rru IN ('NWBDEUAI', 'NWMDEUAI')",
        ),
        _branch("exposures", "'CBI'", _kept(_EU, "EU"), _RAISED, "u.llp_rru LIKE '%UBIL%'"),
    ]
) + ")"


def _target_sub_class(retail: str) -> str:
    return f"""CASE WHEN d.reg_exposure_type IN ('Central Governments and Central Banks', 'Institutions', 'Non-credit Obligation Assets', 'Equities', 'Securitisation Positions') THEN c.basel_exposure_sub_type
      WHEN d.reg_exposure_type = 'Corporates' AND j.rwa_calc_method = 'AIRB - SL PD/LGD Approach' THEN 'RWA Calc Under AIRB - SL PD/LGD'
      WHEN d.reg_exposure_type = 'Corporates' AND j.rwa_calc_method = 'AIRB - SL Slotting Approach' THEN 'RWA Calc Under AIRB - SL Slotting'
      WHEN {retail} THEN j.corep_irb_exposure_sub_type ELSE d.basel_exposure_sub_type END"""


def _first_class(column: str, retail: str) -> str:
    return f"""(SELECT min(c.{column}) FROM asset_class c WHERE c.type = 'COREP_IRB' AND c.valid_flag = 'Y' AND c.basel_exposure_type = d.basel_exposure_type
      AND c.basel_exposure_sub_type = {_target_sub_class(retail)})"""


_STAGED = f"""cp AS (SELECT * FROM counterparty WHERE snap_dt = (SELECT max(snap_dt) FROM counterparty) AND {_valid('counterparty')}),
dcc AS (SELECT wbu_counterparty_rk, max(le_counterparty_rk) AS le_rk FROM cost_centre WHERE wbu_counterparty_rk <> -1 AND {_valid('cost_centre')} GROUP BY 1),
joined AS (SELECT r.* EXCLUDE (year_month_rk, aclm_product_type, b2_std_ccf, b2_app_rwa_post_crm_amt),
  r.year_month_rk AS year_month, upper(r.aclm_product_type) AS aclm_product_type, coalesce(r.b2_std_ccf, 0) / 100 AS b2_std_ccf_input,
  dac.type AS dac_type, dac.valid_flag AS dac_valid_flag, dac.asset_class_rk AS dac_asset_class_rk, dac.reg_exposure_type AS b2_irb_asset_class_reg_exposure_type,
  dac.reg_exposure_sub_type AS b2_irb_asset_class_reg_exposure_sub_type, dac.basel_exposure_type AS b2_irb_asset_class_basel_exposure_type, dac.basel_exposure_sub_type AS b2_irb_asset_class_basel_exposure_sub_type,
  dac5.basel_exposure_type AS b2_std_asset_class_basel_exposure_type, dac5.basel_exposure_type AS memo_b2_std_basel_exposure_type, dac5.basel_exposure_type AS b2_std_basel_exposure_type,
  dac5.basel_exposure_sub_type AS memo_b2_std_basel_exposure_sub_type, dac5.type AS memo_b2_std_type, dac5.reg_exposure_type AS memo_b2_std_reg_exposure_type,
  dac5.basel_exposure_sub_type AS b2_std_asset_class_basel_exposure_sub_type, dac4.basel_exposure_type AS b2_std_pre_dflt_asset_class_basel_exposure_type,
  dac4.basel_exposure_sub_type AS b2_std_pre_dflt_asset_class_basel_exposure_sub_type, dac4.reg_exposure_type AS b2_std_pre_dflt_asset_class_reg_exposure_type, dac4.type AS b2_std_pre_dflt_asset_class_type,
  rec.b2_std_ccf_less_than_year, rec.b2_std_ccf_more_than_year, incorp.p3_country_desc AS incorp_country_desc, op.p3_country_desc AS op_country_desc, u2.ll_rru_desc AS risk_on_ll_rru_desc, div.sub2 AS division_sub2, div.division, m1.model_code AS pd_model_code, m2.model_code AS ead_model_code,
  dprod.aiml_product_type, dprod.regulatory_product_type, u2.ll_rru AS risk_on_ll_rru, incorp.p3_country_desc AS incorp_p3_country_desc, op.p3_country_desc AS op_p3_country_desc,
  coalesce(incorp.p3_country_desc, 'Unknown Geographic Area') AS corep_incorp_p3_country_desc, coalesce(incorp.country_desc, 'Unknown Geographic Area') AS corep_incorp_country_desc,
  gl.bspl_900_gl_code, gl.bspl_60_gl_code, glm.ias39_class, ind.sector_type, ind.sector_cluster, ind.sub_sector, dind.sector_type AS industry_sector_type,
  CASE WHEN dind.uk_sic_code = 'UNKNOWN' THEN NULL ELSE dind.uk_sic_code END AS ec92_code, fc.bsd_marker,
  own.cis_code AS external_counterparty_id_temp, own.qccp AS external_counterparty_qccp_flag, own.sys_id AS csys_id, own.sys_code AS csys_code, own.fi_avc_category,
  parent.cis_code AS branch_ciscode, cc.cost_centre, cc.cost_centre_type, le.cis_code AS le, rul.rule_desc, rec.mortgages_flag, mat.maturity_band_desc, pdb.mgs AS dim_mgs, pdb.pd_band_code AS dim_pd_band_code,
  cat2.corep_product_category AS corep_exposure_category,
  CASE WHEN cat.corep_product_category_rk = -1 THEN 'UNKNOWN' ELSE cat.corep_product_category END AS corep_product_category,
  CASE WHEN div.sub2 IN {_OVERRIDE} THEN 'Y' ELSE 'N' END AS citizens_override_flag,
  'N' AS crd4_rep_stdflow_flag, 'EXPOSURE' AS flow_type,
  CASE WHEN div.sub2 IN {_OVERRIDE} THEN coalesce(r.b2_std_ead_post_crm_amt, 0) ELSE coalesce(r.b2_app_ead_post_crm_amt, 0) END AS ead_post_crm_amt,
  CASE WHEN r._source = 'exposures_dnb' THEN CASE WHEN m1.model_code = 'LC' OR (dac.reg_exposure_sub_type IN {_SPECIALISED} AND dac.basel_exposure_type = 'Corporate') THEN r.b2_irb_rwa_post_crm_amt ELSE r.b2_std_rwa_post_crm_amt END
    ELSE r.b2_app_rwa_post_crm_amt END AS b2_app_rwa_post_crm_amt,
  CASE WHEN coalesce(r.sys_code, 'X') NOT IN ('ACBCNTNW', 'ACBCNTRB', 'LNIQNWTR', 'LNIQRBTR') THEN coalesce(r.gross_dep_utilisation_amt, 0) - coalesce(r.net_dep_utilisation_amt, 0) ELSE 0 END AS b2_std_netted_coll_gbp,
  CASE WHEN r.reporting_type_code = 'NC' AND dac5.basel_exposure_type NOT IN ('Equity Claims', '{_GOV}') THEN 'Other items' ELSE dac5.basel_exposure_type END AS corep_std_basel_exposure_type,
  CASE WHEN r.reporting_type_code = 'NC' AND dac5.basel_exposure_type NOT IN ('Equity Claims', '{_GOV}') THEN 214 ELSE r.b2_std_asset_class_rk END AS corep_std_asset_class_rk,
  CASE WHEN dac3.basel_exposure_type = 'Retail' AND dac3.basel_exposure_sub_type = 'N/A' THEN CASE WHEN r.qual_rev_exp_flag = 'Y' THEN 'Qualifying Revolving Exposures' ELSE
    CASE WHEN r.comm_real_estate_sec_flag = 'Y' OR rec.mortgages_flag = 'Y' THEN CASE WHEN r.pers_acc_flag = 'N' THEN 'Secured by Real Estate Property - SME' ELSE 'Secured by Real Estate Property - Non-SME' END
    ELSE CASE WHEN r.pers_acc_flag = 'N' THEN 'Other Retail Exposures - SME' ELSE 'Other Retail Exposures - Non-SME' END END END ELSE dac3.basel_exposure_sub_type END AS corep_irb_exposure_sub_type,
  CASE WHEN r.reporting_regulator_code = 'CBI' AND r.b2_app_adjusted_pd_ratio = 1 AND dac.reg_exposure_sub_type = 'Income Producing Real Estate' AND dac.basel_exposure_type = 'Corporate' AND r.definitive_slot_category_calc = 'N' THEN 'AIRB - SL PD/LGD Approach'
    WHEN dprod.regulatory_product_type = 'PR_EQ_CIU' THEN 'AIRB - Equity Simple Risk Weight' WHEN m1.model_code = 'SRW' THEN 'AIRB - Equity Simple Risk Weight' WHEN m1.model_code = 'SG' THEN 'AIRB - SL PD/LGD Approach'
    WHEN dac.reg_exposure_type = 'Corporates' AND dac.reg_exposure_sub_type IN ('Object Finance', 'Commodities Finance') THEN 'AIRB - SL PD/LGD Approach'
    WHEN dac.reg_exposure_type = 'Corporates' AND dac.reg_exposure_sub_type IN {_SPECIALISED} THEN 'AIRB - SL Slotting Approach' ELSE 'AIRB - PD/LGD Approach' END AS rwa_calc_method,
  coalesce(r.ifrs9_prov_write_off_amt_gbp, 0) AS imp_write_off_amt, CASE WHEN r.b3_cva_cc_rwa_amt IS NOT NULL THEN 'Y' ELSE 'N' END AS crd4_rep_cva_flag,
  CASE WHEN r.reporting_type_code = 'SR' THEN 'Y' ELSE 'N' END AS crd4_rep_settl_flag,
  CASE WHEN own.cis_code = 'Z6VR0IT' OR r.deal_id LIKE 'AR2956%' THEN 'OTHER' ELSE 'IFRS9' END AS rep_provision_type,
  CASE WHEN cat2.aclm_product_type = 'NCA' AND contains(r.deal_id, '_SI') THEN 'SI' WHEN cat2.aclm_product_type = 'NCA' AND contains(r.deal_id, '_DTA') THEN 'DT' WHEN cat2.aclm_product_type = 'NCA' AND contains(r.deal_id, '_NSI') THEN 'NSI' END AS deal_type,
  CASE WHEN r.approved_approach_code = 'STD' THEN r.b3_sme_discount_flag END AS std_sme_discount_app_flag,
  coalesce(CASE WHEN wbu.counterparty_rk = -1 THEN NULL ELSE wbu.counterparty_rk END, CASE WHEN parent.counterparty_rk = -1 THEN NULL ELSE parent.counterparty_rk END, CASE WHEN own.counterparty_rk = -1 THEN NULL ELSE own.counterparty_rk END, -1) AS ler_child_counterparty,
  CASE WHEN coalesce(r.b2_app_ead_post_crm_amt, 0) = 0 THEN 'NULL EAD' ELSE CASE WHEN r.counterparty_rk = -1 THEN 'RETAIL' ELSE 'CORP' END END AS obligor_type,
  200001 AS v_icb_eff_from_year_month_rk, 200103 AS v_core_ig_eff_year_month_rk, CAST(0.75 AS DOUBLE) AS v_infra_discount_factor, r.rru_rk AS risk_taker_rru, r.risk_on_rru_rk AS risk_on_rru
  FROM routed r
  LEFT JOIN exposures_rec rec ON r.fact_deal = rec.deal_id
  LEFT JOIN counterparties fc ON r.counterparty_rk = fc.counterparty_rk
  LEFT JOIN industry dind ON fc.ec92_industry_rk = dind.industry_rk
  LEFT JOIN asset_class dac ON r.b2_irb_asset_class_rk = dac.asset_class_rk LEFT JOIN asset_class dac3 ON r.corep_asset_class_rk = dac3.asset_class_rk
  LEFT JOIN asset_class dac4 ON r.b2_std_pre_dflt_asset_class_rk = dac4.asset_class_rk LEFT JOIN asset_class dac5 ON r.b2_std_asset_class_rk = dac5.asset_class_rk
  LEFT JOIN division div ON r.division_rk = div.division_rk LEFT JOIN model m1 ON r.pd_model_rk = m1.model_rk LEFT JOIN model m2 ON r.ead_model_rk = m2.model_rk
  LEFT JOIN product dprod ON r.product_rk = dprod.product_rk LEFT JOIN unit u2 ON r.risk_on_rru_rk = u2.rru_rk
  LEFT JOIN cp own ON r.counterparty_rk = own.counterparty_rk LEFT JOIN dcc ON own.counterparty_rk = dcc.wbu_counterparty_rk
  LEFT JOIN cp wbu ON wbu.counterparty_rk = dcc.le_rk AND wbu.group_internal_flag = 'Y' LEFT JOIN cp parent ON parent.counterparty_rk = fc.branch_parent_counterparty_rk
  LEFT JOIN country incorp ON r.incorp_country_rk = incorp.country_rk LEFT JOIN country op ON r.op_country_rk = op.country_rk
  LEFT JOIN cost_centre cc ON r.cost_centre_rk = cc.cost_centre_rk AND cc.valid_flag = 'Y' LEFT JOIN cp le ON cc.le_counterparty_rk = le.counterparty_rk
  LEFT JOIN ledger gl ON r.gl_account_rk = gl.gl_rk LEFT JOIN ledger_map glm ON gl.bspl_800_gl_code = glm.bspl800_code
  LEFT JOIN product_category cat ON (CASE WHEN upper(r.aclm_product_type) = 'N/A' THEN 'UNKNOWN' ELSE upper(r.aclm_product_type) END) = cat.aclm_product_type
  LEFT JOIN product_category cat2 ON r.corep_product_category_rk = cat2.corep_product_category_rk
  LEFT JOIN industry ind ON r.industry_rk = ind.industry_rk LEFT JOIN rule rul ON r.std_rw_priority_order_rule_rk = rul.rule_rk
  LEFT JOIN maturity_band mat ON mat.type = 'S' AND ((r.b2_irb_effective_maturity_yrs > mat.lower_value AND r.b2_irb_effective_maturity_yrs < mat.upper_value)
    OR (r.b2_irb_effective_maturity_yrs = mat.lower_value AND mat.lower_val_inclusive = 'Y') OR (r.b2_irb_effective_maturity_yrs = mat.upper_value AND mat.upper_val_inclusive = 'Y'))
  LEFT JOIN pd_band pdb ON pdb.type = 'MGS' AND ((coalesce(r.b2_app_adjusted_pd_ratio, 0.02501) > pdb.lower_value AND coalesce(r.b2_app_adjusted_pd_ratio, 0.02501) < pdb.upper_value)
    OR (coalesce(r.b2_app_adjusted_pd_ratio, 0.02501) = pdb.lower_value AND pdb.lower_val_inclusive = 'Y') OR (coalesce(r.b2_app_adjusted_pd_ratio, 0.02501) = pdb.upper_value AND pdb.upper_val_inclusive = 'Y'))),
staged AS (SELECT j.*, ch.risk_entity_class AS dim_ctrpty_risk_entity_class, ov.override_value,
  coalesce({_first_class('asset_class_rk', "d.reg_exposure_type = 'Retail'")}, -1) AS corep_irb_asset_class_rk,
  {_first_class('reg_exposure_type', "j.type = 'RET'")} AS crd4_rep_irbeq_reg_exposure_type
  FROM joined j JOIN asset_class d ON j.b2_irb_asset_class_rk = d.asset_class_rk
  LEFT JOIN cp ch ON j.ler_child_counterparty = ch.counterparty_rk
  LEFT JOIN override ov ON ov.overridden_value = ch.cis_code AND ov.override_rule = 'EXC_IG_CIS' AND ov.override_reason = 'CIS EXCLUSION')"""

STAGING_INPUTS = (
    "facts", "exposures_rec", "counterparties", "counterparty", "unit", "division", "country", "asset_class", "model", "product",
    "industry", "cost_centre", "ledger", "ledger_map", "product_category", "rule", "maturity_band", "pd_band", "override",
)
SUB_INPUTS = ("sub_exposures", "sub_exposures_oth", "mitigants", "mitigant_type", "collateral_type")

_T2 = """SELECT s.* EXCLUDE (year_month_rk, b2_std_eff_gtee_amt, b2_std_eff_cds_amt{drop}), s.year_month_rk AS year_month, m.sys_code, m.adjust_flag, m.sys_protection_type, m.basel_security_sub_type,
  t.mitigant_type, c.collateral_type_code, coalesce(s.b2_std_eff_gtee_amt, 0) AS b2_std_eff_gtee_amt, coalesce(s.b2_std_eff_cds_amt, 0) AS b2_std_eff_cds_amt,
  coalesce(p.b2_std_asset_class_rk, -1) AS corep_std_asset_class_rk, 'INFLOW' AS flow_type, {regulator} AS reporting_regulator_code
  FROM {source} s JOIN mitigants m ON s.mitigant_id = m.mitigant_id JOIN mitigant_type t ON s.mitigant_type_rk = t.mitigant_type_rk
  LEFT JOIN collateral_type c ON s.collateral_type_rk = c.collateral_type_rk LEFT JOIN counterparties p ON s.provider_counterparty_rk = p.counterparty_rk"""
_SUBS = (
    "t2 AS ("
    + _T2.format(source="sub_exposures", regulator="'UK-FSA'", drop="")
    + " UNION ALL BY NAME "
    + _T2.format(source="sub_exposures_oth", regulator="'DE-BBK'", drop=", reporting_regulator_code")
    + "),\nsubs AS (SELECT * FROM t2 UNION ALL BY NAME SELECT t2.* REPLACE (x.code AS reporting_regulator_code) FROM t2 CROSS JOIN (VALUES ('DE-BBK'), ('NL-DNB'), ('CBI')) AS x(code) WHERE t2.reporting_regulator_code = 'UK-FSA')"
)

_ZERO = (
    "b2_app_ead_post_crm_amt", "ifrs9_tot_regu_ecl_amt_gbp", "provision_amount_gbp", "b3_cva_provision_amt", "b2_std_rwa_post_crm_amt",
    "b2_app_rwa_post_crm_amt", "b2_std_drawn_rwa", "b2_std_undrawn_rwa", "b2_irb_undrawn_rwa", "b2_app_adjusted_pd_ratio", "b2_app_adjusted_lgd_ratio",
    "b2_irb_drawn_ead", "b2_irb_undrawn_ead", "off_bal_led_exp_gbp_post_sec", "undrawn_commitment_amt_pst_sec", "off_balance_exposure",
    "undrawn_commitment_amt", "b2_irb_effective_maturity_yrs", "b2_irb_drawn_expected_loss", "b2_app_expected_loss_amt", "unsettled_price_difference_amt",
)
_EMPTY = (
    "b2_irb_asset_class_reg_exposure_sub_type", "approved_approach_code", "b2_std_asset_class_basel_exposure_type", "reporting_type_code",
    "aclm_product_type", "bank_base_role_code",
)
_PIN = (
    "pin AS (SELECT staged.* REPLACE ("
    + ", ".join(f"coalesce(staged.{c}, 0) AS {c}" for c in _ZERO)
    + ", "
    + ", ".join(f"coalesce(staged.{c}, '') AS {c}" for c in _EMPTY)
    + """, coalesce(corep_product_category, 'UNKNOWN') AS corep_product_category, coalesce(retail_off_bal_sheet_flag, 'X') AS retail_off_bal_sheet_flag),
  h.rwa_approach_code AS q_approach, h.memo_b2_std_basel_exposure_type AS q_class, h.b2_app_adjusted_pd_ratio AS q_pd
  FROM staged LEFT JOIN history h ON h.year_month = 200106 AND h.reporting_regulator_code = staged.reporting_regulator_code AND h.deal_id = staged.deal_id)"""
)


def _name_map(c: str) -> str:
    return f"""CASE {c} WHEN 'Equities' THEN 'Equity Claims' WHEN 'Central Governments and Central Banks' THEN '{_GOV}' WHEN 'Corporates' THEN 'Exposures to corporates'
      WHEN 'Institutions' THEN 'Exposures to institutions' WHEN 'Non-credit Obligation Assets' THEN 'Other items' WHEN 'Retail' THEN 'Retail exposures' ELSE {c} END"""


_EFFECTIVE = f"(CASE WHEN division_sub2 IN {_OVERRIDE} THEN 'STD' ELSE approved_approach_code END)"
_TG, _OG, _TS, _OS = "upper(risk_taker_group_structure)", "upper(risk_on_group_structure)", "upper(risk_taker_gs_code)", "upper(risk_on_gs_code)"

_PA = f"""pa AS (SELECT pin.*,
  CASE WHEN reporting_regulator_code = 'UK-FSA' THEN CASE WHEN division_sub2 IN {_OVERRIDE} THEN 'STD' ELSE approved_approach_code END
    WHEN reporting_regulator_code = 'NL-DNB' THEN CASE WHEN pd_model_code = 'LC' OR (b2_irb_asset_class_reg_exposure_sub_type IN {_SPECIALISED} AND b2_irb_asset_class_basel_exposure_type = 'Corporate') THEN 'AIRB' ELSE 'STD' END
    ELSE approved_approach_code END AS rwa_approach_code,
  CASE WHEN reporting_type_code = 'NC' AND coalesce(b2_std_asset_class_basel_exposure_type, '') NOT IN ('Equity Claims', '{_GOV}') THEN 'Other items' ELSE b2_std_asset_class_basel_exposure_type END AS corep_std_asset_class_basel_exposure_type,
  CASE WHEN b2_std_asset_class_basel_exposure_type = 'Exposures in default' AND coalesce(b2_std_pre_dflt_asset_class_basel_exposure_type, '') NOT IN ('Exposures Secured by Immovable Property', 'N/A')
    THEN b2_std_pre_dflt_asset_class_basel_exposure_type ELSE b2_irb_asset_class_reg_exposure_type END AS crd4_memo_items_exposure_type,
  CASE WHEN q_approach = 'STD' AND q_class = 'Exposures in default' THEN 'Y' ELSE 'N' END AS std_pre_dflt, CASE WHEN q_approach = 'AIRB' AND q_pd = 1 THEN 'Y' ELSE 'N' END AS airb_pre_dflt,
  CASE WHEN year_month < v_icb_eff_from_year_month_rk THEN
      CASE WHEN {_TG} IS NULL OR {_OG} IS NULL OR ({_TG} = 'UKIG' AND {_OG} IN ('WIG', 'NIG')) OR ({_TG} = 'WIG' AND {_OG} = 'NIG') THEN 'N' ELSE 'Y' END
    ELSE CASE WHEN {_OS} = 'CONNECTEDC_XREF' THEN 'N' WHEN {_TS} IS NULL OR {_OS} IS NULL OR risk_taker_ll_rru IS NULL THEN 'N'
      WHEN ({_TS} = 'CORE' AND {_OS} = 'NONCORE') OR ({_TS} = 'CORE' AND {_OS} = 'CONNECTEDC') OR ({_TS} = 'NONCORE' AND {_OS} = 'CONNECTEDC') OR ({_TS} = 'CONNECTEDC' AND {_OS} = 'CONNECTEDC')
        OR upper(risk_taker_ll_rru) = 'ULSTERAI' OR (year_month >= v_core_ig_eff_year_month_rk AND {_TS} = 'CORE' AND {_OS} = 'CORE') THEN 'N' ELSE 'Y' END END AS temp_flag,
  CASE WHEN reporting_regulator_code IN ('CBI', 'NL-DNB') THEN 'N' WHEN upper(internal_transaction_flag) = 'Y' THEN
    CASE WHEN upper(override_value) = 'Y' OR (dim_ctrpty_risk_entity_class IS NOT NULL AND dim_ctrpty_risk_entity_class NOT IN ('Bank', 'Corporate')) OR temp_flag = 'Y' THEN 'Y' ELSE 'N' END ELSE '' END AS ig_exclusion_flag,
  CASE WHEN rwa_approach_code = 'AIRB' THEN 0 ELSE b2_std_risk_weight_ratio END AS std_risk_weight_ratio,
  CASE WHEN rwa_approach_code = 'STD' AND corep_std_asset_class_basel_exposure_type <> 'Items representing securitisation positions' AND basel_data_flag = 'Y' THEN 'Y' ELSE 'N' END AS crd4_rep_std_flag,
  CASE WHEN rwa_approach_code = 'AIRB' AND crd4_rep_irbeq_reg_exposure_type = 'Equities' AND basel_data_flag = 'Y' THEN 'Y' ELSE 'N' END AS crd4_rep_irbeq_flag,
  CASE WHEN b2_irb_asset_class_reg_exposure_type IN ('Central Governments and Central Banks', 'Institutions', 'Non-credit Obligation Assets', 'Equities', 'Securitisation Positions') THEN b2_irb_asset_class_basel_exposure_sub_type
    WHEN b2_irb_asset_class_reg_exposure_type = 'Corporates' AND rwa_calc_method = 'AIRB - SL PD/LGD Approach' THEN 'RWA Calc Under AIRB - SL PD/LGD'
    WHEN b2_irb_asset_class_reg_exposure_type = 'Corporates' AND rwa_calc_method = 'AIRB - SL Slotting Approach' THEN 'RWA Calc Under AIRB - SL Slotting'
    WHEN b2_irb_asset_class_reg_exposure_type = 'RET' THEN corep_irb_exposure_sub_type ELSE b2_irb_asset_class_basel_exposure_sub_type END AS derived_class,
  CASE WHEN rwa_approach_code = 'AIRB' AND basel_data_flag = 'Y' AND NOT (b2_irb_asset_class_basel_exposure_sub_type IS NOT DISTINCT FROM derived_class AND coalesce(dac_type, '') = 'COREP_IRB' AND coalesce(dac_valid_flag, '') = 'Y'
    AND coalesce(b2_irb_asset_class_reg_exposure_type, 'XXXX') IN ('Equities', 'Non-credit Obligation Assets', 'Securitisation Positions')) THEN 'Y' ELSE 'N' END AS crd4_rep_irb_flag,
  CASE regulatory_product_type WHEN 'PR_DFP_ESTAR' THEN 'P' WHEN 'PR_DFC_ESTAR' THEN 'C' ELSE 'N' END AS default_fund_contrib_indicator,
  CASE WHEN fi_avc_category IN ('1', '2') THEN 'Y' ELSE 'N' END AS lrfe_ufe_flag,
  CASE WHEN b2_irb_asset_class_reg_exposure_sub_type IN ('Corporates with turnover < Eur 50M', 'Retail SME') THEN 'Y' ELSE 'N' END AS sme_flag,
  coalesce(external_counterparty_qccp_flag, '') AS qccp_flag,
  CASE WHEN residual_maturity_days IS NULL THEN '' WHEN residual_maturity_days < 913 THEN '< 2.5 YEARS' ELSE '>= 2.5 YEARS' END AS slotting_residual_maturity,
  CASE WHEN reporting_type_code NOT IN ('MR', 'OR', 'SR', 'NC') AND aclm_product_type NOT IN {_OTC} THEN 'CRD' WHEN aclm_product_type IN {_OTC} AND reporting_type_code NOT IN ('MR', 'OR', 'NC') THEN 'CCR'
    WHEN reporting_type_code = 'NC' THEN 'NCA' WHEN reporting_type_code = 'OR' THEN 'OP' WHEN reporting_type_code = 'MR' AND aclm_product_type IN ('CADII', 'SPEC') THEN 'MAR' ELSE '' END AS risk_type,
  CASE WHEN (ec92_code IN ('G', 'H') AND bsd_marker IN ('Q', 'P', 'S')) OR (ec92_code = 'J' AND bsd_marker = 'C') THEN 'General Government'
    WHEN external_counterparty_id_temp = 'UnKnown' AND sector_cluster IN ('Sovereigns &', ' Quasi Sovereigns') AND sub_sector IN ('Local Authorities', 'Other public bodies', 'Central Government') THEN 'General Government' ELSE 'Others' END AS c33_exposure_sector,
  CASE WHEN obligor_type = 'RETAIL' THEN coalesce(obligors_count, 0) ELSE 0 END AS retail_obligor_count,
  CASE WHEN {_EFFECTIVE} = 'AIRB' AND coalesce(dim_pd_band_code, '') <> '' THEN dim_pd_band_code ELSE '-1' END AS pd_band_code,
  CASE WHEN {_EFFECTIVE} = 'AIRB' AND coalesce(dim_mgs, 0) <> 0 THEN dim_mgs ELSE -1 END AS mgs,
  CASE WHEN external_counterparty_id_temp IS NULL THEN coalesce(csys_id, '') || '_' || coalesce(csys_code, '') ELSE external_counterparty_id_temp END AS external_counterparty_id,
  CASE WHEN memo_b2_std_type = 'B2_STD' THEN {_name_map("coalesce(crd4_memo_items_exposure_type, '')")} ELSE 'N/A' END AS crd4_memo_items_asset_class_basel_exposure_type,
  CASE WHEN memo_b2_std_type = 'B2_STD' THEN memo_b2_std_reg_exposure_type END AS crd4_memo_items_asset_class_reg_exposure_type,
  CASE WHEN memo_b2_std_type = 'B2_STD' THEN memo_b2_std_basel_exposure_sub_type ELSE 'N/A' END AS crd4_memo_items_asset_class_basel_exposure_sub_type,
  {_name_map('memo_b2_std_basel_exposure_type')} AS crd4_memo_basel_exposure_type,
  CASE WHEN external_counterparty_id_temp IS NULL OR external_counterparty_id_temp = 'UnKnown' THEN 'N' WHEN approved_approach_code = 'AIRB' AND b2_app_adjusted_pd_ratio = 1 AND airb_pre_dflt <> 'Y' THEN 'Y' ELSE 'N' END AS b2_irb_obsrvd_new_default_flag,
  CASE WHEN external_counterparty_id_temp = 'UnKnown' THEN 'N' WHEN approved_approach_code = 'STD' AND b2_irb_asset_class_basel_exposure_type = 'Exposures in default' AND std_pre_dflt <> 'Y' THEN 'Y' ELSE 'N' END AS b2_std_obsrvd_new_default_flag
  FROM pin)"""

_ON, _OFF = "corep_product_category = 'ON BALANCE SHEET'", "corep_product_category = 'OFF BALANCE SHEET'"
_SPLIT = "retail_off_bal_sheet_flag = 'Y'"


def _chosen(a: str, b: str) -> str:
    return f"(CASE WHEN citizens_override_flag = 'Y' THEN coalesce({a}, 0) ELSE coalesce({b}, 0) END)"


def _on_part(a: str, b: str) -> str:
    return f"""CASE WHEN {_ON} AND {_SPLIT} THEN {_chosen(a, b)} * ret_rwa_post_crm_amt_pct WHEN ({_ON} OR aclm_product_type IN ('EQUITY', 'NCA')) AND NOT {_SPLIT} THEN {_chosen(a, b)} ELSE 0 END"""


def _off_part(a: str, b: str) -> str:
    return f"CASE WHEN {_ON} AND {_SPLIT} THEN {_chosen(a, b)} * (1 - ret_rwa_post_crm_amt_pct) WHEN {_OFF} THEN {_chosen(a, b)} ELSE 0 END"


def _irb_on(drawn: str, full: str) -> str:
    return f"CASE WHEN aclm_product_type IN {_DRAWN} AND {_SPLIT} THEN coalesce({drawn}, 0) WHEN aclm_product_type IN ('UNDRAWN-COMM', 'OFF_BALANCE', 'BASEL-OTC', 'REPO') THEN 0 ELSE coalesce({full}, 0) END"


def _irb_off(undrawn: str, full: str) -> str:
    return f"CASE WHEN aclm_product_type IN {_DRAWN} AND {_SPLIT} THEN coalesce({undrawn}, 0) WHEN aclm_product_type IN {_UNDRAWN} THEN coalesce({full}, 0) ELSE 0 END"


_PB = f"""pb AS (SELECT pa.*,
  CASE WHEN external_counterparty_id_temp = 'Z6VROIT' OR contains(deal_id, 'AR2956') THEN ifrs9_tot_regu_ecl_amt_gbp + provision_amount_gbp ELSE ifrs9_tot_regu_ecl_amt_gbp END AS rep_provision_amt_gbp,
  CASE WHEN {_SPLIT} THEN b2_std_drawn_rwa / (CASE WHEN b2_std_drawn_rwa + b2_std_undrawn_rwa = 0 THEN 1 ELSE b2_std_drawn_rwa + b2_std_undrawn_rwa END) ELSE 1 END AS ret_rwa_post_crm_amt_pct,
  {_irb_on('b2_irb_drawn_ead', 'b2_app_ead_post_crm_amt')} AS b2_irb_ead_amt_onbal, {_irb_off('b2_irb_undrawn_ead', 'b2_app_ead_post_crm_amt')} AS b2_irb_ead_amt_ofbal,
  CASE WHEN aclm_product_type IN {_ANY} THEN CASE WHEN bank_base_role_code = 'P' THEN off_bal_led_exp_gbp_post_sec + undrawn_commitment_amt_pst_sec ELSE off_balance_exposure + undrawn_commitment_amt END ELSE 0 END AS irb_orig_exp_pre_conv_ofbal,
  CASE WHEN aclm_product_type IN {_ANY} THEN CASE WHEN bank_base_role_code = 'P' THEN CASE WHEN coalesce(grdw_pool_id, '') <> '' THEN off_bal_led_exp_gbp_post_sec + (comm_less_than_1_year + comm_more_than_1_year) ELSE off_bal_led_exp_gbp_post_sec + undrawn_commitment_amt_pst_sec END
    ELSE CASE WHEN coalesce(grdw_pool_id, '') <> '' THEN off_balance_exposure + (comm_less_than_1_year + comm_more_than_1_year) ELSE off_balance_exposure + undrawn_commitment_amt END END ELSE 0 END AS std_orig_exp_pre_conv_ofbal,
  coalesce(b2_std_orig_exp_pre_con_factor, 0) + CASE WHEN aclm_product_type IN {_OTC} THEN b3_cva_provision_amt ELSE 0 END AS b2_std_orig_exp_pre_con_factor_exp,
  coalesce(rep_provision_amt_gbp, 0) AS b2_irb_provisions_amt, rep_provision_amt_gbp + b3_cva_provision_amt AS b2_std_provisions_amt,
  CASE WHEN corep_product_category IN ('ON BALANCE SHEET', 'N/A', 'UNKNOWN') THEN rep_provision_amt_gbp + b3_cva_provision_amt ELSE 0 END AS b2_std_provisions_amt_onbal,
  CASE WHEN {_OFF} THEN rep_provision_amt_gbp + b3_cva_provision_amt ELSE 0 END AS b2_std_provisions_amt_ofbal,
  {_chosen('b2_std_rwa_post_crm_amt', 'b2_app_rwa_post_crm_amt')} AS rwa_post_crm_amount, {_chosen('b2_std_ead_pre_crm_amt', 'b2_app_ead_pre_crm_amt')} AS ead_pre_crm_amt,
  {_on_part('b2_std_rwa_post_crm_amt', 'b2_app_rwa_post_crm_amt')} AS b2_std_rwa_post_crm_amt_onbal, {_off_part('b2_std_rwa_post_crm_amt', 'b2_app_rwa_post_crm_amt')} AS b2_std_rwa_post_crm_amt_ofbal,
  {_on_part('b2_std_ead_post_crm_amt', 'b2_app_ead_post_crm_amt')} AS b2_std_ead_post_crm_amt_onbal, {_off_part('b2_std_ead_post_crm_amt', 'b2_app_ead_post_crm_amt')} AS b2_std_ead_post_crm_amt_ofbal,
  {_irb_on('b2_irb_drawn_rwa', 'b2_app_rwa_post_crm_amt')} AS b2_irb_rwa_amt_onbal, {_irb_off('b2_irb_undrawn_rwa', 'b2_app_rwa_post_crm_amt')} AS b2_irb_rwa_amt_ofbal,
  {_irb_on('b2_irb_drawn_expected_loss', 'b2_app_expected_loss_amt')} AS b2_irb_el_amt_onbal, {_irb_off('b2_irb_undrawn_expected_loss', 'b2_app_expected_loss_amt')} AS b2_irb_el_amt_ofbal,
  b2_app_adjusted_pd_ratio * b2_app_ead_post_crm_amt AS ead_pd_numerator, b2_app_adjusted_pd_ratio * b2_irb_ead_amt_onbal AS ead_pd_numerator_on, b2_app_adjusted_pd_ratio * b2_irb_ead_amt_ofbal AS ead_pd_numerator_off,
  b2_app_adjusted_lgd_ratio * b2_app_ead_post_crm_amt AS ead_lgd_numerator, b2_app_adjusted_lgd_ratio * b2_irb_ead_amt_onbal AS ead_lgd_numerator_on, b2_app_adjusted_lgd_ratio * b2_irb_ead_amt_ofbal AS ead_lgd_numerator_off,
  b2_irb_effective_maturity_yrs * b2_app_ead_post_crm_amt AS ead_mat_years_numerator, b2_irb_effective_maturity_yrs * b2_irb_ead_amt_onbal AS ead_mat_years_numerator_on, b2_irb_effective_maturity_yrs * b2_irb_ead_amt_ofbal AS ead_mat_years_numerator_off,
  CASE WHEN {_ON} THEN b2_std_orig_exp_pre_con_factor_exp - std_orig_exp_pre_conv_ofbal ELSE 0 END AS std_orig_exp_pre_conv_onbal,
  (CASE WHEN {_ON} AND {_SPLIT} THEN 1 - ret_rwa_post_crm_amt_pct WHEN {_OFF} THEN 1 ELSE 0 END) * {_chosen('b2_std_ead_post_crm_amt', 'b2_app_ead_post_crm_amt')} AS ccf_part,
  ccf_part / (CASE WHEN undrawn_commitment_amt + off_balance_exposure = 0 THEN 1 ELSE undrawn_commitment_amt + off_balance_exposure END) AS ccf_usage,
  CASE WHEN rwa_approach_code = 'STD' AND ccf_part <> 0 AND b2_std_ccf_input = 0 THEN CASE WHEN ccf_usage < 0.35 THEN 0.2::DOUBLE WHEN ccf_usage <= 0.75 THEN 0.5::DOUBLE ELSE 1::DOUBLE END ELSE b2_std_ccf_input END AS b2_std_ccf,
  (CASE WHEN aclm_product_type = 'NCA' THEN b2_app_ead_post_crm_amt WHEN aclm_product_type IN {_UNDRAWN} THEN 0
    WHEN coalesce(aiml_product_type, '') IN ('Term Loan', 'Revolver Receivable') OR coalesce(cost_centre, '') || coalesce(bspl_900_gl_code, '') IN ('RBSSUBR18013100000', '150005412013100000', 'RBSSUBR04013100000', 'RBSSUBL01013100000', 'RBSSUB110013100000', '150021259013100000') THEN coalesce(net_exposure, 0)
    WHEN bspl_60_gl_code = 'XCONTLIAB' AND abs(off_balance_exposure) > 0 THEN 0 ELSE coalesce(drawn_ledger_balance, 0) END)
  + (CASE approved_approach_code WHEN 'AIRB' THEN coalesce(b2_irb_interest_at_default_gbp, 0) WHEN 'STD' THEN coalesce(accrued_interest_gbp, 0) ELSE 0 END)
  + (CASE WHEN cost_centre IN ('OVERSGMPF', 'OVERS7GMP', 'OVERS7GIB', 'NCOREZUE1', 'NCOREGMP1', 'GREENZUEF', 'GREENCAPP', 'GREENCAPH', 'GREENCHUE', 'OVERS7HMP') AND internal_transaction_flag = 'N' AND basel_data_flag = 'Y' THEN coalesce(e_star_gross_exposure, 0) ELSE 0 END)
  - rep_provision_amt_gbp AS ra_ad_exp,
  CASE WHEN b2_std_ccf = 0 THEN std_orig_exp_pre_conv_ofbal ELSE 0 END AS b2_std_fully_adj_exp_ccf_0
  FROM pa)"""

_WG = "(b2_std_eff_gtee_amt > 0 OR b2_std_eff_cds_amt > 0) AND type = 'WG' AND mitigant_type IN ('GU', 'CD')"
_DD = "double_default_flag = 'Y'"


def _funded(code: str) -> str:
    return f"""CASE WHEN collateral_type_code = '{code}' AND sys_protection_type = 'EP' AND sys_code = 'RMP' AND corep_crm_category = 'OTHER FUNDED CREDIT PROTECTION' AND NOT {_DD}
      THEN CASE WHEN coalesce(sec_discntd_b2_irb_colltrl_amt, 0) <> 0 THEN sec_discntd_b2_irb_colltrl_amt ELSE b2_irb_coll_amt END ELSE 0 END"""


_PC = f"""pcin AS (SELECT subs.* REPLACE (coalesce(corep_crm_category, '') AS corep_crm_category, coalesce(sec_discntd_b2_irb_garntee_amt, 0) AS sec_discntd_b2_irb_garntee_amt,
  coalesce(double_default_flag, 'N') AS double_default_flag, coalesce(b2_irb_gtee_amt, 0) AS b2_irb_gtee_amt, coalesce(b2_irb_coll_amt, 0) AS b2_irb_coll_amt, coalesce(b2_std_fx_haircut, 0) AS b2_std_fx_haircut,
  coalesce(b2_std_elig_coll_amt, 0) AS b2_std_elig_coll_amt, coalesce(b2_std_gtee_cds_rwa, 0) AS b2_std_gtee_cds_rwa) FROM subs),
pc AS (SELECT pcin.*,
  CASE WHEN {_WG} THEN b2_std_gtee_cds_rwa ELSE 0 END AS b2_std_crm_tot_outflow_rwa_indv, CASE WHEN {_WG} THEN b2_std_eff_gtee_amt + b2_std_eff_cds_amt ELSE 0 END AS b2_std_crm_tot_outflow_indv,
  b2_std_gtee_cds_rwa AS b2_std_gtee_cds_rwa_indv,
  CASE WHEN corep_crm_category = 'GUARANTEES' AND NOT {_DD} THEN CASE WHEN sec_discntd_b2_irb_garntee_amt = 0 THEN b2_irb_gtee_amt ELSE sec_discntd_b2_irb_garntee_amt END ELSE 0 END AS b2_irb_crm_ufcp_guar_amt_indv,
  CASE WHEN corep_crm_category = 'CREDIT DERIVATIVES' AND mitigant_type = 'CD' AND NOT {_DD} THEN CASE WHEN sec_discntd_b2_irb_garntee_amt = 0 THEN b2_irb_gtee_amt ELSE sec_discntd_b2_irb_garntee_amt END ELSE 0 END AS b2_irb_crm_ufcp_cred_deriv_amt_indv,
  CASE WHEN corep_crm_category = 'CREDIT DERIVATIVES' AND mitigant_type = 'CD' AND {_DD} THEN b2_irb_gtee_amt ELSE 0 END AS crm_ufcp_cred_deriv_amt_indv,
  CASE WHEN corep_crm_category = 'GUARANTEES' AND {_DD} THEN b2_irb_gtee_amt ELSE 0 END AS crm_ufcp_guar_amt_indv,
  CASE WHEN corep_crm_category = 'ELIGIBLE FINANCIAL COLLATERAL' AND NOT {_DD} THEN b2_irb_coll_amt ELSE 0 END AS crm_fcp_elig_fin_coll_amt_indv,
  CASE WHEN corep_crm_category = 'OTHER FUNDED CREDIT PROTECTION' AND NOT {_DD} THEN CASE WHEN coalesce(sec_discntd_b2_irb_colltrl_amt, 0) <> 0 THEN sec_discntd_b2_irb_colltrl_amt ELSE b2_irb_coll_amt END ELSE 0 END AS b2_irb_crm_fcp_oth_funded_amt_indv,
  CASE WHEN corep_crm_category = 'REAL ESTATE' AND NOT {_DD} THEN b2_irb_coll_amt ELSE 0 END AS crm_fcp_real_estate_amt_indv,
  CASE WHEN corep_crm_category = 'OTHER PHYSICAL COLLATERAL' AND NOT {_DD} THEN b2_irb_coll_amt ELSE 0 END AS b2_irb_crm_fcp_oth_phy_col_amt_indv,
  CASE WHEN corep_crm_category = 'RECEIVABLES' AND NOT {_DD} THEN b2_irb_coll_amt ELSE 0 END AS b2_irb_crm_fcp_receivables_amt_indv,
  CASE WHEN corep_crm_category = 'ELIGIBLE FINANCIAL COLLATERAL' THEN coalesce(b2_std_eff_coll_amt_post_hcut, 0) ELSE 0 END AS b2_std_eff_fin_coll_amt,
  CASE WHEN corep_crm_category = 'OTHER FUNDED CREDIT PROTECTION' THEN coalesce(b2_std_eff_coll_amt_post_hcut, 0) ELSE 0 END AS b2_std_oth_fun_cred_prot_amt_indv,
  b2_std_fx_haircut * b2_std_elig_coll_amt AS b2_std_coll_fx_haircut_amt_indv,
  CASE WHEN corep_crm_category = '' THEN b2_std_eff_gtee_amt + b2_std_eff_cds_amt + coalesce(b2_std_eff_coll_amt_post_hcut, 0) ELSE 0 END AS blank_crm_amt_std_indv,
  CASE WHEN corep_crm_category = '' THEN b2_irb_gtee_amt + b2_irb_coll_amt ELSE 0 END AS blank_crm_amt_irb_indv,
  {_funded('CO')} AS b2_irb_crm_cod_amt, {_funded('LP')} AS b2_irb_crm_lip_amt
  FROM pcin)"""

_SUMS = {
    "b2_std_crm_tot_outflow_rwa_agg": "b2_std_crm_tot_outflow_rwa_indv",
    "b2_std_crm_tot_outflow_agg": "b2_std_crm_tot_outflow_indv",
    "b2_std_gtee_cds_rwa_agg": "b2_std_gtee_cds_rwa_indv",
    "crm_ufcp_cred_deriv_amt_agg": "crm_ufcp_cred_deriv_amt_indv",
    "crm_ufcp_guar_amt_agg": "crm_ufcp_guar_amt_indv",
    "crm_fcp_elig_fin_coll_amt_agg": "crm_fcp_elig_fin_coll_amt_indv",
    "b2_std_eff_gtee_amt_agg": "b2_std_eff_gtee_amt",
    "b2_std_eff_cds_amt_agg": "b2_std_eff_cds_amt",
    "b2_std_coll_volatility_amt_agg": "b2_std_coll_volatility_amt",
    "b2_std_coll_mty_mismatch_amt_agg": "b2_std_coll_mty_mismatch_amt",
    "b2_std_eff_fin_coll_amt_agg": "b2_std_eff_fin_coll_amt",
    "b2_std_coll_fx_haircut_amt_agg": "b2_std_coll_fx_haircut_amt_indv",
    "b2_irb_colltrl_amt_ttc_agg": "b2_irb_colltrl_amt_ttc",
    "b2_irb_garntee_amt_ttc_agg": "b2_irb_garntee_amt_ttc",
    "sec_discnt_b2_irb_coll_amt_ttc_agg": "sec_discnt_b2_irb_coll_amt_ttc",
    "sec_discnt_b2_irb_gtee_amt_ttc_agg": "sec_discnt_b2_irb_gtee_amt_ttc",
    "blank_crm_amt_std_agg": "blank_crm_amt_std_indv",
    "blank_crm_amt_irb_agg": "blank_crm_amt_irb_indv",
    "b2_std_oth_fun_cred_prot_amt": "b2_std_oth_fun_cred_prot_amt_indv",
    "b2_irb_crm_ufcp_cred_deriv_amt": "b2_irb_crm_ufcp_cred_deriv_amt_indv",
    "b2_irb_crm_fcp_oth_funded_amt": "b2_irb_crm_fcp_oth_funded_amt_indv",
    "b2_irb_crm_fcp_oth_phy_col_amt": "b2_irb_crm_fcp_oth_phy_col_amt_indv",
    "b2_irb_crm_fcp_receivables_amt": "b2_irb_crm_fcp_receivables_amt_indv",
    "b2_irb_crm_ufcp_guar_amt": "b2_irb_crm_ufcp_guar_amt_indv",
    "b2_irb_crm_fcp_real_estate_amt": "crm_fcp_real_estate_amt_indv",
}
TOTAL_NAMES = tuple(_SUMS)
_TOTALS = (
    "totals AS (SELECT year_month, reporting_regulator_code, deal_id, "
    + ", ".join(f"sum(coalesce({src}, 0)) AS {out}" for out, src in _SUMS.items())
    + " FROM pc GROUP BY ALL)"
)


def _cap(amount: str, ceiling: str) -> str:
    return f"CASE WHEN coalesce({amount}, 0) > 0 THEN CASE WHEN {ceiling} <= 0 THEN {ceiling} ELSE least({amount}, {ceiling}) END ELSE 0 END"


def _sf(infra: str = "v_infra_discount_factor") -> str:
    return f"""(CASE WHEN crr2_501a_discount_flag = 'Y' THEN CASE WHEN coalesce({infra}, 0) = 0 THEN 1 ELSE {infra} END
      WHEN b3_sme_discount_flag = 'Y' THEN CASE WHEN coalesce(sme_discount_factor, 0) = 0 THEN 1 ELSE sme_discount_factor END ELSE 1 END)"""


def _weight(rwa: str, value: str, factor: str, given: str) -> str:
    return f"""round(CASE WHEN {rwa} = 0 AND {value} = 0 THEN coalesce({given}, 0) WHEN {value} = 0 THEN 9999 WHEN {rwa} / {value} > 9999 THEN 9999
      WHEN {rwa} < 0 AND {value} >= 0 THEN 9999 WHEN {rwa} > 0 AND {value} < 0 THEN 9999
      WHEN ({rwa} / (CASE WHEN rwa_approach_code = 'STD' THEN {factor} ELSE 1 END)) / {value} < 9999 THEN ({rwa} / (CASE WHEN rwa_approach_code = 'STD' THEN {factor} ELSE 1 END)) / {value} ELSE 9999 END, 2)"""


_REPORTED = f"crd4_rep_std_flag = 'Y' AND {_SPLIT} AND {_ON}"
_CCF_STEP = "CASE WHEN {f} IN (0.2, 0.5, 1) THEN {a} / {f} ELSE 0 END"
_NET_OFF = f"b2_std_ead_post_crm_amt_ofbal - CASE WHEN {_OFF} THEN outflow ELSE 0 END"

_PD = f"""pd AS (SELECT pb.*, t.* EXCLUDE (year_month, reporting_regulator_code, deal_id), substring(pb.deal_id, length(coalesce(pb.deal_id_prefix, '')) + 1) AS plain_deal,
  {_cap('b2_std_crm_tot_outflow_rwa_agg', 'rwa_post_crm_amount')} AS b2_std_crm_tot_outflow_rwa, {_cap('b2_std_crm_tot_outflow_agg', 'ead_post_crm_amt')} AS outflow,
  coalesce(crm_fcp_elig_fin_coll_amt_agg, 0) + coalesce(b2_irb_netted_coll_gbp, 0) AS b2_irb_crm_fcp_elg_fin_col_amt, coalesce(crm_ufcp_guar_amt_agg, 0) + coalesce(crm_ufcp_cred_deriv_amt_agg, 0) AS b2_irb_crm_ufcp_double_def_amt,
  ead_post_crm_amt - outflow AS b2_std_exposure_value, {_NET_OFF} AS b2_std_exposure_value_ofbal, b2_std_ead_post_crm_amt_onbal - CASE WHEN {_ON} THEN outflow ELSE 0 END AS b2_std_exposure_value_onbal_expone,
  CASE WHEN b2_std_ccf = 0.5 AND default_fund_contrib_indicator = 'N' THEN ({_NET_OFF}) / 0.5 ELSE 0 END AS b2_std_fully_adj_exp_ccf_50,
  CASE WHEN b2_std_ccf = 0.2 AND default_fund_contrib_indicator = 'N' THEN ({_NET_OFF}) / 0.2 ELSE 0 END AS b2_std_fully_adj_exp_ccf_20,
  CASE WHEN b2_std_ccf = 1 AND default_fund_contrib_indicator = 'N' THEN {_NET_OFF} ELSE 0 END AS b2_std_fully_adj_exp_ccf_100,
  CASE WHEN {_ON} THEN outflow ELSE 0 END AS b2_std_crm_tot_outflow_onbal, CASE WHEN {_OFF} THEN {_CCF_STEP.format(f='b2_std_ccf', a='outflow')} ELSE 0 END AS b2_std_crm_tot_outflow_ofbal,
  CASE WHEN rwa_post_crm_amount <= 0 THEN rwa_post_crm_amount WHEN coalesce(b2_std_gtee_cds_rwa_agg, 0) >= rwa_post_crm_amount THEN rwa_post_crm_amount ELSE coalesce(b2_std_gtee_cds_rwa_agg, 0) END AS b2_std_rwa_amt_expone,
  b2_app_rwa_post_crm_amt - b2_std_crm_tot_outflow_rwa AS b2_std_rwa_amt, b2_std_rwa_post_crm_amt_onbal - CASE WHEN {_ON} THEN b2_std_crm_tot_outflow_rwa ELSE 0 END AS b2_std_rwa_amt_onbal_fur_exp,
  b2_std_rwa_post_crm_amt_ofbal - CASE WHEN {_OFF} THEN b2_std_crm_tot_outflow_rwa ELSE 0 END AS b2_std_rwa_amt_ofbal,
  CASE WHEN {_REPORTED} THEN b2_std_exposure_value - b2_std_exposure_value_ofbal ELSE b2_std_exposure_value_onbal_expone END AS b2_std_exposure_value_onbal,
  CASE WHEN {_REPORTED} THEN b2_std_rwa_amt - b2_std_rwa_amt_ofbal ELSE b2_std_rwa_amt_onbal_fur_exp END AS b2_std_rwa_amt_onbal,
  CASE WHEN {_ON} THEN b2_std_crm_tot_outflow_onbal WHEN {_OFF} THEN b2_std_crm_tot_outflow_ofbal ELSE outflow END AS b2_std_crm_tot_outflow,
  CASE WHEN pb.reporting_regulator_code = 'NL-DNB' AND substring(pb.deal_id, 4, 2) = 'WM' AND aclm_product_type = 'ON_BALANCE' THEN std_orig_exp_pre_conv_onbal - b2_std_exposure_value_onbal ELSE coalesce(b2_std_eff_fin_coll_amt_agg, 0) END AS b2_std_eff_fin_coll_amt,
  coalesce(b2_std_eff_cds_amt_agg, 0) + coalesce(b2_std_eff_gtee_amt_agg, 0) AS protection,
  CASE WHEN protection <> 0 THEN b2_std_eff_cds_amt_agg * b2_std_crm_tot_outflow / protection ELSE 0 END AS b2_std_eff_cds_amt, CASE WHEN protection <> 0 THEN b2_std_eff_gtee_amt_agg * b2_std_crm_tot_outflow / protection ELSE 0 END AS b2_std_eff_gtee_amt,
  b2_std_rwa_amt / {_sf()} AS b2_std_rwa_pre_sprt_amt, b2_std_rwa_amt_onbal / {_sf()} AS b2_std_rwa_pre_sprt_amt_onbal, b2_std_rwa_amt_ofbal / {_sf()} AS b2_std_rwa_pre_sprt_amt_ofbal,
  {_weight('b2_std_rwa_amt', 'b2_std_exposure_value', _sf(), 'std_risk_weight_ratio')} AS std_act_risk_weight
  FROM pb LEFT JOIN totals t ON pb.year_month = t.year_month AND pb.reporting_regulator_code = t.reporting_regulator_code AND substring(pb.deal_id, length(coalesce(pb.deal_id_prefix, '')) + 1) = t.deal_id)"""

_PE = f"""pe AS (SELECT s.deal_id AS sub_deal, d.deal_id, s.year_month, s.reporting_regulator_code, s.mitigant_id, s.mitigant_type, s.corep_crm_category, s.type, s.sys_code, s.corep_std_asset_class_rk, 'INFLOW' AS flow_type, s.sys_protection_type, s.basel_security_sub_type,
  s.b2_std_eff_gtee_amt + s.b2_std_eff_cds_amt AS own, s.b2_std_gtee_cds_rwa, s.b2_std_gtor_rw_ratio, s.b2_irb_crm_cod_amt, s.b2_irb_crm_lip_amt, s.double_default_flag,
  coalesce(d.b2_std_eff_gtee_amt_agg, 0) + coalesce(d.b2_std_eff_cds_amt_agg, 0) AS protection, d.ead_post_crm_amt AS ead, d.outflow, d.corep_product_category, d.b2_std_ccf_input AS factor, d.rwa_approach_code,
  d.rwa_post_crm_amount AS deal_rwa, d.b2_std_gtee_cds_rwa_agg AS rwa_agg, d.b2_std_rwa_amt_expone AS expone, d.crr2_501a_discount_flag, d.b3_sme_discount_flag, d.sme_discount_factor, d.v_infra_discount_factor,
  d.std_risk_weight_ratio, d.b3_sme_rp_flag, d.retail_pool_sme_flag, d.external_counterparty_id, d.regulatory_product_type, d.industry_sector_type, d.sector_type, d.corep_exposure_category, d.b2_app_adjusted_pd_ratio, d.corep_irb_asset_class_rk, d.b2_irb_ccf,
  coalesce(d.risk_taker_rru, -9999999999) AS risk_taker_rru, coalesce(d.risk_on_rru, -9999999999) AS risk_on_rru, coalesce(d.internal_transaction_flag, '') AS internal_transaction_flag, coalesce(d.ig_exclusion_flag, '') AS ig_exclusion_flag,
  coalesce(d.risk_taker_gs_code, '') AS risk_taker_gs_code, coalesce(d.risk_on_gs_code, '') AS risk_on_gs_code, coalesce(d.default_fund_contrib_indicator, '') AS default_fund_contrib_indicator, coalesce(d.basel_data_flag, '') AS basel_data_flag,
  coalesce(d.aclm_product_type, '') AS aclm_product_type, coalesce(d.division, '') AS division,
  CASE WHEN ead <= 0 THEN ead WHEN protection >= ead THEN CASE WHEN protection <> 0 THEN own * ead / protection ELSE 0 END WHEN d.outflow < ead THEN own ELSE 0 END AS b2_std_exposure_value,
  CASE WHEN ead <= 0 THEN ead WHEN protection >= ead THEN ead WHEN d.outflow < ead THEN protection ELSE 0 END AS whole_part,
  CASE WHEN d.corep_product_category = 'ON BALANCE SHEET' THEN whole_part ELSE 0 END AS b2_std_exposure_value_onbal, CASE WHEN d.corep_product_category = 'OFF BALANCE SHEET' THEN whole_part ELSE 0 END AS b2_std_exposure_value_ofbal,
  CASE WHEN d.corep_product_category = 'ON BALANCE SHEET' THEN CASE WHEN deal_rwa <= 0 THEN deal_rwa ELSE least(s.b2_std_gtee_cds_rwa, deal_rwa) END ELSE 0 END AS b2_std_rwa_amt_onbal,
  CASE WHEN d.corep_product_category = 'OFF BALANCE SHEET' THEN CASE WHEN deal_rwa <= 0 THEN deal_rwa WHEN s.b2_std_gtee_cds_rwa >= deal_rwa THEN CASE WHEN coalesce(rwa_agg, 0) = 0 THEN 0 ELSE s.b2_std_gtee_cds_rwa / rwa_agg * deal_rwa END ELSE s.b2_std_gtee_cds_rwa END ELSE 0 END AS b2_std_rwa_amt_ofbal,
  CASE WHEN factor = 0.5 THEN b2_std_exposure_value_ofbal / 0.5 ELSE 0 END AS b2_std_fully_adj_exp_ccf_50, CASE WHEN factor = 0.2 THEN b2_std_exposure_value_ofbal / 0.2 ELSE 0 END AS b2_std_fully_adj_exp_ccf_20, CASE WHEN factor = 1 THEN b2_std_exposure_value_ofbal ELSE 0 END AS b2_std_fully_adj_exp_ccf_100,
  CASE WHEN d.corep_product_category = 'ON BALANCE SHEET' THEN b2_std_exposure_value_onbal WHEN d.corep_product_category = 'OFF BALANCE SHEET' THEN {_CCF_STEP.format(f='factor', a='b2_std_exposure_value_ofbal')} ELSE b2_std_exposure_value END AS b2_std_crm_tot_inflow,
  CASE WHEN d.corep_product_category = 'ON BALANCE SHEET' THEN b2_std_exposure_value_onbal ELSE 0 END AS b2_std_crm_tot_inflow_onbal,
  CASE WHEN d.corep_product_category = 'OFF BALANCE SHEET' THEN {_CCF_STEP.format(f='factor', a='b2_std_exposure_value_ofbal')} ELSE 0 END AS b2_std_crm_tot_inflow_ofbal,
  round(expone, 2) / {_sf('coalesce(d.v_infra_discount_factor, 0.75)')} AS b2_std_rwa_pre_sprt_amt, round(b2_std_rwa_amt_onbal, 2) / {_sf('coalesce(d.v_infra_discount_factor, 0.75)')} AS b2_std_rwa_pre_sprt_amt_onbal,
  round(b2_std_rwa_amt_ofbal, 2) / {_sf('coalesce(d.v_infra_discount_factor, 0.75)')} AS b2_std_rwa_pre_sprt_amt_ofbal,
  {_weight('expone', 'b2_std_exposure_value', _sf('coalesce(d.v_infra_discount_factor, 0.75)'), 's.b2_std_gtor_rw_ratio')} AS std_act_risk_weight
  FROM (SELECT * FROM pc WHERE {_WG}) s JOIN (SELECT * EXCLUDE (b2_std_exposure_value, b2_std_exposure_value_onbal, b2_std_exposure_value_ofbal, b2_std_rwa_amt_onbal, b2_std_rwa_amt_ofbal, protection) FROM pd WHERE rwa_approach_code = 'STD') d
  ON s.year_month = d.year_month AND s.reporting_regulator_code = d.reporting_regulator_code AND s.deal_id = d.plain_deal)"""

_INTERNAL = (
    "b2_irb_crm_ufcp_cred_deriv_amt", "b2_irb_crm_fcp_real_estate_amt", "b2_irb_colltrl_amt_ttc_agg", "b2_irb_crm_fcp_oth_funded_amt",
    "b2_irb_crm_fcp_oth_phy_col_amt", "b2_irb_crm_fcp_receivables_amt", "b2_irb_crm_ufcp_guar_amt", "b2_irb_crm_ufcp_double_def_amt",
)

_MART = f"""flows AS (SELECT pd.* REPLACE ({', '.join(f"CASE WHEN rwa_approach_code IS DISTINCT FROM 'STD' THEN coalesce({c}, 0) ELSE 0 END AS {c}" for c in _INTERNAL)}),
    b2_std_coll_volatility_amt_agg AS b2_std_coll_volatility_amt, b2_std_coll_mty_mismatch_amt_agg AS b2_std_coll_mty_mismatch_amt, b2_std_coll_fx_haircut_amt_agg AS b2_std_coll_fx_haircut_amt,
    CAST(0 AS DOUBLE) AS b2_irb_crm_cod_amt, CAST(0 AS DOUBLE) AS b2_irb_crm_lip_amt, CAST(NULL AS DOUBLE) AS b2_std_crm_tot_inflow FROM pd
  UNION ALL BY NAME SELECT pe.*, 'A' AS adjust_flag, CAST(0 AS DOUBLE) AS b2_irb_provisions_amt, CAST(0 AS DOUBLE) AS b2_std_provisions_amt_onbal, factor AS b2_std_ccf, factor AS b2_std_ccf_input, 'N' AS crd4_rep_std_flag, 'Y' AS crd4_rep_stdflow_flag FROM pe),
mart AS (SELECT flows.* REPLACE ({_irb_on('b2_irb_drawn_rwa', 'b2_app_rwa_post_crm_amt')} AS b2_irb_rwa_amt_onbal),
  CASE WHEN approved_approach_code = 'AIRB' THEN CASE WHEN coalesce(b2_app_ead_post_crm_amt, 0) = 0 THEN 0 ELSE CASE WHEN abs(coalesce(b2_app_rwa_post_crm_amt, 0) / b2_app_ead_post_crm_amt / {_sf()}) > 9999 THEN 9999
    ELSE coalesce(b2_app_rwa_post_crm_amt, 0) / b2_app_ead_post_crm_amt / {_sf()} END END ELSE 0 END AS irb_risk_weight_ratio,
  CASE WHEN corep_exposure_category = 'ON BALANCE SHEET' OR aclm_product_type IN ('EQUITY', 'NCA') THEN coalesce(b2_irb_orig_exp_pre_con_factor, 0) - coalesce(irb_orig_exp_pre_conv_ofbal, 0) ELSE 0 END AS irb_orig_exp_pre_conv_onbal,
  coalesce(rwa_post_crm_amount, 0) / {_sf()} AS rwa_post_crm_pre_sprt_amount, ({_irb_on('b2_irb_drawn_rwa', 'b2_app_rwa_post_crm_amt')}) / {_sf()} AS b2_irb_rwa_pre_sprt_amt_onbal, coalesce(b2_irb_rwa_amt_ofbal, 0) / {_sf()} AS b2_irb_rwa_pre_sprt_amt_ofbal,
  CASE WHEN rwa_approach_code = 'STD' THEN CASE WHEN b2_std_asset_class_basel_exposure_type = '{_GOV}' AND sub_sector = 'Central Government' THEN 'Central governments'
      WHEN b2_std_asset_class_basel_exposure_type = 'Exposures to regional governments or local authorities' AND sub_sector = 'Local Authorities' THEN 'Regional governments or local authorities'
      WHEN b2_std_asset_class_basel_exposure_type = 'Exposures to public sector entities' AND sub_sector = 'Other public bodies' THEN 'Public sector entities'
      WHEN b2_std_asset_class_basel_exposure_type = 'Exposures to international organisations' THEN 'International Organisations' ELSE 'Others' END
    WHEN rwa_approach_code = 'AIRB' THEN CASE WHEN b2_irb_asset_class_reg_exposure_type = 'Central governments and central banks' THEN CASE b2_std_asset_class_basel_exposure_type WHEN '{_GOV}' THEN 'Central governments'
        WHEN 'Exposures to public sector entities' THEN 'Public sector entities [Central governments and central banks]' WHEN 'Exposures to international organisations' THEN 'International Organisations [Central governments and central banks]' ELSE 'Others' END
      WHEN b2_irb_asset_class_reg_exposure_type = 'Institutions' THEN CASE b2_std_asset_class_basel_exposure_type WHEN 'Exposures to regional governments or local authorities' THEN 'Regional governments or local authorities [Institutions]'
        WHEN 'Exposures to public sector entities' THEN 'Public sector entities [Institutions]' ELSE 'Others' END ELSE 'Others' END ELSE 'Others' END AS finrep_counterparty_sector
  FROM flows)"""

BLOCKS = {
    "staged": (_ROUTED, _STAGED),
    "subs": (_SUBS,),
    "pa": (_PIN, _PA),
    "pb": (_PB,),
    "pc": (_PC,),
    "totals": (_TOTALS,),
    "pd": (_PD,),
    "pe": (_PE,),
    "mart": (_MART,),
}
_CHAINS = {
    "staged": ("staged",),
    "subs": ("subs",),
    "pa": ("staged", "pa"),
    "pb": ("staged", "pa", "pb"),
    "pc": ("subs", "pc"),
    "totals": ("subs", "pc", "totals"),
    "pd": ("staged", "pa", "pb", "subs", "pc", "totals", "pd"),
    "pe": ("staged", "pa", "pb", "subs", "pc", "totals", "pd", "pe"),
    "mart": ("staged", "pa", "pb", "subs", "pc", "totals", "pd", "pe", "mart"),
}


def chain(last: str, extra_inputs: tuple[str, ...] = ()) -> str:
    """WITH clause that ends in a block."""
    names = _CHAINS[last]
    inputs: tuple[str, ...] = ()
    if "staged" in names:
        inputs += STAGING_INPUTS + (("history",) if "pa" in names else ())
    if "subs" in names:
        inputs += SUB_INPUTS + (() if "staged" in names else ("counterparties",))
    inputs += tuple(i for i in extra_inputs if i not in inputs)
    return "WITH " + oracle_inputs(inputs) + ",\n" + ",\n".join(t for n in names for t in BLOCKS[n])
