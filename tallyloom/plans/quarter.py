"""Quarter aggregate: new defaults of the quarter, re-keyed and merged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import equals, first_match, z
from tallyloom.functions.periods import quarter_months_from_calendar
from tallyloom.operators.aggregates import group_sum
from tallyloom.operators.joins import rekey, successor_map
from tallyloom.operators.setops import merge_upsert, union_branches

# --- fixed values: keys of the quarter aggregate ----------------------------------
QUARTER_KEYS = (
    "year_month",
    "reporting_regulator_code",
    "risk_taker_ll_rru",
    "sub5",
    "risk_on_ll_rru",
    "corep_irb_asset_class_rk",
    "corep_std_asset_class_rk",
    "corep_prdef_std_asset_class_nk",
    "unsettled_period_code",
    "incorp_iso_code",
    "op_iso_code",
    "dim_mgs",
    "dim_pd_band_code",
    "mgs_pd_band_type",
    "adjust_flag",
    "basel_data_flag",
    "rwa_approach_code",
    "aclm_product_type",
    "default_fund_contrib_indicator",
    "sme_flag",
    "internal_transaction_flag",
    "rwa_calc_method",
    "trading_book_flag",
    "reporting_type_code",
    "crd4_rep_irb_flag",
    "crd4_rep_irbeq_flag",
    "crd4_rep_std_flag",
    "crd4_rep_stdflow_flag",
    "crd4_rep_settl_flag",
    "pers_acc_flag",
    "b3_sme_rp_flag",
    "b3_sme_discount_flag",
    "corep_incorp_country_nk",
    "walker_cost_centre_nk",
    "crd4_memo_items_asset_class_rk",
    "ig_exclusion_flag",
    "retail_pool_sme_flag",
    "sys_code",
    "deal_type",
    "sts_securitisation",
    "sts_sec_qual_cap_trtmnt",
    "sts_sec_approach_code",
    "ifrs9_final_stage",
    "ifrs9_stage_3_type",
    "ifrs9_ecl_currency_code",
    "c33_exposure_sector",
    "finrep_counterparty_sector",
    "ias39_class",
    "rep_provision_type",
    "crr2_501a_discount_flag",
    "mortgages_flag",
    "security_nk_1_2",
    "security_nk_2_2",
)
# Keys the mart holds under another name. The described input layer lacks them
# and the amounts the rules read, so the job starts from rows of the mart.
NAMES_IN_MART = {
    "sub5": "division_rk",
    "corep_prdef_std_asset_class_nk": "b2_std_pre_dflt_asset_class_rk",
    "incorp_iso_code": "incorp_country_rk",
    "op_iso_code": "op_country_rk",
    "corep_incorp_country_nk": "incorp_country_rk",
    "walker_cost_centre_nk": "cost_centre_rk",
    "crd4_memo_items_asset_class_rk": "b2_std_asset_class_rk",
    "security_nk_1_2": "basel_security_sub_type",
    "security_nk_2_2": "sys_protection_type",
}
PD_BAND_TYPE = "MGS"
# The eleven roles that earlier months are re-keyed in, by dimension.
REKEYED_ROLES = {
    "unit": ("risk_taker_ll_rru", "risk_on_ll_rru"),
    "division": ("sub5",),
    "asset_class": (
        "corep_irb_asset_class_rk",
        "corep_std_asset_class_rk",
        "corep_prdef_std_asset_class_nk",
        "crd4_memo_items_asset_class_rk",
    ),
    "country": ("incorp_iso_code", "op_iso_code", "corep_incorp_country_nk"),
    "pd_band": ("dim_pd_band_code",),
}

NEW_DEFAULT_AMOUNTS = ("obsrvd_new_default_exp_amt", "obsrvd_new_default_cr_adj")
# Columns of the mart that the rules of new defaults read.
NEW_DEFAULT_INPUTS = (
    "rwa_approach_code",
    "b2_std_obsrvd_new_default_flag",
    "b2_irb_obsrvd_new_default_flag",
    "b2_std_exposure_value",
    "b2_std_fully_adj_exp_ccf_50",
    "b2_std_fully_adj_exp_ccf_20",
    "b2_std_fully_adj_exp_ccf_0",
    "b2_std_eff_fin_coll_amt",
    "b2_std_netted_coll_gbp",
    "b2_std_crm_tot_inflow",
    "b2_std_crm_tot_outflow",
    "b2_std_provisions_amt",
    "b2_irb_provisions_amt",
    "b2_irb_orig_exp_pre_con_factor",
    "imp_write_off_amt",
)
# Columns of the mart that the whole job reads.
QUARTER_INPUTS = (*[NAMES_IN_MART.get(key, key) for key in QUARTER_KEYS if key != "mgs_pd_band_type"], *NEW_DEFAULT_INPUTS)


def quarter_input(mart: DataFrame) -> DataFrame:
    """Rows of the mart with every key of the quarter under its name."""
    named = {key: F.col(name) for key, name in NAMES_IN_MART.items()}
    return mart.withColumns(named | {"mgs_pd_band_type": F.lit(PD_BAND_TYPE)})


def new_default_exposure() -> Column:
    """Exposure of a new default: before mitigation and provisions, or the original one."""
    standard = (
        z("b2_std_exposure_value")
        + z("b2_std_fully_adj_exp_ccf_50") * 0.5
        + z("b2_std_fully_adj_exp_ccf_20") * 0.8
        + z("b2_std_fully_adj_exp_ccf_0")
        + (z("b2_std_eff_fin_coll_amt") + z("b2_std_netted_coll_gbp"))
        - (z("b2_std_crm_tot_inflow") - z("b2_std_crm_tot_outflow"))
        + z("b2_std_provisions_amt")
    )
    return first_match(
        [
            (equals("rwa_approach_code", K.STD) & equals("b2_std_obsrvd_new_default_flag", "Y"), standard),
            (
                equals("rwa_approach_code", K.AIRB) & equals("b2_irb_obsrvd_new_default_flag", "Y"),
                z("b2_irb_orig_exp_pre_con_factor"),
            ),
        ],
        F.lit(0.0),
    )


def new_default_adjustment() -> Column:
    """Provisions and write-offs by approach."""
    return first_match(
        [
            (equals("rwa_approach_code", K.STD), z("b2_std_provisions_amt") + z("imp_write_off_amt")),
            (equals("rwa_approach_code", K.AIRB), z("b2_irb_provisions_amt") + z("imp_write_off_amt")),
        ],
        F.lit(0.0),
    )


def new_default_rows(rows: DataFrame) -> DataFrame:
    """Rows newly in default under either approach, with both amounts."""
    return rows.where(
        equals("b2_std_obsrvd_new_default_flag", "Y") | equals("b2_irb_obsrvd_new_default_flag", "Y")
    ).withColumns(
        {NEW_DEFAULT_AMOUNTS[0]: new_default_exposure(), NEW_DEFAULT_AMOUNTS[1]: new_default_adjustment()}
    )


def rows_of_quarter(rows: DataFrame, calendar: DataFrame, run_month: int, month: str = "year_month") -> DataFrame:
    """Rows of the run quarter's months: a join to the month list, not a loop per month."""
    months = quarter_months_from_calendar(calendar, run_month).select(F.col("curr_qtr_month").alias("_qm"))
    return rows.join(months, F.col(month) == F.col("_qm"), "left_semi")


def quarter_sums(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return group_sum(new_default_rows(rows), keys, NEW_DEFAULT_AMOUNTS)


def quarter_aggregate(
    rows: DataFrame,
    calendar: DataFrame,
    run_month: int,
    keys: Sequence[str],
    dimensions: Mapping[str, tuple[DataFrame, str, Sequence[str], Mapping[str, str]]],
    date: str,
    month: str = "year_month",
) -> DataFrame:
    """New defaults of the run month plus those of the earlier quarter months, re-keyed.

    ``dimensions`` maps a name to (frame, key column, natural attributes,
    roles); a role maps a key column of the rows to the same column re-keyed.
    """
    in_quarter = rows_of_quarter(rows, calendar, run_month, month)
    sums = quarter_sums(in_quarter, keys)
    current = sums.where(F.col(month) == run_month)
    earlier = sums.where(F.col(month) != run_month)
    for frame, key, natural, roles in dimensions.values():
        default = -1 if dict(frame.dtypes)[key] in ("int", "bigint") else "-1"
        earlier = rekey(earlier, roles, successor_map(frame, key, natural, date), default)
    earlier = earlier.withColumn(month, F.lit(run_month).cast(rows.schema[month].dataType))
    both = union_branches([current.select(*keys, *NEW_DEFAULT_AMOUNTS), earlier.select(*keys, *NEW_DEFAULT_AMOUNTS)])
    return group_sum(both, keys, NEW_DEFAULT_AMOUNTS)


def merge_quarter(target: DataFrame, quarter: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Write the quarter's amounts onto the target: update, insert, keep."""
    return merge_upsert(target, quarter, keys, NEW_DEFAULT_AMOUNTS)
