"""Rule pack D: exposure values after mitigation, support factors, risk weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import (
    amount_if,
    equals,
    first_match,
    limited_to,
    pick,
    pro_rata,
    support_divisor,
    z,
)


def _on_balance() -> Column:
    return equals("corep_product_category", K.ON)


def _off_balance() -> Column:
    return equals("corep_product_category", K.OFF)


def support_factor() -> Column:
    return support_divisor(
        "crr2_501a_discount_flag", "v_infra_discount_factor", "b3_sme_discount_flag", "sme_discount_factor"
    )


def by_conversion_factor(factor: Column, amount: Column) -> Column:
    """Amount before conversion, for the three factors that convert."""
    return first_match([(factor == step, amount / F.lit(step)) for step in (0.2, 0.5, 1.0)], F.lit(0.0))


def actual_risk_weight(rwa: Column, exposure: Column, divisor: Column, given: Column) -> Column:
    """Risk weight with the support factor undone, limited and rounded to 2.

    Nothing at all keeps the given ratio. A zero exposure, opposite signs or a
    ratio above the limit give the limit.
    """
    limit = F.lit(K.RISK_WEIGHT_LIMIT)
    raw = F.try_divide(rwa, exposure)
    adjusted = F.try_divide(rwa / divisor, exposure)
    opposite = ((rwa < 0) & (exposure >= 0)) | ((rwa > 0) & (exposure < 0))
    weight = first_match(
        [
            ((rwa == 0) & (exposure == 0), given),
            (exposure == 0, limit),
            ((raw > K.RISK_WEIGHT_LIMIT) | opposite, limit),
            (adjusted < K.RISK_WEIGHT_LIMIT, adjusted),
        ],
        limit,
    )
    return F.round(weight, 2)


def add_exposure_values(deals: DataFrame) -> DataFrame:
    """Add all amounts of pack D; needs packs A and B and the deal caps."""
    outflow, outflow_rwa = z("b2_std_crm_tot_outflow_exp"), z("b2_std_crm_tot_outflow_rwa")
    own_fund = equals("default_fund_contrib_indicator", "N")
    ccf = z("b2_std_ccf")
    off_ead_net = z("b2_std_ead_post_crm_amt_ofbal") - amount_if(_off_balance(), outflow)
    first = deals.withColumns(
        {
            "b2_std_exposure_value": z("ead_post_crm_amt") - outflow,
            "b2_std_exposure_value_ofbal": off_ead_net,
            "b2_std_exposure_value_onbal_expone": z("b2_std_ead_post_crm_amt_onbal")
            - amount_if(_on_balance(), outflow),
            "b2_std_fully_adj_exp_ccf_50": amount_if((ccf == 0.5) & own_fund, off_ead_net / F.lit(0.5)),
            "b2_std_fully_adj_exp_ccf_20": amount_if((ccf == 0.2) & own_fund, off_ead_net / F.lit(0.2)),
            "b2_std_fully_adj_exp_ccf_100": amount_if((ccf == 1.0) & own_fund, off_ead_net),
            "b2_std_crm_tot_outflow_onbal": amount_if(_on_balance(), outflow),
            "b2_std_crm_tot_outflow_ofbal": amount_if(_off_balance(), by_conversion_factor(ccf, outflow)),
            "b2_std_rwa_amt_expone": limited_to("rwa_post_crm_amount", "b2_std_gtee_cds_rwa_agg"),
            "b2_std_rwa_amt": z("b2_app_rwa_post_crm_amt") - outflow_rwa,
            "b2_std_rwa_amt_onbal_fur_exp": z("b2_std_rwa_post_crm_amt_onbal") - amount_if(_on_balance(), outflow_rwa),
            "b2_std_rwa_amt_ofbal": z("b2_std_rwa_post_crm_amt_ofbal") - amount_if(_off_balance(), outflow_rwa),
        }
    )
    reported_split = (
        equals("crd4_rep_std_flag", "Y") & equals("retail_off_bal_sheet_flag", "Y") & _on_balance()
    )
    second = first.withColumns(
        {
            "b2_std_exposure_value_onbal": pick(
                reported_split,
                F.col("b2_std_exposure_value") - F.col("b2_std_exposure_value_ofbal"),
                "b2_std_exposure_value_onbal_expone",
            ),
            "b2_std_rwa_amt_onbal": pick(
                reported_split,
                F.col("b2_std_rwa_amt") - F.col("b2_std_rwa_amt_ofbal"),
                "b2_std_rwa_amt_onbal_fur_exp",
            ),
            "b2_std_crm_tot_outflow": first_match(
                [
                    (_on_balance(), F.col("b2_std_crm_tot_outflow_onbal")),
                    (_off_balance(), F.col("b2_std_crm_tot_outflow_ofbal")),
                ],
                outflow,
            ),
        }
    )
    protection = z("b2_std_eff_cds_amt_agg") + z("b2_std_eff_gtee_amt_agg")
    total_outflow = F.col("b2_std_crm_tot_outflow")
    own_collateral = (
        equals(F.upper("reporting_regulator_code"), K.NETHERLANDS)
        & equals(F.substring("deal_id", 4, 2), "WM")
        & equals(F.upper("aclm_product_type"), "ON_BALANCE")
    )
    divisor = support_factor()
    std_divisor = F.when(equals("rwa_approach_code", K.STD), divisor).otherwise(F.lit(1.0))
    return second.withColumns(
        {
            "b2_std_eff_fin_coll_amt": pick(
                own_collateral,
                z("std_orig_exp_pre_conv_onbal") - z("b2_std_exposure_value_onbal"),
                z("b2_std_eff_fin_coll_amt_agg"),
            ),
            "b2_std_eff_cds_amt": pro_rata("b2_std_eff_cds_amt_agg", protection, total_outflow),
            "b2_std_eff_gtee_amt": pro_rata("b2_std_eff_gtee_amt_agg", protection, total_outflow),
            "b2_std_rwa_pre_sprt_amt": z("b2_std_rwa_amt") / divisor,
            "b2_std_rwa_pre_sprt_amt_onbal": z("b2_std_rwa_amt_onbal") / divisor,
            "b2_std_rwa_pre_sprt_amt_ofbal": z("b2_std_rwa_amt_ofbal") / divisor,
            "std_act_risk_weight": actual_risk_weight(
                z("b2_std_rwa_amt"), z("b2_std_exposure_value"), std_divisor, z("std_risk_weight_ratio")
            ),
        }
    )


EXPOSURE_VALUE_COLUMNS = (
    "b2_std_exposure_value",
    "b2_std_exposure_value_ofbal",
    "b2_std_exposure_value_onbal_expone",
    "b2_std_fully_adj_exp_ccf_50",
    "b2_std_fully_adj_exp_ccf_20",
    "b2_std_fully_adj_exp_ccf_100",
    "b2_std_crm_tot_outflow_onbal",
    "b2_std_crm_tot_outflow_ofbal",
    "b2_std_rwa_amt_expone",
    "b2_std_rwa_amt",
    "b2_std_rwa_amt_onbal_fur_exp",
    "b2_std_rwa_amt_ofbal",
    "b2_std_exposure_value_onbal",
    "b2_std_rwa_amt_onbal",
    "b2_std_crm_tot_outflow",
    "b2_std_eff_fin_coll_amt",
    "b2_std_eff_cds_amt",
    "b2_std_eff_gtee_amt",
    "b2_std_rwa_pre_sprt_amt",
    "b2_std_rwa_pre_sprt_amt_onbal",
    "b2_std_rwa_pre_sprt_amt_ofbal",
    "std_act_risk_weight",
)
