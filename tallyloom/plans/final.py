"""Rule pack F: rules on the union of both flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import amount_if, equals, one_of, z
from tallyloom.plans.amounts import internal_on_balance
from tallyloom.plans.exposures import support_factor
from tallyloom.plans.flags import counterparty_sector


def internal_risk_weight():
    """Internal risk weight with the support factor undone, limited in size."""
    weight = F.coalesce(
        F.try_divide(z("b2_app_rwa_post_crm_amt"), z("b2_app_ead_post_crm_amt")) / support_factor(), F.lit(0.0)
    )
    limited = F.when(F.abs(weight) > K.RISK_WEIGHT_LIMIT, F.lit(K.RISK_WEIGHT_LIMIT)).otherwise(weight)
    return amount_if(equals("approved_approach_code", K.AIRB), limited)


def add_final_columns(rows: DataFrame) -> DataFrame:
    """Add all columns of pack F to the union of both flows."""
    divisor = support_factor()
    first = rows.withColumn(
        "b2_irb_rwa_amt_onbal", internal_on_balance("b2_irb_drawn_rwa", "b2_app_rwa_post_crm_amt")
    )
    return first.withColumns(
        {
            "irb_risk_weight_ratio": internal_risk_weight(),
            "irb_orig_exp_pre_conv_onbal": amount_if(
                equals("corep_exposure_category", K.ON)
                | one_of("aclm_product_type", K.OTHER_ON_BALANCE_PRODUCTS),
                z("b2_irb_orig_exp_pre_con_factor") - z("irb_orig_exp_pre_conv_ofbal"),
            ),
            "rwa_post_crm_pre_sprt_amount": z("rwa_post_crm_amount") / divisor,
            "b2_irb_rwa_pre_sprt_amt_onbal": z("b2_irb_rwa_amt_onbal") / divisor,
            "b2_irb_rwa_pre_sprt_amt_ofbal": z("b2_irb_rwa_amt_ofbal") / divisor,
            "finrep_counterparty_sector": counterparty_sector(F.col("rwa_approach_code")),
        }
    )


FINAL_COLUMNS = (
    "b2_irb_rwa_amt_onbal",
    "irb_risk_weight_ratio",
    "irb_orig_exp_pre_conv_onbal",
    "rwa_post_crm_pre_sprt_amount",
    "b2_irb_rwa_pre_sprt_amt_onbal",
    "b2_irb_rwa_pre_sprt_amt_ofbal",
    "finrep_counterparty_sector",
)
# Columns that the rules above read.
FINAL_INPUTS = (
    "approved_approach_code",
    "rwa_approach_code",
    "aclm_product_type",
    "corep_exposure_category",
    "retail_off_bal_sheet_flag",
    "b2_irb_drawn_rwa",
    "b2_app_rwa_post_crm_amt",
    "b2_app_ead_post_crm_amt",
    "b2_irb_orig_exp_pre_con_factor",
    "irb_orig_exp_pre_conv_ofbal",
    "b2_irb_rwa_amt_ofbal",
    "rwa_post_crm_amount",
    "crr2_501a_discount_flag",
    "v_infra_discount_factor",
    "b3_sme_discount_flag",
    "sme_discount_factor",
    "b2_std_asset_class_basel_exposure_type",
    "b2_irb_asset_class_reg_exposure_type",
    "sub_sector",
)
