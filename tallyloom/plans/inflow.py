"""Rule pack E: protected parts as inflow rows of their protection provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import amount_if, equals, first_match, limited_to, pro_rata, support_divisor, z
from tallyloom.plans.exposures import actual_risk_weight, by_conversion_factor

# --- fixed values: deal attributes an inflow row takes, with their defaults --
DEAL_ATTRIBUTE_DEFAULTS = {
    "risk_taker_rru": K.NO_UNIT,
    "risk_on_rru": K.NO_UNIT,
    "internal_transaction_flag": "",
    "ig_exclusion_flag": "",
    "risk_taker_gs_code": "",
    "risk_on_gs_code": "",
    "default_fund_contrib_indicator": "",
    "basel_data_flag": "",
    "aclm_product_type": "",
    "division": "",
}


def _on_balance() -> Column:
    return equals("corep_product_category", K.ON)


def _off_balance() -> Column:
    return equals("corep_product_category", K.OFF)


def protected_value(protection: Column, taken: Column) -> Column:
    """Value a protection takes over: at most the deal's exposure.

    A protection at or above the exposure is scaled to it in proportion to
    ``taken``; a smaller one counts as it is, while the outflow leaves room.
    """
    ead, outflow = z("ead_post_crm_amt"), z("b2_std_crm_tot_outflow_exp")
    return first_match(
        [
            (ead <= 0, ead),
            (protection >= ead, pro_rata(taken, protection, ead)),
            (outflow < ead, taken),
        ],
        F.lit(0.0),
    )


def protected_part(protection: Column) -> Column:
    """As ``protected_value`` with the whole protection taken over."""
    ead, outflow = z("ead_post_crm_amt"), z("b2_std_crm_tot_outflow_exp")
    return first_match([(ead <= 0, ead), (protection >= ead, ead), (outflow < ead, protection)], F.lit(0.0))


def add_inflow_values(rows: DataFrame) -> DataFrame:
    """Add all amounts of pack E to sub-exposures that carry their deal's columns."""
    protection = z("b2_std_eff_gtee_amt_agg") + z("b2_std_eff_cds_amt_agg")
    own = z("b2_std_eff_gtee_amt") + z("b2_std_eff_cds_amt")
    factor = z("b2_std_ccf_input")
    own_rwa, deal_rwa = z("b2_std_gtee_cds_rwa"), z("rwa_post_crm_amount")
    first = rows.withColumns(
        {
            "b2_std_exposure_value": protected_value(protection, own),
            "b2_std_exposure_value_onbal": amount_if(_on_balance(), protected_part(protection)),
            "b2_std_exposure_value_ofbal": amount_if(_off_balance(), protected_part(protection)),
            "b2_std_rwa_amt_onbal": amount_if(_on_balance(), limited_to(deal_rwa, own_rwa)),
            "b2_std_rwa_amt_ofbal": amount_if(
                _off_balance(),
                first_match(
                    [
                        (deal_rwa <= 0, deal_rwa),
                        (
                            own_rwa >= deal_rwa,
                            F.coalesce(
                                F.try_divide(own_rwa, z("b2_std_gtee_cds_rwa_agg")) * deal_rwa, F.lit(0.0)
                            ),
                        ),
                    ],
                    own_rwa,
                ),
            ),
        }
    )
    off_value = F.col("b2_std_exposure_value_ofbal")
    divisor = support_divisor(
        "crr2_501a_discount_flag",
        F.coalesce(F.col("v_infra_discount_factor").cast("double"), F.lit(K.DEFAULT_INFRA_FACTOR)),
        "b3_sme_discount_flag",
        "sme_discount_factor",
    )
    std_divisor = F.when(equals("rwa_approach_code", K.STD), divisor).otherwise(F.lit(1.0))
    return first.withColumns(
        {
            "b2_std_fully_adj_exp_ccf_50": amount_if(factor == 0.5, off_value / F.lit(0.5)),
            "b2_std_fully_adj_exp_ccf_20": amount_if(factor == 0.2, off_value / F.lit(0.2)),
            "b2_std_fully_adj_exp_ccf_100": amount_if(factor == 1.0, off_value),
            "b2_std_crm_tot_inflow": first_match(
                [
                    (_on_balance(), F.col("b2_std_exposure_value_onbal")),
                    (_off_balance(), by_conversion_factor(factor, off_value)),
                ],
                F.col("b2_std_exposure_value"),
            ),
            "b2_std_crm_tot_inflow_onbal": amount_if(_on_balance(), "b2_std_exposure_value_onbal"),
            "b2_std_crm_tot_inflow_ofbal": amount_if(_off_balance(), by_conversion_factor(factor, off_value)),
            "b2_std_rwa_pre_sprt_amt": F.round(z("b2_std_rwa_amt_expone"), 2) / divisor,
            "b2_std_rwa_pre_sprt_amt_onbal": F.round(z("b2_std_rwa_amt_onbal"), 2) / divisor,
            "b2_std_rwa_pre_sprt_amt_ofbal": F.round(z("b2_std_rwa_amt_ofbal"), 2) / divisor,
            "std_act_risk_weight": actual_risk_weight(
                z("b2_std_rwa_amt_expone"), z("b2_std_exposure_value"), std_divisor, z("b2_std_gtor_rw_ratio")
            ),
            **{
                name: F.coalesce(F.col(name), F.lit(default)) for name, default in DEAL_ATTRIBUTE_DEFAULTS.items()
            },
        }
    )


INFLOW_COLUMNS = (
    "b2_std_exposure_value",
    "b2_std_exposure_value_onbal",
    "b2_std_exposure_value_ofbal",
    "b2_std_rwa_amt_onbal",
    "b2_std_rwa_amt_ofbal",
    "b2_std_fully_adj_exp_ccf_50",
    "b2_std_fully_adj_exp_ccf_20",
    "b2_std_fully_adj_exp_ccf_100",
    "b2_std_crm_tot_inflow",
    "b2_std_crm_tot_inflow_onbal",
    "b2_std_crm_tot_inflow_ofbal",
    "b2_std_rwa_pre_sprt_amt",
    "b2_std_rwa_pre_sprt_amt_onbal",
    "b2_std_rwa_pre_sprt_amt_ofbal",
    "std_act_risk_weight",
)
