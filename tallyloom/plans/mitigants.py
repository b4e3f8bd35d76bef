"""Rule pack C: credit-risk mitigants of a sub-exposure, and their totals per deal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import amount_if, capped_by, equals, is_blank, one_of, z
from tallyloom.operators.aggregates import group_sum
from tallyloom.plans.staging import for_all_regulators

# --- fixed values: mitigant categories and codes ----------------------------
GUARANTEES = "GUARANTEES"
CREDIT_DERIVATIVES = "CREDIT DERIVATIVES"
FINANCIAL_COLLATERAL = "ELIGIBLE FINANCIAL COLLATERAL"
OTHER_FUNDED = "OTHER FUNDED CREDIT PROTECTION"
REAL_ESTATE = "REAL ESTATE"
PHYSICAL_COLLATERAL = "OTHER PHYSICAL COLLATERAL"
RECEIVABLES = "RECEIVABLES"
WITHOUT_GUARANTOR_TYPE = "WG"
UNFUNDED_TYPES = ("GU", "CD")

DEAL_KEYS = ("year_month", "reporting_regulator_code", "deal_id")


def _category(name: str) -> Column:
    return equals(F.upper("corep_crm_category"), name)


def _double_default() -> Column:
    return equals(F.upper("double_default_flag"), "Y")


def discounted_or_plain(discounted: str, plain: str) -> Column:
    """The discounted amount unless it is zero."""
    return F.when(z(discounted) != 0, z(discounted)).otherwise(z(plain))


def is_unfunded_outflow() -> Column:
    """Guarantee or credit derivative that moves an exposure to its provider."""
    return (
        ((z("b2_std_eff_gtee_amt") > 0) | (z("b2_std_eff_cds_amt") > 0))
        & equals("type", WITHOUT_GUARANTOR_TYPE)
        & one_of("mitigant_type", UNFUNDED_TYPES)
    )


def _funded_by(collateral_code: str) -> Column:
    kind = (
        equals("collateral_type_code", collateral_code)
        & equals("sys_protection_type", "EP")
        & equals("sys_code", "RMP")
        & _category(OTHER_FUNDED)
        & ~_double_default()
    )
    return amount_if(kind, discounted_or_plain("sec_discntd_b2_irb_colltrl_amt", "b2_irb_coll_amt"))


def add_mitigant_amounts(sub_exposures: DataFrame) -> DataFrame:
    """Add all amounts of pack C to sub-exposures."""
    guarantee = discounted_or_plain("sec_discntd_b2_irb_garntee_amt", "b2_irb_gtee_amt")
    plain_guarantee, collateral = z("b2_irb_gtee_amt"), z("b2_irb_coll_amt")
    derivative = _category(CREDIT_DERIVATIVES) & equals(F.upper("mitigant_type"), "CD")
    blank = is_blank("corep_crm_category")
    after_haircut = z("b2_std_eff_coll_amt_post_hcut")
    single = ~_double_default()
    return sub_exposures.withColumns(
        {
            "b2_std_crm_tot_outflow_rwa_indv": amount_if(is_unfunded_outflow(), z("b2_std_gtee_cds_rwa")),
            "b2_std_crm_tot_outflow_indv": amount_if(
                is_unfunded_outflow(), z("b2_std_eff_gtee_amt") + z("b2_std_eff_cds_amt")
            ),
            "b2_std_gtee_cds_rwa_indv": z("b2_std_gtee_cds_rwa"),
            "b2_irb_crm_ufcp_guar_amt_indv": amount_if(_category(GUARANTEES) & single, guarantee),
            "b2_irb_crm_ufcp_cred_deriv_amt_indv": amount_if(derivative & single, guarantee),
            "crm_ufcp_cred_deriv_amt_indv": amount_if(derivative & _double_default(), plain_guarantee),
            "crm_ufcp_guar_amt_indv": amount_if(_category(GUARANTEES) & _double_default(), plain_guarantee),
            "crm_fcp_elig_fin_coll_amt_indv": amount_if(_category(FINANCIAL_COLLATERAL) & single, collateral),
            "b2_irb_crm_fcp_oth_funded_amt_indv": amount_if(
                _category(OTHER_FUNDED) & single,
                discounted_or_plain("sec_discntd_b2_irb_colltrl_amt", "b2_irb_coll_amt"),
            ),
            "crm_fcp_real_estate_amt_indv": amount_if(_category(REAL_ESTATE) & single, collateral),
            "b2_irb_crm_fcp_oth_phy_col_amt_indv": amount_if(_category(PHYSICAL_COLLATERAL) & single, collateral),
            "b2_irb_crm_fcp_receivables_amt_indv": amount_if(_category(RECEIVABLES) & single, collateral),
            "b2_std_eff_fin_coll_amt": amount_if(_category(FINANCIAL_COLLATERAL), after_haircut),
            "b2_std_oth_fun_cred_prot_amt_indv": amount_if(_category(OTHER_FUNDED), after_haircut),
            "b2_std_coll_fx_haircut_amt_indv": F.coalesce(F.col("b2_std_fx_haircut"), F.lit(1.0))
            * z("b2_std_elig_coll_amt"),
            "blank_crm_amt_std_indv": amount_if(
                blank, z("b2_std_eff_gtee_amt") + z("b2_std_eff_cds_amt") + after_haircut
            ),
            "blank_crm_amt_irb_indv": amount_if(blank, plain_guarantee + collateral),
            "b2_irb_crm_cod_amt": _funded_by("CO"),
            "b2_irb_crm_lip_amt": _funded_by("LP"),
        }
    )


MITIGANT_COLUMNS = (
    "b2_std_crm_tot_outflow_rwa_indv",
    "b2_std_crm_tot_outflow_indv",
    "b2_std_gtee_cds_rwa_indv",
    "b2_irb_crm_ufcp_guar_amt_indv",
    "b2_irb_crm_ufcp_cred_deriv_amt_indv",
    "crm_ufcp_cred_deriv_amt_indv",
    "crm_ufcp_guar_amt_indv",
    "crm_fcp_elig_fin_coll_amt_indv",
    "b2_irb_crm_fcp_oth_funded_amt_indv",
    "crm_fcp_real_estate_amt_indv",
    "b2_irb_crm_fcp_oth_phy_col_amt_indv",
    "b2_irb_crm_fcp_receivables_amt_indv",
    "b2_std_eff_fin_coll_amt",
    "b2_std_oth_fun_cred_prot_amt_indv",
    "b2_std_coll_fx_haircut_amt_indv",
    "blank_crm_amt_std_indv",
    "blank_crm_amt_irb_indv",
    "b2_irb_crm_cod_amt",
    "b2_irb_crm_lip_amt",
)

# Sub-exposure column to its total per deal.
MITIGANT_TOTALS = {
    "b2_std_crm_tot_outflow_rwa_indv": "b2_std_crm_tot_outflow_rwa_agg",
    "b2_std_crm_tot_outflow_indv": "b2_std_crm_tot_outflow_agg",
    "b2_std_gtee_cds_rwa_indv": "b2_std_gtee_cds_rwa_agg",
    "crm_ufcp_cred_deriv_amt_indv": "crm_ufcp_cred_deriv_amt_agg",
    "crm_ufcp_guar_amt_indv": "crm_ufcp_guar_amt_agg",
    "crm_fcp_elig_fin_coll_amt_indv": "crm_fcp_elig_fin_coll_amt_agg",
    "b2_std_eff_gtee_amt": "b2_std_eff_gtee_amt_agg",
    "b2_std_eff_cds_amt": "b2_std_eff_cds_amt_agg",
    "b2_std_coll_volatility_amt": "b2_std_coll_volatility_amt_agg",
    "b2_std_coll_mty_mismatch_amt": "b2_std_coll_mty_mismatch_amt_agg",
    "b2_std_eff_fin_coll_amt": "b2_std_eff_fin_coll_amt_agg",
    "b2_std_coll_fx_haircut_amt_indv": "b2_std_coll_fx_haircut_amt_agg",
    "b2_irb_colltrl_amt_ttc": "b2_irb_colltrl_amt_ttc_agg",
    "b2_irb_garntee_amt_ttc": "b2_irb_garntee_amt_ttc_agg",
    "sec_discnt_b2_irb_coll_amt_ttc": "sec_discnt_b2_irb_coll_amt_ttc_agg",
    "sec_discnt_b2_irb_gtee_amt_ttc": "sec_discnt_b2_irb_gtee_amt_ttc_agg",
    "blank_crm_amt_std_indv": "blank_crm_amt_std_agg",
    "blank_crm_amt_irb_indv": "blank_crm_amt_irb_agg",
    "b2_std_oth_fun_cred_prot_amt_indv": "b2_std_oth_fun_cred_prot_amt",
    "b2_irb_crm_ufcp_cred_deriv_amt_indv": "b2_irb_crm_ufcp_cred_deriv_amt",
    "b2_irb_crm_fcp_oth_funded_amt_indv": "b2_irb_crm_fcp_oth_funded_amt",
    "b2_irb_crm_fcp_oth_phy_col_amt_indv": "b2_irb_crm_fcp_oth_phy_col_amt",
    "b2_irb_crm_fcp_receivables_amt_indv": "b2_irb_crm_fcp_receivables_amt",
    "b2_irb_crm_ufcp_guar_amt_indv": "b2_irb_crm_ufcp_guar_amt",
    "crm_fcp_real_estate_amt_indv": "b2_irb_crm_fcp_real_estate_amt",
}


def mitigant_totals(sub_exposures: DataFrame, keys=DEAL_KEYS) -> DataFrame:
    """All totals per deal in one pass; a deal with many mitigants is summed before it is shuffled."""
    filled = sub_exposures.withColumns({c: z(c) for c in MITIGANT_TOTALS})
    return group_sum(filled, keys, MITIGANT_TOTALS)


def totals_for_all(own: DataFrame, keys=DEAL_KEYS) -> DataFrame:
    """Totals of sub-exposures before they are copied: summed once, then copied.

    Only a regulator with sub-exposures of its own needs a second sum, of
    what was summed already.
    """
    totals = mitigant_totals(own, keys)
    regulator = F.col("reporting_regulator_code")
    copied = for_all_regulators(totals)
    alone = copied.where(~regulator.isin(K.GERMANY))
    return alone.unionByName(group_sum(copied.where(regulator == K.GERMANY), keys, list(MITIGANT_TOTALS.values())))


def add_deal_caps(deals: DataFrame) -> DataFrame:
    """Cap the totals by the deal's own amounts; a deal without mitigants gets zeros."""
    return deals.withColumns(
        {
            "b2_std_crm_tot_outflow_rwa": capped_by("b2_std_crm_tot_outflow_rwa_agg", "rwa_post_crm_amount"),
            "b2_std_crm_tot_outflow_exp": capped_by("b2_std_crm_tot_outflow_agg", "ead_post_crm_amt"),
            "b2_irb_crm_fcp_elg_fin_col_amt": z("crm_fcp_elig_fin_coll_amt_agg") + z("b2_irb_netted_coll_gbp"),
            "b2_irb_crm_ufcp_double_def_amt": z("crm_ufcp_guar_amt_agg") + z("crm_ufcp_cred_deriv_amt_agg"),
        }
    )
