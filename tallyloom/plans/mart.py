"""Reporting mart: exposures and protected inflow in one layer.

Three exchanges matter: the mitigant totals per deal, the join of what a deal
takes from other tables to its narrow keys, and the join of deal columns to the
inflow rows. All rules run as columns of the frame that already holds their
inputs.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import equals, without_prefix, z
from tallyloom.operators.aggregates import exact_pair
from tallyloom.operators.joins import prior_period_join
from tallyloom.operators.setops import align_union
from tallyloom.plans.amounts import add_amounts
from tallyloom.plans.exposures import add_exposure_values
from tallyloom.plans.final import FINAL_COLUMNS, FINAL_INPUTS, add_final_columns
from tallyloom.plans.flags import add_flags
from tallyloom.plans.inflow import DEAL_ATTRIBUTE_DEFAULTS, add_inflow_values
from tallyloom.plans.staging import DealSide, regulators_of
from tallyloom.plans.mitigants import (
    MITIGANT_TOTALS,
    add_deal_caps,
    add_mitigant_amounts,
    is_unfunded_outflow,
    mitigant_totals,
)

# Deal columns the inflow rules read.
DEAL_COLUMNS_FOR_INFLOW = (
    "ead_post_crm_amt",
    "corep_product_category",
    "b2_std_ccf_input",
    "crr2_501a_discount_flag",
    "b2_std_rwa_amt_expone",
    "sme_discount_factor",
    "v_infra_discount_factor",
    "b3_sme_discount_flag",
    "rwa_post_crm_amount",
    "rwa_approach_code",
    "std_risk_weight_ratio",
    "b2_std_crm_tot_outflow_exp",
    "b2_std_gtee_cds_rwa_agg",
    "b2_std_eff_gtee_amt_agg",
    "b2_std_eff_cds_amt_agg",
    *DEAL_ATTRIBUTE_DEFAULTS,
)
# Deal columns an inflow row shows as its own.
DEAL_COLUMNS_ON_INFLOW = (
    "b3_sme_rp_flag",
    "retail_pool_sme_flag",
    "external_counterparty_id",
    "regulatory_product_type",
    "industry_sector_type",
    "sector_type",
    "corep_exposure_category",
    "b2_app_adjusted_pd_ratio",
    "corep_irb_asset_class_rk",
    "b2_irb_ccf",
)
# Amounts an exposure has none of, zero rather than null.
ZERO_ON_EXPOSURES = (
    "b2_irb_gtee_amt",
    "sec_discntd_b2_irb_garntee_amt",
    "sec_discntd_b2_irb_colltrl_amt",
    "b2_irb_coll_amt",
    "b2_irb_crm_cod_amt",
    "b2_irb_crm_lip_amt",
)
# Totals that only internal-ratings deals show.
INTERNAL_TOTALS = (
    "b2_irb_crm_ufcp_cred_deriv_amt",
    "b2_irb_crm_fcp_real_estate_amt",
    "b2_irb_colltrl_amt_ttc_agg",
    "b2_irb_crm_fcp_oth_funded_amt",
    "b2_irb_crm_fcp_oth_phy_col_amt",
    "b2_irb_crm_fcp_receivables_amt",
    "b2_irb_crm_ufcp_guar_amt",
    "b2_irb_crm_ufcp_double_def_amt",
)


# Columns of the previous quarter under their name in the mart.
PRIOR_COLUMNS = {
    "rwa_approach_code": "rwa_approach_code_qtr",
    "memo_b2_std_basel_exposure_type": "memo_b2_std_basel_exposure_type_qtr",
    "b2_app_adjusted_pd_ratio": "b2_app_adjusted_pd_ratio_qtr",
}
# Totals that an exposure row shows under the name the return reads.
REDUCTION_TOTALS = {
    "b2_std_coll_volatility_amt_agg": "b2_std_coll_volatility_amt",
    "b2_std_coll_mty_mismatch_amt_agg": "b2_std_coll_mty_mismatch_amt",
    "b2_std_coll_fx_haircut_amt_agg": "b2_std_coll_fx_haircut_amt",
}


def filled(df: DataFrame, defaults: dict) -> DataFrame:
    """Null defaults of a layer, which must have all these columns."""
    missing = sorted(set(defaults) - set(df.columns))
    if missing:
        raise ValueError(f"no column for the defaults {missing}")
    return df.fillna(defaults)


def with_prior_quarter(exposures: DataFrame, history: DataFrame, previous_quarter: Column) -> DataFrame:
    """Attributes of the same deal at the previous quarter end.

    All prior rows take part; the default test runs on what was joined.
    """
    prior = history.where(equals("flow_type", K.EXPOSURE) & equals("adjust_flag", "A"))
    return prior_period_join(
        exposures,
        prior,
        ["reporting_regulator_code", "deal_id"],
        "year_month",
        previous_quarter,
        PRIOR_COLUMNS,
    )


def with_deal_side(exposures: DataFrame, history: DataFrame, previous_quarter: Column, totals: DataFrame) -> DataFrame:
    """Prior quarter and mitigant totals of each exposure, in one join by deal.

    Exposures are hundreds of columns wide. Their distinct keys meet the
    history and the totals, and what was found meets the exposures. ``totals``
    are those of sub-exposures that are not copied for other regulators.
    """
    keys = ["year_month", "reporting_regulator_code", "deal_id"]
    plain = without_prefix("deal_id", "deal_id_prefix")
    narrow = exposures.select(*keys, plain.alias("_plain_deal")).distinct()
    side = with_shared_totals(with_own_totals(with_prior_quarter(narrow, history, previous_quarter), totals), totals)
    side = side.withColumnsRenamed({k: f"_s{i}" for i, k in enumerate((*keys, "_plain_deal"))})
    left = exposures.withColumn("_plain_deal", plain)
    met = F.lit(True)
    for i, k in enumerate((*keys, "_plain_deal")):
        met = met & left[k].eqNullSafe(side[f"_s{i}"])
    return left.join(side, met, "left").drop(*[f"_s{i}" for i in range(len(keys) + 1)])


def deal_side(history: DataFrame, previous_quarter: Column, totals: DataFrame, month: int) -> DealSide:
    """The same columns for the facts of a month, which meet them while they are staged: see ``with_deal_side``."""
    return DealSide(
        (*PRIOR_COLUMNS.values(),),
        (*MITIGANT_TOTALS.values(),),
        lambda keys: with_prior_quarter(keys, history, previous_quarter),
        lambda rows: with_shared_totals(with_own_totals(rows, totals, "_deal"), totals.where(F.col("year_month") == month), "_deal", ()),
    )


def without_prior_quarter(exposures: DataFrame) -> DataFrame:
    """The same columns where no earlier quarter exists."""
    return exposures.withColumns(
        {
            "rwa_approach_code_qtr": F.lit(None).cast("string"),
            "memo_b2_std_basel_exposure_type_qtr": F.lit(None).cast("string"),
            "b2_app_adjusted_pd_ratio_qtr": F.lit(None).cast("double"),
        }
    )


def enrich_exposures(exposures: DataFrame) -> DataFrame:
    """Packs A and B."""
    return add_amounts(add_flags(filled(exposures, K.EXPOSURE_DEFAULTS)))


def with_totals(exposures: DataFrame, totals: DataFrame) -> DataFrame:
    """Mitigant totals joined to their deals by stripped id."""
    right = totals.select(
        F.col("year_month").alias("_m"), F.col("reporting_regulator_code").alias("_r"), F.col("deal_id").alias("_d"),
        *MITIGANT_TOTALS.values(),
    )
    return exposures.join(
        right,
        (exposures["year_month"] == right["_m"])
        & (exposures["reporting_regulator_code"] == right["_r"])
        & (exposures["_plain_deal"] == right["_d"]),
        "left",
    ).drop("_m", "_r", "_d")


def _named_totals(totals: DataFrame, prefix: str) -> DataFrame:
    return totals.select(
        F.col("year_month").alias("_m"), F.col("reporting_regulator_code").alias("_r"), F.col("deal_id").alias("_d"),
        *[F.col(c).alias(prefix + c) for c in MITIGANT_TOTALS.values()],
    )


def with_own_totals(rows: DataFrame, totals: DataFrame, deal: str = "_plain_deal") -> DataFrame:
    """Totals of a regulator's own sub-exposures; those of the first one are met by ``with_shared_totals``."""
    right = _named_totals(totals.where(F.col("reporting_regulator_code") != K.UK), "_own_")
    met = (F.col("year_month") == F.col("_m")) & (F.col("reporting_regulator_code") == F.col("_r")) & (F.col(deal) == F.col("_d"))
    return rows.join(right, met, "left").drop("_m", "_r", "_d")


def with_shared_totals(rows: DataFrame, totals: DataFrame, deal: str = "_plain_deal", period: tuple = ("year_month",)) -> DataFrame:
    """The first regulator's totals for its deals and those of the regulators they are reported to, with their own.

    Totals are not copied: a deal of each of these regulators meets them by
    its id, and by the ``period`` where there are several.
    """
    right = _named_totals(totals.where(F.col("reporting_regulator_code") == K.UK), "_shared_")
    met = F.col(deal) == F.col("_d")
    for c in period:
        met = met & (F.col(c) == F.col("_m"))
    reported = F.col("reporting_regulator_code").isin(K.UK, *K.FAN_OUT_REGULATORS)
    names = [*MITIGANT_TOTALS.values()]
    # As arrays: one small expression for all totals instead of one for each.
    shared, own = (F.array(*[F.col(prefix + c) for c in names]) for prefix in ("_shared_", "_own_"))
    both = F.when(reported, F.zip_with(shared, own, exact_pair)).otherwise(own)
    joined = rows.join(right, met, "left").withColumn("_totals", both)
    drop = ["_m", "_r", "_d", "_totals", *[prefix + c for prefix in ("_own_", "_shared_") for c in names]]
    return joined.withColumns({c: F.col("_totals")[i] for i, c in enumerate(names)}).drop(*drop)


def cap_deals(joined: DataFrame) -> DataFrame:
    """Caps and pack D of enriched exposures that hold their totals."""
    return add_exposure_values(add_deal_caps(joined))


def enrich_deals(exposures: DataFrame, totals: DataFrame) -> DataFrame:
    """Mitigant totals joined to their deals by stripped id, caps, pack D."""
    left = exposures.withColumn("_plain_deal", without_prefix("deal_id", "deal_id_prefix"))
    return cap_deals(with_totals(left, totals))


def inflow_rows(deals: DataFrame, sub_exposures: DataFrame, copied: bool = True) -> DataFrame:
    """Protected parts of standard deals as rows of their own, with pack E.

    Rows that cannot become inflow are dropped before the join. Sub-exposures
    that are not yet ``copied`` for the other regulators meet the deals of all
    of them by deal alone, so that no copy is shuffled that meets nothing.
    """
    own = {*DEAL_COLUMNS_FOR_INFLOW, *DEAL_COLUMNS_ON_INFLOW}
    kept = [c for c in sub_exposures.columns if c not in own]
    left = sub_exposures.where(is_unfunded_outflow()).select(*kept)
    right = deals.where(equals("rwa_approach_code", K.STD)).select(
        F.col("year_month").alias("_m"),
        F.col("reporting_regulator_code").alias("_r"),
        F.col("_plain_deal").alias("_d"),
        F.col("deal_id").alias("_deal_id"),
        *dict.fromkeys((*DEAL_COLUMNS_FOR_INFLOW, *DEAL_COLUMNS_ON_INFLOW)),
    )
    same_deal = (left["year_month"] == right["_m"]) & (left["deal_id"] == right["_d"])
    if copied:
        joined = left.join(right, same_deal & (left["reporting_regulator_code"] == right["_r"]), "inner")
    else:
        # A copy for a regulator only counts where that regulator has the deal.
        reached = F.array_contains(regulators_of(left["reporting_regulator_code"]), right["_r"])
        joined = left.join(right, same_deal & reached, "inner").withColumn("reporting_regulator_code", F.col("_r"))
    rows = add_inflow_values(joined.drop("deal_id", "_m", "_r", "_d").withColumnRenamed("_deal_id", "deal_id"))
    return rows.drop(
        "b2_std_rwa_amt_expone",
        "b2_std_crm_tot_outflow_exp",
        "b2_std_gtee_cds_rwa_agg",
        "b2_std_eff_gtee_amt_agg",
        "b2_std_eff_cds_amt_agg",
        "rwa_post_crm_amount",
        "ead_post_crm_amt",
        # The deal's own row shows these, so an inflow row must not repeat them.
        "b2_std_eff_gtee_amt",
        "b2_std_eff_cds_amt",
        "b2_std_eff_fin_coll_amt",
        "b2_std_coll_volatility_amt",
        "b2_std_coll_mty_mismatch_amt",
    ).withColumns(
        {
            "adjust_flag": F.lit("A"),
            "on_balance_ledger_exposure": F.lit(0.0),
            "b2_irb_provisions_amt": F.lit(0.0),
            "b2_std_provisions_amt_onbal": F.lit(0.0),
            "b2_std_ccf": F.col("b2_std_ccf_input"),
            "crd4_rep_std_flag": F.lit("N"),
            "crd4_rep_stdflow_flag": F.lit("Y"),
        }
    )


def unite_flows(deals: DataFrame, mitigants: DataFrame, copied: bool = True) -> DataFrame:
    """Deals and their inflow rows as one layer, with pack F; ``copied`` as in ``inflow_rows``."""
    return unite_rows(deals, inflow_rows(deals, mitigants, copied))


def unite_rows(deals: DataFrame, inflow: DataFrame, wanted: Collection[str] | None = None) -> DataFrame:
    """Deals and inflow rows with the columns of the mart, or with the ``wanted`` ones; either may be empty.

    Deals must have what ``deal_columns_for`` the wanted columns names.
    """
    internal = ~equals("rwa_approach_code", K.STD)
    own = {c: F.when(internal, z(c)).otherwise(F.lit(0.0)) for c in INTERNAL_TOTALS}
    own |= {plain: F.col(total) for total, plain in REDUCTION_TOTALS.items()}
    shown = deals.withColumns({c: value for c, value in own.items() if wanted is None or c in wanted})
    rows = align_union(shown.drop("_plain_deal"), inflow, ZERO_ON_EXPOSURES)
    if wanted is None:
        return add_final_columns(rows)
    return (add_final_columns(rows) if {*FINAL_COLUMNS} & {*wanted} else rows).select(*wanted)


def deal_columns_for(wanted: Collection[str]) -> set[str]:
    """Columns of the deals that the wanted columns of the mart come from, on exposure and on inflow rows."""
    named = {*wanted, "_plain_deal", "rwa_approach_code", *DEAL_COLUMNS_FOR_INFLOW, *DEAL_COLUMNS_ON_INFLOW}
    named |= {total for total, plain in REDUCTION_TOTALS.items() if plain in wanted}
    return named | {*FINAL_INPUTS} if {*FINAL_COLUMNS} & named else named


def build_mart(exposures: DataFrame, sub_exposures: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The mart of staged exposures (with prior-quarter columns) and sub-exposures.

    The deals feed both flows; ``keep`` may write them as a layer in between.
    """
    mitigants = add_mitigant_amounts(filled(sub_exposures, K.SUB_EXPOSURE_DEFAULTS))
    deals = enrich_deals(enrich_exposures(exposures), mitigant_totals(mitigants))
    return unite_flows(keep(deals) if keep else deals, mitigants)
