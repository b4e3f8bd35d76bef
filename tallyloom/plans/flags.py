"""Rule pack A: approach, reporting and classification flags of an exposure."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import code_lookup, equals, first_match, is_blank, one_of, text

# --- fixed values: intra-group exclusions -----------------------------------
OPEN_STRUCTURES = (("UKIG", "WIG"), ("UKIG", "NIG"), ("WIG", "NIG"))
OPEN_GROUP_PAIRS = (
    ("CORE", "NONCORE"),
    ("CORE", "CONNECTEDC"),
    ("NONCORE", "CONNECTEDC"),
    ("CONNECTEDC", "CONNECTEDC"),
)
CROSS_REFERENCE = "CONNECTEDC_XREF"
EXEMPT_UNIT = "ULSTERAI"
EXEMPT_REGULATORS = (K.IRELAND, K.NETHERLANDS)
COUNTED_ENTITY_CLASSES = ("Bank", "Corporate")

# --- fixed values: sector of a standard class with its sub-sector ----------
STANDARD_SECTORS = (
    (K.CENTRAL_GOVERNMENT, "Central Government", "Central governments"),
    (K.REGIONAL_GOVERNMENT, "Local Authorities", "Regional governments or local authorities"),
    (K.PUBLIC_SECTOR, "Other public bodies", "Public sector entities"),
    (K.INTERNATIONAL, None, "International Organisations"),
)
# --- fixed values: sector of an internal class with a standard class -------
INTERNAL_SECTORS = (
    ("Central governments and central banks", K.CENTRAL_GOVERNMENT, "Central governments"),
    ("Institutions", K.REGIONAL_GOVERNMENT, "Regional governments or local authorities [Institutions]"),
    (
        "Central governments and central banks",
        K.PUBLIC_SECTOR,
        "Public sector entities [Central governments and central banks]",
    ),
    ("Institutions", K.PUBLIC_SECTOR, "Public sector entities [Institutions]"),
    (
        "Central governments and central banks",
        K.INTERNATIONAL,
        "International Organisations [Central governments and central banks]",
    ),
)


@dataclass(frozen=True)
class FlagNames:
    """Where the prior-quarter attributes of an exposure are found."""

    prior_approach: str = "rwa_approach_code_qtr"
    prior_class: str = "memo_b2_std_basel_exposure_type_qtr"
    prior_pd: str = "b2_app_adjusted_pd_ratio_qtr"


def _yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def _pairs(a: Column, b: Column, pairs) -> Column:
    """Membership of two codes in a list of pairs; null is in no pair."""
    result = F.lit(False)
    for x, y in pairs:
        result = result | (equals(a, x) & equals(b, y))
    return result


def approach_code() -> Column:
    approved = F.col("approved_approach_code")
    specialised = one_of(
        "b2_irb_asset_class_reg_exposure_sub_type", ("Income Producing Real Estate", "Project Finance")
    ) & equals("b2_irb_asset_class_basel_exposure_type", "Corporate")
    return first_match(
        [
            (
                equals("reporting_regulator_code", K.UK) & one_of("division_sub2", K.OVERRIDE_DIVISIONS),
                F.lit(K.STD),
            ),
            (
                equals("reporting_regulator_code", K.NETHERLANDS),
                F.when(equals("pd_model_code", "LC") | specialised, F.lit(K.AIRB)).otherwise(F.lit(K.STD)),
            ),
        ],
        approved,
    )


def effective_approach() -> Column:
    """Approved approach, or standard for the divisions that always use it."""
    return F.when(one_of("division_sub2", K.OVERRIDE_DIVISIONS), F.lit(K.STD)).otherwise(
        F.col("approved_approach_code")
    )



def ig_exclusion_flag() -> Column:
    month = F.coalesce(F.col("year_month").cast("int"), F.lit(0))
    ring_fence = F.coalesce(F.col("v_icb_eff_from_year_month_rk").cast("int"), F.lit(0))
    core_to_core = F.coalesce(F.col("v_core_ig_eff_year_month_rk").cast("int"), F.lit(0))
    taker, on = F.upper("risk_taker_group_structure"), F.upper("risk_on_group_structure")
    taker_gs, on_gs, unit = F.upper("risk_taker_gs_code"), F.upper("risk_on_gs_code"), F.upper("risk_taker_ll_rru")
    closed_before = taker.isNotNull() & on.isNotNull() & ~_pairs(taker, on, OPEN_STRUCTURES)
    open_after = (
        _pairs(taker_gs, on_gs, OPEN_GROUP_PAIRS)
        | equals(unit, EXEMPT_UNIT)
        | ((month >= core_to_core) & _pairs(taker_gs, on_gs, (("CORE", "CORE"),)))
    )
    closed_after = (
        ~equals(on_gs, CROSS_REFERENCE)
        & taker_gs.isNotNull()
        & on_gs.isNotNull()
        & unit.isNotNull()
        & ~open_after
    )
    closed = F.when(month < ring_fence, closed_before).otherwise(closed_after)
    overridden = equals(F.upper("override_value"), "Y")
    entity = F.col("dim_ctrpty_risk_entity_class")
    other_entity = entity.isNotNull() & ~one_of(entity, COUNTED_ENTITY_CLASSES)
    return first_match(
        [
            (one_of("reporting_regulator_code", EXEMPT_REGULATORS), F.lit("N")),
            (
                equals(F.upper("internal_transaction_flag"), "Y"),
                _yes_no(overridden | other_entity | closed),
            ),
        ],
        F.lit(""),
    )


def reported_class(name: str = "b2_std_asset_class_basel_exposure_type") -> Column:
    """Non-credit rows report as other items, equity and governments excepted."""
    is_other = equals("reporting_type_code", "NC") & ~one_of(name, (K.EQUITY, K.CENTRAL_GOVERNMENT))
    return F.when(is_other, F.lit(K.OTHER_ITEMS)).otherwise(F.col(name))


def internal_class_target() -> Column:
    """Sub-class an internal-ratings row reports under."""
    reg = F.col("b2_irb_asset_class_reg_exposure_type")
    method = F.col("rwa_calc_method")
    return first_match(
        [
            (
                equals(reg, "Corporates") & equals(method, "AIRB - SL PD/LGD Approach"),
                F.lit("RWA Calc Under AIRB - SL PD/LGD"),
            ),
            (
                equals(reg, "Corporates") & equals(method, "AIRB - SL Slotting Approach"),
                F.lit("RWA Calc Under AIRB - SL Slotting"),
            ),
            (equals(reg, "RET"), F.col("corep_irb_exposure_sub_type")),
        ],
        F.col("b2_irb_asset_class_basel_exposure_sub_type"),
    )


def internal_report_flag(approach: Column) -> Column:
    same = F.col("b2_irb_asset_class_basel_exposure_sub_type").eqNullSafe(internal_class_target())
    listed = same & equals("dac_type", "COREP_IRB") & equals("dac_valid_flag", "Y")
    excluded = listed & one_of(
        "b2_irb_asset_class_reg_exposure_type",
        ("Equities", "Non-credit Obligation Assets", "Securitisation Positions"),
    )
    return _yes_no(equals(approach, K.AIRB) & equals("basel_data_flag", "Y") & ~excluded)


def risk_type() -> Column:
    kind = text("reporting_type_code", "X")
    counterparty = one_of("aclm_product_type", K.COUNTERPARTY_PRODUCTS)
    return first_match(
        [
            (~kind.isin("MR", "OR", "SR", "NC") & ~counterparty, F.lit("CRD")),
            (counterparty & ~kind.isin("MR", "OR", "NC"), F.lit("CCR")),
            (kind == "NC", F.lit("NCA")),
            (kind == "OR", F.lit("OP")),
            ((kind == "MR") & one_of("aclm_product_type", ("CADII", "SPEC")), F.lit("MAR")),
        ],
        F.lit(""),
    )


def counterparty_sector(approach: Column) -> Column:
    """Sector name by approach from class and sub-sector; unlisted pairs are others."""
    std_class = F.col("b2_std_asset_class_basel_exposure_type")
    rules = []
    for cls, sub, name in STANDARD_SECTORS:
        match = equals(approach, K.STD) & equals(std_class, cls)
        rules.append((match if sub is None else match & equals("sub_sector", sub), F.lit(name)))
    for internal, cls, name in INTERNAL_SECTORS:
        match = (
            equals(approach, K.AIRB)
            & equals("b2_irb_asset_class_reg_exposure_type", internal)
            & equals(std_class, cls)
        )
        rules.append((match, F.lit(name)))
    return first_match(rules, F.lit("Others"))


def government_sector() -> Column:
    by_industry = (one_of("ec92_code", ("G", "H")) & one_of("bsd_marker", ("Q", "P", "S"))) | (
        equals("ec92_code", "J") & equals("bsd_marker", "C")
    )
    by_cluster = (
        equals("external_counterparty_id_temp", K.UNKNOWN_COUNTERPARTY)
        & one_of("sector_cluster", ("Sovereigns &", " Quasi Sovereigns"))
        & one_of("sub_sector", ("Local Authorities", "Other public bodies", "Central Government"))
    )
    return F.when(by_industry | by_cluster, F.lit("General Government")).otherwise(F.lit("Others"))


def memo_class() -> Column:
    """Class before default where one is known, else the internal class."""
    before = F.col("b2_std_pre_dflt_asset_class_basel_exposure_type")
    keeps_before = equals("b2_std_asset_class_basel_exposure_type", K.IN_DEFAULT) & ~one_of(
        before, (K.SECURED, "N/A")
    )
    return F.when(keeps_before, before).otherwise(F.col("b2_irb_asset_class_reg_exposure_type"))


def standard_name(name: Column) -> Column:
    """Internal class name as a standard one; other names stay."""
    return code_lookup(name, K.STANDARD_CLASS_OF, otherwise=name)


def add_flags(exposures: DataFrame, names: FlagNames | None = None) -> DataFrame:
    """Add all flags of pack A to exposures that carry their joined inputs."""
    names = names or FlagNames()
    approach = F.col("rwa_approach_code")
    first = exposures.withColumns(
        {
            "rwa_approach_code": approach_code(),
            "corep_std_asset_class_basel_exposure_type": reported_class(),
            "crd4_memo_items_exposure_type": memo_class(),
            "std_pre_dflt": _yes_no(equals(names.prior_approach, K.STD) & equals(names.prior_class, K.IN_DEFAULT)),
            "airb_pre_dflt": _yes_no(equals(names.prior_approach, K.AIRB) & equals(names.prior_pd, 1.0)),
        }
    )
    known = ~equals("external_counterparty_id_temp", K.UNKNOWN_COUNTERPARTY)
    memo = text("crd4_memo_items_exposure_type")
    is_memo = equals("memo_b2_std_type", "B2_STD")
    on_internal = equals(effective_approach(), K.AIRB)
    return first.withColumns(
        {
            "ig_exclusion_flag": ig_exclusion_flag(),
            "std_risk_weight_ratio": F.when(equals(approach, K.AIRB), F.lit(0.0)).otherwise(
                F.col("b2_std_risk_weight_ratio")
            ),
            "crd4_rep_std_flag": _yes_no(
                equals(approach, K.STD)
                & ~equals("corep_std_asset_class_basel_exposure_type", K.SECURITISATION)
                & equals("basel_data_flag", "Y")
            ),
            "crd4_rep_irbeq_flag": _yes_no(
                equals(approach, K.AIRB)
                & equals("crd4_rep_irbeq_reg_exposure_type", "Equities")
                & equals("basel_data_flag", "Y")
            ),
            "crd4_rep_irb_flag": internal_report_flag(approach),
            "default_fund_contrib_indicator": code_lookup(
                F.col("regulatory_product_type"), {"PR_DFP_ESTAR": "P", "PR_DFC_ESTAR": "C"}, F.lit("N")
            ),
            "lrfe_ufe_flag": _yes_no(one_of("fi_avc_category", ("1", "2"))),
            "sme_flag": _yes_no(
                one_of(
                    "b2_irb_asset_class_reg_exposure_sub_type",
                    ("Corporates with turnover < Eur 50M", "Retail SME"),
                )
            ),
            "qccp_flag": text("external_counterparty_qccp_flag"),
            "slotting_residual_maturity": first_match(
                [
                    (F.col("residual_maturity_days").isNull(), F.lit("")),
                    (F.col("residual_maturity_days") < K.SHORT_MATURITY_DAYS, F.lit("< 2.5 YEARS")),
                ],
                F.lit(">= 2.5 YEARS"),
            ),
            "risk_type": risk_type(),
            "c33_exposure_sector": government_sector(),
            "retail_obligor_count": F.when(
                equals("obligor_type", "RETAIL"), F.coalesce(F.col("obligors_count"), F.lit(0))
            ).otherwise(F.lit(0)),
            "pd_band_code": F.when(
                on_internal & ~is_blank("dim_pd_band_code"), F.col("dim_pd_band_code")
            ).otherwise(F.lit("-1")),
            "mgs": F.when(
                on_internal & (F.coalesce(F.col("dim_mgs"), F.lit(0)) != 0), F.col("dim_mgs")
            ).otherwise(F.lit(-1)),
            "external_counterparty_id": F.coalesce(
                F.col("external_counterparty_id_temp"), F.concat(text("csys_id"), F.lit("_"), text("csys_code"))
            ),
            "crd4_memo_items_asset_class_basel_exposure_type": F.when(is_memo, standard_name(memo)).otherwise(
                F.lit("N/A")
            ),
            "crd4_memo_items_asset_class_reg_exposure_type": F.when(is_memo, F.col("memo_b2_std_reg_exposure_type")),
            "crd4_memo_items_asset_class_basel_exposure_sub_type": F.when(
                is_memo, F.col("memo_b2_std_basel_exposure_sub_type")
            ).otherwise(F.lit("N/A")),
            "crd4_memo_basel_exposure_type": standard_name(F.col("memo_b2_std_basel_exposure_type")),
            "b2_irb_obsrvd_new_default_flag": _yes_no(
                F.col("external_counterparty_id_temp").isNotNull()
                & known
                & equals("approved_approach_code", K.AIRB)
                & (F.coalesce(F.col("b2_app_adjusted_pd_ratio"), F.lit(K.DEFAULT_PD)) == 1.0)
                & ~equals("airb_pre_dflt", "Y")
            ),
            "b2_std_obsrvd_new_default_flag": _yes_no(
                known
                & equals("approved_approach_code", K.STD)
                & equals("b2_irb_asset_class_basel_exposure_type", K.IN_DEFAULT)
                & ~equals("std_pre_dflt", "Y")
            ),
        }
    )


FLAG_COLUMNS = (
    "rwa_approach_code",
    "corep_std_asset_class_basel_exposure_type",
    "crd4_memo_items_exposure_type",
    "std_pre_dflt",
    "airb_pre_dflt",
    "ig_exclusion_flag",
    "std_risk_weight_ratio",
    "crd4_rep_std_flag",
    "crd4_rep_irbeq_flag",
    "crd4_rep_irb_flag",
    "default_fund_contrib_indicator",
    "lrfe_ufe_flag",
    "sme_flag",
    "qccp_flag",
    "slotting_residual_maturity",
    "risk_type",
    "c33_exposure_sector",
    "retail_obligor_count",
    "pd_band_code",
    "mgs",
    "external_counterparty_id",
    "crd4_memo_items_asset_class_basel_exposure_type",
    "crd4_memo_items_asset_class_reg_exposure_type",
    "crd4_memo_items_asset_class_basel_exposure_sub_type",
    "crd4_memo_basel_exposure_type",
    "b2_irb_obsrvd_new_default_flag",
    "b2_std_obsrvd_new_default_flag",
)
