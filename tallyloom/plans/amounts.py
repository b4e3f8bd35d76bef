"""Rule pack B: exposure, risk-weighted and provision amounts of an exposure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import amount_if, equals, first_match, one_of, pick, text, z

# --- fixed values: provisions and accounting exposure -----------------------
LEGACY_PROVISION_COUNTERPARTY = "Z6VROIT"
LEGACY_PROVISION_DEAL = "AR2956"
NET_EXPOSURE_PRODUCTS = ("Term Loan", "Revolver Receivable")
NET_EXPOSURE_LEDGERS = (
    "RBSSUBR18013100000",
    "150005412013100000",
    "RBSSUBR04013100000",
    "RBSSUBL01013100000",
    "RBSSUB110013100000",
    "150021259013100000",
)
GROSS_ADD_ON_CENTRES = (
    "OVERSGMPF",
    "OVERS7GMP",
    "OVERS7GIB",
    "NCOREZUE1",
    "NCOREGMP1",
    "GREENZUEF",
    "GREENCAPP",
    "GREENCAPH",
    "GREENCHUE",
    "OVERS7HMP",
)
CONTINGENT_LEDGER = "XCONTLIAB"


def _overridden() -> Column:
    return equals("citizens_override_flag", "Y")


def _retail_split() -> Column:
    """Retail deals whose drawn and undrawn parts report separately."""
    return equals(F.upper("retail_off_bal_sheet_flag"), "Y")


def _on_balance() -> Column:
    return equals("corep_product_category", K.ON)


def _off_balance() -> Column:
    return equals("corep_product_category", K.OFF)


def chosen(std: str, approved: str) -> Column:
    """Standard amount for overridden divisions, else the approved one."""
    return pick(_overridden(), z(std), z(approved))


def _decided() -> Column:
    """The override flag is a definite yes or no; other values report nothing."""
    return one_of(F.upper("citizens_override_flag"), ("Y", "N"))


def on_balance_part(std: str, approved: str) -> Column:
    """On-balance share: drawn share of split deals, else all of on-balance deals."""
    amount = chosen(std, approved)
    counts = _on_balance() | one_of("aclm_product_type", K.OTHER_ON_BALANCE_PRODUCTS)
    return first_match(
        [
            (_on_balance() & _retail_split(), amount * F.col("ret_rwa_post_crm_amt_pct")),
            (counts & ~_retail_split() & _decided(), amount),
        ],
        F.lit(0.0),
    )


def off_balance_part(std: str, approved: str) -> Column:
    """Off-balance share: the undrawn share of split deals, else all of off-balance deals."""
    amount = chosen(std, approved)
    return first_match(
        [
            (_on_balance() & _retail_split(), amount * (F.lit(1.0) - F.col("ret_rwa_post_crm_amt_pct"))),
            (_off_balance() & _decided(), amount),
        ],
        F.lit(0.0),
    )


def internal_on_balance(drawn: str, full: str) -> Column:
    """Drawn amount of split deals; nothing for undrawn and counterparty products."""
    return first_match(
        [
            (one_of("aclm_product_type", K.DRAWN_PRODUCTS) & _retail_split(), z(drawn)),
            (one_of("aclm_product_type", K.UNDRAWN_PRODUCTS + K.COUNTERPARTY_PRODUCTS), F.lit(0.0)),
        ],
        z(full),
    )


def internal_off_balance(undrawn: str, full: str) -> Column:
    """Undrawn amount of split deals; all of undrawn products."""
    return first_match(
        [
            (one_of("aclm_product_type", K.DRAWN_PRODUCTS) & _retail_split(), z(undrawn)),
            (one_of("aclm_product_type", K.UNDRAWN_PRODUCTS), z(full)),
        ],
        F.lit(0.0),
    )


def drawn_share() -> Column:
    whole = z("b2_std_drawn_rwa") + z("b2_std_undrawn_rwa")
    divisor = F.when(whole == 0, F.lit(1.0)).otherwise(whole)
    return F.when(_retail_split(), z("b2_std_drawn_rwa") / divisor).otherwise(F.lit(1.0))


def conversion_factor() -> Column:
    """Given factor, or one of three steps from the off-balance usage ratio."""
    share = first_match(
        [
            (_on_balance() & _retail_split(), F.lit(1.0) - F.col("ret_rwa_post_crm_amt_pct")),
            (_off_balance(), F.lit(1.0)),
        ],
        F.lit(0.0),
    )
    part = share * chosen("b2_std_ead_post_crm_amt", "b2_app_ead_post_crm_amt")
    base = z("undrawn_commitment_amt") + z("off_balance_exposure")
    usage = part / F.when(base == 0, F.lit(1.0)).otherwise(base)
    given = z("b2_std_ccf_input")
    step = first_match([(usage < 0.35, F.lit(0.2)), (usage <= 0.75, F.lit(0.5))], F.lit(1.0))
    derive = equals("rwa_approach_code", K.STD) & (part != 0) & (given == 0)
    return F.when(derive, step).otherwise(given)


def _with_ledger() -> Column:
    return one_of(F.upper("aclm_product_type"), K.UNDRAWN_PRODUCTS + K.DRAWN_PRODUCTS)


def internal_off_balance_original() -> Column:
    participant = equals(F.upper("bank_base_role_code"), "P")
    amount = pick(
        participant,
        z("off_bal_led_exp_gbp_post_sec") + z("undrawn_commitment_amt_pst_sec"),
        z("off_balance_exposure") + z("undrawn_commitment_amt"),
    )
    return amount_if(one_of("aclm_product_type", K.UNDRAWN_PRODUCTS + K.DRAWN_PRODUCTS), amount)


def standard_off_balance_original() -> Column:
    """As the internal one; pooled deals use their commitments by maturity."""
    participant = equals("bank_base_role_code", "P")
    pooled = F.length(text("grdw_pool_id")) > 0
    ledger = pick(participant, z("off_bal_led_exp_gbp_post_sec"), z("off_balance_exposure"))
    commitment = first_match(
        [
            (pooled, z("comm_less_than_1_year") + z("comm_more_than_1_year")),
            (participant, z("undrawn_commitment_amt_pst_sec")),
        ],
        z("undrawn_commitment_amt"),
    )
    return amount_if(_with_ledger(), ledger + commitment)


def accounting_exposure() -> Column:
    centre = text("cost_centre")
    ledger = F.concat(centre, text("bspl_900_gl_code"))
    contingent = equals("bspl_60_gl_code", CONTINGENT_LEDGER) & (F.abs(z("off_balance_exposure")) > 0)
    base = first_match(
        [
            (equals("aclm_product_type", "NCA"), z("b2_app_ead_post_crm_amt")),
            (one_of("aclm_product_type", K.UNDRAWN_PRODUCTS), F.lit(0.0)),
            (
                one_of("aiml_product_type", NET_EXPOSURE_PRODUCTS) | ledger.isin(*NET_EXPOSURE_LEDGERS),
                z("net_exposure"),
            ),
            (contingent, F.lit(0.0)),
        ],
        z("drawn_ledger_balance"),
    )
    interest = first_match(
        [
            (equals("approved_approach_code", K.AIRB), z("b2_irb_interest_at_default_gbp")),
            (equals("approved_approach_code", K.STD), z("accrued_interest_gbp")),
        ],
        F.lit(0.0),
    )
    add_on = amount_if(
        centre.isin(*GROSS_ADD_ON_CENTRES)
        & equals("internal_transaction_flag", "N")
        & equals("basel_data_flag", "Y"),
        z("e_star_gross_exposure"),
    )
    return base + interest + add_on - z("rep_provision_amt_gbp")


def add_amounts(exposures: DataFrame) -> DataFrame:
    """Add all amounts of pack B; needs the approach code of pack A."""
    legacy = equals("external_counterparty_id_temp", LEGACY_PROVISION_COUNTERPARTY) | F.coalesce(
        F.col("deal_id").contains(LEGACY_PROVISION_DEAL), F.lit(False)
    )
    pd, lgd, years = z("b2_app_adjusted_pd_ratio"), z("b2_app_adjusted_lgd_ratio"), z("b2_irb_effective_maturity_yrs")
    first = exposures.withColumns(
        {
            "rep_provision_amt_gbp": z("ifrs9_tot_regu_ecl_amt_gbp") + amount_if(legacy, z("provision_amount_gbp")),
            "ret_rwa_post_crm_amt_pct": drawn_share(),
            "b2_irb_ead_amt_onbal": internal_on_balance("b2_irb_drawn_ead", "b2_app_ead_post_crm_amt"),
            "b2_irb_ead_amt_ofbal": internal_off_balance("b2_irb_undrawn_ead", "b2_app_ead_post_crm_amt"),
            "irb_orig_exp_pre_conv_ofbal": internal_off_balance_original(),
            "std_orig_exp_pre_conv_ofbal": standard_off_balance_original(),
            "b2_std_orig_exp_pre_con_factor_exp": z("b2_std_orig_exp_pre_con_factor")
            + amount_if(one_of("aclm_product_type", K.COUNTERPARTY_PRODUCTS), z("b3_cva_provision_amt")),
        }
    )
    provision = z("rep_provision_amt_gbp") + z("b3_cva_provision_amt")
    on_ead, off_ead = F.col("b2_irb_ead_amt_onbal"), F.col("b2_irb_ead_amt_ofbal")
    ead = z("b2_app_ead_post_crm_amt")
    second = first.withColumns(
        {
            "b2_irb_provisions_amt": z("rep_provision_amt_gbp"),
            "b2_std_provisions_amt": provision,
            "b2_std_provisions_amt_onbal": amount_if(
                one_of("corep_product_category", (K.ON, "N/A", "UNKNOWN")), provision
            ),
            "b2_std_provisions_amt_ofbal": amount_if(_off_balance(), provision),
            "rwa_post_crm_amount": chosen("b2_std_rwa_post_crm_amt", "b2_app_rwa_post_crm_amt"),
            "ead_pre_crm_amt": chosen("b2_std_ead_pre_crm_amt", "b2_app_ead_pre_crm_amt"),
            "b2_std_rwa_post_crm_amt_onbal": on_balance_part("b2_std_rwa_post_crm_amt", "b2_app_rwa_post_crm_amt"),
            "b2_std_rwa_post_crm_amt_ofbal": off_balance_part("b2_std_rwa_post_crm_amt", "b2_app_rwa_post_crm_amt"),
            "b2_std_ead_post_crm_amt_onbal": on_balance_part("b2_std_ead_post_crm_amt", "b2_app_ead_post_crm_amt"),
            "b2_std_ead_post_crm_amt_ofbal": off_balance_part("b2_std_ead_post_crm_amt", "b2_app_ead_post_crm_amt"),
            "b2_irb_rwa_amt_onbal": internal_on_balance("b2_irb_drawn_rwa", "b2_app_rwa_post_crm_amt"),
            "b2_irb_rwa_amt_ofbal": internal_off_balance("b2_irb_undrawn_rwa", "b2_app_rwa_post_crm_amt"),
            "b2_irb_el_amt_onbal": internal_on_balance("b2_irb_drawn_expected_loss", "b2_app_expected_loss_amt"),
            "b2_irb_el_amt_ofbal": internal_off_balance("b2_irb_undrawn_expected_loss", "b2_app_expected_loss_amt"),
            "ead_pd_numerator": pd * ead,
            "ead_pd_numerator_on": pd * on_ead,
            "ead_pd_numerator_off": pd * off_ead,
            "ead_lgd_numerator": lgd * ead,
            "ead_lgd_numerator_on": lgd * on_ead,
            "ead_lgd_numerator_off": lgd * off_ead,
            "ead_mat_years_numerator": years * ead,
            "ead_mat_years_numerator_on": years * on_ead,
            "ead_mat_years_numerator_off": years * off_ead,
            "std_orig_exp_pre_conv_onbal": amount_if(
                _on_balance(), z("b2_std_orig_exp_pre_con_factor_exp") - z("std_orig_exp_pre_conv_ofbal")
            ),
            "b2_std_ccf": conversion_factor(),
            "ra_ad_exp": accounting_exposure(),
        }
    )
    return second.withColumn(
        "b2_std_fully_adj_exp_ccf_0", amount_if(z("b2_std_ccf") == 0, z("std_orig_exp_pre_conv_ofbal"))
    )


AMOUNT_COLUMNS = (
    "rep_provision_amt_gbp",
    "ret_rwa_post_crm_amt_pct",
    "b2_irb_ead_amt_onbal",
    "b2_irb_ead_amt_ofbal",
    "irb_orig_exp_pre_conv_ofbal",
    "std_orig_exp_pre_conv_ofbal",
    "b2_std_orig_exp_pre_con_factor_exp",
    "b2_irb_provisions_amt",
    "b2_std_provisions_amt",
    "b2_std_provisions_amt_onbal",
    "b2_std_provisions_amt_ofbal",
    "rwa_post_crm_amount",
    "ead_pre_crm_amt",
    "b2_std_rwa_post_crm_amt_onbal",
    "b2_std_rwa_post_crm_amt_ofbal",
    "b2_std_ead_post_crm_amt_onbal",
    "b2_std_ead_post_crm_amt_ofbal",
    "b2_irb_rwa_amt_onbal",
    "b2_irb_rwa_amt_ofbal",
    "b2_irb_el_amt_onbal",
    "b2_irb_el_amt_ofbal",
    "ead_pd_numerator",
    "ead_pd_numerator_on",
    "ead_pd_numerator_off",
    "ead_lgd_numerator",
    "ead_lgd_numerator_on",
    "ead_lgd_numerator_off",
    "ead_mat_years_numerator",
    "ead_mat_years_numerator_on",
    "ead_mat_years_numerator_off",
    "std_orig_exp_pre_conv_onbal",
    "b2_std_ccf",
    "ra_ad_exp",
    "b2_std_fully_adj_exp_ccf_0",
)
