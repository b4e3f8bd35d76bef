"""Fixed values of the reporting domain.

Everything here is data: codes, class names and tables that results must
carry as they stand. Nothing in the operators depends on them.
"""

# --- fixed values: regulators, flows, categories -------------------------
UK, IRELAND, NETHERLANDS, GERMANY = "UK-FSA", "CBI", "NL-DNB", "DE-BBK"
FAN_OUT_REGULATORS = ("DE-BBK", "NL-DNB", "CBI")
EXPOSURE, INFLOW = "EXPOSURE", "INFLOW"
ON, OFF = "ON BALANCE SHEET", "OFF BALANCE SHEET"
STD, AIRB = "STD", "AIRB"

# --- fixed values: product types ------------------------------------------
COUNTERPARTY_PRODUCTS = ("BASEL-OTC", "REPO")
UNDRAWN_PRODUCTS = ("UNDRAWN-COMM", "OFF_BALANCE")
DRAWN_PRODUCTS = ("RETAIL", "ON_BALANCE")
OTHER_ON_BALANCE_PRODUCTS = ("EQUITY", "NCA")

# --- fixed values: divisions that always report on the standard approach --
OVERRIDE_DIVISIONS = (
    "CITIZENS2001",
    "CITIZENS2002",
    "CITIZENS2003",
    "CITIZENS2001_NC",
    "CITIZENS2002_NC",
    "CITIZENS2003_NC",
)
OVERRIDE_DIVISION = "CITIZENS"

# --- fixed values: asset classes ------------------------------------------
CENTRAL_GOVERNMENT = "Exposures to central governments or central banks"
REGIONAL_GOVERNMENT = "Exposures to regional governments or local authorities"
PUBLIC_SECTOR = "Exposures to public sector entities"
INTERNATIONAL = "Exposures to international organisations"
INSTITUTIONS = "Exposures to institutions"
CORPORATES = "Exposures to corporates"
RETAIL = "Retail exposures"
SECURED = "Exposures Secured by Immovable Property"
IN_DEFAULT = "Exposures in default"
HIGH_RISK = "Exposures associated with particularly high risk"
EQUITY = "Equity Claims"
OTHER_ITEMS = "Other items"
SECURITISATION = "Items representing securitisation positions"
RESIDENTIAL_MORTGAGE = "Secured by mortgages on residential property"
COLLECTIVE_INVESTMENT = "Collective Investment Undertakings"

# --- fixed values: class name to report sheet -----------------------------
SHEET_OF_CLASS = {
    CENTRAL_GOVERNMENT: "STD0002",
    REGIONAL_GOVERNMENT: "STD0003",
    PUBLIC_SECTOR: "STD0004",
    "Exposures to multilateral development banks": "STD0005",
    INTERNATIONAL: "STD0006",
    INSTITUTIONS: "STD0007",
    CORPORATES: "STD0008",
    RETAIL: "STD0009",
    SECURED: "STD0010",
    IN_DEFAULT: "STD0011",
    HIGH_RISK: "STD0012",
    "Exposures in the form of covered bonds": "STD0013",
    "Exposures to institutions and corporates with a  short-term credit assessment": "STD0014",
    "Exposures in the form of units or shares in collective investment undertakings ('CIUs')": "STD0015",
    EQUITY: "STD0016",
    OTHER_ITEMS: "STD0017",
}
TOTAL_SHEET = "STD0001"

# --- fixed values: internal class name to standard class name --------------
STANDARD_CLASS_OF = {
    "Equities": EQUITY,
    "Central Governments and Central Banks": CENTRAL_GOVERNMENT,
    "Corporates": CORPORATES,
    "Institutions": INSTITUTIONS,
    "Non-credit Obligation Assets": OTHER_ITEMS,
    "Retail": RETAIL,
}

# --- fixed values: risk weight to report row -------------------------------
ROW_OF_RISK_WEIGHT = {
    0.00: "R0140",
    0.02: "R0150",
    0.04: "R0160",
    0.10: "R0170",
    0.20: "R0180",
    0.35: "R0190",
    0.50: "R0200",
    0.70: "R0210",
    0.75: "R0220",
    1.00: "R0230",
    1.50: "R0240",
    2.50: "R0250",
    3.70: "R0260",
    13.50: "R0270",
}
ROW_OF_OTHER_RISK_WEIGHT = "R0280"

# --- fixed values: rule texts behind two report columns --------------------
RATED_RULES = (
    "RW set for Regional Government or Local Authority where valid rating exists for the counterparty (CQS Risk Weight Mapping RDS table)",
    "RW set for Admin and Non Commercial Undertaking where valid rating exists for the counterparty (CQS Risk Weight Mapping RDS table)",
)
GOVERNMENT_RATED_RULES = (
    "RW set for Regional Government or Local Authority where counterparty is unrated so Central government rating is used (CQS Risk Weight Mapping RDS table)",
    "RW set for Admin and Non Commercial Undertaking where counterparty is unrated so Central government rating is used (CQS Risk Weight Mapping RDS table)",
    "RW set for Unrated Institution where Original Effective Maturity > 3 months using Central government rating (CQS Risk Weight Mapping RDS table)",
)

# --- fixed values: limits and defaults --------------------------------------
UNKNOWN_COUNTERPARTY = "UnKnown"
DEFAULT_PD = 0.02501
DEFAULT_INFRA_FACTOR = 0.75
RISK_WEIGHT_LIMIT = 9999.0
NO_UNIT = -9999999999
SHORT_MATURITY_DAYS = 913

# --- fixed values: null defaults per layer ----------------------------------
EXPOSURE_DEFAULTS = {
    "b2_irb_asset_class_reg_exposure_sub_type": "",
    "approved_approach_code": "",
    "b2_std_asset_class_basel_exposure_type": "",
    "reporting_type_code": "",
    "b2_app_ead_post_crm_amt": 0.0,
    "ifrs9_tot_regu_ecl_amt_gbp": 0.0,
    "provision_amount_gbp": 0.0,
    "corep_product_category": "UNKNOWN",
    "b3_cva_provision_amt": 0.0,
    "b2_std_rwa_post_crm_amt": 0.0,
    "b2_app_rwa_post_crm_amt": 0.0,
    "retail_off_bal_sheet_flag": "X",
    "b2_std_drawn_rwa": 0.0,
    "b2_std_undrawn_rwa": 0.0,
    "aclm_product_type": "",
    "b2_irb_undrawn_rwa": 0.0,
    "b2_app_adjusted_pd_ratio": 0.0,
    "b2_app_adjusted_lgd_ratio": 0.0,
    "b2_irb_drawn_ead": 0.0,
    "b2_irb_undrawn_ead": 0.0,
    "bank_base_role_code": "",
    "off_bal_led_exp_gbp_post_sec": 0.0,
    "undrawn_commitment_amt_pst_sec": 0.0,
    "off_balance_exposure": 0.0,
    "undrawn_commitment_amt": 0.0,
    "b2_irb_effective_maturity_yrs": 0.0,
    "b2_irb_drawn_expected_loss": 0.0,
    "b2_app_expected_loss_amt": 0.0,
    "unsettled_price_difference_amt": 0.0,
}
SUB_EXPOSURE_DEFAULTS = {
    "b2_std_eff_gtee_amt": 0.0,
    "b2_std_eff_cds_amt": 0.0,
    "b2_std_gtee_cds_rwa": 0.0,
    "corep_crm_category": "",
    "sec_discntd_b2_irb_garntee_amt": 0.0,
    "double_default_flag": "N",
    "b2_irb_gtee_amt": 0.0,
    "b2_irb_coll_amt": 0.0,
    "b2_std_fx_haircut": 0.0,
    "b2_std_elig_coll_amt": 0.0,
}

# --- fixed values: aggregate mart -------------------------------------------
AGGREGATE_MEASURES = (
    "b2_irb_orig_exp_pre_con_factor",
    "b2_irb_provisions_amt",
    "ead_post_crm_amt",
    "ead_lgd_numerator",
    "ead_pd_numerator",
    "rwa_post_crm_amount",
    "b2_app_expected_loss_amt",
    "unsettled_amount",
    "unsettled_price_difference_amt",
)
