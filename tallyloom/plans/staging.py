"""Staging job: facts of several sources to one exposure layout, and sub-exposures.

The sources are united first, rows are routed to the reporting branches they
belong to, and one chain of dimension lookups then serves all branches. Each
fact is scanned once and each role of a dimension is joined once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import equals, first_match, first_valid_key, one_of, pick, z
from tallyloom.operators.filters import RegimeRule, latest_snapshot, regime_value, valid_on
from tallyloom.operators.joins import asked_rows, band_join, effective_dated_join, lookup, packed_lookup, scalar_lookup
from tallyloom.operators.setops import union_branches
from tallyloom.operators.sizing import broadcast_if_small, fits_broadcast
from tallyloom.sources.tables import parameter_month, parameter_value

# --- fixed values: systems with their own regime -----------------------------
UK_SYSTEMS = ("SABFUKOR", "MUREUKOR", "MTH_OTH", "DAY_OTH")
EU_SYSTEMS = ("SABFI2OR", "MUREX2OR", "MTH_OTH", "DAY_OTH")
EU_DUAL_SYSTEMS = ("SABFI2OR", "MUREX2OR")
EU_ALL_SYSTEMS = ("SABFIMOR", "MUREXOR", "SABFI2OR", "MUREX2OR")
NETTING_EXCLUDED_SYSTEMS = ("ACBCNTNW", "ACBCNTRB", "LNIQNWTR", "LNIQRBTR")
GERMAN_UNITS = ("NWBDEUAI", "NWMDEUAI")
IRISH_UNIT_TOKEN = "UBIL"
LEGACY_PROVISION_COUNTERPARTY = "Z6VR0IT"
LEGACY_PROVISION_PREFIX = "AR2956"
UNKNOWN_AREA = "Unknown Geographic Area"

# --- fixed values: parameter names --------------------------------------------
DIVERGENCE_PARAMETER = "PRA_DIVERGENCE_EFF_DATE"
DUAL_REPORTING_PARAMETER = "CRR2_DUAL_REP_EFF_DATE"
RING_FENCE_PARAMETER = "ICB_EFFECTIVE_DATE"
CORE_TO_CORE_PARAMETER = "CORE_TO_CORE_IG_EXP_EFF_DATE"
INFRA_FACTOR_PARAMETER = "INFRADISCOUNTFACTOR"

_COUNTERPARTY = K.COUNTERPARTY_PRODUCTS


def _since_divergence(systems: Sequence[str], jurisdiction: str | None) -> tuple[RegimeRule, RegimeRule]:
    """From the divergence month on; without a jurisdiction column only blank cuts count."""
    inner = [RegimeRule(other_than_systems=systems, blank_cut=True, blank_jurisdiction=jurisdiction is not None)]
    if jurisdiction is not None:
        inner.insert(0, RegimeRule(systems=systems, cut="4", jurisdiction=jurisdiction))
    return (
        RegimeRule(since="divergence", products=_COUNTERPARTY, within=tuple(inner)),
        RegimeRule(since="divergence", other_than_products=_COUNTERPARTY),
    )


_EU_DUAL = (
    RegimeRule(systems=EU_DUAL_SYSTEMS, crr2=True, cut="4"),
    RegimeRule(other_than_systems=EU_ALL_SYSTEMS, crr2=False, blank_cut=True),
)

UK_RULES = (
    *_since_divergence(UK_SYSTEMS, "UK"),
    RegimeRule(since="dual", before="divergence", crr2=False, blank_cut=True),
    RegimeRule(before="dual"),
)
DUTCH_RULES = (
    *_since_divergence(EU_SYSTEMS, "EU"),
    RegimeRule(since="dual", before="divergence", within=_EU_DUAL),
    RegimeRule(before="dual"),
)
OTHER_RULES = (
    *_since_divergence(EU_SYSTEMS, None),
    RegimeRule(since="dual", before="divergence", within=_EU_DUAL),
    RegimeRule(before="dual"),
)
IRISH_RULES = (
    *_since_divergence(EU_SYSTEMS, "EU"),
    RegimeRule(before="divergence", within=_EU_DUAL),
)


def basel_rules(keep_flag: Column, jurisdiction: bool = True) -> tuple[RegimeRule, ...]:
    """Rules that raise the basel flag outside the UK; else the given flag."""
    raised = RegimeRule(systems=EU_SYSTEMS, cut="4", jurisdiction="EU", keep="Y")
    return (
        RegimeRule(
            since="divergence",
            products=_COUNTERPARTY,
            within=(raised,) if jurisdiction else (RegimeRule(keep=keep_flag),),
        ),
        RegimeRule(
            since="dual",
            before="divergence",
            within=(RegimeRule(systems=EU_DUAL_SYSTEMS, crr2=True, cut="4", keep="Y"),),
        ),
    )


@dataclass(frozen=True)
class Branch:
    """One reporting branch of a source fact."""

    source: str
    regulator: str | None
    rules: tuple[RegimeRule, ...]
    raise_basel: bool = True
    has_jurisdiction: bool = True
    condition: Column | None = None


def default_branches() -> tuple[Branch, ...]:
    return (
        Branch("exposures", K.UK, UK_RULES, raise_basel=False),
        Branch("exposures_dnb", K.NETHERLANDS, DUTCH_RULES),
        Branch(
            "exposures_oth",
            None,
            OTHER_RULES,
            has_jurisdiction=False,
            condition=F.col("reporting_regulator_code").isin(K.GERMANY, K.UK, K.NETHERLANDS)
            & one_of("unit_ll_rru", GERMAN_UNITS),
        ),
        Branch(
            "exposures",
            K.IRELAND,
            IRISH_RULES,
            condition=F.coalesce(F.col("unit_llp_rru").contains(IRISH_UNIT_TOKEN), F.lit(False)),
        ),
    )


def route_branches(facts: DataFrame, branches: Sequence[Branch], months: Mapping[str, object]) -> DataFrame:
    """One row per branch a fact row belongs to; rows of no branch go.

    ``facts`` carries ``_source``. Branch columns are set here: regulator,
    deal prefix, basel flag.
    """
    tests = []
    for i, b in enumerate(branches):
        holds = (F.col("_source") == b.source) & regime_value(b.rules, months, False)
        tests.append(F.when(holds if b.condition is None else holds & b.condition, F.lit(i)))
    routed = facts.withColumn("_branch", F.explode(F.array_compact(F.array(*tests))))
    given = F.col("basel_data_flag")
    basel = first_match(
        [
            (F.col("_branch") == i, regime_value(basel_rules(given, b.has_jurisdiction), months, given))
            for i, b in enumerate(branches)
            if b.raise_basel
        ]
        or [(F.lit(False), given)],
        given,
    )
    regulator = first_match(
        [(F.col("_branch") == i, F.lit(b.regulator)) for i, b in enumerate(branches) if b.regulator],
        F.col("reporting_regulator_code"),
    )
    return routed.withColumns(
        {
            "basel_data_flag": basel,
            "reporting_regulator_code": regulator,
            "deal_id": F.concat(F.coalesce(F.col("deal_id_prefix"), F.lit("")), F.col("deal_id")),
            "adjust_flag": F.lit("A"),
        }
    )


def is_in_run(df: DataFrame, month: int, day: int) -> DataFrame:
    """Valid rows of the run's month and day; the month is the partition column."""
    return df.where(
        (F.col("year_month_rk") == month) & (F.col("day_rk") == day) & (F.col("valid_flag") == "Y")
    )


# Role of a dimension: name, table, dimension key, fact key, columns kept.
CLASS_COLUMNS = ("type", "reg_exposure_type", "basel_exposure_type", "basel_exposure_sub_type")
DIMENSION_ROLES = (
    ("irb", "asset_class", "asset_class_rk", "b2_irb_asset_class_rk",
     (*CLASS_COLUMNS, "reg_exposure_sub_type", "valid_flag", "asset_class_rk")),
    ("std", "asset_class", "asset_class_rk", "b2_std_asset_class_rk", CLASS_COLUMNS),
    ("corep", "asset_class", "asset_class_rk", "corep_asset_class_rk", CLASS_COLUMNS),
    ("pre", "asset_class", "asset_class_rk", "b2_std_pre_dflt_asset_class_rk", CLASS_COLUMNS),
    ("div", "division", "division_rk", "division_rk", ("sub1", "sub2", "sub3", "sub4", "sub5", "division")),
    ("pd_model", "model", "model_rk", "pd_model_rk", ("model_code",)),
    ("ead_model", "model", "model_rk", "ead_model_rk", ("model_code",)),
    ("prod", "product", "product_rk", "product_rk", ("aiml_product_type", "regulatory_product_type", "high_prod")),
    ("on_unit", "unit", "rru_rk", "risk_on_rru_rk", ("ll_rru", "ll_rru_desc")),
    ("incorp", "country", "country_rk", "incorp_country_rk", ("p3_country_desc", "country_desc")),
    ("op", "country", "country_rk", "op_country_rk", ("p3_country_desc", "country_desc")),
    ("ind", "industry", "industry_rk", "industry_rk", ("sector_type", "sector", "sector_cluster", "sub_sector")),
)
REC_COLUMNS = ("mortgages_flag", "product_family_code", "b2_std_ccf_less_than_year", "b2_std_ccf_more_than_year")
LEDGER_COLUMNS = ("bspl_900_gl_code", "bspl_60_gl_code", "ias39_class")
CENTRE_COLUMNS = ("cost_centre", "cost_centre_type", "le")
PARTY_COLUMNS = (
    "own_rk",
    "own_cis_code",
    "own_risk_entity_class",
    "own_qccp",
    "own_sys_id",
    "own_sys_code",
    "own_fi_avc_category",
    "bsd_marker",
    "branch_ciscode",
    "branch_risk_class",
    "industry_sector_type",
    "ec92_code",
    "ler_child_counterparty",
    "dim_ctrpty_risk_entity_class",
    "override_value",
)
JOIN_KEYS = (
    *dict.fromkeys(role[3] for role in DIMENSION_ROLES),
    "gl_account_rk",
    "cost_centre_rk",
    "counterparty_rk",
    "corep_product_category_rk",
    "std_rw_priority_order_rule_rk",
)


def party_profile(tables: Mapping[str, DataFrame], date: str, month: int, day: int) -> DataFrame:
    """Everything a deal takes from its counterparty, one row per counterparty.

    Parents, industry, the counterparty that answers for the group and its
    exclusion all depend on the counterparty alone, so they are looked up per
    counterparty and not per deal.
    """
    parties = latest_snapshot(tables["counterparty"], "snap_dt", date)
    monthly = is_in_run(tables["counterparties"], month, day).select(
        F.col("counterparty_rk").alias("party_rk"),
        F.col("ec92_industry_rk").alias("_industry"),
        F.col("branch_parent_counterparty_rk").alias("_parent"),
        "bsd_marker",
    )
    own = parties.select(
        F.col("counterparty_rk").alias("own_rk"),
        *[
            F.col(c).alias("own_" + c)
            for c in ("cis_code", "risk_entity_class", "qccp", "sys_id", "sys_code", "fi_avc_category")
        ],
    )
    rows = monthly.join(own, F.col("party_rk") == F.col("own_rk"), "full").withColumn(
        "party_rk", F.coalesce(F.col("party_rk"), F.col("own_rk"))
    )
    industry = valid_on(tables["industry"], date).select(
        F.col("industry_rk").alias("_ik"),
        F.col("sector_type").alias("industry_sector_type"),
        F.nullif(F.col("uk_sic_code"), F.lit("UNKNOWN")).alias("ec92_code"),
    )
    rows = lookup(rows, industry, {"_industry": "_ik"})
    whole_book = (
        valid_on(tables["cost_centre"], date)
        .where(F.col("wbu_counterparty_rk") != -1)
        .groupBy("wbu_counterparty_rk")
        .agg(F.max("le_counterparty_rk").alias("_le_of_wbu"))
    )
    rows = lookup(rows, whole_book, {"own_rk": "wbu_counterparty_rk"})
    internal = parties.where(F.col("group_internal_flag") == "Y").select(
        F.col("counterparty_rk").alias("_w"), F.col("counterparty_rk").alias("_wbu_parent")
    )
    rows = lookup(rows, internal, {"_le_of_wbu": "_w"})
    parent = parties.select(
        F.col("counterparty_rk").alias("_p"),
        F.col("counterparty_rk").alias("_parent_rk"),
        F.col("cis_code").alias("branch_ciscode"),
        F.col("risk_entity_class").alias("branch_risk_class"),
    )
    rows = lookup(rows, parent, {"_parent": "_p"})
    rows = rows.withColumn("ler_child_counterparty", first_valid_key("_wbu_parent", "_parent_rk", "own_rk"))
    child = parties.select(
        F.col("counterparty_rk").alias("_c"),
        F.col("risk_entity_class").alias("dim_ctrpty_risk_entity_class"),
        F.col("cis_code").alias("_child_cis"),
    )
    rows = lookup(rows, child, {"ler_child_counterparty": "_c"})
    exclusions = (
        valid_on(tables["override"], date)
        .where(equals("override_rule", "EXC_IG_CIS") & equals("override_reason", "CIS EXCLUSION"))
        .select(F.col("overridden_value").alias("_ov"), "override_value")
    )
    return lookup(rows, exclusions, {"_child_cis": "_ov"}).select("party_rk", *PARTY_COLUMNS)


@dataclass(frozen=True)
class DealSide:
    """Columns of the deals that a later job reads, met while the facts are still narrow.

    Both steps get rows with ``year_month``, ``reporting_regulator_code`` and
    ``_deal``, the id without prefix, and add columns to them: ``by_key`` to
    distinct keys, with ``deal_id``, and ``by_deal`` to the facts themselves,
    from rows that lie by deal as the facts do. ``key_columns`` and
    ``deal_columns`` are kept.
    """

    key_columns: Sequence[str]
    deal_columns: Sequence[str]
    by_key: Callable[[DataFrame], DataFrame]
    by_deal: Callable[[DataFrame], DataFrame]

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.key_columns, *self.deal_columns)


def attach_deal_side(
    rows: DataFrame, tables: Mapping[str, DataFrame], date: str, month: int, day: int, more: DealSide | None = None
) -> DataFrame:
    """The deal's record and its counterparty's columns, in one join by deal.

    Facts are wide, their keys are not: counterparties meet the distinct pairs
    of deal and counterparty, and these the records, so that the facts are
    shuffled once and by deal. Where the counterparties can be broadcast, no
    pairs are made. What ``more`` knows by key joins the pairs, what it knows
    by deal the facts, and it comes packed as ``side``. Facts that lie by deal
    are not shuffled then: pairs and records come to them.
    """
    rec = is_in_run(tables["exposures_rec"], month, day)
    party = party_profile(tables, date, month, day)
    if more is not None:
        named = {"_deal": "_deal", "counterparty_rk": "counterparty_rk", "fact.reporting_regulator_code": "reporting_regulator_code", "fact.deal_id": "deal_id"}
        pairs = rows.select(*[F.col(c).alias(n) for c, n in named.items()]).distinct()
        pairs = more.by_key(pairs.withColumn("year_month", F.lit(month)))
        pairs = packed_lookup(pairs, party, "counterparty_rk", "party_rk", "party", PARTY_COLUMNS, spread_by=("_deal",), sentinels=(-1,))
        keys = {f"_s{i}": c for i, c in enumerate(named)}
        side = pairs.select(*[F.col(named[c]).alias(s) for s, c in keys.items()], "party", F.struct(*more.key_columns).alias("_by_key"))
        # A deal id is never null in the layer; as a plain key it lets rows that lie by deal stay.
        met = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(s)) for s, c in keys.items() if c != "_deal"], F.col("_deal") == F.col("_s0"))
        work = {"year_month": F.lit(month), "reporting_regulator_code": F.col("fact.reporting_regulator_code")}
        rows = more.by_deal(packed_lookup(rows, rec, "_deal", "deal_id", "rec", REC_COLUMNS).withColumns(work))
        rows = rows.join(side, met, "left").drop(*keys)
        packed = F.struct(*[F.col(f"_by_key.{c}") for c in more.key_columns], *more.deal_columns)
        return rows.withColumn("side", packed).drop(*work, "_by_key", *more.deal_columns)
    if fits_broadcast(party):
        rows = packed_lookup(rows, rec, "_deal", "deal_id", "rec", REC_COLUMNS)
        return packed_lookup(rows, party, "counterparty_rk", "party_rk", "party", PARTY_COLUMNS)
    pairs = rows.select("_deal", "counterparty_rk").distinct()
    pairs = packed_lookup(pairs, party, "counterparty_rk", "party_rk", "party", PARTY_COLUMNS, spread_by=("_deal",), sentinels=(-1,))
    side = packed_lookup(pairs, rec, "_deal", "deal_id", "rec", REC_COLUMNS)
    side = side.select(F.col("_deal").alias("_sd"), F.col("counterparty_rk").alias("_sp"), "rec", "party")
    met = rows["_deal"].eqNullSafe(side["_sd"]) & rows["counterparty_rk"].eqNullSafe(side["_sp"])
    return rows.join(side, met, "left").drop("_sd", "_sp")


def attach_dimensions(
    facts: DataFrame, tables: Mapping[str, DataFrame], date: str, month: int, day: int, more: DealSide | None = None
) -> DataFrame:
    """All lookups of the staging job as one chain over packed columns."""
    normal_product = F.when(F.upper("aclm_product_type") == "N/A", F.lit("UNKNOWN")).otherwise(F.upper("aclm_product_type"))
    rows = facts.select(
        *JOIN_KEYS,
        F.col("_fact_deal_id").alias("_deal"),
        normal_product.alias("_product"),
        F.col("b2_irb_effective_maturity_yrs").alias("_years"),
        F.col("b2_app_adjusted_pd_ratio").alias("_pd"),
        F.struct("*").alias("fact"),
    )
    rows = attach_deal_side(rows, tables, date, month, day, more)
    for name, table, dim_key, fact_key, keep in DIMENSION_ROLES:
        rows = packed_lookup(rows, valid_on(tables[table], date), fact_key, dim_key, name, keep)
    legal = latest_snapshot(tables["counterparty"], "snap_dt", date).select(
        F.col("counterparty_rk").alias("_l"), F.col("cis_code").alias("le")
    )
    current = valid_on(tables["cost_centre"], date).where(F.col("valid_flag") == "Y")
    centres = lookup(current, legal, {"le_counterparty_rk": "_l"})
    # One row per centre, and per ledger below, whatever the planned size of the join.
    centres = F.broadcast(centres) if fits_broadcast(current) else centres
    rows = packed_lookup(rows, centres, "cost_centre_rk", "cost_centre_rk", "cc", CENTRE_COLUMNS)
    accounts = valid_on(tables["ledger"], date)
    classes = tables["ledger_map"].select(F.col("bspl800_code").alias("_bc"), "ias39_class")
    ledgers = lookup(accounts, classes, {"bspl_800_gl_code": "_bc"})
    ledgers = F.broadcast(ledgers) if fits_broadcast(accounts) else ledgers
    rows = packed_lookup(rows, ledgers, "gl_account_rk", "gl_rk", "ledger", LEDGER_COLUMNS)
    categories = tables["product_category"]
    rows = packed_lookup(
        rows, categories, "_product", "aclm_product_type", "cat", ("corep_product_category", "corep_product_category_rk")
    )
    rows = packed_lookup(
        rows,
        categories,
        "corep_product_category_rk",
        "corep_product_category_rk",
        "exposure_cat",
        ("corep_product_category", "aclm_product_type"),
    )
    rows = packed_lookup(rows, tables["rule"], "std_rw_priority_order_rule_rk", "rule_rk", "rule", ("rule_desc",))
    maturity = valid_on(tables["maturity_band"].where(F.col("type") == "S"), date)
    rows = band_join(rows, maturity, "_years", ["maturity_band_desc"])
    grades = valid_on(tables["pd_band"].where(F.col("type") == "MGS"), date).select(
        "lower_value",
        "upper_value",
        "lower_val_inclusive",
        "upper_val_inclusive",
        F.col("mgs").alias("dim_mgs"),
        F.col("pd_band_code").alias("dim_pd_band_code"),
    )
    return band_join(rows, grades, "_pd", ["dim_mgs", "dim_pd_band_code"], default=K.DEFAULT_PD)


def unpack(rows: DataFrame, more: DealSide | None = None) -> DataFrame:
    """The packed columns as flat ones, prefixed by their role."""
    roles = [(name, keep) for name, _, _, _, keep in DIMENSION_ROLES]
    roles += [
        ("cat", ("corep_product_category", "corep_product_category_rk")),
        ("exposure_cat", ("corep_product_category", "aclm_product_type")),
    ]
    flat = [F.col(f"{name}.{c}").alias(f"{name}_{c}") for name, keep in roles for c in keep]
    plain = (("party", PARTY_COLUMNS), ("rec", REC_COLUMNS), ("ledger", LEDGER_COLUMNS), ("cc", CENTRE_COLUMNS), ("rule", ("rule_desc",)))
    own_names = [F.col(f"{name}.{c}").alias(c) for name, keep in plain for c in keep]
    side = ["side.*"] if more is not None else []
    return rows.select("fact.*", *flat, *own_names, "maturity_band_desc", "dim_mgs", "dim_pd_band_code", *side)


def retail_sub_class() -> Column:
    """Sub-class of retail rows: revolving, secured by property, other; SME or not."""
    sme = equals("pers_acc_flag", "N")
    secured = equals("comm_real_estate_sec_flag", "Y") | equals("mortgages_flag", "Y")
    retail = equals("corep_basel_exposure_type", "Retail") & equals("corep_basel_exposure_sub_type", "N/A")
    return first_match(
        [
            (~retail, F.col("corep_basel_exposure_sub_type")),
            (equals("qual_rev_exp_flag", "Y"), F.lit("Qualifying Revolving Exposures")),
            (secured & sme, F.lit("Secured by Real Estate Property - SME")),
            (secured, F.lit("Secured by Real Estate Property - Non-SME")),
            (sme, F.lit("Other Retail Exposures - SME")),
        ],
        F.lit("Other Retail Exposures - Non-SME"),
    )


def approach_method() -> Column:
    """Calculation method, first match wins."""
    corporate = equals("irb_reg_exposure_type", "Corporates")
    return first_match(
        [
            (
                equals("reporting_regulator_code", K.IRELAND)
                & equals("b2_app_adjusted_pd_ratio", 1.0)
                & equals("irb_reg_exposure_sub_type", "Income Producing Real Estate")
                & equals("irb_basel_exposure_type", "Corporate")
                & equals("definitive_slot_category_calc", "N"),
                F.lit("AIRB - SL PD/LGD Approach"),
            ),
            (
                equals("prod_regulatory_product_type", "PR_EQ_CIU") | equals("pd_model_model_code", "SRW"),
                F.lit("AIRB - Equity Simple Risk Weight"),
            ),
            (equals("pd_model_model_code", "SG"), F.lit("AIRB - SL PD/LGD Approach")),
            (
                corporate & one_of("irb_reg_exposure_sub_type", ("Object Finance", "Commodities Finance")),
                F.lit("AIRB - SL PD/LGD Approach"),
            ),
            (
                corporate & one_of("irb_reg_exposure_sub_type", ("Income Producing Real Estate", "Project Finance")),
                F.lit("AIRB - SL Slotting Approach"),
            ),
        ],
        F.lit("AIRB - PD/LGD Approach"),
    )


def deal_type() -> Column:
    """Kind of a non-credit deal, from a token in its id (underscore literal)."""
    other = equals("exposure_cat_aclm_product_type", "NCA")
    return first_match(
        [
            (other & F.col("deal_id").contains("_SI"), F.lit("SI")),
            (other & F.col("deal_id").contains("_DTA"), F.lit("DT")),
            (other & F.col("deal_id").contains("_NSI"), F.lit("NSI")),
        ],
        F.lit(None).cast("string"),
    )


def derive_columns(rows: DataFrame, other_items_key: Column, parameters: Mapping[str, Column]) -> DataFrame:
    """Flags, classes and picked amounts of a staged exposure."""
    override = one_of("div_sub2", K.OVERRIDE_DIVISIONS)
    non_credit = equals("reporting_type_code", "NC") & F.coalesce(
        ~F.col("std_basel_exposure_type").isin(K.EQUITY, K.CENTRAL_GOVERNMENT), F.lit(False)
    )
    specialised = equals("pd_model_model_code", "LC") | (
        one_of("irb_reg_exposure_sub_type", ("Income Producing Real Estate", "Project Finance"))
        & equals("irb_basel_exposure_type", "Corporate")
    )
    netted = ~one_of("sys_code", NETTING_EXCLUDED_SYSTEMS)
    return rows.withColumns(
        {
            "citizens_override_flag": F.when(override, F.lit("Y")).otherwise(F.lit("N")),
            "crd4_rep_stdflow_flag": F.lit("N"),
            "flow_type": F.lit(K.EXPOSURE),
            "ead_post_crm_amt": pick(override, z("b2_std_ead_post_crm_amt"), z("b2_app_ead_post_crm_amt")),
            "b2_app_rwa_post_crm_amt": F.when(
                F.col("_source") == "exposures_dnb",
                pick(specialised, "b2_irb_rwa_post_crm_amt", "b2_std_rwa_post_crm_amt"),
            ).otherwise(F.col("b2_app_rwa_post_crm_amt")),
            "b2_std_netted_coll_gbp": F.when(
                netted, z("gross_dep_utilisation_amt") - z("net_dep_utilisation_amt")
            ).otherwise(F.lit(0.0)),
            "b2_std_ccf_input": z("b2_std_ccf") / F.lit(100.0),
            "corep_std_basel_exposure_type": F.when(non_credit, F.lit(K.OTHER_ITEMS)).otherwise(
                F.col("std_basel_exposure_type")
            ),
            "corep_std_asset_class_rk": F.when(non_credit, other_items_key).otherwise(F.col("b2_std_asset_class_rk")),
            "corep_product_category": F.when(
                F.col("cat_corep_product_category_rk") == -1, F.lit("UNKNOWN")
            ).otherwise(F.col("cat_corep_product_category")),
            "corep_irb_exposure_sub_type": retail_sub_class(),
            "aclm_product_type": F.upper("aclm_product_type"),
            "rwa_calc_method": approach_method(),
            "imp_write_off_amt": z("ifrs9_prov_write_off_amt_gbp"),
            "crd4_rep_cva_flag": F.when(F.col("b3_cva_cc_rwa_amt").isNotNull(), F.lit("Y")).otherwise(F.lit("N")),
            "crd4_rep_settl_flag": F.when(equals("reporting_type_code", "SR"), F.lit("Y")).otherwise(F.lit("N")),
            "rep_provision_type": F.when(
                equals("own_cis_code", LEGACY_PROVISION_COUNTERPARTY)
                | F.col("deal_id").startswith(LEGACY_PROVISION_PREFIX),
                F.lit("OTHER"),
            ).otherwise(F.lit("IFRS9")),
            "deal_type": deal_type(),
            "std_sme_discount_app_flag": F.when(
                equals("approved_approach_code", K.STD), F.col("b3_sme_discount_flag")
            ),
            "ler_child_counterparty": F.coalesce(F.col("ler_child_counterparty"), F.lit(-1)),
            "obligor_type": first_match(
                [(z("b2_app_ead_post_crm_amt") == 0, F.lit("NULL EAD")), (equals("counterparty_rk", -1), F.lit("RETAIL"))],
                F.lit("CORP"),
            ),
            "corep_incorp_p3_country_desc": F.coalesce(F.col("incorp_p3_country_desc"), F.lit(UNKNOWN_AREA)),
            "corep_incorp_country_desc": F.coalesce(F.col("incorp_country_desc"), F.lit(UNKNOWN_AREA)),
            **parameters,
        }
    )


# Staged name of a joined column.
STAGED_NAMES = {
    "year_month_rk": "year_month",
    "irb_reg_exposure_type": "b2_irb_asset_class_reg_exposure_type",
    "irb_reg_exposure_sub_type": "b2_irb_asset_class_reg_exposure_sub_type",
    "irb_basel_exposure_type": "b2_irb_asset_class_basel_exposure_type",
    "irb_basel_exposure_sub_type": "b2_irb_asset_class_basel_exposure_sub_type",
    "irb_type": "dac_type",
    "irb_valid_flag": "dac_valid_flag",
    "irb_asset_class_rk": "dac_asset_class_rk",
    "std_basel_exposure_type": "b2_std_asset_class_basel_exposure_type",
    "std_basel_exposure_sub_type": "memo_b2_std_basel_exposure_sub_type",
    "std_reg_exposure_type": "memo_b2_std_reg_exposure_type",
    "std_type": "memo_b2_std_type",
    "pre_basel_exposure_type": "b2_std_pre_dflt_asset_class_basel_exposure_type",
    "pre_basel_exposure_sub_type": "b2_std_pre_dflt_asset_class_basel_exposure_sub_type",
    "pre_reg_exposure_type": "b2_std_pre_dflt_asset_class_reg_exposure_type",
    "pre_type": "b2_std_pre_dflt_asset_class_type",
    "div_sub2": "division_sub2",
    "div_division": "division",
    "pd_model_model_code": "pd_model_code",
    "ead_model_model_code": "ead_model_code",
    "prod_aiml_product_type": "aiml_product_type",
    "prod_regulatory_product_type": "regulatory_product_type",
    "prod_high_prod": "high_prod",
    "unit_ll_rru": "risk_taker_ll_rru",
    "unit_ll_rru_desc": "risk_taker_ll_rru_desc",
    "unit_llp_rru": "llp_rru",
    "on_unit_ll_rru": "risk_on_ll_rru",
    "on_unit_ll_rru_desc": "risk_on_ll_rru_desc",
    "op_country_desc": "op_country_name",
    "ind_sector_type": "sector_type",
    "ind_sector": "sector",
    "ind_sector_cluster": "sector_cluster",
    "ind_sub_sector": "sub_sector",
    "own_cis_code": "external_counterparty_id_temp",
    "own_risk_entity_class": "external_counterparty_risk_class",
    "own_qccp": "external_counterparty_qccp_flag",
    "own_sys_id": "csys_id",
    "own_sys_code": "csys_code",
    "own_fi_avc_category": "fi_avc_category",
    "exposure_cat_corep_product_category": "corep_exposure_category",
}
WORK_COLUMNS = (
    "_source",
    "_branch",
    "_fact_deal_id",
    "b2_std_ccf",
    "own_rk",
    "cat_corep_product_category",
    "cat_corep_product_category_rk",
    "exposure_cat_aclm_product_type",
    "corep_type",
    "corep_reg_exposure_type",
    "corep_basel_exposure_type",
    "corep_basel_exposure_sub_type",
)


def internal_report_class(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Key and class an internal-ratings row reports under, from many candidates.

    The wanted sub-class is derived as a column; classes whose sub-class does
    not matter match any. The smallest candidate is taken, so a rerun repeats.
    """
    reported = tables["asset_class"].where(equals("type", "COREP_IRB") & equals("valid_flag", "Y"))
    candidates = reported.select(
        F.col("basel_exposure_type").alias("c_type"),
        F.explode(F.array(F.col("basel_exposure_sub_type"), F.lit("*"))).alias("c_sub_type"),
        F.col("asset_class_rk").alias("c_key"),
        F.col("reg_exposure_type").alias("c_reg"),
    )
    reg, method = F.col("b2_irb_asset_class_reg_exposure_type"), F.col("rwa_calc_method")
    any_sub_class = one_of(
        reg,
        (
            "Central Governments and Central Banks",
            "Institutions",
            "Non-credit Obligation Assets",
            "Equities",
            "Securitisation Positions",
        ),
    )

    def wanted(is_retail: Column) -> Column:
        return first_match(
            [
                (any_sub_class, F.lit("*")),
                (
                    equals(reg, "Corporates") & equals(method, "AIRB - SL PD/LGD Approach"),
                    F.lit("RWA Calc Under AIRB - SL PD/LGD"),
                ),
                (
                    equals(reg, "Corporates") & equals(method, "AIRB - SL Slotting Approach"),
                    F.lit("RWA Calc Under AIRB - SL Slotting"),
                ),
                (is_retail, F.col("corep_irb_exposure_sub_type")),
            ],
            F.col("b2_irb_asset_class_basel_exposure_sub_type"),
        )

    work = rows.withColumns({"_key_sub": wanted(equals(reg, "Retail")), "_reg_sub": wanted(equals("type", "RET"))})
    match_type = "b2_irb_asset_class_basel_exposure_type"
    work = scalar_lookup(
        work,
        {match_type: "c_type", "_key_sub": "c_sub_type"},
        candidates,
        {"c_key": "corep_irb_asset_class_rk"},
        {"corep_irb_asset_class_rk": -1},
    )
    work = scalar_lookup(
        work,
        {match_type: "c_type", "_reg_sub": "c_sub_type"},
        candidates,
        {"c_reg": "crd4_rep_irbeq_reg_exposure_type"},
    )
    return work.drop("_key_sub", "_reg_sub")


SOURCE_OPTIONAL = ("deal_id_prefix", "jurisdiction_flag", "reporting_regulator_code")


def unite_sources(tables: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """The source facts as one frame, tagged with their source."""
    tagged = []
    for name in names:
        source = tables[name]
        absent = {c: F.lit(None).cast("string") for c in SOURCE_OPTIONAL if c not in source.columns}
        source = source.withColumns(absent) if absent else source
        tagged.append(source.withColumn("_source", F.lit(name)))
    return union_branches(tagged)


def run_keys(date: str) -> tuple[int, int]:
    """Month and day key of a reporting date."""
    return int(date[:4] + date[5:7]), int(date[:10].replace("-", ""))


def stage_exposures(
    tables: Mapping[str, DataFrame],
    date: str,
    branches: Sequence[Branch] | None = None,
    facts: DataFrame | None = None,
    more: DealSide | None = None,
) -> DataFrame:
    """Exposure staging for one reporting date (ISO text).

    ``facts`` may hold the united sources already (see ``unite_sources``);
    the columns of ``more`` stand beside the staged ones.
    """
    branches = default_branches() if branches is None else branches
    month, day = run_keys(date)
    if facts is None:
        facts = unite_sources(tables, list(dict.fromkeys(b.source for b in branches)))
    facts = is_in_run(facts, month, day).where(F.col("adjust_flag").isin("U", "A"))
    facts = facts.withColumn("_fact_deal_id", F.col("deal_id"))
    facts = effective_dated_join(
        facts, tables["unit"], {"rru_rk": "rru_rk"}, date, ("ll_rru", "ll_rru_desc", "llp_rru"), prefix="unit_"
    )
    months = {
        "divergence": parameter_month(tables["etl_parameter"], DIVERGENCE_PARAMETER),
        "dual": parameter_month(tables["etl_parameter"], DUAL_REPORTING_PARAMETER),
    }
    routed = route_branches(facts, branches, months)
    # Only rows whose internal class is known are reported.
    known = tables["asset_class"].select(F.col("asset_class_rk").alias("_ak")).distinct()
    routed = routed.join(broadcast_if_small(known), F.col("b2_irb_asset_class_rk") == F.col("_ak"), "left_semi")
    rows = unpack(attach_dimensions(routed, tables, date, month, day, more), more)
    other_items = (
        valid_on(tables["asset_class"], date)
        .where((F.col("type") == "B2_STD") & (F.col("basel_exposure_type") == K.OTHER_ITEMS))
        .agg(F.min("asset_class_rk"))
        .scalar()
    )
    parameters = {
        "v_icb_eff_from_year_month_rk": parameter_month(tables["etl_parameter"], RING_FENCE_PARAMETER),
        "v_core_ig_eff_year_month_rk": parameter_month(tables["etl_parameter"], CORE_TO_CORE_PARAMETER),
        "v_infra_discount_factor": parameter_value(tables["engine_parameter"], INFRA_FACTOR_PARAMETER).cast("double"),
    }
    rows = derive_columns(rows, other_items, parameters)
    rows = rows.drop(*WORK_COLUMNS).withColumnsRenamed(STAGED_NAMES)
    rows = rows.withColumns(
        {
            "memo_b2_std_basel_exposure_type": F.col("b2_std_asset_class_basel_exposure_type"),
            "b2_std_basel_exposure_type": F.col("b2_std_asset_class_basel_exposure_type"),
            "b2_std_asset_class_basel_exposure_sub_type": F.col("memo_b2_std_basel_exposure_sub_type"),
            "incorp_p3_country_desc": F.col("incorp_p3_country_desc"),
            "op_country_desc": F.col("op_p3_country_desc"),
            "incorp_country_desc": F.col("incorp_p3_country_desc"),
            "risk_taker_rru": F.col("rru_rk"),
            "risk_on_rru": F.col("risk_on_rru_rk"),
        }
    )
    return internal_report_class(rows, tables)


def stage_sub_exposures(tables: Mapping[str, DataFrame], date: str) -> DataFrame:
    """Sub-exposure staging: two sources, then copies for the other regulators."""
    return for_all_regulators(sub_exposure_rows(tables, date))


def for_all_regulators(rows: DataFrame, codes: Sequence[str] = (K.UK, *K.FAN_OUT_REGULATORS)) -> DataFrame:
    """Rows of the first regulator for each of the codes; other rows as they are."""
    return rows.withColumn("reporting_regulator_code", F.explode(regulators_of(F.col("reporting_regulator_code"), codes)))


def regulators_of(own: Column, codes: Sequence[str] = (K.UK, *K.FAN_OUT_REGULATORS)) -> Column:
    """Regulators that a row of a regulator is reported to."""
    return F.when(own == K.UK, F.array(*map(F.lit, codes))).otherwise(F.array(own))


def provider_classes(tables: Mapping[str, DataFrame], date: str) -> DataFrame:
    """Class of each counterparty; where they are many, of those that provide protection."""
    month, day = run_keys(date)
    providers = is_in_run(tables["counterparties"], month, day).select(
        F.col("counterparty_rk").alias("_p"), F.col("b2_std_asset_class_rk").alias("provider_b2_std_asset_class")
    )
    named = [is_in_run(tables[t], month, day).select("provider_counterparty_rk") for t in ("sub_exposures", "sub_exposures_oth")]
    return asked_rows(providers, "_p", union_branches(named))


def sub_exposure_rows(tables: Mapping[str, DataFrame], date: str, providers: DataFrame | None = None) -> DataFrame:
    """Sub-exposures of their own regulator, before they are copied for the others.

    ``providers`` may hold the classes already (see ``provider_classes``).
    """
    month, day = run_keys(date)
    uk = is_in_run(tables["sub_exposures"], month, day).withColumn("reporting_regulator_code", F.lit(K.UK))
    german = is_in_run(tables["sub_exposures_oth"], month, day).where(
        F.col("reporting_regulator_code") == K.GERMANY
    )
    facts = uk.unionByName(german, allowMissingColumns=True).drop("sys_code", "adjust_flag")
    mitigants = is_in_run(tables["mitigants"], month, day).select(
        F.col("mitigant_id").alias("_m"), "sys_code", "adjust_flag", "sys_protection_type", "basel_security_sub_type"
    )
    rows = facts.join(mitigants, F.col("mitigant_id") == F.col("_m"), "inner").drop("_m")
    kinds = valid_on(tables["mitigant_type"], date).select(F.col("mitigant_type_rk").alias("_t"), "mitigant_type")
    rows = rows.join(broadcast_if_small(kinds), F.col("mitigant_type_rk") == F.col("_t"), "inner").drop("_t")
    collateral = valid_on(tables["collateral_type"], date).select(
        F.col("collateral_type_rk").alias("_c"), "collateral_type_code"
    )
    rows = lookup(rows, collateral, {"collateral_type_rk": "_c"})
    providers = provider_classes(tables, date) if providers is None else providers
    rows = lookup(rows, providers, {"provider_counterparty_rk": "_p"})
    return rows.withColumns(
        {
            "b2_std_eff_gtee_amt": z("b2_std_eff_gtee_amt"),
            "b2_std_eff_cds_amt": z("b2_std_eff_cds_amt"),
            "corep_std_asset_class_rk": F.coalesce(F.col("provider_b2_std_asset_class"), F.lit(-1)),
            "flow_type": F.lit(K.INFLOW),
        }
    ).withColumnRenamed("year_month_rk", "year_month")
