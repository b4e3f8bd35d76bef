"""Regulatory return: conditional sums, report rows, totals and skeleton.

The conditional sums and the report rows are the same for both reporting
categories, so they are computed once and only the last step differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.functions.columns import code_lookup, equals, one_of, z
from tallyloom.operators.aggregates import conditional_sums, exact_sum, group_sum
from tallyloom.operators.filters import valid_on
from tallyloom.operators.reshape import CellRow, measures_of, route_by_value, route_rows, spread_cells
from tallyloom.operators.setops import union_branches

# --- fixed values: input selection ------------------------------------------------
RETURN_REGULATORS = (K.UK, K.IRELAND)
GROUP_REGULATORS = (K.UK, K.IRELAND, K.NETHERLANDS)
CATEGORIES = ("INTRA", "ALL")
SECURITIES_FINANCING, DERIVATIVES = "SECURITIES FINANCING", "DERIVATIVES"

# --- fixed values: memo classes ---------------------------------------------------
MEMO_CLASSES = (
    K.CENTRAL_GOVERNMENT,
    K.REGIONAL_GOVERNMENT,
    K.PUBLIC_SECTOR,
    K.INSTITUTIONS,
    K.CORPORATES,
    K.RETAIL,
)

MEASURE_KEYS = (
    "year_month",
    "reporting_regulator_code",
    "risk_taker_rru",
    "risk_on_rru",
    "internal_transaction_flag",
    "ig_exclusion_flag",
    "division",
    "b3_sme_rp_flag",
    "retail_pool_sme_flag",
    "transitional_portfolio_flag",
    "corep_product_category",
    "qccp_flag",
    "b3_sme_discount_flag",
    "crr2_501a_discount_flag",
    "reporting_type_code",
    "crd4_memo_basel_exposure_type",
    "std_act_risk_weight",
    "b2_std_basel_exposure_type",
    "basel_exposure_type",
    "reg_exposure_type",
)
# Columns of the mart that the return reads, those with an on and an off balance part first.
_IN_PARTS = (
    "b2_std_exposure_value",
    "b2_std_crm_tot_inflow",
    "b2_std_crm_tot_outflow",
    "b2_std_provisions_amt",
    "b2_std_rwa_amt",
    "b2_std_rwa_pre_sprt_amt",
)
RETURN_INPUTS = (
    *(name + part for name in _IN_PARTS for part in ("", "_onbal", "_ofbal")),
    # The classes come from the key of the asset class.
    *(k for k in MEASURE_KEYS if k not in ("crd4_memo_basel_exposure_type", "basel_exposure_type", "reg_exposure_type")),
    "crd4_memo_items_asset_class_basel_exposure_type",
    "corep_std_asset_class_rk",
    "rwa_approach_code",
    "adjust_flag",
    "crd4_rep_std_flag",
    "crd4_rep_stdflow_flag",
    "aclm_product_type",
    "basel_data_flag",
    "default_fund_contrib_indicator",
    "b2_std_fully_adj_exp_ccf_0",
    "b2_std_fully_adj_exp_ccf_20",
    "b2_std_fully_adj_exp_ccf_50",
    "b2_std_fully_adj_exp_ccf_100",
    "b2_std_eff_fin_coll_amt",
    "b2_std_netted_coll_gbp",
    "b2_std_eff_gtee_amt",
    "b2_std_eff_cds_amt",
    "b2_std_oth_fun_cred_prot_amt",
    "b2_std_coll_mty_mismatch_amt",
    "b2_std_coll_volatility_amt",
    "b2_std_coll_fx_haircut_amt",
    "rule_desc",
)


def select_input(
    mart: DataFrame, asset_class: DataFrame, parameters: DataFrame, month: int, date: str
) -> DataFrame:
    """Standard-approach rows of the month in reported divisions, with their class."""
    divisions = valid_on(parameters, date).where(
        equals("param_code", "DIVISION") & equals("parameter2_value", "Y")
    )
    rows = mart.where(
        (F.col("year_month") == month)
        & F.col("reporting_regulator_code").isin(*RETURN_REGULATORS)
        & equals("rwa_approach_code", K.STD)
        & equals("adjust_flag", "A")
        & ~one_of("reporting_type_code", ("OR", "MR", "SR"))
        & (
            equals("crd4_rep_std_flag", "Y")
            | equals("crd4_rep_stdflow_flag", "Y")
            | (equals("aclm_product_type", "BASEL-OTC") & equals("basel_data_flag", "N"))
        )
        & equals("default_fund_contrib_indicator", "N")
    )
    kept = rows.join(
        divisions.select(F.col("parameter1_value").alias("_div")), F.col("division") == F.col("_div"), "left_semi"
    ).drop("crd4_memo_basel_exposure_type")
    classes = asset_class.select(F.col("asset_class_rk").alias("_ak"), "basel_exposure_type", "reg_exposure_type")
    return kept.join(classes, F.col("corep_std_asset_class_rk") == F.col("_ak"), "inner").drop("_ak").withColumn(
        "crd4_memo_basel_exposure_type", F.col("crd4_memo_items_asset_class_basel_exposure_type")
    )


def measure_table() -> dict[str, tuple[Column, Column | None]]:
    """The measures as (expression, condition); suffixes are the on, off and secured parts."""
    on, off = equals("corep_product_category", K.ON), equals("corep_product_category", K.OFF)
    steps = z("b2_std_fully_adj_exp_ccf_50") * 0.5 + z("b2_std_fully_adj_exp_ccf_20") * 0.8 + z(
        "b2_std_fully_adj_exp_ccf_0"
    )
    value = {s: z("b2_std_exposure_value" + s) for s in ("", "_onbal", "_ofbal")}
    adjusted = {"": value[""] + steps, "_onbal": value["_onbal"], "_ofbal": value["_ofbal"] + steps}
    whole_collateral = z("b2_std_eff_fin_coll_amt") + z("b2_std_netted_coll_gbp")
    part = {"": F.lit(True), "_onbal": on, "_ofbal": off}

    def counted(amount: Column, s: str) -> Column:
        return amount if s == "" else F.when(part[s], amount).otherwise(F.lit(0.0))

    collateral = {s: counted(whole_collateral, s) for s in part}
    net = {s: z("b2_std_crm_tot_inflow" + s) - z("b2_std_crm_tot_outflow" + s) for s in part}
    provisions = {s: z("b2_std_provisions_amt" + s) for s in part}
    rwa = {s: z("b2_std_rwa_amt" + s) for s in part}
    rwa_before = {s: z("b2_std_rwa_pre_sprt_amt" + s) for s in part}
    reductions = z("b2_std_coll_mty_mismatch_amt") + z("b2_std_coll_volatility_amt") + z("b2_std_coll_fx_haircut_amt")
    counterparty = one_of("corep_product_category", (SECURITIES_FINANCING, DERIVATIVES))

    table: dict[str, tuple[Column, Column | None]] = {}
    for s in ("", "_onbal", "_ofbal"):
        table["c0010" + s] = (adjusted[s] + collateral[s] - net[s] + provisions[s], None)
        table["c0030" + s] = (-provisions[s], None)
        table["c0040" + s] = (adjusted[s] + collateral[s] - net[s], None)
        table["c0050" + s] = (-counted(z("b2_std_eff_gtee_amt"), s), None)
        table["c0060" + s] = (-counted(z("b2_std_eff_cds_amt"), s), None)
        table["c0080" + s] = (-counted(z("b2_std_oth_fun_cred_prot_amt"), s), None)
        table["c0090" + s] = (-z("b2_std_crm_tot_outflow" + s), None)
        table["c0100" + s] = (z("b2_std_crm_tot_inflow" + s), None)
        table["c0110" + s] = (adjusted[s] + collateral[s], None)
        table["c0130" + s] = (-collateral[s], None)
        table["c0140" + s] = (-counted(reductions, s), None)
        table["c0150" + s] = (adjusted[s], None)
        table["c0200" + s] = (value[s], None)
        table["c0215" + s] = (rwa_before[s], None)
        table["c0216" + s] = (rwa[s] - rwa_before[s], equals("b3_sme_discount_flag", "Y"))
        table["c0217" + s] = (rwa[s] - rwa_before[s], equals("crr2_501a_discount_flag", "Y"))
        table["c0220" + s] = (rwa[s], None)
    table["c0010_mrtg"] = (adjusted[""] + whole_collateral + provisions[""], None)
    table["c0040_mrtg"] = (adjusted[""] + whole_collateral, None)
    for name, step in (("c0160", "0"), ("c0170", "20"), ("c0180", "50"), ("c0190", "100")):
        table[name] = (z("b2_std_fully_adj_exp_ccf_" + step), None)
    table["c0210"] = (value[""], counterparty)
    table["c0211"] = (value[""], counterparty & ~equals("qccp_flag", "Y"))
    table["c0230"] = (rwa[""], one_of("rule_desc", K.RATED_RULES))
    table["c0240"] = (rwa[""], one_of("rule_desc", K.GOVERNMENT_RATED_RULES))
    return table


def measures_by_attributes(rows: DataFrame, keys: Sequence[str] = MEASURE_KEYS) -> DataFrame:
    """All conditional sums in one pass, with the sheet of both classes."""
    sums = conditional_sums(rows, keys, measure_table())
    return sums.withColumns(
        {
            "sheet_id": code_lookup(F.col("basel_exposure_type"), K.SHEET_OF_CLASS),
            "memo_sheet_id": code_lookup(F.col("crd4_memo_basel_exposure_type"), K.SHEET_OF_CLASS),
        }
    )


# --- fixed values: cells of each report row ----------------------------------------
# fmt: off
SHORT_LIST = (
    "c0010", "c0030", "c0040", "c0050", "c0060", "c0080", "c0090", "c0100", "c0110", "c0130", "c0140", "c0150", "c0160", "c0170",
    "c0180", "c0190", "c0200", "c0210", "c0215", "c0216", "c0217", "c0220",
)
FULL_LIST = (
    "c0010", "c0030", "c0040", "c0050", "c0060", "c0080", "c0090", "c0100", "c0110", "c0130", "c0140", "c0150", "c0160", "c0170",
    "c0180", "c0190", "c0200", "c0210", "c0215", "c0216", "c0217", "c0220", "c0230", "c0240",
)
COUNTERPARTY_LIST = (
    "c0200", "c0210", "c0211", "c0215", "c0216", "c0217", "c0220",
)
QUALIFYING_LIST = (
    "c0200", "c0210", "c0215", "c0216", "c0217", "c0220",
)
ON_LIST = (
    "c0010_onbal", "c0030_onbal", "c0040_onbal", "c0050_onbal", "c0060_onbal", "c0080_onbal", "c0090_onbal", "c0100_onbal",
    "c0110_onbal", "c0130_onbal", "c0140_onbal", "c0150_onbal", "c0200_onbal", "c0215_onbal", "c0216_onbal", "c0217_onbal",
    "c0220_onbal",
)
OFF_LIST = (
    "c0010_ofbal", "c0030_ofbal", "c0040_ofbal", "c0050_ofbal", "c0060_ofbal", "c0080_ofbal", "c0090_ofbal", "c0100_ofbal",
    "c0110_ofbal", "c0130_ofbal", "c0140_ofbal", "c0150_ofbal", "c0160", "c0170", "c0180", "c0190", "c0200_ofbal", "c0215_ofbal",
    "c0216_ofbal", "c0217_ofbal", "c0220_ofbal",
)
WEIGHT_LIST = (
    "c0010", "c0030", "c0040", "c0150", "c0160", "c0170", "c0180", "c0190", "c0200", "c0210", "c0211", "c0215", "c0216", "c0217",
    "c0220",
)
MORTGAGE_LIST = (
    "c0010_mrtg", "c0030", "c0040_mrtg", "c0150", "c0160", "c0170", "c0180", "c0190", "c0200", "c0210", "c0215", "c0216",
    "c0217", "c0220",
)
WEIGHT_ROW_LIST = (
    "c0010", "c0030", "c0040", "c0150", "c0160", "c0170", "c0180", "c0190", "c0200", "c0210", "c0211", "c0215", "c0216", "c0217",
    "c0220", "c0230", "c0240",
)
# fmt: on


def report_rows() -> list[CellRow]:
    """Every report row: its measures, the rows it takes, and where it is routed."""
    in_default = equals("basel_exposure_type", K.IN_DEFAULT)
    memo = F.col("crd4_memo_basel_exposure_type")
    category = F.col("corep_product_category")
    ls = equals("reporting_type_code", "LS")
    financing = equals(category, SECURITIES_FINANCING) & ~ls
    derivatives = equals(category, DERIVATIVES) | ls
    qualifying = equals("qccp_flag", "Y")
    transitional = equals("transitional_portfolio_flag", "Y") | equals("division", K.OVERRIDE_DIVISION)
    residential = equals("reg_exposure_type", K.RESIDENTIAL_MORTGAGE)
    weight = F.round(F.col("std_act_risk_weight"), 3)
    germany = equals("reporting_regulator_code", K.GERMANY)
    return [
        CellRow("R0010", FULL_LIST),
        CellRow("R0015", SHORT_LIST, in_default & one_of(memo, (K.HIGH_RISK, K.EQUITY)), "memo_sheet_id"),
        CellRow("R0020", SHORT_LIST, equals("b3_sme_rp_flag", "Y") | equals("retail_pool_sme_flag", "Y")),
        CellRow("R0030", SHORT_LIST, equals("b3_sme_discount_flag", "Y")),
        CellRow("R0035", SHORT_LIST, equals("crr2_501a_discount_flag", "Y")),
        CellRow("R0040", SHORT_LIST, residential),
        CellRow("R0050", SHORT_LIST, ~transitional, blank=(SHORT_LIST, germany)),
        CellRow("R0060", SHORT_LIST, transitional, blank=(SHORT_LIST, germany)),
        CellRow("R0070", ON_LIST),
        CellRow("R0080", OFF_LIST),
        CellRow("R0090", COUNTERPARTY_LIST, financing),
        CellRow("R0100", QUALIFYING_LIST, financing & qualifying),
        CellRow("R0110", COUNTERPARTY_LIST, derivatives),
        CellRow("R0120", QUALIFYING_LIST, derivatives & qualifying),
        CellRow(
            route_by_value(F.col("std_act_risk_weight"), K.ROW_OF_RISK_WEIGHT, K.ROW_OF_OTHER_RISK_WEIGHT),
            WEIGHT_ROW_LIST,
            blank=(("c0010", "c0030", "c0040"), weight == 0.70),
        ),
        CellRow("R0283", FULL_LIST, equals("reg_exposure_type", K.COLLECTIVE_INVESTMENT)),
        CellRow(
            F.when(residential, F.lit("R0310")).otherwise(F.lit("R0290")),
            MORTGAGE_LIST,
            one_of(memo, MEMO_CLASSES) & equals("b2_std_basel_exposure_type", K.SECURED),
            "memo_sheet_id",
        ),
        CellRow(
            F.when(weight == 1.00, F.lit("R0300")).otherwise(F.lit("R0320")),
            WEIGHT_LIST,
            in_default & one_of(memo, MEMO_CLASSES) & weight.isin(1.00, 1.50),
            "memo_sheet_id",
        ),
    ]


def by_entity(rows: DataFrame, group_map: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Rows of unit pairs with the reporting entity and category they count for.

    ``ALL`` adds external business to the group's; the group part leaves out
    excluded rows. Both categories come from one join: a row is copied only
    to the categories it belongs to.
    """
    mapping = group_map.where(
        ~F.coalesce(F.col("risk_taker_ll_rru").contains("DECON"), F.lit(False))
        & F.col("risk_taker_ll_rru").isNotNull()
        & F.col("risk_taker_group").isNotNull()
    ).select(
        F.col("risk_taker_rru_rk").alias("_t"),
        F.col("risk_on_rru_rk").alias("_o"),
        F.col("year_month_rk").alias("_m"),
        F.col("internal_transaction_flag").alias("_f"),
        "risk_taker_group",
        "reporting_desc",
    )
    joined = rows.join(
        mapping,
        (rows["risk_taker_rru"] == mapping["_t"])
        & (rows["risk_on_rru"] == mapping["_o"])
        & (rows["year_month"] == mapping["_m"])
        & (rows["internal_transaction_flag"] == mapping["_f"]),
        "inner",
    )
    in_group = (
        equals("reporting_desc", "Inter Group")
        & ~equals("ig_exclusion_flag", "Y")
        & one_of("reporting_regulator_code", GROUP_REGULATORS)
    )
    external = equals("reporting_desc", "External")
    member = [F.when(in_group | external if c == "ALL" else in_group, F.lit(c)) for c in categories]
    return joined.withColumn("reportable_category", F.explode(F.array_compact(F.array(*member)))).drop("_t", "_o", "_m", "_f")


ENTITY_KEYS = ("year_month", "reporting_regulator_code", "risk_taker_group", "reportable_category")


def entity_sums(measures: DataFrame, group_map: DataFrame, rows: Sequence[CellRow], categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Wide sums per entity, category, report row and sheet, with the total sheet.

    A measure row is routed as it is, with all its measures; nothing is spread
    to cells before it is summed.
    """
    names = measures_of(rows)
    routed = route_rows(by_entity(measures, group_map, categories), [*ENTITY_KEYS, *names], rows)
    keys = [*ENTITY_KEYS, "_row", "row_id", "_blank"]
    sheets = group_sum(routed, [*keys, "sheet_id"], names)
    total = group_sum(sheets, keys, names).withColumn("sheet_id", F.lit(K.TOTAL_SHEET))
    return sheets.unionByName(total)


def entity_cells(measures: DataFrame, group_map: DataFrame, rows: Sequence[CellRow] | None = None, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Cell sums per reporting entity and category, with the total sheet.

    Only sums of entities are spread to cells. Report rows that share an id,
    and parts whose blank cells differ, meet in one last sum.
    """
    rows = report_rows() if rows is None else rows
    cells = spread_cells(entity_sums(measures, group_map, rows, categories), ENTITY_KEYS, rows)
    keys = [*ENTITY_KEYS, "row_id", F.upper("column_id").alias("column_id"), "sheet_id"]
    return cells.groupBy(*keys).agg(exact_sum(F.col("value")).alias("value"))


def cell_skeleton(
    row_columns: DataFrame,
    members: DataFrame,
    sheets: DataFrame,
    domains: DataFrame,
    parameters: DataFrame,
    returns: DataFrame,
    templates: DataFrame,
    return_rk: int,
    return_code: str,
    month: int,
    date: str,
    categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """Every cell the template names: 0 where it applies, else null."""
    current_domains = valid_on(domains, date)

    def in_domain(df: DataFrame, code: str) -> DataFrame:
        keys = current_domains.where(equals("domain_code", code)).select(F.col("domain_rk").alias("_dom"))
        return df.join(keys, F.col("domain_rk") == F.col("_dom"), "left_semi")

    template = (
        valid_on(returns, date)
        .where((F.col("return_rk") == return_rk) & (F.col("return_code") == return_code))
        .select("template_rk")
        .join(templates.select("template_rk").distinct(), "template_rk", "left_semi")
    )
    cells = row_columns.where(
        (F.col("year_month_rk") == month) & (F.col("reporting_regulator_code") == K.UK)
    ).join(template, "template_rk", "inner")
    regulators = in_domain(valid_on(members, date), "REG_CODE").select(F.col("member_code").alias("_reg"))
    entities = in_domain(valid_on(members, date), "REP_ENTITY").select(F.col("member_code").alias("_ent"))
    pairs = (
        valid_on(parameters, date)
        .where(equals("param_code", "REGULATOR_REP_ENTITY_MAP"))
        .join(regulators, F.col("parameter1_value") == F.col("_reg"), "inner")
        .join(entities, F.col("parameter2_value") == F.col("_ent"), "inner")
        .select("_reg", F.col("_ent").alias("risk_taker_group"))
    )
    wanted_sheets = in_domain(sheets.where(F.col("year_month_rk") == month), "EC_COREP_STD").select(
        F.col("reporting_regulator_code").alias("_sreg"), F.col("member_code").alias("sheet_id")
    )
    return (
        cells.join(pairs, F.col("reporting_regulator_code") == F.col("_reg"), "inner")
        .join(wanted_sheets, F.col("reporting_regulator_code") == F.col("_sreg"), "inner")
        .withColumn("reportable_category", F.explode(F.array(*[F.lit(c) for c in categories])))
        .select(
            F.lit(month).alias("year_month"),
            "reporting_regulator_code",
            "risk_taker_group",
            "reportable_category",
            "row_id",
            "column_id",
            "sheet_id",
            F.when(F.col("appl_data_point_flag") == "Y", F.lit(0.0)).alias("value"),
        )
    )


def full_return(
    cells: DataFrame, skeleton: DataFrame, run_rk: int, return_rk: int, return_code: str
) -> DataFrame:
    """Cells, totals and skeleton in the layout of the return fact."""
    names = [
        "year_month",
        "reporting_regulator_code",
        "risk_taker_group",
        "reportable_category",
        "row_id",
        "column_id",
        "sheet_id",
        "value",
    ]
    none = F.lit(None).cast("string")
    tagged = union_branches(
        [
            cells.select(*names, none.alias("for_adjust_flag")),
            skeleton.select(*names, F.lit("A").alias("for_adjust_flag")),
        ]
    )
    return tagged.select(
        F.lit(return_rk).alias("return_rk"),
        "row_id",
        "column_id",
        "reporting_regulator_code",
        "risk_taker_group",
        "for_adjust_flag",
        "value",
        F.lit(run_rk).alias("run_rk"),
        "sheet_id",
        "reportable_category",
        none.alias("group_text"),
        none.alias("text_value"),
        none.alias("division"),
        none.alias("appl_data_point_flag"),
        none.alias("extract_row_id"),
        F.col("year_month").alias("year_month_rk"),
        F.lit(return_code).alias("return_code"),
    )
