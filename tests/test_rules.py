"""Rule shapes against literal tables of inputs and expected values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import columns as C
from tallyloom.functions import periods
from tallyloom.operators.filters import RegimeRule, regime_filter
from tallyloom.plans.exposures import actual_risk_weight
from tallyloom.plans.mitigants import add_deal_caps, add_mitigant_amounts
from tallyloom.plans.staging import DUTCH_RULES, UK_RULES


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def rows(spark, data, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, " + schema)


def test_cap(spark):
    data = [(10.0, 4.0), (3.0, 4.0), (10.0, 0.0), (10.0, -5.0), (0.0, 4.0), (-1.0, 4.0), (None, 4.0), (5.0, None)]
    df = rows(spark, data, "a double, c double")
    assert column(df, C.capped_by("a", "c")) == [4.0, 3.0, 0.0, -5.0, 0.0, 0.0, 0.0, 0.0]


def test_pro_rata_parts_add_up(spark):
    df = rows(spark, [(30.0, 70.0, 50.0), (0.0, 0.0, 50.0), (None, 10.0, 5.0)], "a double, b double, t double")
    whole = C.z("a") + C.z("b")
    first = column(df, C.pro_rata("a", whole, F.col("t")))
    second = column(df, C.pro_rata("b", whole, F.col("t")))
    assert first == [15.0, 0.0, 0.0]
    assert [x + y for x, y in zip(first, second)] == [50.0, 0.0, 5.0]


def test_support_divisor(spark):
    data = [("Y", 0.75, "Y", 0.8), ("N", 0.75, "Y", 0.8), (None, 0.75, None, 0.8), ("Y", 0.0, "Y", 0.8), ("Y", None, "N", 0.8), ("N", 0.75, "Y", None)]
    df = rows(spark, data, "i1 string, f1 double, i2 string, f2 double")
    assert column(df, C.support_divisor("i1", "f1", "i2", "f2")) == [0.75, 0.8, 1.0, 1.0, 1.0, 1.0]


def test_first_valid_key_and_prefix(spark):
    df = rows(spark, [(-1, None, 7, "NLD1", "NL"), (3, 4, 5, "D1", None), (-1, -1, None, "D1", "")], "a int, b int, c int, id string, p string")
    assert column(df, C.first_valid_key("a", "b", "c")) == [7, 3, -1]
    assert column(df, C.without_prefix("id", "p")) == ["D1", "D1", "D1"]


def test_null_safe_tests(spark):
    df = rows(spark, [("A",), (None,), ("",), ("  ",), ("B",)], "c string")
    assert column(df, C.is_blank("c")) == [False, True, True, True, False]
    assert column(df, ~C.one_of("c", ("A",))) == [False, True, True, True, True]
    assert column(df, C.differs("c", "A", "X")) == [False, True, True, True, True]


def test_actual_risk_weight(spark):
    data = [
        (0.0, 0.0, 1.0, 0.35, 0.35),
        (5.0, 0.0, 1.0, 0.35, 9999.0),
        (20000.0, 1.0, 1.0, 0.35, 9999.0),
        (-1.0, 5.0, 1.0, 0.35, 9999.0),
        (1.0, -5.0, 1.0, 0.35, 9999.0),
        (75.0, 100.0, 0.75, 0.35, 1.0),
        (-2.0, -4.0, 1.0, 0.35, 0.5),
        (8000.0, 1.0, 0.75, 0.35, 9999.0),
    ]
    df = rows(spark, data, "rwa double, ead double, d double, g double, want double")
    got = column(df, actual_risk_weight(F.col("rwa"), F.col("ead"), F.col("d"), F.col("g")))
    assert got == [r[4] for r in data]


def test_quarter_arithmetic(spark):
    df = rows(spark, [(date(2001, 8, 31),), (date(2001, 1, 15),), (date(2000, 5, 31),)], "d date")
    assert column(df, periods.previous_quarter_key("d")) == [200106, 200012, 200003]
    assert column(df, F.size(periods.quarter_months("d"))) == [2, 1, 2]
    assert column(df, periods.quarter_end("d")) == [date(2001, 9, 30), date(2001, 3, 31), date(2000, 6, 30)]


REGIME = [
    # month, product, system, cut, jurisdiction, crr2, UK, Dutch
    (202201, "REPO", "SABFUKOR", "4", "UK", None, True, False),
    (202201, "REPO", "SABFI2OR", "4", "EU", None, False, True),
    (202201, "REPO", None, None, "", None, True, True),
    (202201, "REPO", "LEDGER", "3", None, None, False, False),
    (202201, None, "LEDGER", "3", "UK", "Y", True, True),
    (202112, "REPO", "LEDGER", "", None, None, True, True),
    (202112, "REPO", "LEDGER", "", None, "Y", False, False),
    (202112, "RETAIL", "MUREX2OR", "4", None, "Y", False, True),
    (202101, "REPO", "LEDGER", "9", "XX", "Y", True, True),
]


def test_regimes(spark):
    schema = "year_month_rk int, aclm_product_type string, sys_code string, capital_cuts string, jurisdiction_flag string, crr2_flag string, uk boolean, nl boolean"
    df = rows(spark, REGIME, schema)
    months = {"divergence": 202201, "dual": 202106}
    kept = {r.i for r in regime_filter(df, UK_RULES, months).collect()}
    assert kept == {i for i, r in enumerate(REGIME) if r[6]}
    kept = {r.i for r in regime_filter(df, DUTCH_RULES, months).collect()}
    assert kept == {i for i, r in enumerate(REGIME) if r[7]}
    first_wins = (RegimeRule(products=("REPO",), keep=False), RegimeRule(since="dual"))
    assert {r.i for r in regime_filter(df, first_wins, months).collect()} == {4, 7}


SUB_SCHEMA = (
    "corep_crm_category string, mitigant_type string, type string, double_default_flag string, b2_std_eff_gtee_amt double, b2_std_eff_cds_amt double, "
    "b2_std_gtee_cds_rwa double, b2_irb_gtee_amt double, sec_discntd_b2_irb_garntee_amt double, b2_irb_coll_amt double, sec_discntd_b2_irb_colltrl_amt double, "
    "b2_std_eff_coll_amt_post_hcut double, b2_std_fx_haircut double, b2_std_elig_coll_amt double, collateral_type_code string, sys_protection_type string, sys_code string"
)


@pytest.mark.parametrize(
    "row, name, want",
    [
        (("GUARANTEES", "GU", "WG", "N", 5.0, 2.0, 3.0, 9.0, 0.0), "b2_std_crm_tot_outflow_indv", 7.0),
        (("GUARANTEES", "GU", "XX", "N", 5.0, 2.0, 3.0, 9.0, 0.0), "b2_std_crm_tot_outflow_indv", 0.0),
        (("GUARANTEES", "GU", "WG", "N", 0.0, 0.0, 3.0, 9.0, 0.0), "b2_std_crm_tot_outflow_rwa_indv", 0.0),
        (("guarantees", "GU", "WG", None, 5.0, 2.0, 3.0, 9.0, 0.0), "b2_irb_crm_ufcp_guar_amt_indv", 9.0),
        (("GUARANTEES", "GU", "WG", "N", 5.0, 2.0, 3.0, 9.0, 4.0), "b2_irb_crm_ufcp_guar_amt_indv", 4.0),
        (("GUARANTEES", "GU", "WG", "Y", 5.0, 2.0, 3.0, 9.0, 4.0), "crm_ufcp_guar_amt_indv", 9.0),
        (("REAL ESTATE", "CO", "WG", "N", 0.0, 0.0, 0.0, 0.0, 0.0, 6.0), "crm_fcp_real_estate_amt_indv", 6.0),
        (("REAL ESTATE", "CO", "WG", "Y", 0.0, 0.0, 0.0, 0.0, 0.0, 6.0), "crm_fcp_real_estate_amt_indv", 0.0),
        ((None, "CO", "WG", "N", 1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 4.0), "blank_crm_amt_std_indv", 7.0),
        (("", "CO", "WG", "N", 1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 4.0), "b2_std_eff_fin_coll_amt", 0.0),
        (("X", "CO", "WG", "N", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, None, 8.0), "b2_std_coll_fx_haircut_amt_indv", 8.0),
        (("OTHER FUNDED CREDIT PROTECTION", "CO", "WG", "N", 0.0, 0.0, 0.0, 0.0, 0.0, 6.0, 0.0, 0.0, 0.0, 0.0, "CO", "EP", "RMP"), "b2_irb_crm_cod_amt", 6.0),
        (("OTHER FUNDED CREDIT PROTECTION", "CO", "WG", "N", 0.0, 0.0, 0.0, 0.0, 0.0, 6.0, 5.0, 0.0, 0.0, 0.0, "LP", "EP", "RMP"), "b2_irb_crm_lip_amt", 5.0),
    ],
)
def test_mitigant_rules(spark, row, name, want):
    width = len(SUB_SCHEMA.split(","))
    full = tuple(row) + (None,) * (width - len(row))
    df = spark.createDataFrame([full], SUB_SCHEMA)
    assert add_mitigant_amounts(df).select(name).collect()[0][0] == want


def test_deal_without_mitigants_has_no_outflow(spark):
    schema = "b2_std_crm_tot_outflow_rwa_agg double, b2_std_crm_tot_outflow_agg double, rwa_post_crm_amount double, ead_post_crm_amt double, crm_fcp_elig_fin_coll_amt_agg double, b2_irb_netted_coll_gbp double, crm_ufcp_guar_amt_agg double, crm_ufcp_cred_deriv_amt_agg double"
    df = spark.createDataFrame([(None, None, 10.0, 20.0, None, 3.0, None, None)], schema)
    r = add_deal_caps(df).collect()[0]
    assert (r.b2_std_crm_tot_outflow_rwa, r.b2_std_crm_tot_outflow_exp, r.b2_irb_crm_fcp_elg_fin_col_amt) == (0.0, 0.0, 3.0)
