"""Sums that do not depend on the order of rows, and aggregation before the spread to cells."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import codes as K
from tallyloom.operators.aggregates import conditional_sums, exact_sum, group_sum, group_sum_of_few, grouping_sets_total, rollup_to
from tallyloom.operators.reshape import measures_of, unpivot_rows
from tallyloom.plans import return_cells as R


def _amounts(rng, n):
    kinds = (lambda: round(rng.uniform(-1e4, 1e4), 2), lambda: rng.uniform(-1, 1), lambda: round(rng.uniform(-1e9, 1e9), 4), lambda: 0.1, lambda: None, lambda: 8.9e12, lambda: -8.9e15)
    return [(k % 5, k % 3, rng.choice(kinds)()) for k in range(n)]


def _plain(values):
    """In unlimited whole numbers."""
    known = [v * 1e6 for v in values if v is not None]
    upper = [math.floor(v / 2**20) for v in known]
    total = sum(u * 2**20 + math.floor(v - u * 2.0**20 + 0.5) for u, v in zip(upper, known))
    return float(total) / 1e6 if known else None


def test_same_sum_for_every_partitioning(spark):
    """Doubles added in another order differ; these sums do not, over one level or two."""
    rows = _amounts(random.Random(1), 4000)
    want = {g: _plain([v for k, _, v in rows if k == g]) for g in range(5)}
    plain = set()
    for parts, seed in ((1, 1), (7, 2), (40, 3)):
        df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "g int, h int, v double").repartition(parts)
        assert {r.g: r.v for r in group_sum(df, ["g"], ["v"]).collect()} == want
        fine = group_sum(df, ["g", "h"], ["v"])
        assert {r.g: pytest.approx(r.v, rel=1e-12) for r in rollup_to(fine, ["g"], ["v"]).collect()} == want
        total = grouping_sets_total(df.withColumn("h", F.col("h").cast("string")), ["g"], "h", "v", "T").where("h = 'T'")
        assert {r.g: r.v for r in total.collect()} == want
        plain.add(tuple(r.s for r in df.groupBy("g").agg(F.sum("v").alias("s")).orderBy("g").collect()))
    assert len(plain) > 1


def test_sums_of_nothing_and_out_of_range(spark):
    df = spark.createDataFrame([(1, None), (2, 0.0), (3, -0.0000005), (4, 2.5), (4, None)], "g int, v double")
    got = {r.g: r.v for r in group_sum(df, ["g"], ["v"]).collect()}
    assert got == {1: None, 2: 0.0, 3: 0.0, 4: 2.5}
    assert {r.g: r.v for r in rollup_to(df, ["g"], ["v"]).collect()}[1] == 0.0
    assert group_sum(df.limit(0), ["g"], ["v"]).count() == 0
    assert dict(group_sum(df.withColumn("v", F.col("g").cast("long")), ["g"], ["v"]).dtypes)["v"] == "bigint"
    got = conditional_sums(df, ["g"], {"m": (F.col("v"), F.col("g") == 4), "n": (F.col("v") + 1, None)}).where("g = 4").first()
    assert (got.m, got.n) == (2.5, 3.5)
    for wrong in (float("nan"), float("inf"), 1e19):
        with pytest.raises(Exception, match="amount out of range"):
            spark.range(1).select(F.lit(wrong).alias("v")).agg(exact_sum(F.col("v"))).collect()


def _measures(spark, n):
    """Measure rows with every attribute the report rows look at, some of them null."""
    rng = random.Random(4)
    pick = lambda *values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.xxhash64("id", F.lit(rng.random())), F.lit(len(values))) + 1).cast("int"))
    attributes = {
        "year_month": F.lit(200108), "reporting_regulator_code": pick(K.UK, K.GERMANY, K.IRELAND), "risk_taker_rru": pick(1, 2, 3), "risk_on_rru": pick(1, 2, None),
        "internal_transaction_flag": pick("Y", "N"), "ig_exclusion_flag": pick("Y", "N", None), "division": pick("A", K.OVERRIDE_DIVISION, None), "b3_sme_rp_flag": pick("Y", "N"),
        "retail_pool_sme_flag": pick("Y", None), "transitional_portfolio_flag": pick("Y", "N", None), "corep_product_category": pick(R.SECURITIES_FINANCING, R.DERIVATIVES, K.ON, K.OFF),
        "qccp_flag": pick("Y", "N"), "b3_sme_discount_flag": pick("Y", "N"), "crr2_501a_discount_flag": pick("Y", None), "reporting_type_code": pick("LS", None),
        "crd4_memo_basel_exposure_type": pick(*R.MEMO_CLASSES, K.HIGH_RISK, None), "std_act_risk_weight": pick(0.0, 0.35, 0.7, 1.0, 1.5, 3.3), "b2_std_basel_exposure_type": pick(K.SECURED, None),
        "basel_exposure_type": pick(K.IN_DEFAULT, K.RETAIL), "reg_exposure_type": pick(K.RESIDENTIAL_MORTGAGE, K.COLLECTIVE_INVESTMENT, None), "sheet_id": pick("S1", "S2", None), "memo_sheet_id": pick("M1", "S1"),
    }
    amounts = {m: (F.pmod(F.xxhash64("id", F.lit(m)), F.lit(10**9)) / 100) for m in R.measure_table()}
    # Written rows: the draws above are made once.
    return spark.createDataFrame(spark.range(n).select(*[c.alias(k) for k, c in (attributes | amounts).items()]).collect())


def _group_map(spark):
    rows = [(t, o, 200108, f, d, g, k) for t in (1, 2, 3) for o in (1, 2) for f, g, k in (("Y", f"G{t % 2}", "Inter Group"), ("N", f"G{o}", "External")) for d in ("LL", "LL2")]
    rows += [(1, 1, 200108, "Y", "DECON 1", "G9", "External"), (2, 2, 200108, "N", None, "G9", "External")]
    return spark.createDataFrame(rows, "risk_taker_rru_rk int, risk_on_rru_rk int, year_month_rk int, internal_transaction_flag string, risk_taker_ll_rru string, risk_taker_group string, reporting_desc string")


def test_sums_before_cells_agree_with_cells_before_sums(spark):
    measures, groups, rows = _measures(spark, 1500), _group_map(spark), R.report_rows()
    got = R.entity_cells(measures, groups)
    spread = unpivot_rows(R.by_entity(measures, groups), R.ENTITY_KEYS, rows).withColumn("column_id", F.upper("column_id"))
    keys = [*R.ENTITY_KEYS, "row_id", "column_id"]
    plain = group_sum(spread, [*keys, "sheet_id"], ["value"]).unionByName(group_sum(spread, keys, ["value"]).withColumn("sheet_id", F.lit(K.TOTAL_SHEET)))
    columns = [*keys, "sheet_id", "value"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(map(tuple, plain.select(columns).collect()), key=repr)
    # What is spread to cells is one row for each entity group, not for each measure row.
    wide = R.entity_sums(measures, groups, rows)
    assert wide.count() == wide.select(*R.ENTITY_KEYS, "_row", "row_id", "_blank", "sheet_id").distinct().count() < spread.count() / 100
    assert set(measures_of(rows)) <= set(wide.columns)
    assert R.entity_cells(measures.limit(0), groups).count() == 0


@pytest.mark.parametrize("fits", [True, False])
def test_few_groups_of_several_rows(spark, monkeypatch, fits):
    """Nulls in either key, zeros of both signs, equal and lone keys give what a plain sum gives."""
    keys = [("a", None, 0.0), (None, "a", 0.0), ("a", None, -0.0), ("b", "c", -0.0), ("d", "e", float("nan")), ("d", "e", float("nan")), (None, None, None)]
    rows = [(*k, 0.1 * i if i % 3 else None, i) for i, k in enumerate(keys)] + [("k", str(i), float(i), 0.1000004, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, l string, x double, amount double, n int")
    monkeypatch.setattr("tallyloom.operators.aggregates.fits_broadcast", lambda df, limit=None: fits)
    plain, few = (f(df, ["k", "l", "x"], ["amount", "n"]) for f in (group_sum, group_sum_of_few))
    assert few.dtypes == plain.dtypes and few.count() == 205
    assert sorted(map(repr, few.collect())) == sorted(map(repr, plain.collect()))
