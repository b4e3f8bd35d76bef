"""Rule lists as rows: proved, compiled, and equal to the lists they come from."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.filters import RegimeRule, regime_value
from tallyloom.operators.rules import RULE_TABLE, RuleConflict, cases, compiled, conflicts, flat, holds, rule_rows, rules_of
from tallyloom.plans.staging import DUTCH_RULES, IRISH_RULES, OTHER_RULES, UK_RULES

MONTHS = {"dual": 202001, "divergence": 202106}
ORDER = tuple(MONTHS)
LISTS = {"uk": UK_RULES, "dutch": DUTCH_RULES, "other": OTHER_RULES, "irish": IRISH_RULES}


def _table(spark, lists):
    return spark.createDataFrame([row for name, rules in lists.items() for row in rule_rows(name, rules)], RULE_TABLE)


def _facts(spark):
    """Every case that some list tells apart, one row each."""
    found = {c for rules in LISTS.values() for c in cases(list(flat(rules)), ORDER)}
    month = {0: 201912, 1: 202001, 2: 202106}
    rows = [(n, month[c.period], c.product or None, c.system or None, c.cut, c.jurisdiction or None, "Y" if c.crr2 else None) for n, c in enumerate(sorted(found, key=repr))]
    return spark.createDataFrame(rows, "id int, year_month_rk int, aclm_product_type string, sys_code string, capital_cuts string, jurisdiction_flag string, crr2_flag string")


def test_tables_give_the_answers_of_their_lists(spark):
    """In the order of the table, and in any other: a proved list does not depend on it."""
    facts, table = _facts(spark), _table(spark, LISTS)
    shuffled = table.withColumn("place", -F.col("place"))
    for name, rules in LISTS.items():
        assert rules_of(table, name) and not conflicts(rules_of(table, name), ORDER)
        both = facts.select(
            regime_value(rules, MONTHS, False).alias("a"), compiled(table, name, MONTHS, ORDER).alias("b"), compiled(shuffled, name, MONTHS, ORDER).alias("c")
        )
        assert both.where("a <> b OR a <> c OR b IS NULL").count() == 0
        assert 0 < both.where("a").count() < facts.count()


def test_plain_meaning_agrees_with_the_column(spark):
    rules = list(flat(UK_RULES))
    found = random.Random(5).sample(cases(rules, ORDER), 300)
    month = {0: 201912, 1: 202003, 2: 202112}
    rows = [(n, month[c.period], c.product, c.system, c.cut, c.jurisdiction, "Y" if c.crr2 else "N") for n, c in enumerate(found)]
    facts = spark.createDataFrame(rows, "id int, year_month_rk int, aclm_product_type string, sys_code string, capital_cuts string, jurisdiction_flag string, crr2_flag string")
    got = {r.id: r.keep for r in facts.select("id", regime_value(rules, MONTHS, False).alias("keep")).collect()}
    assert got == {n: next((r.keep for r in rules if holds(r, c, ORDER)), False) for n, c in enumerate(found)}


def test_bad_lists_are_rejected(spark):
    bad = {
        "hidden": [RegimeRule(systems=("A", "B")), RegimeRule(systems=("A",), cut="4")],
        "covered": [RegimeRule(since="dual"), RegimeRule(before="dual"), RegimeRule(products=("P",))],
        "contrary": [RegimeRule(products=("P",), keep=True), RegimeRule(systems=("A",), keep=False)],
        "unknown": [RegimeRule(since="later")],
        "good": [RegimeRule(products=("P",), keep=True), RegimeRule(other_than_products=("P",), systems=("A",), keep=False)],
    }
    table = _table(spark, bad)
    report = {}
    for name in bad:
        try:
            compiled(table, name, MONTHS | {"later": 202212}, ORDER)
        except RuleConflict as conflict:
            report[name] = conflict.report
    assert report["hidden"] == ["rule 1 cannot be reached"] and report["covered"] == ["rule 2 cannot be reached"]
    assert report["unknown"] == ["month later is not known"] and "good" not in report
    [line] = report["contrary"]
    assert line.startswith("rules 0 and 1 answer differently for Case(")
    with pytest.raises(RuleConflict, match="more than"):
        rules_of(spark.range(1001).selectExpr("'x' AS rule_list", "CAST(id AS INT) AS place"), "x")
