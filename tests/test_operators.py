"""Invariants and differential checks of the operators."""

import os
import random
from datetime import date
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import joins
from tallyloom.operators.asof import versions_on
from tallyloom.operators.aggregates import group_sum, grouping_sets_total
from tallyloom.operators.audit import duplicate_keys, observed
from tallyloom.operators.filters import latest_day
from tallyloom.operators.reshape import CellRow, unpivot_rows
from tallyloom.operators.setops import merge_upsert
from tallyloom.operators.sizing import fits_broadcast
from tallyloom.plans.aggregate_mart import aggregate_mart
from tallyloom.plans.mart import with_own_totals, with_shared_totals, with_totals
from tallyloom.plans.mitigants import MITIGANT_TOTALS, mitigant_totals, totals_for_all
from tallyloom.plans.return_cells import measure_table, report_rows
from tallyloom.plans.staging import for_all_regulators
from tallyloom.sources.layouts import conform
from tallyloom.sources.sinks import insert_overwrite, load_return, save_table, write_layer
from tallyloom.sources.tables import scan

FOLDER = "/root/testdata/sf0.001"


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


BANDS = [(float(i), float(i + 1), "Y", "N", f"B{i}") for i in range(40)] + [
    (40.0, 1e12, "Y", "Y", "REST"), (5.0, 5.0, "Y", "N", "POINT"), (6.0, 6.0, "N", "N", "NOTHING"), (None, 7.0, "N", "Y", "UPPER"), (2.0, None, "Y", "Y", "LOWER"),
    (9.0, 8.0, "Y", "Y", "TURNED"), (3.0, 30.0, "N", "Y", "WIDE"), (3.0, 30.0, None, None, "WIDE2"), (-1.0, 0.0, "N", "Y", "NEG"),
]
BAND_COLUMNS = "lower_value double, upper_value double, lower_val_inclusive string, upper_val_inclusive string, code string"


def _plain_bands(rows, bands, default=None):
    def holds(v, lo, hi, li, ui):
        inside = lo is not None and hi is not None and lo < v < hi
        return inside or (v == lo and li == "Y") or (v == hi and ui == "Y")

    for i, v in rows:
        value = default if v is None else v
        yield from [(i, v, b[4]) for b in bands if value is not None and holds(value, *b[:4])] or [(i, v, None)]


@pytest.mark.parametrize("default", [None, 2.5, 40.0])
def test_band_join_agrees_with_plain_code(spark, default):
    """The index, and segments of given and of measured number, with overlaps, points and missing bounds."""
    bands = spark.createDataFrame(BANDS, BAND_COLUMNS)
    rows = [(i, None if i % 17 == 0 else i / 8.0 - 1) for i in range(400)] + [(7, 5.0), (7, 5.0), (900, float("inf")), (901, float("-inf")), (902, -0.0)]
    facts = spark.createDataFrame(rows, "id long, v double")
    want = sorted(_plain_bands(rows, BANDS, default), key=repr)
    for options in ({}, {"limit": 0, "segments": 8}, {"limit": 0}, {"limit": 0, "segments": 1}):
        got = joins.band_join(facts, bands, "v", ["code"], default=default, **options)
        assert as_set(got) == want, options
    none = bands.limit(0)
    assert as_set(joins.band_join(facts, none, "v", ["code"])) == as_set(joins.band_join(facts, none, "v", ["code"], limit=0)) == sorted([(*r, None) for r in rows], key=repr)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_band_join_plans_and_balance(spark):
    """No nested loop, and no task above twice the median where every value is missing."""
    bands = spark.createDataFrame([(i / 1000, (i + 1) / 1000, "Y", "N", str(i)) for i in range(1000)], BAND_COLUMNS)
    facts = spark.range(200000).select("id", F.lit(None).cast("double").alias("v"))
    for limit in (None, 0):
        joined = joins.band_join(facts, bands, "v", ["code"], default=0.02501, limit=limit)
        assert "NestedLoop" not in _plan(joined) and "Cartesian" not in _plan(joined)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = joins.band_join(facts, bands, "v", ["code"], default=0.02501, limit=0)
        tasks = sorted(r.n for r in joined.groupBy(F.spark_partition_id().alias("p"), "code").agg(F.count("*").alias("n")).collect())
        assert joined.where("code = '25'").count() == 200000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[4]


def test_hot_key_keeps_every_row(spark):
    """A third of all rows on one key: lookups neither drop nor multiply rows."""
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    dim = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for limit in (None, 0):
        joined = joins.lookup(facts, dim, ["k"], limit=limit)
        assert joined.count() == 3000
        assert joined.where(F.col("v") != F.col("k") * 2).count() == 0


def test_effective_dated_join_never_multiplies(spark):
    dim = spark.createDataFrame(
        [(1, "a", "2000-01-01", "2001-01-01"), (1, "b", "2001-01-01", "2002-01-01"), (1, "c", "2003-01-01", "9999-12-31")],
        "key int, attr string, f string, t string",
    ).select("key", "attr", F.to_date("f").alias("valid_from_date"), F.to_date("t").alias("valid_to_date"))
    facts = spark.createDataFrame(
        [(1, 1, "2000-12-31"), (2, 1, "2001-01-01"), (3, 1, "2002-06-01"), (4, 1, "2003-01-01"), (5, 2, "2001-01-01")],
        "i int, k int, d string",
    ).withColumn("d", F.to_date("d"))
    rows = joins.effective_dated_join(facts, dim, {"k": "key"}, F.col("d"), ["attr"])
    assert [(r.i, r.attr) for r in rows.orderBy("i").collect()] == [(1, "a"), (2, "b"), (3, None), (4, "c"), (5, None)]
    on_date = joins.effective_dated_join(facts, dim, {"k": "key"}, "2001-01-01", ["attr"])
    assert {r.attr for r in on_date.where("k = 1").collect()} == {"b"}


def _random_versions(rng, keys, overlap):
    out = []
    for key in range(keys):
        day = rng.randrange(20)
        for _ in range(rng.randrange(12)):
            length = rng.randrange(0, 9)
            out.append((key if rng.random() < 0.95 else None, f"v{len(out)}", date.fromordinal(730000 + day), date.fromordinal(730000 + day + length)))
            day += length + rng.randrange(0, 5) - (rng.randrange(0, 6) if overlap and key % 2 else 0)
    return out + [(0, "no start", None, date.fromordinal(800000)), (0, "no end", date.fromordinal(1), None)]


@pytest.mark.parametrize("overlap", [False, True])
def test_as_of_agrees_with_every_pair_compared(spark, overlap):
    """Gaps, empty versions, days on both ends, null keys and dates; overlaps give each version, or the latest."""
    rng = random.Random(11)
    versions = _random_versions(rng, 12, overlap)
    facts = [(i, rng.choice([None, *range(14)]), None if i % 40 == 0 else date.fromordinal(730000 + rng.randrange(90))) for i in range(600)]
    facts += facts[:5]
    dim = spark.createDataFrame(versions, "key int, attr string, valid_from_date date, valid_to_date date")
    left = spark.createDataFrame(facts, "i int, k int, d date")
    want, latest = [], []
    for i, k, d in facts:
        held = sorted((f, t, a) for key, a, f, t in versions if None not in (key, f, t, k, d) and key == k and f <= d < t)
        want += [(i, k, d, a) for _, _, a in held] or [(i, k, d, None)]
        latest.append((i, k, d, held[-1][2] if held else None))
    got = joins.effective_dated_join(left, dim, {"k": "key"}, F.col("d"), ["attr"])
    assert as_set(got) == sorted(want, key=repr)
    one = versions_on(left, dim, "k", "key", F.col("d"), ["attr"], prefix="own_", latest=True)
    assert one.columns == ["i", "k", "d", "own_attr"] and as_set(one) == sorted(latest, key=repr)
    assert as_set(joins.effective_dated_join(left, dim.limit(0), {"k": "key"}, F.col("d"), ["attr"])) == sorted([(*r, None) for r in facts], key=repr)


def test_as_of_plan_has_no_range_condition_on_facts(spark):
    """Facts meet answers by equality; a key with 10,000 versions and a third of all facts costs its days."""
    dim = spark.range(10000).select(F.expr("CAST(id DIV 100000 AS INT) + 1").alias("key"), "id", *[F.expr(f"date_add(DATE '1950-01-01', CAST(id + {k} AS INT))").alias(n) for k, n in ((0, "valid_from_date"), (1, "valid_to_date"))])
    facts = spark.range(30000).select("id", (F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(1)).cast("int").alias("k"), F.expr("date_add(DATE '1950-01-01', CAST(id % 12000 AS INT))").alias("d"))
    joined = joins.effective_dated_join(facts.withColumnRenamed("id", "i"), dim, {"k": "key"}, F.col("d"), ["id"])
    assert joined.count() == 30000 and joined.where("id IS NOT NULL").count() == facts.where("k = 1 AND id % 12000 < 10000").count()
    assert "NestedLoop" not in _plan(joined)


def test_overlapping_versions_meet_only_the_days_they_hold_on(spark):
    """Days of a key with overlaps meet no version that does not hold: no condition is left behind the join."""
    dim = spark.range(20000).select(F.lit(1).alias("key"), "id", *[F.expr(f"date_add(DATE '1950-01-01', CAST(id + {k} AS INT))").alias(n) for k, n in ((0, "valid_from_date"), (5, "valid_to_date"))])
    dim = dim.unionByName(spark.sql("SELECT 1 AS key, -1L AS id, DATE '0001-01-01' AS valid_from_date, DATE '9999-12-31' AS valid_to_date"))
    facts = spark.range(6000).select(F.col("id").alias("i"), F.lit(1).alias("k"), F.expr("date_add(DATE '1950-01-01', CAST(id AS INT))").alias("d"))
    joined = joins.effective_dated_join(facts, dim, {"k": "key"}, F.col("d"), ["id"])
    # Five versions hold on a day, fewer on the first four, and the one that always does.
    assert joined.count() == 6000 * 5 - (4 + 3 + 2 + 1) + 6000
    joins_on_days = [line for line in _plan(joined).splitlines() if "Join" in line and "Inner" in line]
    assert joins_on_days and not any("_from" in line or "_to" in line for line in joins_on_days)


def test_successors_and_default(spark):
    dim = spark.createDataFrame(
        [(1, "x", None, "2000-01-01", "2001-01-01"), (11, "x", None, "2001-01-01", "9999-12-31"), (2, "gone", "r", "2000-01-01", "2001-01-01")],
        "k int, a string, b string, f string, t string",
    ).select("k", "a", "b", F.to_date("f").alias("valid_from_date"), F.to_date("t").alias("valid_to_date"))
    successors = joins.successor_map(dim, "k", ["a", "b"], "2001-06-30")
    facts = spark.createDataFrame([(1,), (2,), (3,), (11,), (None,)], "k int")
    assert as_set(joins.rekey(facts, {"k": "new"}, successors, -1).select("k", "new")) == sorted(
        [(1, 11), (2, -1), (3, -1), (11, 11), (None, -1)], key=repr
    )


def test_merge_keeps_updates_and_inserts(spark):
    target = spark.createDataFrame([(1, None, 1.0, "t"), (2, "a", 2.0, "t"), (None, "b", 3.0, "t")], "k int, s string, v double, o string")
    source = spark.createDataFrame([(1, None, 10.0), (3, "c", 30.0), (None, "b", None)], "k int, s string, v double")
    merged = merge_upsert(target, source, ["k", "s"], ["v"], {"o": "n"})
    assert as_set(merged) == sorted([(1, None, 10.0, "t"), (2, "a", 2.0, "t"), (None, "b", None, "t"), (3, "c", 30.0, "n")], key=repr)


def test_total_is_the_sum_of_details(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    df = lines.select("l_returnflag", F.when(F.col("l_linenumber") < 5, F.col("l_linestatus")).alias("sheet"), "l_quantity")
    both = grouping_sets_total(df, ["l_returnflag"], "sheet", "l_quantity", "ALL")
    details = both.where("sheet IS NULL OR sheet <> 'ALL'").groupBy("l_returnflag").agg(F.sum("l_quantity"))
    totals = both.where("sheet = 'ALL'").select("l_returnflag", "l_quantity")
    assert as_set(details) == as_set(totals)


def test_one_pass_unpivot_equals_a_union(spark):
    df = spark.range(50).select(
        F.col("id"), F.lit("S").alias("sheet_id"), F.lit("M").alias("memo_sheet_id"), (F.col("id") * 1.5).alias("c0010"), (F.col("id") * 2.5).alias("c0030_onbal")
    )
    rows = [
        CellRow("R1", ["c0010", "c0030_onbal"]),
        CellRow("R2", ["c0010"], F.col("id") > 20, "memo_sheet_id"),
        CellRow("R3", ["c0030_onbal"], F.lit(None).cast("boolean")),
        CellRow(F.when(F.col("id") < 5, F.lit("R4")).otherwise(F.lit("R5")), ["c0010"], blank=(["c0010"], F.col("id") == 7)),
    ]
    one = unpivot_rows(df, ["id"], rows)
    cell = lambda d, sheet, row, column, value: d.select("id", F.col(sheet), row.alias("r"), F.lit(column), value.cast("double"))
    union = (
        cell(df, "sheet_id", F.lit("R1"), "c0010", F.col("c0010"))
        .union(cell(df, "sheet_id", F.lit("R1"), "c0030", F.col("c0030_onbal")))
        .union(cell(df.where("id > 20"), "memo_sheet_id", F.lit("R2"), "c0010", F.col("c0010")))
        .union(cell(df, "sheet_id", F.when(F.col("id") < 5, F.lit("R4")).otherwise(F.lit("R5")), "c0010", F.when(F.col("id") != 7, F.col("c0010"))))
    )
    assert as_set(one) == as_set(union)


def test_measure_and_row_counts(spark):
    assert len(measure_table()) == 61
    rows = report_rows()
    assert [len(r.measures) for r in rows] == [24, 22, 22, 22, 22, 22, 22, 22, 17, 21, 7, 6, 7, 6, 17, 24, 14, 15]
    known = set(measure_table())
    assert all(m in known for r in rows for m in r.measures)


def test_fan_out_count(spark):
    df = spark.range(100).withColumn("code", F.lit("UK"))
    assert joins.fan_out(df, "code", ("A", "B", "C")).count() == 300


def test_sinks(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("year_month"), F.lit("x").alias("reporting_regulator_code"))
    assert write_layer(df, str(tmp_path / "layer"), ["reporting_regulator_code"]).count() == 100
    name = f"t_{uuid4().hex}"
    try:
        df.write.format("parquet").option("path", str(tmp_path / name)).partitionBy("year_month").saveAsTable(name)
        insert_overwrite(df.where("year_month = 1").select("year_month", (F.col("id") + 1000).alias("ID"), "reporting_regulator_code"), name)
        assert spark.table(name).count() == 100
        assert spark.table(name).where("id >= 1000").count() == 25
        with pytest.raises(ValueError):
            insert_overwrite(df.drop("id"), name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    saved = f"t_{uuid4().hex}"
    try:
        for factor in (1, 2):
            save_table(df.withColumn("id", F.col("id") * factor), saved, ["year_month"], str(tmp_path / saved))
        assert spark.table(saved).agg(F.sum("id")).first()[0] == 2 * sum(range(100))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {saved}")


def test_overwriting_one_month_keeps_the_others(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4 + 200101).cast("int").alias("year_month"), F.lit("UK-FSA").alias("reporting_regulator_code"))
    by = ["year_month", "reporting_regulator_code"]
    write_layer(df, str(tmp_path / "layer"), by)
    layer = write_layer(df.where("year_month = 200102").withColumn("id", F.col("id") + 1000), str(tmp_path / "layer"), by)
    assert layer.count() == 100 and layer.where("id >= 1000").count() == 25


def test_scans_are_pruned(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4 + 200101).cast("int").alias("year_month"), F.lit("A").alias("adjust_flag"), F.lit("Y").alias("valid_flag"))
    layer = write_layer(df, str(tmp_path / "months"), ["year_month", "adjust_flag"])
    plan = scan(layer, 200102, "A")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and scan(layer, 200102, "A").count() == 25
    events = spark.range(300).select("id", F.timestamp_seconds(F.col("id") * 3600).alias("ts"))
    newest = latest_day(events, "ts")
    assert sorted(r.id for r in newest.collect()) == list(range(288, 300))


def test_spread_keys_change_no_row(spark):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).cast("int").alias("k"))
    dim = spark.range(40).select(F.col("id").cast("int").alias("dk"), (F.col("id") * 2).alias("v"))
    small = joins.packed_lookup(facts, dim, "k", "dk", "d", ["v"])
    spread = joins.packed_lookup(facts, dim, "k", "dk", "d", ["v"], limit=0, spread_by=("id",), sentinels=(-1,))
    assert as_set(small) == as_set(spread)
    keys = facts.where("k = -1 OR k IS NULL").select(joins.spread_key(F.col("k"), [F.col("id")], (-1,)).alias("s"))
    assert keys.distinct().count() == keys.count() and keys.agg(F.max("s")).first()[0] < -1


def test_prior_period_takes_one_row_per_key(spark):
    now = spark.createDataFrame([(1, 200108)], "deal int, month int")
    before = spark.createDataFrame([(1, 200106, "b"), (1, 200106, "a")], "deal int, month int, flag string")
    got = joins.prior_period_join(now, before, ["deal"], "month", F.lit(200106), {"flag": "flag_before"})
    assert [r.flag_before for r in got.collect()] == ["a"]


def test_totals_before_copies_equal_totals_after(spark):
    rows = [("UK-FSA", 1, 2.0), ("UK-FSA", 1, 3.0), ("UK-FSA", 2, None), ("DE-BBK", 1, 7.0)]
    df = spark.createDataFrame([(200108, *r) for r in rows], "year_month int, reporting_regulator_code string, deal_id int, amount double")
    df = df.select("year_month", "reporting_regulator_code", "deal_id", *[F.col("amount").alias(c) for c in MITIGANT_TOTALS])
    assert as_set(totals_for_all(df)) == as_set(mitigant_totals(for_all_regulators(df)))


def test_totals_are_met_without_copies(spark):
    """Deals meet uncopied totals and get what copies of them give, own and shared ones added; nothing is copied on the way."""
    rows = [("UK-FSA", "1", 2.25), ("UK-FSA", "1", 3.0), ("UK-FSA", "2", None), ("DE-BBK", "1", 7.1), ("DE-BBK", "3", 0.7), ("UK-FSA", "4", 1e12)]
    df = spark.createDataFrame([(200108, *r) for r in rows], "year_month int, reporting_regulator_code string, deal_id string, amount double")
    df = df.select("year_month", "reporting_regulator_code", "deal_id", *[F.col("amount").alias(c) for c in MITIGANT_TOTALS])
    deals = [(m, r, d) for m in (200107, 200108) for r in ("UK-FSA", "DE-BBK", "NL-DNB", "CBI", "OTHER", None) for d in ("1", "2", "3", "4", "5", None)]
    keys = spark.createDataFrame(deals, "year_month int, reporting_regulator_code string, _plain_deal string")
    totals = mitigant_totals(df)
    met = with_shared_totals(with_own_totals(keys, totals), totals)
    assert "Generate" not in met._jdf.queryExecution().optimizedPlan().toString()
    assert met.count() == len(deals) and as_set(met) == as_set(with_totals(keys, totals_for_all(df)).select(met.columns))


def test_missing_group_key_is_an_error(spark):
    with pytest.raises(ValueError):
        aggregate_mart(spark.range(1), ["id", "no_such_key"], ["id"])


def test_changed_inputs_give_new_layers(spark, tmp_path):
    from tallyloom.catalog.jobs import input_state, job_of

    spark.range(5).write.parquet(str(tmp_path / "orders.parquet"))
    first = job_of(spark, str(tmp_path))
    assert job_of(spark, str(tmp_path)) is first
    spark.range(6).write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    assert job_of(spark, str(tmp_path)) is not first and len(input_state(spark, str(tmp_path))) > 0


def test_scratch_tables_are_removed(spark, tmp_path):
    from tallyloom import session

    kept = dict(session._SCRATCH)
    session._SCRATCH.clear()
    try:
        made = session.scratch_table(spark.range(3), "t")
        path = made.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        path = "/" + path.lstrip("/")
        assert os.path.isdir(path)
        session.drop_scratch(spark)
        assert not os.path.exists(path)
    finally:
        session._SCRATCH.update(kept)


def test_load_return_per_flag(spark, tmp_path):
    cells = spark.createDataFrame(
        [("C 07.00", 200108, None, 1.0), ("C 07.00", 200108, "A", 0.0)], "return_code string, year_month_rk int, for_adjust_flag string, value double"
    )
    load_return(cells, str(tmp_path / "cells"))
    loaded = spark.read.parquet(str(tmp_path / "cells"))
    assert as_set(loaded.groupBy("adjust_flag").count()) == [("A", 2), ("U", 1)]


def test_layout_and_audit(spark):
    df = spark.range(5).withColumn("V", F.lit(1))
    schema = conform(df, df.select(F.col("V").cast("double").alias("v"), F.col("id").cast("int").alias("id")).schema)
    assert schema.dtypes == [("v", "double"), ("id", "int")]
    with pytest.raises(ValueError):
        conform(df.drop("V"), schema.schema)
    watched, observation = observed(df, f"layer_{uuid4().hex}")
    watched.write.format("noop").mode("overwrite").save()
    assert observation.get["rows"] == 5
    assert duplicate_keys(df.union(df), ["id"]).count() == 5
    assert as_set(group_sum(df, ["V"], {"id": "total"})) == [(1, 10)]
