"""Contracts, audit log, merge of touched partitions and idempotent return runs."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.catalog.inputs import RUN_DATE, JobInputs
from tallyloom.catalog.jobs import Job, fine_level, job_of
from tallyloom.catalog.registry import QUERIES
from tallyloom.plans.aggregate_mart import aggregate_level_one, aggregate_mart
from tallyloom.plans.final import FINAL_COLUMNS
from tallyloom.plans.mart import INTERNAL_TOTALS, REDUCTION_TOTALS, inflow_rows, is_unfunded_outflow, unite_flows
from tallyloom.plans.mitigants import mitigant_totals
from tallyloom.plans.staging import provider_classes, stage_exposures, sub_exposure_rows
from tallyloom.sources.layouts import Contract, ContractViolation
from tallyloom.sources.sinks import AuditLog, merge_layer, publish_return, published_return, write_layer, write_partitioned

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CONTRACT = Contract(
    "deals", {"month": "int", "deal": "string"}, ((r"_flag$", "string"), (r"_amt(_|$)", "double"), (r"_rk$", "int")),
    ("month", "deal"), ("month", "deal"), {"wide_rk": "bigint"},
)
ROWS = [(1, "a", "Y", 1.0, 5, 7), (1, "b", None, 2.0, 5, 7), (2, "a", "N", None, 5, 7)]
COLUMNS = "month int, deal string, new_flag string, exp_amt_qtr double, unit_rk int, wide_rk long"


def _files(path):
    """Time and size of every data file."""
    return {
        os.path.join(d, f): (os.stat(os.path.join(d, f)).st_mtime_ns, os.stat(os.path.join(d, f)).st_size)
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_contract_is_kept_and_counted(spark, tmp_path):
    audit = AuditLog(spark, str(tmp_path / "audit"), "run 1")
    df = spark.createDataFrame(ROWS, COLUMNS)
    written = write_layer(df, str(tmp_path / "good"), ["month"], CONTRACT, audit, "deals")
    assert _set(written.select(*df.columns)) == _set(df)
    write_layer(df.limit(0), str(tmp_path / "none"), ["month"], CONTRACT, audit, "empty")
    write_layer(df.where("month = 1"), str(tmp_path / "again"), ["month"], CONTRACT, audit, "deals")
    assert _set(audit.table()) == [("run 1", "deals", 2), ("run 1", "empty", 0)]


def test_contract_reports_every_violation(spark, tmp_path):
    df = spark.createDataFrame(ROWS, COLUMNS)
    wrong = df.drop("deal").withColumn("new_flag", F.lit(1)).withColumn("unit_rk", F.lit("x"))
    with pytest.raises(ContractViolation) as found:
        write_layer(wrong, str(tmp_path / "types"), ["month"], CONTRACT)
    assert found.value.report == ["column deal is missing", "column new_flag is int, not string", "column unit_rk is string, not int"]
    assert not (tmp_path / "types").exists()
    rows = spark.createDataFrame([*ROWS, (1, None, "Y", 1.0, 5, 7), (2, "a", "Y", 1.0, 5, 7)], COLUMNS)
    with pytest.raises(ContractViolation) as found:
        write_layer(rows, str(tmp_path / "rows"), ["month"], CONTRACT)
    assert found.value.report == ["column deal is null in 1 rows", "key (month, deal) is not unique: 1 keys occur more than once"]


def test_merge_touches_only_the_months_it_holds(spark, tmp_path):
    path = str(tmp_path / "layer")
    layer = spark.range(600).selectExpr("id", "CAST(id % 6 AS INT) AS month", "CASE id % 5 WHEN 0 THEN NULL ELSE CONCAT('k', id) END AS name", "CAST(id AS DOUBLE) AS v")
    write_partitioned(layer.withColumn("month", F.when(F.col("month") < 5, F.col("month"))), path, ["month"])
    before = _files(path)
    source = spark.createDataFrame([(2, 2, "k2", -1.0), (5, None, None, -5.0), (900, 2, "new", -9.0), (901, 77, "own", -7.0)], "id long, month int, name string, v double")
    merged = merge_layer(source, path, ["month", "id"], ["v"], ["month"])
    after = _files(path)
    kept = {f for f in before if "month=0/" in f or "month=1/" in f or "month=3/" in f or "month=4/" in f}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert not [f for f in after if f in before and f not in kept]
    rows = {r.id: r for r in merged.collect()}
    assert len(rows) == merged.count() == 602
    assert (rows[2].v, rows[5].v, rows[900].v, rows[901].month, rows[8].v) == (-1.0, -5.0, -9.0, 77, 8.0)
    # The same source again changes nothing.
    assert _set(merge_layer(source, path, ["month", "id"], ["v"], ["month"])) == _set(spark.createDataFrame(list(rows.values()), merged.schema))
    files = _files(path)
    merge_layer(source.limit(0), path, ["month", "id"], ["v"], ["month"])
    assert _files(path) == files
    with pytest.raises(ValueError, match="not in the key"):
        merge_layer(source, path, ["id"], ["v"], ["month"])


def test_merge_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_partitioned(spark.range(60).selectExpr("id", "CAST(id % 6 AS INT) AS month"), path, ["month"])
    from tallyloom.sources.sinks import _in_partitions

    pruned = spark.read.parquet(path).where(_in_partitions([(2,), (None,)], ["month"]))
    assert {r.f.split("month=")[1][0] for r in pruned.select(F.input_file_name().alias("f")).distinct().collect()} == {"2"}
    assert "PartitionFilters: [" in pruned._jdf.queryExecution().executedPlan().toString()


def _cells(spark, value):
    rows = [("C 07.00", 200108, r, value, f) for r, f in (("R1", None), ("R2", "A"), ("R3", "U"), ("R4", "X"))]
    return spark.createDataFrame(rows, "return_code string, year_month_rk int, row_id string, value double, for_adjust_flag string")


def test_run_that_dies_leaves_the_run_before(spark, tmp_path):
    folder = str(tmp_path / "return")
    publish_return(_cells(spark, 1.0), folder, 1)
    want = [("A", "R1"), ("A", "R2"), ("U", "R1"), ("U", "R3")]
    read = lambda: sorted((r.adjust_flag, r.row_id, r.value) for r in published_return(spark, folder).collect())
    assert read() == [(*k, 1.0) for k in want]
    dying = _cells(spark, 2.0).withColumn("value", F.when(F.col("row_id") == "R3", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        publish_return(dying, folder, 2)
    assert read() == [(*k, 1.0) for k in want]
    # The run is done again, twice over; then one flag alone moves on.
    publish_return(_cells(spark, 2.0), folder, 2)
    publish_return(_cells(spark, 2.0), folder, 2)
    assert read() == [(*k, 2.0) for k in want]
    publish_return(_cells(spark, 3.0), folder, 3, flags=("U",))
    assert read() == [("A", "R1", 2.0), ("A", "R2", 2.0), ("U", "R1", 3.0), ("U", "R3", 3.0)]


def test_layers_are_written_where_their_rows_are(spark, tmp_path, monkeypatch):
    """No row of a layer is moved or sorted for its write: each task writes its own rows."""
    asked = []
    df = spark.range(100).select(F.lit(200108).alias("year_month"), F.when(F.col("id") % 2 == 0, "UK-FSA").otherwise("CBI").alias("reporting_regulator_code"), F.col("id").cast("string").alias("deal_id"))
    monkeypatch.setattr(type(df), "hint", lambda df, name, *columns: asked.append(name) or df)
    written = write_layer(df, str(tmp_path / "layer"), ["year_month", "reporting_regulator_code"], Contract("deals", dict(df.dtypes), key=("deal_id",)))
    assert asked == [] and written.count() == 100
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "16"


def test_staging_shuffles_its_facts_once(spark, monkeypatch):
    """Counterparties too large to broadcast meet the pairs of deal and counterparty; the staged rows are the same."""
    inputs = JobInputs(spark, FOLDER)
    small = stage_exposures(inputs, RUN_DATE, facts=inputs["facts"])
    rows = sorted(map(repr, small.select("deal_id", "reporting_regulator_code", "mortgages_flag", "bsd_marker", "csys_id", "ler_child_counterparty").collect()))
    monkeypatch.setattr("tallyloom.plans.staging.fits_broadcast", lambda df, limit=None: False)
    monkeypatch.setattr("tallyloom.operators.joins.fits_broadcast", lambda df, limit=None: False)
    inputs = JobInputs(spark, FOLDER)
    large = stage_exposures(inputs, RUN_DATE, facts=inputs["facts"])
    assert rows == sorted(map(repr, large.select("deal_id", "reporting_regulator_code", "mortgages_flag", "bsd_marker", "csys_id", "ler_child_counterparty").collect()))


def test_copies_of_sub_exposures_are_not_needed_for_inflow(spark):
    """Sub-exposures met by deal and then by regulator give the rows that their copies give."""
    job = job_of(spark, FOLDER)
    names = ("reporting_regulator_code", "deal_id", "mitigant_id", "b2_std_exposure_value", "std_act_risk_weight")
    copies = inflow_rows(job.deals(), job.mitigants()).select(*names)
    alone = inflow_rows(job.deals(), job.subs(), copied=False).select(*names)
    assert copies.count() > 0 and sorted(map(repr, copies.collect())) == sorted(map(repr, alone.collect()))


def test_whole_deals_need_no_shuffle_of_staged_rows(spark):
    """Staged rows that hold their deal's side give the deals that a join of the wide rows gives."""
    job = job_of(spark, FOLDER)
    wide, narrow = job.wide_deals_plan(), job.deals_plan()
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    assert set(job.staged().columns) == set(job.staging_plan().columns)
    names = sorted(wide.columns)
    assert sorted(map(repr, wide.select(names).collect())) == sorted(map(repr, narrow.select(names).collect()))


def _shuffled(df):
    """Names of the columns that each exchange of a plan moves, broadcasts aside."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [re.findall(r"(\w+)#", names) for names in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)]


def test_only_narrow_rows_are_shuffled_for_the_mart(spark, monkeypatch):
    """Facts and sub-exposures are shuffled by deal before their hundreds of columns are derived, and stay there."""
    job = Job(spark, FOLDER)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "10000", "spark.sql.debug.maxToStringFields": "1000"}
    before = {name: spark.conf.get(name) for name in settings}
    # Of the tables, only the fixed lists and the nations can be broadcast.
    for name, value in settings.items():
        spark.conf.set(name, value)
    monkeypatch.setattr("tallyloom.operators.sizing.BROADCAST_LIMIT_BYTES", 10000)
    try:
        facts = _shuffled(job.staging_for_deals_plan())
        totals = _shuffled(mitigant_totals(job.subs_by_deal()).where("reporting_regulator_code = 'UK-FSA'"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # The facts travel packed as ``fact``, the totals of the mitigants as ``side``.
    assert len(facts) > 5 and max(map(len, facts)) <= 16 and not any({"fact", "side"} & set(names) for names in facts)
    assert len(totals) == 1 and len(totals[0]) <= 12


def test_deals_are_not_written_again_for_the_mart(spark):
    """The mart's files hold inflow rows alone; with the layer of deals they are both flows, and the audit counts both."""
    job = job_of(spark, FOLDER)
    mart, whole = job.mart(), unite_flows(job.deals(), job.subs(), copied=False)
    names = sorted(whole.columns)
    assert sorted(mart.columns) == names
    assert sorted(map(repr, mart.select(names).collect())) == sorted(map(repr, whole.select(names).collect()))
    assert {r.flow_type for r in job.inflow().select("flow_type").distinct().collect()} == {"INFLOW"}
    counts = {r.stage: r.n_rows for r in job.audit().table().collect()}
    assert counts["mart"] == whole.count() > counts["deals"] == job.deals().count()


def test_inputs_by_deal_hold_the_same_rows(spark):
    job = job_of(spark, FOLDER)
    for name in ("facts", "sub_exposures", "sub_exposures_oth"):
        assert sorted(map(repr, job.by_deal()[name].collect())) == sorted(map(repr, job[name].collect()))
    assert sorted(map(repr, job.subs_by_deal().where(is_unfunded_outflow()).select("deal_id", "mitigant_id", "b2_std_crm_tot_outflow_indv").collect())) == sorted(
        map(repr, job.subs().where(is_unfunded_outflow()).select("deal_id", "mitigant_id", "b2_std_crm_tot_outflow_indv").collect())
    )


def test_coarser_level_shuffles_the_mart_once(spark):
    """Summed from rows of the mart, without the finer level in between, the coarser one is the same."""
    direct = QUERIES["job_agg_mart"](spark, FOLDER)
    names = sorted(direct.columns)
    fine = aggregate_level_one(fine_level(spark, FOLDER))
    assert len(_shuffled(direct)) == 1 < len(_shuffled(fine))
    assert sorted(map(repr, direct.select(names).collect())) == sorted(map(repr, fine.select(names).collect()))


def test_rows_that_are_groups_of_their_own_stay_where_they_are(spark):
    """The full grain by digests is that of a plain sum; the exchange of all keys holds but the rows whose digest is shared."""
    rows = job_of(spark, FOLDER).mart().where("adjust_flag = 'A'")
    plain, fine = aggregate_mart(rows), fine_level(spark, FOLDER)
    names = plain.columns
    assert fine.dtypes == plain.dtypes
    assert _set(fine.select(names)) == _set(plain)
    assert min(map(len, _shuffled(plain))) > 100 and "LeftAnti" in fine._jdf.queryExecution().executedPlan().toString()


def test_quarter_target_is_written_where_its_rows_are(spark, monkeypatch):
    """The distinct keys of the mart are not moved once more for their write; only the merged rows are."""
    frame = type(spark.range(1))
    asked, plain = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, name, *columns: asked.append(name) or plain(df, name, *columns))
    assert QUERIES["job_quarter"](spark, FOLDER).count() > 0
    assert asked.count("rebalance") == 1


@pytest.mark.parametrize(("name", "most"), [("quarter_default_amounts", 160), ("job_return", 220), ("job_agg_mart_fine", 400), ("job_agg_mart", 310)])
def test_readers_of_few_columns_write_few(spark, monkeypatch, name, most):
    """Without a mart to read, a query on few of its columns writes deals and inflow rows with these alone, and gives the same."""
    job_of(spark, FOLDER).mart()
    whole = _set(QUERIES[name](spark, FOLDER))
    layers = []
    monkeypatch.setattr("tallyloom.catalog.jobs._JOBS", {})
    monkeypatch.setattr("tallyloom.catalog.jobs.write_layer", lambda df, *rest: layers.append((rest[4], len(df.columns))) or write_layer(df, *rest))
    assert _set(QUERIES[name](spark, FOLDER)) == whole
    assert [stage for stage, _ in layers] == ["deals", "mart"] and sum(n for _, n in layers) < most


def test_narrow_mart_is_the_whole_one(spark):
    """Columns of the mart derived for a reader of few of them, rules of the last pack among them, are those of the whole mart."""
    wanted = (*FINAL_COLUMNS, *INTERNAL_TOTALS, *REDUCTION_TOTALS.values(), "basel_security_sub_type", "b2_irb_gtee_amt")
    narrow, whole = Job(spark, FOLDER).narrow_mart("test", wanted), job_of(spark, FOLDER).mart()
    assert set(wanted) < set(narrow.columns) < set(whole.columns)
    assert _set(narrow) == _set(whole.select(narrow.columns))


def test_contract_of_a_layer_that_is_not_written(spark):
    rows = spark.createDataFrame([*ROWS, (1, None, "Y", 1.0, 5, 7), (2, "a", "Y", 1.0, 5, 7)], COLUMNS)
    with pytest.raises(ContractViolation) as found:
        CONTRACT.check(rows)
    assert found.value.report == ["column deal is null in 1 rows", "key (month, deal) is not unique: 1 keys occur more than once"]
    with pytest.raises(ContractViolation) as found:
        CONTRACT.check(rows.drop("deal"))
    assert found.value.report == ["column deal is missing"]
    good = spark.createDataFrame(ROWS, COLUMNS)
    assert CONTRACT.check(good) is good


@pytest.mark.parametrize(("name", "stages", "most"), [("rules_risk_weight", ["deals", "mart"], 150), ("job_quarter", ["deals", "mart"], 260), ("rules_inflow", ["deals"], 80), ("rules_cap_allocate", ["deals"], 120), ("rules_support_factor", ["deals"], 80)])
def test_rules_on_few_columns_write_few(spark, monkeypatch, name, stages, most):
    """Queries on a pack's columns write those alone, and give what they give on whole layers."""
    job_of(spark, FOLDER).mart()
    whole = _set(QUERIES[name](spark, FOLDER))
    layers = []
    monkeypatch.setattr("tallyloom.catalog.jobs._JOBS", {})
    monkeypatch.setattr("tallyloom.catalog.jobs.write_layer", lambda df, *rest: layers.append((rest[4], len(df.columns))) or write_layer(df, *rest))
    assert _set(QUERIES[name](spark, FOLDER)) == whole
    assert [stage for stage, _ in layers] == stages and sum(n for _, n in layers) < most


def test_many_providers_do_not_pass_through_the_driver(spark, tmp_path, monkeypatch):
    """Counterparties whose file is packed far below their size as rows are cut to those that provide protection, with the same result."""
    tables = Job(spark, FOLDER)
    rows = spark.range(1_500_000).selectExpr("IF(id < 1000, id, id * 2654435761 % 1099511627776) AS counterparty_rk", "CAST(200 + id % 16 AS INT) AS b2_std_asset_class_rk")
    rows.unionByName(rows.where("counterparty_rk < 3")).write.parquet(str(tmp_path / "parties"))
    parties = spark.read.parquet(str(tmp_path / "parties"))
    tables["counterparties"] = parties.selectExpr("*", "200108 AS year_month_rk", "20010831 AS day_rk", "'Y' AS valid_flag")
    named = tables["sub_exposures"].selectExpr("provider_counterparty_rk AS k").union(tables["sub_exposures_oth"].selectExpr("provider_counterparty_rk")).distinct()
    cut = provider_classes(tables, RUN_DATE)
    assert 0 < cut.count() <= named.count() + 3 < 1000
    wanted = sub_exposure_rows(tables, RUN_DATE)
    monkeypatch.setattr("tallyloom.operators.joins.fits_broadcast", lambda df, limit=None: True)
    assert provider_classes(tables, RUN_DATE).count() == parties.count()
    names = ["deal_id", "mitigant_id", "provider_counterparty_rk", "provider_b2_std_asset_class", "corep_std_asset_class_rk"]
    assert _set(wanted.select(names)) == _set(sub_exposure_rows(tables, RUN_DATE).select(names))


def test_whole_mart_writes_no_layer_it_does_not_read(spark, monkeypatch):
    """The mart alone is that of the layers; the audit of the same run then writes the layers that were left out and counts all."""
    job = job_of(spark, FOLDER)
    whole = _set(QUERIES["job_mart"](spark, FOLDER))
    job.staged(), job.subs(), job.mart()
    counts = _set(QUERIES["job_audit"](spark, FOLDER))
    layers = []
    monkeypatch.setattr("tallyloom.catalog.jobs._JOBS", {})
    monkeypatch.setattr("tallyloom.catalog.jobs.write_layer", lambda df, *rest: layers.append(rest[4]) or write_layer(df, *rest))
    assert _set(QUERIES["job_mart"](spark, FOLDER)) == whole
    assert layers == ["deals", "mart"]
    assert _set(QUERIES["job_audit"](spark, FOLDER)) == counts and len(counts) == 4
    assert sorted(layers) == ["deals", "mart", "staged", "sub_exposures"]
