"""Sinks: month overwrites into partitioned parquet, merges, and return loading."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.setops import merge_upsert
from tallyloom.session import scratch_table
from tallyloom.sources.layouts import Contract, ContractViolation


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], cluster: bool = True, codec: str = "snappy") -> None:
    """Overwrite only the partitions that are written.

    ``cluster`` rebalances rows by partition value so that each partition gets
    a few large files; a partition that is much larger than the others is
    split over several writers, so no task writes it alone. Without it each
    task writes its own rows: no shuffle, and a file per task and partition.
    """
    rows = df.hint("rebalance", *[F.col(c) for c in by]) if cluster else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", codec)
        .partitionBy(*by)
        .parquet(path)
    )


def write_wide(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write rows of hundreds of columns where they are: a shuffle of them costs several times their files."""
    write_partitioned(df, path, by, cluster=False, codec="zstd")


def write_layer(df: DataFrame, path: str, by: Sequence[str], contract: Contract | None = None, audit: AuditLog | None = None, stage: str = "", beside: int = 0) -> DataFrame:
    """Write a layer and continue from what was written.

    Later steps then start from files on shared storage: a lost executor costs
    a rescan of its split, not the chain of joins behind the layer. With a
    contract, its names and types are checked before anything runs; its nulls
    are counted while rows are written and its key is checked on what was
    written, before the layer is handed on. With an audit log the counts are
    kept under ``stage``: no job of their own. ``beside`` counts rows of the
    layer that stand in the files of an earlier one and are not written again.
    """
    if contract is not None:
        report = contract.schema_report(df)
        if report:
            raise ContractViolation(contract.layer, report)
    if contract is None and audit is None:
        write_partitioned(df, path, by)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    seen, metrics = Observation(), contract.null_counts() if contract is not None else []
    write_wide(df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *metrics), path, by)
    written, counts = df.sparkSession.read.schema(df.schema).parquet(path), seen.get
    report = contract.row_report(written, counts) if contract is not None else []
    if report:
        raise ContractViolation(contract.layer, report)
    if audit is not None:
        audit.add(stage, counts["n_rows"] + beside)
    return written


class AuditLog:
    """Row counts of layer writes, a row for each run and stage, in a folder."""

    SCHEMA = "run string, stage string, place int, n_rows long"

    def __init__(self, spark: SparkSession, folder: str, run: str):
        self.spark, self.folder, self.run, self.place = spark, folder, run, 0
        self.rows: dict[str, int] = {}

    def add(self, stage: str, n_rows: int) -> None:
        """Append one stage; a stage that is written again counts with its last row."""
        self.place += 1
        self.rows[stage] = n_rows
        self.spark.createDataFrame([(self.run, stage, self.place, n_rows)], self.SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def table(self) -> DataFrame:
        """(run, stage, n_rows) as last written."""
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.folder)
        return rows.groupBy("run", "stage").agg(F.max_by("n_rows", "place").alias("n_rows"))


def _in_partitions(values: Sequence[Sequence], by: Sequence[str]) -> Column:
    """Rows of the given partitions; made of partition columns only, so others are never listed or read."""
    one = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, row)]) for row in values]
    return reduce(lambda a, b: a | b, one)


def merge_layer(
    source: DataFrame, path: str, keys: Sequence[str], update: Sequence[str], by: Sequence[str], insert: Mapping[str, object] | None = None
) -> DataFrame:
    """Merge a source into a partitioned layer and return the layer.

    Only the partitions that hold a row of the source are read, merged and
    replaced. The partition columns belong to the key, so no row can match in
    another one. The merged rows are written apart first: a run that dies there
    leaves the layer as it was, and one that dies while partitions are put in
    place can be run again, since a merge with the same source is the same.
    """
    if not set(by) <= set(keys):
        raise ValueError(f"partition columns {sorted(set(by) - set(keys))} are not in the key")
    layer = source.sparkSession.read.parquet(path)
    # Months and regulators: a short list whatever the number of rows.
    touched = [tuple(row) for row in source.select(*by).distinct().collect()]
    if touched:
        merged = merge_upsert(layer.where(_in_partitions(touched, by)), source, keys, update, insert)
        write_partitioned(scratch_table(merged, "merge"), path, by)
    return source.sparkSession.read.schema(layer.schema).parquet(path)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Replace the written partitions of a table, matching columns by name."""
    target = [f.name for f in df.sparkSession.table(table).schema.fields]
    have = {c.lower(): c for c in df.columns}
    missing = [c for c in target if c.lower() not in have]
    extra = set(have) - {c.lower() for c in target}
    if missing or extra:
        raise ValueError(f"columns differ: missing {missing}, unexpected {sorted(extra)}")
    df.select(*[F.col(have[c.lower()]).alias(c) for c in target]).write.mode("overwrite").insertInto(
        table, overwrite=True
    )


def save_table(df: DataFrame, table: str, by: Sequence[str], path: str | None = None) -> None:
    """Create or replace a partitioned table, in the warehouse or at a path of its own."""
    writer = df.write.format("parquet").mode("overwrite").partitionBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def _per_flag(cells: DataFrame, flags: Iterable[str]) -> DataFrame:
    """Cells once for each dataset flag; those without a flag belong to every one."""
    wanted, own = F.array(*[F.lit(f) for f in flags]), F.col("for_adjust_flag")
    every = cells.withColumn("adjust_flag", F.explode(F.when(own.isNull(), wanted).otherwise(F.array(own))))
    return every.where(F.col("adjust_flag").isin(*flags))


def load_return(cells: DataFrame, path: str, flags: Iterable[str] = ("A", "U")) -> None:
    """Load staged return cells once per dataset flag.

    Cells without a flag of their own belong to every flag; the flag becomes a
    partition, so a rerun for one flag replaces only that flag.
    """
    write_partitioned(_per_flag(cells, list(flags)), path, RETURN_PARTS)


RETURN_PARTS = ("return_code", "year_month_rk", "adjust_flag")
RUN_LEDGER = "return_code string, year_month_rk int, adjust_flag string, run_rk long, n_cells long, place string"


def publish_return(cells: DataFrame, folder: str, run_rk: int, flags: Iterable[str] = ("A", "U")) -> None:
    """Load a run of a return beside the earlier ones, then name it in the run ledger.

    The cells go to a folder of the run. Only when all of them are written
    does one file join the ledger, a row for each return, month and flag: until
    then readers see the cells of the run before, and a run that died half-way
    is simply run again.
    """
    place = f"runs/run={run_rk}"
    write_partitioned(_per_flag(cells, list(flags)), f"{folder}/{place}", RETURN_PARTS)
    written = cells.sparkSession.read.parquet(f"{folder}/{place}")
    entries = written.groupBy(*RETURN_PARTS).agg(F.count(F.lit(1)).alias("n_cells")).select(
        F.col("return_code").cast("string"), F.col("year_month_rk").cast("int"), F.col("adjust_flag").cast("string"),
        F.lit(run_rk).cast("long").alias("run_rk"), "n_cells", F.lit(place).alias("place"),
    )
    entries.coalesce(1).write.mode("append").parquet(f"{folder}/ledger")


def published_return(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of the latest run of each return, month and flag; cells of other runs are not read."""
    entries = spark.read.schema(RUN_LEDGER).parquet(f"{folder}/ledger")
    current = entries.groupBy(*RETURN_PARTS).agg(F.max_by("place", "run_rk").alias("place")).collect()
    parts = {}
    for row in current:
        parts.setdefault(row.place, []).append((row.return_code, row.year_month_rk, row.adjust_flag))
    frames = [spark.read.parquet(f"{folder}/{place}").where(_in_partitions(values, RETURN_PARTS)) for place, values in sorted(parts.items())]
    return reduce(lambda a, b: a.unionByName(b), frames)
