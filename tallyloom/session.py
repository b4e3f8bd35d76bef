"""Session settings the plans rely on."""

from __future__ import annotations

import atexit
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: each can be set on a session that already exists.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One key may hold a third of a fact table: split that partition even
    # when a later aggregation then needs its own exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Staged layers are about 200 columns wide; without this, every operator
    # on them leaves whole-stage code generation.
    "spark.sql.codegen.maxFields": "1000",
    # Month overwrites touch only the partitions that are written.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Rows that lie by deal already meet others by deal and regulator where
    # they are; only the other side is shuffled.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A task holds a few months and regulators: it writes them side by side
    # and does not sort its wide rows by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session; ``conf`` uses underscores for dots."""
    builder = SparkSession.builder.appName(app_name).config(
        # Recording the Python call site of every column call costs more than
        # building the plans of the wide layers.
        "spark.python.sql.dataFrameDebugging.enabled",
        "false",
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), value)
    return prepare(builder.getOrCreate())


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is made only where none is named, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tallyloom-")
    context.setCheckpointDir(folder)
    return folder


# Folders of intermediate tables, by application id: (session, path).
_SCRATCH: dict[str, list[tuple[SparkSession, str]]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder for one intermediate table, removed by ``drop_scratch``."""
    path = f"{checkpoint_folder(spark).rstrip('/')}/{label}-{uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append((spark, path))
    return path


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a rescan of the files, not
    the work behind them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application."""
    for session, path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        target = session._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(session._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _drop_all_scratch() -> None:
    for tables in list(_SCRATCH.values()):
        session = tables[0][0]
        if session.sparkContext._jsc is not None:
            try:
                drop_scratch(session)
            except Exception:  # noqa: BLE001  the session may be gone already
                return
