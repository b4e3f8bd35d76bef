"""Secret scans: an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the digest of its content. The
ledger holds which blob was scanned under which rule version, and what was
found; a scan reads only pairs of blob and rule version that the ledger does
not hold, and findings are joined back to all paths that ever had the blob.
Contents are scanned where they are read: only digests and findings are
shuffled, which costs a second scan of a blob that several rows of one batch
share, and no text is sorted or moved. All of it is native columns: no Python
runs on the executors.

Defined results: a null content is the empty blob; a blob that many paths
share is listed once, and not scanned again by later batches; repeated rows are
reported each; an empty table gives no rows; other columns of the input are
ignored.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.spans import joined, matches, scored
from tallyloom.session import scratch_path, scratch_table

# One pattern for each kind. Raise RULES with any change.
RULES = 1
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
FORGE = r"(?<![A-Za-z0-9])gh[oprsu]_[A-Za-z0-9]{36,}+"
JWT = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
PEM = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
KEYWORDS = ("password", "passwd", "secret", "token", "api")
BASE = ("assign", "access", "hex")
ADDED = ("forge", "jwt", "pem")


def _has_keyword(text: Column) -> Column:
    lowered = F.lower(text)
    found = F.contains(lowered, F.lit(KEYWORDS[0]))
    for word in KEYWORDS[1:]:
        found = found | F.contains(lowered, F.lit(word))
    return found


def spans_of(text: Column) -> Column:
    """All spans of a text that is not null, by start, then kind as listed."""

    def always(value):
        return lambda s: F.lit(value)

    def long_value(s):
        return F.length(F.regexp_extract(s["match"], ASSIGN_VALUE, 1)) >= 8

    every = [
        scored("assign", matches(text, ASSIGN, _has_keyword(text)), long_value, always(0.7)),
        scored("access", matches(text, ACCESS, F.contains(text, F.lit("AKIA"))), always(True), always(0.9)),
        scored("hex", matches(text, HEX, text.rlike("[0-9a-f]{32}")), always(True), always(0.5)),
        scored("forge", matches(text, FORGE, text.rlike("gh[oprsu]_[A-Za-z0-9]")), always(True), always(0.9)),
        scored("jwt", matches(text, JWT, F.contains(text, F.lit("eyJ"))), always(True), always(0.8)),
        scored("pem", matches(text, PEM, F.contains(text, F.lit("PRIVATE KEY-----"))), always(True), always(0.9)),
    ]
    ranked = [
        F.transform(spans, lambda s, n=n: F.struct(s["start"].alias("start"), F.lit(n).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["score"].alias("score"), s["match"].alias("match")))
        for n, spans in enumerate(every)
    ]
    return F.array_sort(F.concat(*ranked))


class Ledger:
    """Tables in a folder: scanned pairs of blob and rule version, findings."""

    PAIRS = "blob string, rules int"
    FINDINGS = "blob string, rules int, spans array<struct<start:int,rank:int,end:int,kind:string,score:double,match:string>>"

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, (folder or scratch_path(spark, "ledger")).rstrip("/")
        for name, schema in (("pairs", self.PAIRS), ("findings", self.FINDINGS)):
            # An empty first part, so that either table can always be read.
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.folder}/{name}/part=0")

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.folder}/{name}")

    def pairs(self) -> DataFrame:
        return self._table("pairs", self.PAIRS)

    def findings(self) -> DataFrame:
        return self._table("findings", self.FINDINGS)

    def scan(self, versions: DataFrame, path: str = "doc_id", content: str = "text", rules: int = RULES) -> DataFrame:
        """Scan what is unseen; then (path, blob, spans) for every version given."""
        versions = versions.select(F.col(path).alias("path"), F.coalesce(F.col(content), F.lit("")).alias("content"))
        versions = versions.withColumn("blob", F.sha2(F.col("content").cast("binary"), 256))
        paths = scratch_table(versions.select("path", "blob"), "paths")
        seen = self.pairs().where(F.col("rules") == rules).select("blob")
        unseen = versions.join(seen, "blob", "left_anti")
        found = unseen.select("blob", F.lit(rules).alias("rules"), spans_of(F.col("content")).alias("spans"))
        # Findings first: a pair is listed as scanned only once its findings are kept.
        part = uuid4().hex
        fresh = scratch_table(found, "scanned")
        # Rows of one blob have the same spans; those without any are not shuffled.
        fresh.where(F.size("spans") > 0).dropDuplicates(["blob"]).write.mode("overwrite").parquet(f"{self.folder}/findings/part={part}")
        fresh.select("blob", "rules").distinct().write.mode("overwrite").parquet(f"{self.folder}/pairs/part={part}")
        results = self.findings().where(F.col("rules") == rules).select("blob", "spans").dropDuplicates(["blob"])
        none = F.array().cast(results.schema["spans"].dataType)
        return paths.join(results, "blob", "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))


def report(found: DataFrame) -> DataFrame:
    """Counts and joined spans for each path of a scan."""

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        F.col("path").alias("doc_id"),
        *(count(kind) for kind in BASE),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
