"""The operators of this subpackage on the shared test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    decontamination, exact_dedup, importance, language_id, line_dedup, merkle, mixing, ngram_join, packing, pii, quality, secrets, toxicity,
)
from tallyloom.llm.compression import sampled_labels, with_texts
from tallyloom.llm.language_id import held_out
from tallyloom.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return register


# --- SQL helpers: spans from the pieces between matches ------------------------


def _spans(kind: str, pattern: str, keep: str, text: str = "t") -> str:
    """SQL list of (kind, start, end, m) for the kept matches of a pattern."""
    return f"""list_filter(list_transform(range(len(regexp_extract_all({text}, '{pattern}'))), lambda i: {{
        'kind': '{kind}',
        'start': coalesce(list_sum(list_transform(string_split_regex({text}, '{pattern}')[1:i + 1], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(regexp_extract_all({text}, '{pattern}')[1:i], lambda x: length(x))), 0),
        'stop': coalesce(list_sum(list_transform(string_split_regex({text}, '{pattern}')[1:i + 1], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(regexp_extract_all({text}, '{pattern}')[1:i + 1], lambda x: length(x))), 0),
        'm': regexp_extract_all({text}, '{pattern}')[i + 1]}}), lambda s: {keep})"""


def _join(spans: str) -> str:
    return f"array_to_string(list_transform({spans}, lambda s: s.kind || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.stop AS BIGINT)), ',')"


_DIGITS = "regexp_replace(s.m, '[^0-9]', '', 'g')"
_LUHN = f"""(length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length({_DIGITS})),
    lambda k: CASE WHEN k % 2 = 0 THEN CAST(substr({_DIGITS}, CAST(length({_DIGITS}) - k AS BIGINT), 1) AS INTEGER)
         ELSE (CAST(substr({_DIGITS}, CAST(length({_DIGITS}) - k AS BIGINT), 1) AS INTEGER) * 2) % 10
            + (CAST(substr({_DIGITS}, CAST(length({_DIGITS}) - k AS BIGINT), 1) AS INTEGER) * 2) // 10 END)) % 10 = 0)"""
_OCTET = "len(list_filter(string_split(s.m, '.'), lambda o: length(ltrim(o, '0')) > 3 OR CAST('0' || right(ltrim(o, '0'), 3) AS INTEGER) > 255)) = 0"
_IBAN = """(regexp_full_match(s.m, '[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}') AND list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(
    string_split(substr(s.m, 5) || substr(s.m, 1, 4), ''), lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS BIGINT))),
    lambda a, c: CASE WHEN c > 9 THEN (a * 100 + c) % 97 ELSE (a * 10 + c) % 97 END) = 1)"""
_SSN = """(regexp_full_match(s.m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND NOT regexp_matches(s.m, '^(?:000|666|9)|-00-|-0000$')
    AND regexp_matches(lower(substr(t, greatest(CAST(s.start AS BIGINT) - 40, 0) + 1, CAST(s.start AS BIGINT) - greatest(CAST(s.start AS BIGINT) - 40, 0))
        || ' ' || substr(t, CAST(s.stop AS BIGINT) + 1, 40)), 'ssn|social|security|tax'))"""

OP4_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT doc_id,
  {_spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true")} AS email,
  {_spans("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", _OCTET)} AS ip,
  {_spans("card", r"[0-9](?:[\x20-]?[0-9])+", _LUHN)} AS card,
  {_spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15")} AS phone,
  {_spans("iban", r"[A-Za-z0-9]*[A-Z]{2}[0-9]{2}[A-Z0-9]{11}[A-Za-z0-9]*", _IBAN)} AS iban,
  {_spans("ssn", r"[0-9-]*[0-9]{3}-[0-9]{2}-[0-9]{4}[0-9-]*", _SSN)} AS ssn
  FROM texts)
SELECT doc_id, CAST(len(email) AS BIGINT) AS n_email, CAST(len(ip) AS BIGINT) AS n_ip,
  CAST(len(card) AS BIGINT) AS n_card, CAST(len(phone) AS BIGINT) AS n_phone,
  sha256({_join("list_concat(list_concat(email, ip), list_concat(card, phone))")}) AS base_sha256,
  {_join("list_concat(list_concat(list_concat(email, ip), list_concat(card, phone)), list_concat(iban, ssn))")} AS spans
FROM found
"""


@query("op4_pii", OP4_SQL)
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(pii.find_pii(table(spark, folder, "documents")))


_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""


def _ordered(*kinds: str) -> str:
    """SQL list of the spans of several columns by start, then as listed."""
    every = ", ".join(
        f"list_transform({k}, lambda s: {{'start': CAST(s.start AS BIGINT), 'rank': {n}, 'stop': CAST(s.stop AS BIGINT), 'kind': s.kind}})"
        for n, k in enumerate(kinds)
    )
    return f"list_sort(flatten([{every}]))"


OP9_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT doc_id,
  {_spans("assign", _ASSIGN, f"length(regexp_extract(s.m, '{_VALUE}', 1)) >= 8")} AS assign,
  {_spans("access", "AKIA[A-Z0-9]+", "length(s.m) >= 16")} AS access,
  {_spans("hex", "[0-9a-f]{32,}", "true")} AS hex,
  {_spans("forge", "[A-Za-z0-9]*gh[oprsu]_[A-Za-z0-9]{36,}", "regexp_full_match(s.m, 'gh[oprsu]_[A-Za-z0-9]+')")} AS forge,
  {_spans("jwt", r"[A-Za-z0-9_-]*eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "starts_with(s.m, 'eyJ')")} AS jwt,
  {_spans("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", "true")} AS pem
  FROM texts)
SELECT doc_id, CAST(len(assign) AS BIGINT) AS n_assign, CAST(len(access) AS BIGINT) AS n_access, CAST(len(hex) AS BIGINT) AS n_hex,
  sha256({_join(_ordered("assign", "access", "hex"))}) AS base_sha256,
  {_join(_ordered("assign", "access", "hex", "forge", "jwt", "pem"))} AS spans
FROM found
"""


@query("op9_secrets", OP9_SQL)
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    ledger = secrets.Ledger(spark)
    return secrets.report(ledger.scan(table(spark, folder, "documents")))


OP10_SQL = r"""
WITH rows AS (SELECT doc_id, coalesce(length(text), 0) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
picked AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size FROM rows)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, text_sha256 FROM picked
"""


@query("op10_exact_dedup", OP10_SQL)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.in_two_batches(table(spark, folder, "documents")).drop("in_snapshot")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels that may be learned from."""
    labels = table(spark, folder, "labels")
    return labels.where(~held_out(labels, 3, 1))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = language_id.learn(documents.where(~held_out(documents)))
    predicted = language_id.predict(documents, model)
    return predicted.withColumn("held_out", held_out(predicted))


def _position(used: str, knots) -> str:
    """SQL of the time at which a weight schedule has used up a share of its integral."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    spent, before, branches = f"({used} * {float(sum(areas))!r}e0)", 0.0, []
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
        rest, slope = f"greatest({spent} - {before!r}e0, 0e0)", (w1 - w0) / (t1 - t0)
        root = f"sqrt(greatest({w0 * w0!r}e0 + {2 * slope!r}e0 * {rest}, 0e0))"
        branches.append(f"WHEN {spent} < {before + area!r}e0 THEN {t0!r}e0 + 2e0 * {rest} / ({w0!r}e0 + {root})")
        before += area
    return f"CASE {' '.join(branches)} ELSE {float(knots[-1][0])!r}e0 END"


_SCHEDULES = {5: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 1: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))}
_TIME = "CASE w " + " ".join(f"WHEN {w} THEN {_position('(start / target)', knots)}" for w, knots in _SCHEDULES.items()) + " END"

OP3_SQL = rf"""
WITH s AS (SELECT row_number() OVER () AS id, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s GROUP BY source),
room AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS pool,
    CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(sum(2 * source_size) OVER before, 0) AS rest,
    sum(w) OVER (ORDER BY CAST(source_size AS DOUBLE) / w, coalesce('=' || source, '') ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharing
    FROM src WINDOW before AS (ORDER BY CAST(source_size AS DOUBLE) / w, coalesce('=' || source, '') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, w * rest > 2 * source_size * sharing AS is_full FROM room),
aims AS (SELECT source, source_size, w, CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
    ELSE (pool - coalesce(sum(2 * source_size) FILTER (is_full) OVER (), 0)) * w / sum(w) FILTER (NOT is_full) OVER () END AS target FROM filled),
placed AS (SELECT s.id, s.doc_id, s.source, s.size, a.source_size, a.w, a.target, CAST(floor(a.target + 0.5) AS BIGINT) AS goal,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(CAST(s.doc_id AS VARCHAR)), s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS first
    FROM s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source),
readings AS (SELECT *, CAST(first + reading * source_size AS DOUBLE) AS start, greatest(least(goal - first - reading * source_size, size), 0) AS take
    FROM placed, (VALUES (0), (1)) AS r(reading)),
timed AS (SELECT *, {_TIME} AS position FROM readings WHERE take > 0),
ordered AS (SELECT *, row_number() OVER (ORDER BY position, source NULLS FIRST, doc_id NULLS FIRST, reading) AS rank FROM timed),
begun AS (SELECT id, min(rank) AS training_rank, arg_min(position, rank) AS first_position FROM ordered GROUP BY id)
SELECT doc_id, size, source_size, target, CAST(greatest(least(goal - first, size), 0) + greatest(least(goal - first - source_size, size), 0) AS BIGINT) AS taken,
    first_position, training_rank FROM placed LEFT JOIN begun USING (id)
"""


@query("op3_mixing", OP3_SQL)
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.ranked_documents(mixing.mix(table(spark, folder, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_position", "training_rank")


@query("op5_quality")
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    labels = _labels(spark, folder)
    sample = with_texts(documents, sampled_labels(labels, "quality", quality.sample_rows()))
    share = labels.where(F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    scored = quality.score(documents, quality.learn(sample, share=share))
    return scored.withColumn("held_out", held_out(scored, 3, 1))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    sample = with_texts(documents, sampled_labels(_labels(spark, folder), "toxic", toxicity.LABELLED.rows))
    scored = toxicity.score(documents, toxicity.learn(sample))
    return scored.withColumn("held_out", held_out(scored, 3, 1))


@query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.removals(table(spark, folder, "documents"))


@query("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op11_best_fit_packing")
def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, folder, "documents")))


def _crc(x: str) -> str:
    """SQL for the unsigned CRC of a text, with the lookups of ``crc_table``."""
    pairs = f"hex(encode({x}))"
    state = f"""list_reduce(list_prepend(4294967295, list_transform(range(len({pairs}) // 2),
        lambda i: CAST('0x' || substr({pairs}, 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]))"""
    return f"xor(CAST({state} AS BIGINT), 4294967295)"


_CRC_ROWS = """
RECURSIVE crc_steps(b, c, k) AS (SELECT range, CAST(range AS BIGINT), 0 FROM range(256)
    UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
crc_lookup AS (SELECT list(c ORDER BY b) AS crc_table FROM crc_steps WHERE k = 8)"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP12_SQL = f"""
WITH {_CRC_ROWS},
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
texts AS (SELECT doc_id, w, list_concat(w, list_transform(range(greatest(len(w) - 1, 0)), lambda i: w[i + 1] || ' ' || w[i + 2])) AS f FROM docs),
goal AS (SELECT list_concat(w, list_transform(range(greatest(len(w) - 1, 0)), lambda i: w[i + 1] || ' ' || w[i + 2])) AS f FROM (SELECT {_WORDS} AS w FROM benchmark)),
spread AS MATERIALIZED (SELECT doc_id, unnest(f) AS x FROM texts),
aimed AS MATERIALIZED (SELECT unnest(f) AS x FROM goal),
coded AS MATERIALIZED (SELECT x, {_crc("x")} % 10000 AS bucket FROM (SELECT x FROM spread UNION SELECT x FROM aimed), crc_lookup),
s AS (SELECT bucket, count(*) AS s FROM spread JOIN coded USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM aimed JOIN coded USING (x) GROUP BY bucket),
gain AS (SELECT b.range AS bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (coalesce((SELECT sum(s) FROM s), 0) + 10000)::DOUBLE)
        / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE))) AS BIGINT) AS g
    FROM range(10000) b LEFT JOIN s ON s.bucket = b.range LEFT JOIN t ON t.bucket = b.range),
means AS (SELECT doc_id, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS m FROM spread JOIN coded USING (x) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w) AS n_words, CAST(len(f) AS BIGINT) AS n_features, coalesce(m, 0) AS weight,
    coalesce(m, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM texts LEFT JOIN means USING (doc_id)),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranks USING (doc_id)
"""


@query("op12_importance_resampling", OP12_SQL)
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _enc(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"


def _tree(name: str, nodes: str) -> str:
    """SQL of all levels of the trees over nodes (g, idx, h, n), and the left and right siblings of each node."""
    return f"""
{name}(lvl, g, idx, h, n) AS (SELECT 0, g, idx, h, n FROM {nodes}
    UNION ALL SELECT lvl + 1, g, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8 FROM {name} WHERE n > 1 GROUP BY lvl, g, idx // 8, n),
{name}_sides AS (SELECT a.lvl, a.g, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
    FROM {name} a JOIN {name} b ON a.lvl = b.lvl AND a.g = b.g AND a.idx // 8 = b.idx // 8 WHERE a.n > 1 GROUP BY a.lvl, a.g, a.idx)"""


_LOWERED = "CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
_FIELDS = ("doc_id", "source", "lang", "n_chars")


OP13_SQL = f"""
WITH {_CRC_ROWS},
docs AS (SELECT *, {_crc("CAST(doc_id AS VARCHAR)")} AS crc FROM documents, crc_lookup),
leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS g,
    sha256({" || ".join(_enc(x) for x in (*_FIELDS, "text"))}) AS h,
    sha256({" || ".join(_enc(x) for x in _FIELDS)} || {_enc("(" + _LOWERED + ")")}) AS shown FROM docs),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM leaves),
{_tree("low", "placed")},
subroots AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS idx, h, count(*) OVER () AS n, g AS branch FROM low WHERE n = 1),
{_tree("high", "subroots")},
steps AS (SELECT p.g, p.idx, x.lvl, x.l, x.r FROM placed p JOIN low_sides x ON x.g = p.g AND x.idx = p.idx // CAST(8 ** x.lvl AS BIGINT)
    UNION ALL SELECT p.g, p.idx, 100 + x.lvl, x.l, x.r FROM placed p JOIN subroots s ON s.branch = p.g JOIN high_sides x ON x.idx = s.idx // CAST(8 ** x.lvl AS BIGINT)),
paths AS (SELECT g, idx, list({{'l': l, 'r': r}} ORDER BY lvl) AS path, string_agg(l || r, '' ORDER BY lvl) AS proof FROM steps GROUP BY g, idx),
folds(g, idx, k, node) AS (SELECT g, idx, 0, shown FROM placed
    UNION ALL SELECT f.g, f.idx, k + 1, sha256(path[k + 1].l || node || path[k + 1].r) FROM folds f JOIN paths p ON p.g = f.g AND p.idx = f.idx WHERE k < len(path)),
ends AS (SELECT g, idx, arg_max(node, k) AS folded_root FROM folds GROUP BY g, idx)
SELECT doc_id, placed.h AS leaf, s.h AS subroot, top.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = top.h AS verified
FROM placed JOIN ends e ON e.g = placed.g AND e.idx = placed.idx LEFT JOIN paths ON paths.g = placed.g AND paths.idx = placed.idx
    JOIN subroots s ON s.branch = placed.g CROSS JOIN (SELECT h FROM high WHERE n = 1) top
"""


@query("op13_merkle_manifest", OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    checks = merkle.manifest(merkle.leaves(documents, merkle.tampered(documents))).checks()
    return checks.select(
        F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
