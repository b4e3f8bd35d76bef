"""Personal data: patterns propose, checksums confirm, context adjusts.

All of it is native columns: no Python runs on the executors.

Kinds with a fixed rule (email, ip, card, phone) always stay once their check
holds; the method adds iban (mod 97) and ssn (number ranges), which must also
reach ``threshold`` after context words near them moved their score.

Defined results: a null text counts as empty and has no spans; repeated rows
are reported each; an empty table gives no rows; a column of the input is kept
only where it is asked for by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.spans import around, joined, matches, scored

# One pattern for each kind. Runs are possessive and begin at
# the begin of a run or right after the previous match, which finds the same
# spans as the plain form without walking a long run once per character.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

# Words near a span that speak for its kind.
CONTEXT = {
    "email": r"mail|contact|write|schreib|correo|courriel",
    "ip": r"\bip\b|address|server|host|adresse",
    "card": r"card|visa|credit|karte|tarjeta|carte",
    "phone": r"phone|call|tel|mobile|fax|anruf|llam",
    "iban": r"iban|account|bank|konto|cuenta|compte",
    "ssn": r"ssn|social|security|tax",
}
# Score that the check alone gives.
CHECKED = {"email": 0.8, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
NEAR = 0.2
WIDTH = 40
THRESHOLD = 0.5
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _is_ip(match: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def _is_card(match: Column) -> Column:
    digits = _digits(match)
    # The length is tested first: the checksum only ever sees short numbers.
    return F.when(F.length(digits).between(13, 19), F.call_function("luhn_check", digits)).otherwise(False)


def mod97(match: Column) -> Column:
    """Remainder of an IBAN: the first four characters move to the end, letters count from 10."""
    moved = F.concat(F.substring(match, 5, 64), F.substring(match, 1, 4))
    return F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda acc, c: F.when(c == "", acc)
        .when(c.rlike("^[0-9]$"), (acc * 10 + F.ascii(c) - 48) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )


def _is_ssn(match: Column) -> Column:
    return ~match.rlike(r"^(?:000|666|9)|-00-|-0000$")


def spans_of(text: Column, threshold: float = THRESHOLD) -> Column:
    """All spans of a text that is not null, by kind as listed, then by start."""

    def score(kind):
        return lambda s: F.lit(CHECKED[kind]) + F.when(around(s).rlike(CONTEXT[kind]), F.lit(NEAR)).otherwise(F.lit(0.0))

    digit_pair = text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]")
    base = [
        scored("email", matches(text, EMAIL, F.contains(text, F.lit("@")), WIDTH), lambda s: F.lit(True), score("email")),
        scored("ip", matches(text, IP, text.rlike(r"[0-9]\.[0-9]"), WIDTH), lambda s: _is_ip(s["match"]), score("ip")),
        scored("card", matches(text, CARD, digit_pair, WIDTH), lambda s: _is_card(s["match"]), score("card")),
        scored(
            "phone", matches(text, PHONE, F.contains(text, F.lit("+")), WIDTH),
            lambda s: F.length(_digits(s["match"])).between(9, 15), score("phone"),
        ),
    ]
    added = [
        scored("iban", matches(text, IBAN, text.rlike("[A-Z]{2}[0-9]{2}[A-Z0-9]{11}"), WIDTH), lambda s: mod97(s["match"]) == 1, score("iban")),
        scored("ssn", matches(text, SSN, text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"), WIDTH), lambda s: _is_ssn(s["match"]), score("ssn")),
    ]
    return F.concat(*base, *(F.filter(x, lambda s: s["score"] >= threshold) for x in added))


def find_pii(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``keep`` and the spans of every text.

    ``spans`` is an array of (kind, start, end, score, match); offsets count
    code points of the whole text, the end is exclusive.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    return documents.select(*keep, spans_of(text, threshold).alias("spans"))


def report(found: DataFrame) -> DataFrame:
    """Counts and joined spans for each document of ``find_pii``."""

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *(count(kind) for kind in BASE),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(documents: DataFrame, text_column: str = "text", mark: str = "[{}]") -> DataFrame:
    """Every text with its spans replaced by the name of their kind.

    Overlapping spans count once, under the kind that begins first.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    ordered = F.array_sort(F.transform(spans_of(text), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark.split("{}")[0]), s["kind"], F.lit(mark.split("{}")[1])).alias("out"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return documents.withColumn(text_column, F.when(F.col(text_column).isNotNull(), done))
