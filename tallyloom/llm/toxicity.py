"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the words of a clause as symbols (insult, threat,
target, negation, report, quote, other): two of them emit weight, at an insult
and at a threat that meets a target, and three scale what is emitted, while a
target is near, within reach of a negation, and in reported or quoted speech.
They are composed into one table before any text is read. A clause is scored
only where it holds an insult or a threat, which an Aho-Corasick automaton finds
in one pass over the whole text; the weights of all clauses of a text are
summed and a logistic model, fitted on labelled rows, turns the sum into a score.

The insult words are a fixed list and what labelled rows add: words and word
stems that toxic rows of a bounded sample have far more often than clean ones.

Defined results: null and empty texts, and texts without a matched clause, have
weight 0 and the score of that weight; without labelled rows a fixed curve is
used; repeated rows are scored each; an empty table gives no rows. Labels other
than 0 and 1, and null ones, are not learned from.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.compression import SampleBound, bounded_sample, fit_logistic, logistic, texts_of

# Words of each class.
INSULTS = (
    "bastard", "clown", "coward", "disgusting", "dumb", "fool", "freak", "idiot", "imbecile", "jerk", "loser", "moron",
    "pathetic", "pig", "scum", "stupid", "trash", "vermin", "worthless", "arschloch", "dummkopf", "idiota", "imbécile",
    "connard", "estúpido",
)
THREATS = ("beat", "burn", "destroy", "hurt", "kill", "shoot", "stab", "strangle", "töten", "umbringen", "tuer", "matar", "matarte")
TARGETS = (
    "you", "your", "yours", "yourself", "he", "him", "she", "her", "they", "them", "du", "dich", "dir", "ihr", "euch", "tu",
    "toi", "te", "vous", "tú", "usted", "ustedes",
)
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "wasn't", "don't", "nicht", "kein", "keine", "nie", "pas", "ne", "jamais", "nunca")
REPORTS = ("said", "says", "say", "wrote", "claimed", "claims", "quoted", "according", "sagte", "schrieb", "dit", "écrit", "dijo", "escribió")

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = range(7)
SYMBOLS = 7
CLAUSE_END = re.compile(r"[.!?;\n]")
TOKEN = re.compile(r"[\"“”«»]|[^\W_]+(?:['’][^\W\d_]+)*")
QUOTES = frozenset("\"“”«»")

# Weights of the grammar.
AIMED, NEGATED, REPORTED = 1.5, 0.3, 0.5
REACH = 3
BEYOND = 6

STEMS = range(5, 9)
LABELLED = SampleBound(rows=4000)
MIN_ROWS = 5


@dataclass(frozen=True)
class Transducer:
    """moves[state][symbol] = (next state, weight); state 0 is the start of a clause."""

    moves: tuple[tuple[tuple[int, float], ...], ...]


def _rows(states: int, rule) -> Transducer:
    return Transducer(tuple(tuple(rule(state, symbol) for symbol in range(SYMBOLS)) for state in range(states)))


def insult_transducer() -> Transducer:
    return _rows(1, lambda _, x: (0, 1.0 if x == INSULT else 0.0))


def threat_transducer() -> Transducer:
    """A threat emits once its target is read, within BEYOND words of it, or an insult."""

    def rule(left, x):
        if x == THREAT:
            return BEYOND, 0.0
        if left and x in (TARGET, INSULT):
            return 0, 1.5
        return max(0, left - 1), 0.0

    return _rows(BEYOND + 1, rule)


def target_transducer() -> Transducer:
    """Scales what follows a target within BEYOND words."""
    return _rows(BEYOND + 1, lambda left, x: (BEYOND if x == TARGET else max(0, left - 1), AIMED if left else 1.0))


def negation_transducer() -> Transducer:
    return _rows(REACH + 1, lambda left, x: (REACH if x == NEGATION else max(0, left - 1), NEGATED if left else 1.0))


def report_transducer() -> Transducer:
    """State 1 follows a report to the end of the clause; state 2 is within quotes."""

    def rule(state, x):
        after = {0: 2, 1: 2, 2: 0}[state] if x == QUOTE else (1 if x == REPORT and state == 0 else state)
        return after, REPORTED if state else 1.0

    return _rows(3, rule)


def compose(emitting: Sequence[Transducer], scaling: Sequence[Transducer]) -> tuple[list[list[int]], list[list[float]]]:
    """One table of the reachable joint states: emitted weights add, scales multiply."""
    parts = [*emitting, *scaling]
    start = (0,) * len(parts)
    number, waiting, following, weights = {start: 0}, [start], [], []
    for state in waiting:
        nexts, row = [], []
        for symbol in range(SYMBOLS):
            moves = [part.moves[s][symbol] for part, s in zip(parts, state)]
            target = tuple(m[0] for m in moves)
            if target not in number:
                number[target] = len(waiting)
                waiting.append(target)
            nexts.append(number[target])
            row.append(sum(m[1] for m in moves[: len(emitting)]) * float(np.prod([m[1] for m in moves[len(emitting) :]])))
        following.append(nexts)
        weights.append(row)
    return following, weights


class Grammar:
    """The composed transducers and the lexicon that gives words their symbols."""

    def __init__(self, words: Mapping[str, float] = {}, stems: Mapping[str, float] = {}):
        self.words = {word: 1.0 for word in INSULTS} | dict(words)
        self.stems = dict(stems)
        self.stem_lengths = sorted({len(s) for s in self.stems})
        self.fixed = {w: c for c, ws in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS)) for w in ws}
        self.following, self.weights = compose(
            [insult_transducer(), threat_transducer()], [target_transducer(), negation_transducer(), report_transducer()]
        )
        self.automaton = ahocorasick.Automaton()
        for item in {*self.words, *self.stems, *THREATS}:
            self.automaton.add_word(item, len(item))
        self.automaton.make_automaton()

    def strength(self, word: str) -> float:
        """Weight of a word as an insult; 0 for other words."""
        found = self.words.get(word, 0.0)
        for length in self.stem_lengths:
            if not found and length <= len(word):
                found = self.stems.get(word[:length], 0.0)
        return found

    def clause_weight(self, clause: str) -> float:
        state, total = 0, 0.0
        for token in TOKEN.findall(clause):
            strength = 0.0
            if token in QUOTES:
                symbol = QUOTE
            else:
                strength = self.strength(token)
                symbol = INSULT if strength else self.fixed.get(token, OTHER)
            weight = self.weights[state][symbol]
            total += weight * strength if symbol == INSULT else weight
            state = self.following[state][symbol]
        return total

    def weight(self, text: str | None) -> float:
        """Summed weight of the matched clauses of a whole text."""
        if not text:
            return 0.0
        text = text.lower()
        total, done = 0.0, -1
        for last, length in self.automaton.iter(text):
            first = last - length + 1
            if first < done or (first and text[first - 1].isalnum()):
                continue
            begin = max(0, done)
            for mark in ".!?;\n":
                begin = max(begin, text.rfind(mark, begin, first) + 1)
            end = CLAUSE_END.search(text, last + 1)
            done = end.start() if end else len(text)
            total += self.clause_weight(text[begin:done])
        return total


@dataclass(frozen=True)
class Model:
    words: dict
    stems: dict
    curve: tuple | None


def units(text: str) -> set[str]:
    """Distinct words of a text, and their stems marked by a star."""
    words = set(TOKEN.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def _count(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """(unit, rows): how many texts hold each unit; one row per unit and batch is shuffled."""

    def run(batches):
        for batch in batches:
            seen: Counter = Counter()
            for text in texts_of(batch["text"]):
                found = units(text)
                seen.update(found if wanted is None else found & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["unit", "rows"])

    return rows.select("text").mapInArrow(run, "unit string, rows long").groupBy("unit").agg(F.sum("rows").alias("rows"))


def contexts(text: str, wanted: frozenset[str]) -> set[tuple[str, int]]:
    """(unit, hash of the words on both sides) of every wanted unit of a text."""
    words = ["", *TOKEN.findall(text.lower()), ""]
    found = set()
    for before, word, after in zip(words, words[1:], words[2:]):
        for unit in (word, *(word[:n] + "*" for n in STEMS if len(word) > n)):
            if unit in wanted:
                found.add((unit, zlib.crc32(f"{before} {after}".encode("utf-8", "surrogatepass"))))
    return found


def _contexts(rows: DataFrame, wanted: frozenset[str]) -> DataFrame:
    """(unit, contexts): between how many pairs of words a unit stands.

    Copies of one text count once here, however many rows hold them.
    """

    def run(batches):
        for batch in batches:
            seen = set().union(*(contexts(text, wanted) for text in texts_of(batch["text"])))
            unit, context = zip(*seen) if seen else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(unit, pa.string()), pa.array(context, pa.int64())], names=["unit", "context"])

    pairs = rows.select("text").mapInArrow(run, "unit string, context long").distinct()
    return pairs.groupBy("unit").agg(F.count(F.lit(1)).alias("contexts"))


def suspects(toxic: Mapping[str, int], clean: Mapping[str, int], toxic_rows: int, clean_rows: int) -> dict[str, float]:
    """Units that speak for toxicity, with weights up to 1.

    The rate in toxic rows is at least 20 times that in clean rows, and chance
    does not explain it.
    """
    share = toxic_rows / max(1, toxic_rows + clean_rows)
    taken: dict[str, float] = {}
    for unit, n in toxic.items():
        m = clean.get(unit, 0)
        odds = np.log((n + 0.5) / (toxic_rows + 1)) - np.log((m + 0.5) / (clean_rows + 1))
        # Log likelihood ratio of the two rates against one common rate.
        surprise = n * np.log(n / ((n + m) * share)) + (m * np.log(m / ((n + m) * (1 - share))) if m else 0.0)
        if n >= MIN_ROWS and odds >= np.log(20) and surprise >= 8:
            taken[unit] = min(1.0, float(odds) / 4)
    return taken


def lexicon(taken: Mapping[str, float]) -> tuple[dict, dict]:
    """(words, stems): a stem replaces the words and longer stems it covers."""
    words, stems = {}, {}
    for unit in sorted(taken, key=lambda u: (len(u.rstrip("*")), not u.endswith("*"), u)):
        bare = unit.rstrip("*")
        if any(bare.startswith(s) for s in stems):
            continue
        (stems if unit.endswith("*") else words)[bare] = taken[unit]
    return words, stems


def learn(rows: DataFrame, label: str = "toxic", bound: SampleBound = LABELLED) -> Model:
    """Fit on rows (doc_id, text, label): two thirds give words, the rest the curve."""
    labelled = rows.where(F.col(label).isin(0, 1) & F.col("text").isNotNull()).select(
        F.col(label).cast("int").alias("label"),
        "text",
        F.xxhash64("doc_id").alias("order"),
    )
    sample = bounded_sample(labelled, "label", F.col("order"), bound, labelled.groupBy("label").count()).persist()
    part = {y: sample.where((F.col("label") == y) & (F.col("place") % 3 > 0)) for y in (0, 1)}
    toxic_rows, clean_rows = part[1].count(), part[0].count()
    # Each of these units is in MIN_ROWS of the sampled rows at least, which bounds their number.
    often = _count(part[1], None).where(F.col("rows") >= MIN_ROWS)
    toxic = {r.unit: r["rows"] for r in often.collect()}
    clean = {r.unit: r["rows"] for r in _count(part[0], frozenset(toxic)).collect()}
    taken = suspects(toxic, clean, toxic_rows, clean_rows)
    varied = {r.unit: r.contexts for r in _contexts(part[1], frozenset(taken)).collect()}
    words, stems = lexicon({unit: weight for unit, weight in taken.items() if varied.get(unit, 0) >= MIN_ROWS})
    bare = Model(words, stems, None)
    pairs = weigh(sample.where(F.col("place") % 3 == 0).select("text", F.col("label").cast("long").alias("doc_id")), bare).collect()
    sample.unpersist()
    x = np.log1p(np.array([[r.weight] for r in pairs]).reshape(-1, 1))
    y = np.array([r.doc_id for r in pairs])
    return Model(words, stems, fit_logistic(x, y) if len(set(y)) == 2 else None)


def weigh(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, weight): the grammar's weight of whole texts."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        grammar = Grammar(shared.value.words, shared.value.stems)
        for batch in batches:
            weights = [grammar.weight(text) for text in texts_of(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(weights, pa.float64())], names=["doc_id", "weight"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, weight double")


def score(documents: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted, weight) of whole texts; reads nothing else of a row."""
    means, scales, weights = model.curve or (np.zeros(1), np.ones(1), np.array([-3.0, 4.0]))
    drive = (F.log1p("weight") - float(means[0])) / float(scales[0]) * float(weights[1]) + float(weights[0])
    scored = weigh(documents, model).withColumn("score", 1 / (1 + F.exp(-drive)))
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "weight")
