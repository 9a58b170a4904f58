"""Toxicity by a weighted grammar over clauses, composed of small finite-state transducers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import slices, text_or_empty
from tallyboard.llm.labels import SAMPLE_ROWS, held_out, training_ids, training_rows

#: Lengths of the word beginnings that may carry a meaning; 0 stands for the whole word.
STEM_LENGTHS = (0, 4, 5, 6, 7)
#: The most stems that the lexicon holds, the surest first, and how sure they have to be (G statistic): less than one in
#: 100,000 stems that mean nothing is as sure as that.
LEXICON_ROWS = 50_000
SURE = 20.0
#: Toxic documents that a stem needs for each other document that has it; how much it counts follows from both.
PURE = 1
KNOWN_WORDS = 300_000

# Function words of the grammar, in English, German, French and Spanish.
TARGETS = frozenset("you your yours yourself he she they him her them du dich dir dein deine ihr euch tu toi te ton ta vous votre tú usted ustedes vosotros".split())
NEGATIONS = frozenset("not no never neither nor isn aren wasn don doesn didn nicht kein keine nie niemals ne pas jamais aucun nunca jamás tampoco".split())
REPORTS = frozenset("said says say wrote writes called quoted claimed reported sagte schrieb nannte zitierte dit écrit disait dijo escribió llamó".split())
THREATS = frozenset("kill hurt destroy burn punch stab shoot töten schlagen vernichten tuer frapper détruire matar golpear destruir".split())

OUTCOMES = ("plain", "targeted", "negated", "reported", "threat")
#: What an outcome is worth before any label is seen; the fit starts from here.
PRIOR = (2.0, 2.5, 0.5, 0.8, 1.5)

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n\"“”«»]")
_ENDS = frozenset(".!?;\n")
_QUOTES = frozenset('"“”«»')


# ---- Transducers: (state, symbol) -> (state, mark) ------------------------------
# Symbols: I insult, T threat, Y target, N negation, R report, Q quote mark, W any other word.


def _scope(opener: str, reach: int):
    """Marks words within ``reach`` words of the opener."""

    def step(state: int, symbol: str) -> tuple[int, bool]:
        return (reach if symbol == opener else max(state - 1, 0)), state > 0

    return 0, step


def _reported():
    """Marks what follows a verb of saying in the clause, and what stands between quote marks."""

    def step(state: tuple[bool, bool], symbol: str):
        said, quoted = state
        if symbol == "Q":
            quoted = not quoted
        return (said or symbol == "R", quoted), said or quoted

    return (False, False), step


def _latest(symbol: str, reach: int):
    """Marks a target within ``reach`` words of a threat."""

    def step(state: int, seen: str) -> tuple[int, bool]:
        return (reach if seen == symbol else max(state - 1, 0)), state > 0 and seen == "Y"

    return 0, step


class Grammar:
    """The transducers run side by side as one; their product is built as it is needed."""

    def __init__(self, reach: int = 4):
        parts = (_scope("Y", reach), _scope("N", 2), _reported(), _latest("I", reach), _latest("T", reach))
        self.start = tuple(start for start, _ in parts)
        self.steps = tuple(step for _, step in parts)
        self.table: dict = {}

    def _step(self, state: tuple, symbol: str):
        key = (state, symbol)
        if key not in self.table:
            moves = [step(s, symbol) for s, step in zip(state, self.steps, strict=True)]
            self.table[key] = (tuple(s for s, _ in moves), tuple(mark for _, mark in moves))
        return self.table[key]

    def outcomes(self, symbols: str, weights: list[float]) -> np.ndarray:
        """Weighted number of matches per outcome in a clause; ``weights`` are those of the insults, in order."""
        total = np.zeros(len(OUTCOMES))
        state, given, last = self.start, iter(weights), None
        for symbol in symbols:
            state, (targeted, negated, reported, after_insult, after_threat) = self._step(state, symbol)
            if symbol == "I":
                outcome = 3 if reported else 2 if negated else 1 if targeted else 0
                last = (outcome, next(given))
                total[outcome] += last[1]
            elif symbol == "T" and targeted and not (negated or reported):
                total[4] += 1
            elif symbol == "Y":
                if after_insult and last and last[0] == 0:  # the target comes after the insult
                    total[0] -= last[1]
                    total[1] += last[1]
                    last = None
                if after_threat and not (negated or reported):
                    total[4] += 1
        return total


@dataclass
class Reader:
    """Turns a text into clauses of symbols, with a lexicon of weighted stems."""

    stems: dict[str, float]
    known: dict[str, str] = field(default_factory=dict)  # word -> symbol
    weights: dict[str, float] = field(default_factory=dict)  # of the insults among them
    grammar: Grammar = field(default_factory=Grammar)

    def symbol(self, word: str) -> str:
        weight = max(self.stems.get(stem, 0.0) for stem in stems_of(word))
        if weight > 0:
            self.weights[word] = weight
            return "I"
        for symbol, words in (("T", THREATS), ("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS)):
            if word in words:
                return symbol
        return "E" if word in _ENDS else "Q" if word in _QUOTES else "W"

    def outcomes(self, text: str) -> np.ndarray:
        words = _TOKEN.findall(text.lower())
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
            self.weights.clear()
        for word in set(words):
            if word not in known:
                known[word] = self.symbol(word)
        line = "".join(map(known.__getitem__, words))
        total = np.zeros(len(OUTCOMES))
        if "I" not in line and "T" not in line:
            return total
        at = 0
        for clause in line.split("E"):
            if "I" in clause or "T" in clause:
                given = [self.weights[w] for w, s in zip(words[at : at + len(clause)], clause, strict=True) if s == "I"]
                total += self.grammar.outcomes(clause, given)
            at += len(clause) + 1
        return total


def stems_of(word: str) -> list[str]:
    """The whole word, marked, and its beginnings."""
    return ["=" + word, *(word[:n] for n in STEM_LENGTHS if 0 < n < len(word))]


# ---- Learning ---------------------------------------------------------------------


def learn_lexicon(chosen: DataFrame, rows: int = LEXICON_ROWS) -> dict[str, float]:
    """Stems found in toxic documents far more often than in others, weighted by their log odds.

    ``chosen`` holds text and y. A stem's toxic documents count at most as often as different words stand before it
    there: the words of a document that was copied many times are no evidence, as they always follow the same word.
    All counting is done in Spark; the driver gets at most ``rows`` stems.
    """
    sizes = chosen.agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).first()
    if not sizes.p or not sizes.n:
        return {}
    p_all, n_all = float(sizes.p), float(sizes.n)
    words = F.filter(F.split(F.lower(text_or_empty()), r"[^\p{L}]+"), lambda w: w != "")
    listed = chosen.select("y", words.alias("words"))

    def stems(word: Column) -> Column:
        shorter = [F.when(F.char_length(word) > n, F.substring(word, 1, n)) for n in STEM_LENGTHS if n]
        return F.array(F.concat(F.lit("="), word), *shorter)

    found = (
        listed.select(F.explode(F.array_distinct(F.flatten(F.transform(F.array_distinct("words"), stems)))).alias("stem"), "y")
        .where("stem is not null")
        .groupBy("stem")
        .agg(F.sum("y").cast("double").alias("p"), F.sum(1 - F.col("y")).cast("double").alias("n"))
        .where("p >= 3")
    )
    before = F.concat(F.array(F.lit("")), F.col("words"))
    contexts = (
        listed.where("y = 1")
        .select(F.explode(F.arrays_zip(F.col("words").alias("word"), before.alias("before"))).alias("at"))
        .where("at.word is not null")
        .select("at.word", "at.before")
        .distinct()
        .select(F.explode(stems(F.col("word"))).alias("stem"), "before")
        .where("stem is not null")
        .groupBy("stem")
        .agg(F.count_distinct("before").cast("double").alias("contexts"))
    )
    found = found.join(contexts, "stem").withColumn("p", F.least("p", "contexts"))
    odds = F.log((F.col("p") + 0.5) / (p_all + 1)) - F.log((F.col("n") + 0.5) / (n_all + 1))
    both, share = F.col("p") + F.col("n"), p_all / (p_all + n_all)
    sure = 2 * (
        F.col("p") * F.log(F.col("p") / (both * share))
        + F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") / (both * (1 - share)))).otherwise(0.0)
    )
    # A stem counts when most documents that have it are toxic.
    best = (
        found.withColumns({"weight": odds, "sure": sure})
        .where((F.col("sure") >= SURE) & (F.col("p") > PURE * F.col("n")))
        .orderBy(F.desc("sure"), "stem")
        .select("stem", "weight")
        .limit(rows)
        .collect()
    )
    return {row.stem: float(row.weight) / 4 for row in best}


def outcome_columns(documents: DataFrame, lexicon: dict[str, float], text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns plus one column per outcome: the weighted matches in all clauses of the text."""
    bodies = documents.select(*keep, F.col(text).alias("_body"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in bodies.schema.fields[:-1])
    columns = [f"o_{name}" for name in OUTCOMES]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch in slices(batches, "_body"):
            found = np.array([reader.outcomes(t or "") for t in batch.column("_body").to_pylist()])
            found = found.reshape(-1, len(OUTCOMES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(found[:, k]) for k in range(len(OUTCOMES)))], [*keep, *columns]
            )

    return bodies.mapInArrow(read, schema + "".join(f", {c} double" for c in columns))


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    base: float
    weights: tuple[float, ...]

    def column(self) -> Column:
        total = F.lit(self.base)
        for name, weight in zip(OUTCOMES, self.weights, strict=True):
            total += F.log1p(F.greatest(F.col(f"o_{name}"), F.lit(0.0))) * weight
        return 1 / (1 + F.exp(-total))


def fit(
    documents: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", rows: int = SAMPLE_ROWS
) -> ToxicityModel:
    """Lexicon and outcome weights from at most ``rows`` labelled documents; held-out ones are never among them.

    Every other chosen document teaches the lexicon and the weights alike; weights start from PRIOR and are
    held near it by a ridge, so an outcome that no label shows keeps its prior.
    """
    chosen = training_rows(
        documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")),
        training_ids(labels, "toxic", rows),
    )
    # Of rows that repeat an id the one with the least text teaches, the same one every time.
    chosen = chosen.groupBy("doc_id").agg(F.min(text_or_empty()).alias("text"), F.max("y").alias("y"))
    lexicon = learn_lexicon(chosen)
    table = outcome_columns(chosen, lexicon, "text", ["doc_id", "y"]).toPandas().sort_values("doc_id")
    prior = np.array((-3.0, *PRIOR))
    if not len(table):
        return ToxicityModel(lexicon, float(prior[0]), PRIOR)
    x = np.log1p(np.maximum(table[[f"o_{name}" for name in OUTCOMES]].to_numpy(np.float64), 0))
    z, y = np.column_stack([np.ones(len(x)), x]), table["y"].to_numpy(np.float64)
    w = prior.copy()
    for _ in range(30):  # Newton steps on the ridge-penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) - (w - prior)
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w += move
        if np.abs(move).max() < 1e-9:
            break
    return ToxicityModel(lexicon, float(w[0]), tuple(float(v) for v in w[1:]))


def toxicity_scores(
    documents: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.5
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, and the matches per outcome.

    A null or empty text has no match and the lowest score. Without labels the lexicon is empty and
    the prior weights hold. Repeated rows score alike.
    """
    model = fit(documents, labels, text, doc_id)
    narrow = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = outcome_columns(narrow, model.lexicon, "text", ["doc_id"]).withColumn("score", model.column())
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *[f"o_{name}" for name in OUTCOMES],
    )
