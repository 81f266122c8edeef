"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read the symbols of a clause: insults, threats, targets, negation and reported speech. Their composition is
one machine whose states are tuples of their states. The insult machine emits the weight of a hostile word, more behind a target and its
verb ("you are a ..."), least for a bare exclamation; the threat machine emits where intent, a verb of harm and a target
follow each other, and nothing for such a verb alone. What is emitted is raised near a target and lowered under negation or in
reported speech. A document's score is a logistic function of what its matched clauses emit.

The hostile words are learned from labelled rows: words and word beginnings whose share among toxic documents is
reliably higher than among others. The rows that serve for fitting are a bounded sample.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import id_remainder, prepare, release, whole_texts

FIT_ROWS = 60_000  # labelled rows used for fitting at most, chosen by a hash of the id
FOLDS = 5
PREFIXES = (4, 5, 6, 7)
LEAST_SHARE = 0.01  # a learned entry is in this share of the toxic rows at least, so entries are bounded
LEAST_RATIO = math.log(4.0)
WORD = re.compile(r"[^\W\d_]+|[\"“”«»]")
CLAUSE = re.compile(r"[.!?;:\n]+")

# Closed word classes of the grammar, in English, German, French and Spanish.
TARGETS = """you your yours yourself he she him her they them their people everyone
du dich dir dein deine ihr euch sie er tu te toi ton ta vous votre il elle ils elles
tú ti usted ustedes vosotros ellos ellas él""".split()
NEGATIONS = "not no never nor neither none cannot nicht kein keine nie niemals ne pas jamais aucun sin nunca ni".split()
REPORTS = """said says say told tells wrote writes claimed quoted called sagte sagt schrieb meinte
dit écrit raconte dijo dice escribió contó""".split()
COPULAS = "are is am be re bist seid ist sind es êtes est sont eres sois son".split()
INTENTS = """will shall must should gonna going want ll werde werden soll sollte muss will vais va allons dois devrait voy va vamos debo
debería""".split()
HARMS = "kill hurt destroy punish shoot burn töten verletzen vernichten tuer blesser détruire matar herir destruir".split()
THREAT_WEIGHT = 3.0

OTHER, TARGET, NEGATION, REPORT, QUOTE, HOSTILE, COPULA, INTENT, HARM = SYMBOLS = range(9)


@dataclass(frozen=True)
class Transducer:
    """States from 0; ``moves[state][symbol]`` is the next state.

    ``gain[state]`` is the factor on whatever is emitted on the way out of a state, ``adds[state]`` what the state adds itself on
    reading a target.
    """

    moves: tuple[tuple[int, ...], ...]
    gain: tuple[float, ...]
    adds: tuple[float, ...]


def _window(symbol: int, length: int, gain: float) -> Transducer:
    """Active for ``length`` symbols after ``symbol``."""
    moves = []
    for state in range(length + 1):
        row = [max(state - 1, 0)] * len(SYMBOLS)
        row[symbol] = length
        moves.append(tuple(row))
    return Transducer(tuple(moves), tuple(gain if s else 1.0 for s in range(length + 1)), (0.0,) * (length + 1))


def _moves(*rows: dict[int, int]) -> tuple[tuple[int, ...], ...]:
    """A row per state; the key None is the state for all symbols that the row does not name."""
    return tuple(tuple(row.get(s, row[None]) for s in SYMBOLS) for row in rows)


TARGETED = _window(TARGET, 4, 1.5)
NEGATED = _window(NEGATION, 3, 0.4)
# Once a verb of saying was read, the rest of the clause is reported; a quotation mark toggles it as well.
REPORTED = Transducer(_moves({None: 0, REPORT: 1, QUOTE: 1}, {None: 1, QUOTE: 0}), (1.0, 0.6), (0.0, 0.0))
# 0: nothing yet, a hostile word is a bare exclamation; 1: a target, "you ..."; 2 and 3: target and copula, with room for an article.
INSULT = Transducer(
    _moves({None: 0, TARGET: 1}, {None: 0, TARGET: 1, COPULA: 2}, {None: 3, TARGET: 1, COPULA: 2}, {None: 0, TARGET: 1}),
    (1.0, 1.2, 1.5, 1.5), (0.0,) * 4)
# 1 to 3: intent, and two words of room; 4 and 5: a verb of harm under intent, waiting for its target.
THREAT = Transducer(
    _moves({None: 0, INTENT: 1}, {None: 2, INTENT: 1, HARM: 4}, {None: 3, INTENT: 1, HARM: 4}, {None: 0, INTENT: 1, HARM: 4},
           {None: 5, INTENT: 1, HARM: 4, TARGET: 0}, {None: 0, INTENT: 1, HARM: 4}),
    (1.0,) * 6, (0.0, 0.0, 0.0, 0.0, THREAT_WEIGHT, THREAT_WEIGHT))


def compose(*machines: Transducer) -> Transducer:
    """One machine whose states are the reachable tuples of states; factors multiply, what states add is summed."""
    start = (0,) * len(machines)
    number, queue, moves = {start: 0}, [start], []
    for state in queue:
        row = []
        for symbol in SYMBOLS:
            to = tuple(m.moves[s][symbol] for m, s in zip(machines, state))
            if to not in number:
                number[to] = len(number)
                queue.append(to)
            row.append(number[to])
        moves.append(tuple(row))
    gains = tuple(math.prod(m.gain[s] for m, s in zip(machines, state)) for state in queue)
    adds = tuple(sum(m.adds[s] for m, s in zip(machines, state)) for state in queue)
    return Transducer(tuple(moves), gains, adds)


GRAMMAR = compose(INSULT, THREAT, TARGETED, NEGATED, REPORTED)
_CLASSES = {w: k for words, k in ((HARMS, HARM), (INTENTS, INTENT), (COPULAS, COPULA), (REPORTS, REPORT), (NEGATIONS, NEGATION),
                                  (TARGETS, TARGET)) for w in words}
_CLASSES |= {q: QUOTE for q in "\"“”«»"}


@dataclass
class ToxicModel:
    """Learned entries (a word, or a beginning followed by *) with weights, and the logistic weights."""

    entries: dict[str, float]
    weights: list[float] = field(default_factory=lambda: [-20.0, 0.0, 0.0, 0.0])

    def __post_init__(self):
        self._machine = None

    def weight(self, word: str) -> float:
        """The largest weight among the entries that match a lower-case word."""
        found = [self.entries.get(word, 0.0)]
        found += [self.entries.get(word[:n] + "*", 0.0) for n in PREFIXES if len(word) >= n]
        return max(found)

    def clause(self, symbols: list[str]) -> float:
        """What the composed machine emits along a clause."""
        state, total = 0, 0.0
        for word in symbols:
            weight = self.weight(word)
            if weight > 0.0:
                total += weight * GRAMMAR.gain[state]
                state = GRAMMAR.moves[state][HOSTILE]
            else:
                symbol = _CLASSES.get(word, OTHER)
                if symbol == TARGET:
                    total += GRAMMAR.adds[state] * GRAMMAR.gain[state]
                state = GRAMMAR.moves[state][symbol]
        return total

    def suspects(self, text: str) -> list[int]:
        """Places where the letters of an entry or of a verb of harm begin a word."""
        if self._machine is None:
            import ahocorasick

            self._machine = ahocorasick.Automaton()
            for entry in [*self.entries, *HARMS]:
                stem = entry.rstrip("*")
                self._machine.add_word(stem, len(stem))
            self._machine.make_automaton()
        starts = (end - n + 1 for end, n in self._machine.iter(text))
        return [k for k in starts if k == 0 or not text[k - 1].isalpha()]

    def features(self, text: str) -> tuple[float, float, float]:
        """Emitted weight (log), matched clauses (log), weight of the strongest clause; zeros without a match."""
        text = text.lower()
        places = self.suspects(text)
        if not places:
            return 0.0, 0.0, 0.0
        bounds = [0, *itertools.chain.from_iterable(m.span() for m in CLAUSE.finditer(text)), len(text)]
        sums, at = [], 0
        places.sort()
        for a, b in zip(bounds[::2], bounds[1::2]):
            hit = False
            while at < len(places) and places[at] < b:
                hit = hit or places[at] >= a
                at += 1
            if hit and (value := self.clause(WORD.findall(text, a, b))) > 0.0:
                sums.append(value)
        return (math.log1p(sum(sums)), math.log1p(len(sums)), max(sums)) if sums else (0.0, 0.0, 0.0)

    def score(self, features: tuple[float, float, float]) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], features))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Text and toxic of a bounded sample of the labelled rows outside the held-out fold.

    Labels are thinned by a hash of the id to about ``fit_rows``; that bounded list is broadcast, so texts are
    not shuffled. Of repeated labels the larger counts; null or other labels are no labels.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (id_remainder(FOLDS) != 0))
    total = known.count()
    share = min(1.0, fit_rows / max(total, 1))
    if share < 1.0:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return whole_texts(docs).join(F.broadcast(known), "doc_id")


def _beginnings(words: Column, n: int) -> Column:
    long = F.filter(words, lambda w: F.char_length(w) >= n)
    return F.transform(long, lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))


def learn_entries(rows: DataFrame) -> dict[str, float]:
    """Words and beginnings with their log odds between toxic and other rows.

    An entry is in ``LEAST_SHARE`` of the toxic rows (three at least), and its odds ratio exceeds 4 at the lower
    end of a one-sided 95 % interval. Words of the closed classes are no entries. Counting is one aggregation
    over the distinct terms of each row.
    """
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.char_length(w) >= 3))
    terms = F.array_distinct(F.concat(words, *[_beginnings(words, n) for n in PREFIXES]))
    counts = rows.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    if not counts["t"] or not counts["c"]:
        return {}
    toxic, clean = F.col("t") + 0.5, F.col("c") + 0.5
    odds = F.log(toxic / (counts["t"] + 1)) - F.log(clean / (counts["c"] + 1))
    least = max(3, math.ceil(LEAST_SHARE * counts["t"]))
    found = (
        rows.select("toxic", F.explode(terms).alias("term")).groupBy("term")
        .agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c"))
        .filter(F.col("t") >= least).withColumn("odds", odds)
        .filter(F.col("odds") - 1.645 * F.sqrt(1 / toxic + 1 / clean) > LEAST_RATIO)
    )
    entries = {r["term"]: round(r["odds"], 6) for r in found.select("term", "odds").collect()
               if r["term"] not in _CLASSES}
    return entries


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Ridge logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def _features(rows: DataFrame, model: ToxicModel, *keep: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.features(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[k] for f in found], pa.float64()) for k in range(3)]
            scores = pa.array([model.score(f) for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *columns, scores], names=[*keep, "total", "clauses", "top", "score"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    ddl = ", ".join(f"{c} {kinds[c]}" for c in keep)
    return rows.mapInArrow(run, f"{ddl}, total double, clauses double, top double, score double")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicModel:
    """Learn the entries and the logistic weights. Without both labels every score is near 0."""
    prepare(docs.sparkSession)
    rows = training_rows(docs, labels, fit_rows)
    entries = learn_entries(rows)
    model = ToxicModel(entries)
    if entries:
        table = _features(rows, model, "toxic").select("total", "clauses", "top", "toxic").toPandas()
        model.weights = fit_logistic(table[["total", "clauses", "top"]].to_numpy(), table["toxic"].to_numpy())
    return ToxicModel(entries, model.weights)


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; a null text is empty. No shuffle."""
    prepare(docs.sparkSession)
    scored = _features(whole_texts(docs), model, "doc_id")
    return scored.select("doc_id", (id_remainder(FOLDS) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """The rows of ``docs`` with all their columns that are not predicted toxic."""
    prepare(docs.sparkSession)
    schema = docs.schema
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = names.index("text")
        for batch in batches:
            fine = [model.score(model.features(t or "")) < 0.5 for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(fine, pa.bool_()))
        release()

    return docs.mapInArrow(run, schema)
