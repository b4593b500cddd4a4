"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as one of six symbols: insult, threat, target, negation, reported speech, other. Three small transducers
are composed into one machine that reads a text clause by clause:

    negation   an insult or threat within `SCOPE` words of a negation becomes a negated one
    reporting  within a clause, hits after a verb of reporting become reported ones
    clause     gathers the hits of a clause and whether a target is named, and at its end gives the clause's pattern

A matched clause weighs as much as its insult or threat words weigh together; a logistic model over the patterns turns
the clause weights of a text into a score, so what negation, reporting or a target are worth is learned, not asserted.

The insult lexicon is a short seed list plus whole words and word beginnings learned from labelled texts: those found
almost only in toxic documents, by a likelihood ratio over documents of which near copies count once. It is learned on a
sample of at most `SAMPLE` labelled rows and holds at most `LEXICON` entries, so it is small enough to ship to tasks.

Cases: a null text counts as empty, and a text without matched clauses gets the score of the intercept alone; labels that
are missing, null or not 0/1 teach nothing; without labels of both kinds the seeds and `PRIOR` are used as they are; an
empty table gives no rows; a repeated row is scored again; a null id counts as held out. Ids, language, source and labels
are no inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolmetrics.llm.common import held_out, stored
from schoolmetrics.llm.shingles import WordHashes, shingle_set
from schoolmetrics.llm.training import labelled_sample

SAMPLE = 24_000
LEXICON = 2_000
SCOPE = 4
#: A learned entry: likelihood ratio over documents, share of toxic documents among those that have it.
LEAST_RATIO, LEAST_SHARE = 20.0, 0.8
SHORTEST, LONGEST = 3, 12

# Seed words of the grammar, in English, German, French and Spanish.
INSULTS = "idiot moron stupid loser scum trash pathetic worthless disgusting dumb fool imbecile jerk dummkopf crétin imbécile estúpido imbécil"
THREATS = "kill hurt destroy beat shoot stab töten umbringen schlagen tuer frapper matar golpear"
TARGETS = "you your yourself u du dich dir dein deine euch tu toi te vous votre tú ti usted ustedes tus"
NEGATIONS = "not no never neither nor without don't isn't aren't wasn't nicht kein keine nie ohne pas jamais sans nunca jamás sin"
REPORTS = "said says called claimed claims wrote quoted according reportedly sagte sagt nannte schrieb laut dit disait selon dijo dice según"

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END = range(7)
PATTERNS = ("insult", "insult_target", "insult_negated", "insult_reported", "threat_target", "threat_weak")
#: Weights where nothing can be learned: intercept, then one for each pattern.
PRIOR = (-3.0, 4.0, 4.5, 1.0, 1.0, 4.0, 0.5)

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[^.!?;:\n]+")


@dataclass(frozen=True)
class Transducer:
    """Reads symbols, writes symbols; `step(state, symbol)` gives the next state and what is written."""

    start: object
    step: object


def negation() -> Transducer:
    def step(left: int, symbol):
        if symbol == END:
            return 0, END
        if symbol == NEGATION:
            return SCOPE, symbol
        if left and symbol in (INSULT, THREAT):
            return left - 1, (symbol, "negated")
        return max(0, left - 1), symbol

    return Transducer(0, step)


def reporting() -> Transducer:
    def step(told: bool, symbol):
        if symbol == END:
            return False, END
        if symbol == REPORT:
            return True, symbol
        kind = symbol[0] if isinstance(symbol, tuple) else symbol
        return told, ((kind, "reported") if told and kind in (INSULT, THREAT) else symbol)

    return Transducer(False, step)


def clause() -> Transducer:
    """States: what the strongest hit so far is, and whether a target was named."""
    rank = {None: 0, "threat_negated": 1, "insult_negated": 2, "insult_reported": 3, "threat": 4, "insult": 5}

    def step(state, symbol):
        hit, target = state
        if symbol == END:
            pattern = {
                "insult": "insult_target" if target else "insult",
                "insult_negated": "insult_negated",
                "insult_reported": "insult_reported",
                "threat": "threat_target" if target else "threat_weak",
                "threat_negated": "threat_weak",
            }.get(hit)
            return (None, False), pattern
        if symbol == TARGET:
            return (hit, True), None
        if isinstance(symbol, tuple):
            kind, how = symbol
            now = f"insult_{how}" if kind == INSULT else "threat_negated"
        else:
            now = {INSULT: "insult", THREAT: "threat"}.get(symbol)
        return (now if rank[now] > rank[hit] else hit, target), None

    return Transducer((None, False), step)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Feeds what `first` writes to `second`."""

    def step(state, symbol):
        one, written = first.step(state[0], symbol)
        two, out = second.step(state[1], written)
        return (one, two), out

    return Transducer((first.start, second.start), step)


def tabulate(machine: Transducer) -> list[list[tuple[int, int]]]:
    """table[state][symbol] = (next state, pattern number or -1), over all reachable states; state 0 is the start."""
    number, table = {machine.start: 0}, []
    queue = [machine.start]
    for state in queue:
        row = []
        for symbol in range(END + 1):
            to, out = machine.step(state, symbol)
            if to not in number:
                number[to] = len(number)
                queue.append(to)
            row.append((number[to], PATTERNS.index(out) if out in PATTERNS else -1))
        table.append(row)
    return table


GRAMMAR = tabulate(compose(compose(negation(), reporting()), clause()))


@dataclass(frozen=True)
class Lexicon:
    """Weights of insult words: whole words, and beginnings of longer words."""

    words: dict[str, float]
    beginnings: dict[str, float]

    def reader(self) -> Reader:
        return Reader(self)


class Reader(dict):
    """Word -> (symbol, weight), remembered up to a bound."""

    BOUND = 300_000

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self._fixed = {w: (s, 1.0) for s, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws.split()}
        self._lexicon = lexicon
        self._lengths = sorted({len(b) for b in lexicon.beginnings})

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) >= self.BOUND:
            self.clear()
        weight = self._lexicon.words.get(word, 0.0)
        for n in self._lengths:
            if n >= len(word):
                break
            weight = max(weight, self._lexicon.beginnings.get(word[:n], 0.0))
        found = self[word] = (INSULT, weight) if weight else self._fixed.get(word, (OTHER, 0.0))
        return found


def matched_clauses(text: str, reader: Reader) -> list[tuple[int, int, int, float]]:
    """(start, end, pattern number, weight) of the clauses of a text that match, in code points."""
    low = text.lower()
    if not any(reader[w][0] <= THREAT for w in set(WORD.findall(low))):
        return []
    found, state = [], 0
    for part in CLAUSE.finditer(low):
        weight = 0.0
        for word in WORD.findall(part.group()):
            symbol, w = reader[word]
            weight += w if symbol <= THREAT else 0.0
            state = GRAMMAR[state][symbol][0]
        state, pattern = GRAMMAR[state][END]
        if pattern >= 0:
            found.append((part.start(), part.end(), pattern, weight))
    return found


def clause_features(text: str, reader: Reader) -> tuple[list[float], int]:
    """For each pattern log(1 + weight of its clauses), and the number of matched clauses."""
    total, clauses = [0.0] * len(PATTERNS), matched_clauses(text, reader)
    for _, _, pattern, weight in clauses:
        total[pattern] += weight
    return [math.log1p(x) for x in total], len(clauses)


def _word_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        words, codes = [], []
        for text in batch.column("text").to_pylist():
            words.append(sorted(set(WORD.findall(text.lower()))))
            shingles = shingle_set(text.encode(), hashes)
            codes.append(int(shingles[0].view(np.int64)) if len(shingles) else 0)
        columns = [batch.column("label"), pa.array(codes, pa.int64()), pa.array(words, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["label", "code", "words"])


def _ratio(a: F.Column, b: F.Column, share: float) -> tuple[F.Column, F.Column]:
    """Toxic share (smoothed) and likelihood ratio against the overall share."""
    p = (a + 0.5) / (a + b + 1.0)
    return p, 2 * (a * F.log(p / share) + b * F.log((1 - p) / (1 - share)))


def learn_lexicon(sample: DataFrame, size: int = LEXICON) -> Lexicon:
    """Whole words and beginnings that mark toxic documents.

    Near copies (equal smallest shingle) count once, by the least list of words among them, so that every run learns the same.
    """
    seeds = {w: 1.0 for w in INSULTS.split()}
    words = stored(
        sample.select("label", "text")
        .mapInArrow(_word_batches, "label int, code long, words array<string>")
        .groupBy("code", "label")
        .agg(F.min("words").alias("words")),
        "words",
    )
    toxic, clean = words.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not toxic or not clean:
        return Lexicon(seeds, {})
    share = toxic / (toxic + clean)

    each = words.select("label", F.explode("words").alias("word"))
    counts = stored(each.groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")), "counts")
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.length("word") - 1, F.lit(LONGEST)))
    starts = counts.where(F.length("word") > SHORTEST).select(
        F.explode(F.transform(lengths, lambda n: F.substring("word", F.lit(1), n))).alias("entry"), "a", "b"
    )
    starts = starts.groupBy("entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn("whole", F.lit(False))
    entries = counts.select(F.col("word").alias("entry"), "a", "b", F.lit(True).alias("whole")).unionByName(starts)
    p, ratio = _ratio(F.col("a"), F.col("b"), share)
    likely = entries.where((p >= LEAST_SHARE) & (ratio >= LEAST_RATIO)).orderBy(ratio.desc(), "entry", "whole")
    shortlist = stored(likely.select("entry", "whole").limit(4 * size), "shortlist")

    numbered = words.select(F.monotonically_increasing_id().alias("row"), "label", F.explode("words").alias("word"))
    choices = F.concat(
        F.array(F.struct(F.col("word").alias("entry"), F.lit(True).alias("whole"))),
        F.when(F.length("word") > SHORTEST, F.transform(lengths, lambda n: F.struct(F.substring("word", F.lit(1), n).alias("entry"), F.lit(False).alias("whole")))).otherwise(F.array()),
    )
    hits = numbered.select("row", "label", F.explode(choices).alias("c")).select("row", "label", "c.entry", "c.whole")
    found = hits.join(F.broadcast(shortlist), ["entry", "whole"]).distinct()
    found = found.groupBy("entry", "whole").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (F.col("b") + 0.5)) - math.log(toxic / clean)
    kept = found.where((p >= LEAST_SHARE) & (ratio >= LEAST_RATIO)).orderBy(ratio.desc(), "entry", "whole").limit(size)
    rows = kept.select("entry", "whole", odds.alias("weight")).collect()
    learned = {r.entry: r.weight for r in rows if r.whole}
    beginnings = {r.entry: r.weight for r in rows if not r.whole}
    implied = {b for b, w in beginnings.items() if any(beginnings.get(b[:n], -1.0) >= w for n in range(1, len(b)))}
    return Lexicon(seeds | learned, {b: w for b, w in beginnings.items() if b not in implied})


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: Iterable[float], strength: float = 2.0) -> np.ndarray:
    """Logistic weights by Newton steps, drawn to `prior` by a quadratic penalty."""
    prior = np.array(list(prior))
    x = np.hstack([np.ones((len(x), 1)), x])
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + strength * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    weights: tuple[float, ...]

    def score(self, features: list[float]) -> float:
        z = self.weights[0] + sum(w * f for w, f in zip(self.weights[1:], features, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE) -> ToxicityModel:
    """Learns from at most `sample_rows` labelled rows outside the held-out fold."""
    sample = stored(labelled_sample(docs, labels, "toxic", sample_rows).select("text", "label"), "sample")
    lexicon = learn_lexicon(sample)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = lexicon.reader()
        for batch in batches:
            x = [clause_features(t, reader)[0] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    # At most sample_rows short rows, in an order of their own, since sums of doubles depend on it.
    rows = sorted(sample.mapInArrow(features, "label int, x array<double>").collect(), key=lambda r: (r.label, r.x))
    y = np.array([r.label for r in rows], float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(lexicon, PRIOR)
    return ToxicityModel(lexicon, tuple(fit_logistic(np.array([r.x for r in rows]), y, PRIOR)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, n_clauses (matched ones) of every document."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.lexicon.reader()
        for batch in batches:
            scores, counts = [], []
            for text in batch.column("text"):
                features, n = clause_features(text.as_py() or "", reader)
                scores.append(model.score(features))
                counts.append(n)
            columns = [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "n_clauses"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"doc_id {kind}, score double, n_clauses long")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "n_clauses",
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `docs` whose text scores below `least`, with all their columns."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        reader = model.lexicon.reader()
        return texts.map(lambda t: model.score(clause_features(t or "", reader)[0])).astype("float64")

    return docs.where(score(F.col(text_col)) < least)
