"""Quality of texts: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A text is read as words, numbers and runs of marks. Its features are single tokens and pairs of neighbours, and the same
over their shapes (lower case, capitalised, upper case, mixed, number, mark, and whether a token repeats the one before);
all are hashed to `SIZE` places. A feature's value is its count over the square root of the number of tokens, so a score is
one sparse dot product: gather the weights, add them up, divide.

Training reads at most `SAMPLE` labelled rows outside the held-out fold, in the order of a hash of their ids, and streams
them through one task; per-coordinate rates and the L1 part of the leader leave most weights at zero. The model is an
array of fixed size.

Cases: a null text counts as empty and gets the score of the intercept; labels that are missing, null or not 0/1 teach
nothing; without labels all scores are 0.5; an empty table gives no rows; a repeated row is scored again; a null id counts
as held out. Ids, language, source and labels are no inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolmetrics.llm.common import held_out, stored
from schoolmetrics.llm.shingles import mix
from schoolmetrics.llm.training import labelled_sample

SAMPLE = 20_000
SIZE = 1 << 18
#: Share of labels at or above which a text is called good.
LEAST = 0.3
#: Rate, its damping, and the L1 and L2 parts.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 1.0

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
LOWER, TITLE, UPPER, MIXED, NUMBER, MARK, REPEAT = range(7)
SHAPES = 8
#: The first places of the weights are for pairs of shapes, single shapes and the intercept.
INTERCEPT = SHAPES * SHAPES + SHAPES
FIRST_WORD = 128


class TokenCodes(dict):
    """Token -> 64-bit hash with its shape in the low three bits, remembered up to a bound."""

    BOUND = 300_000

    def __missing__(self, token: str) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        if token.isalpha():
            shape = LOWER if token.islower() else UPPER if token.isupper() and len(token) > 1 else TITLE if token.istitle() else MIXED
        else:
            shape = NUMBER if token.isdigit() else MARK
        code = self[token] = xxhash.xxh3_64_intdigest(token.encode()) & ~7 | shape
        return code


def places(text: str, codes: TokenCodes) -> np.ndarray:
    """The hashed places of all n-grams of a text, one entry for each occurrence; empty for a text without tokens."""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not n:
        return np.empty(0, np.int64)
    code = np.fromiter(map(codes.__getitem__, tokens), np.uint64, n)
    shape = (code & np.uint64(7)).astype(np.int64)
    again = np.flatnonzero(code[1:] == code[:-1]) + 1
    shape[again] = REPEAT
    words = np.uint64(SIZE - FIRST_WORD)
    single = code % words
    pair = mix(code[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[1:]) % words
    return np.concatenate(
        (
            single.astype(np.int64) + FIRST_WORD,
            pair.astype(np.int64) + FIRST_WORD,
            shape[:-1] * SHAPES + shape[1:],
            shape + SHAPES * SHAPES,
        )
    )


def _margin(at: np.ndarray, weights: np.ndarray) -> float:
    return float(weights[INTERCEPT] + (weights[at].sum() / math.sqrt(len(at)) if len(at) else 0.0))


def _share(margin: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, margin))))


class Leader:
    """Follow the regularised leader, one row at a time."""

    def __init__(self):
        self.z, self.n = np.zeros(SIZE), np.zeros(SIZE)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        place, count = np.unique(at, return_counts=True)
        x = np.append(count / math.sqrt(max(1, len(at))), 1.0)
        place = np.append(place, INTERCEPT)
        w = self.weights(place)
        g = (_share(float(w @ x)) - label) * x
        n = self.n[place]
        self.z[place] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[place] = n + g * g


def fit_quality(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE) -> np.ndarray:
    """Weights learned from at most `sample_rows` labelled rows."""
    sample = stored(labelled_sample(docs, labels, "quality", sample_rows), "sample")

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, codes = Leader(), TokenCodes()
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                leader.learn(places(text.as_py(), codes), label)
        data = leader.weights(slice(None)).astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["weights"])

    in_order = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("text", "label")
    rows = in_order.mapInArrow(train, "weights binary").collect()  # one array of fixed size
    return np.frombuffer(rows[0].weights, "<f4").astype(np.float64) if rows else np.zeros(SIZE)


def score_quality(
    docs: DataFrame, weights: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST
) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    small = docs.sparkSession.sparkContext.broadcast(weights.astype("<f4"))  # SIZE numbers, whatever the input

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, w = TokenCodes(), small.value.astype(np.float64)
        for batch in batches:
            scores = [_share(_margin(places(t.as_py() or "", codes), w)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(score, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"),
    )
