"""Secrets in texts: fixed patterns, and a battery of randomness tests with false-discovery control.

Patterns find assignments, access keys and long hexadecimal runs. The battery looks at every other token of 20 or more
characters that mixes letters with digits or cases; tokens are cut at '=' and, where no encoding fits, at foreign characters. Its encoding is inferred from its characters (hexadecimal, base 32,
36 or 64), and over that alphabet of k symbols it takes

    chi-squared    how evenly the symbols are used,
    runs           how often the token crosses the middle of the alphabet,
    serial         the correlation of neighbouring symbols.

A token that one of them calls uneven is no secret. For the rest the chi-squared value and the number of changes between
letter, digit and case are held against what ordinary text would give at this length: a noncentral chi-squared law with the
symbol frequencies of ordinary text, and a binomial law with its rate of changes. Both come from the document outside its
long tokens, shrunk towards all documents, and these towards `PRIOR`; a list of keys thus isn't its own law. Fisher's method joins the two to a
p-value of "ordinary text", and within each length class the Benjamini-Hochberg rule over all documents bounds the share
of false discoveries. Its thresholds come from a histogram of fixed size, not from a sorted list.

Cases: a null text counts as empty and has no spans; a repeated row is scanned again; a null id is carried; an empty table
gives no rows. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
#: Assignments have one of these in them, which is quicker to look for.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# A run is maximal, so asking for the least length finds the same matches as filtering by it.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ALPHABETS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "0123456789abcdefghijklmnopqrstuvwxyz",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)
PLACES = [{c: i for i, c in enumerate(a)} for a in ALPHABETS]
OWN = [re.compile(f"[{re.escape(a)}]+") for a in ALPHABETS]
SYMBOLS = "".join(sorted(set().union(*ALPHABETS)))
#: Shares of symbols in ordinary text (letters by their frequency in English), and its rate of changes between kinds.
PRIOR = {c: 0.0005 for c in SYMBOLS} | dict(
    zip("etaoinshrdlcumwfgypbvkjxqz", (0.12, 0.09, 0.08, 0.075, 0.07, 0.07, 0.063, 0.06, 0.06, 0.043, 0.04, 0.028, 0.028, 0.024, 0.024, 0.022, 0.02, 0.02, 0.019, 0.015, 0.01, 0.008, 0.0015, 0.0015, 0.001, 0.0007), strict=True)
)
CHANGES = 0.02
#: So many characters does a document count with besides its own, and do all documents.
DOCUMENT_WEIGHT, CORPUS_WEIGHT = 200, 10_000
#: A test that gives less than this calls the token uneven.
UNEVEN = 1e-3
#: Upper ends of the length classes, and the histogram of -10 log10(p).
LENGTHS = (31, 63, 127)
LEVELS = 300
FALSE_SHARE = 1e-3


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns' matches, in code points."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _tail(z: float) -> float:
    """P(Z > z) of the standard normal law."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def infer_encoding(token: str) -> int | None:
    """The smallest alphabet that has all characters of the token, padding aside."""
    used = set(token)
    for i, places in enumerate(PLACES):
        if used <= places.keys():
            return i
    return None


def randomness(codes: np.ndarray, k: int) -> tuple[float, float, float, float]:
    """p-values of the three tests if symbols are drawn evenly, and the chi-squared value."""
    n = len(codes)
    chi = float(((np.bincount(codes, minlength=k) - n / k) ** 2).sum() * k / n)
    # Wilson and Hilferty: the cube root of chi-squared / df is nearly normal.
    spread = 2 / (9 * (k - 1))
    p_chi = _tail(((chi / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    high = codes >= k / 2
    ones = int(high.sum())
    zeros = n - ones
    if not ones or not zeros:
        return p_chi, 0.0, 0.0, chi
    mean = 1 + 2 * ones * zeros / n
    variance = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    runs = 1 + int((high[1:] != high[:-1]).sum())
    p_runs = 2 * _tail(abs(runs - mean) / math.sqrt(variance))
    centred = codes - codes.mean()
    power = float(centred @ centred)
    serial = float(centred[1:] @ centred[:-1]) / power if power else 1.0
    p_serial = 2 * _tail(abs(serial + 1 / n) * math.sqrt(n))
    return p_chi, p_runs, p_serial, chi


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2


class Levels(list):
    """Least levels by length class, with the law of ordinary text of the documents they were taken from."""

    law: tuple[dict[str, float], float] = (PRIOR, CHANGES)


def counted(text: str) -> tuple[Counter, int, int]:
    """Symbols, changes of kind, and pairs of neighbours in words, outside tokens of 20 and more characters."""
    outside = TOKEN.sub(" ", text)
    words = [w for w in re.findall(r"[A-Za-z0-9]{2,}", outside) if len(w) < 20]
    turns = sum(1 for w in words if not w.isalpha() or not w.islower() for a, b in zip(w, w[1:], strict=False) if _kind(a) != _kind(b))
    return Counter(outside), turns, sum(len(w) - 1 for w in words)


def shrunk(symbols: Counter, turns: int, pairs: int, law: tuple[dict[str, float], float], weight: float) -> tuple[dict[str, float], float]:
    """Expected shares of symbols and rate of changes, with `weight` characters of `law` added."""
    mixed = {c: symbols.get(c, 0) + weight * law[0][c] for c in SYMBOLS}
    total = sum(mixed.values())
    return {c: n / total for c, n in mixed.items()}, (turns + weight * law[1]) / (pairs + weight)


def corpus_law(docs: DataFrame, *, text_col: str = "text") -> tuple[dict[str, float], float]:
    """The law of ordinary text over all documents. What reaches the driver is one row a symbol, and two."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                symbols, turns, pairs = counted(text.as_py() or "")
                total.update(symbols)
                total.update({"turns": turns, "pairs": pairs})
        names = [c for c in (*SYMBOLS, "turns", "pairs") if total[c]]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([total[c] for c in names], pa.int64())], ["name", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "name string, n long")
    found = Counter({r["name"]: r["n"] for r in rows.groupBy("name").agg(F.sum("n").alias("n")).collect()})
    return shrunk(found, found["turns"], found["pairs"], (PRIOR, CHANGES), CORPUS_WEIGHT)


def _ordinary(token: str, codes: np.ndarray, encoding: int, chi: float, symbols: dict[str, float], changes: float) -> float:
    """p-value of "ordinary text of this length looks as random as this"."""
    n, k = len(codes), len(ALPHABETS[encoding])
    q = np.array([symbols[c] for c in ALPHABETS[encoding]])
    q /= q.sum()
    away = n * k * float(((q - 1 / k) ** 2).sum())
    p_even = _tail((k - 1 + away - chi) / math.sqrt(2 * (k - 1 + 2 * away)))
    turns = sum(_kind(a) != _kind(b) for a, b in zip(token, token[1:], strict=False))
    spread = math.sqrt((n - 1) * changes * (1 - changes))
    p_turns = _tail((turns - 0.5 - (n - 1) * changes) / spread)
    x = -math.log(max(p_even, 1e-300)) - math.log(max(p_turns, 1e-300))
    return math.exp(-x) * (1 + x)


def pieces_of(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """(start, end) of the parts of a token that are tested: cut at '=', and where no alphabet has all its characters,
    at those foreign to the alphabet that leaves the longest part (of equal ones, the smallest).
    """
    found = []
    for part in re.finditer("[^=]+", text[start:end]):
        at, token = start + part.start(), part.group()
        if len(token) < 20:
            continue
        if infer_encoding(token) is not None:
            found.append((at, at + len(token)))
            continue
        cuts = [[m.span() for m in own.finditer(token)] for own in OWN]
        best = max(cuts, key=lambda spans: max((e - s for s, e in spans), default=0))
        found += [(at + s, at + e) for s, e in best if e - s >= 20]
    return found


def candidates(text: str, taken: list[tuple[int, int, int]], law: tuple[dict[str, float], float]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, level) of the tokens that look random and that no pattern has found."""
    found, symbols, changes = [], None, 0.0
    for start, end in (piece for m in TOKEN.finditer(text) for piece in pieces_of(text, *m.span())):
        token = text[start:end]
        body = token[1:]
        if token.isalpha() and (body.islower() or body.isupper()):
            continue
        if not any(c.isalpha() for c in token) or any(s < end and start < e for s, _, e in taken):
            continue
        encoding = infer_encoding(token)
        codes = np.array([PLACES[encoding][c] for c in token])
        p_chi, p_runs, p_serial, chi = randomness(codes, len(ALPHABETS[encoding]))
        if min(p_chi, p_runs, p_serial) < UNEVEN:
            continue
        if symbols is None:
            symbols, changes = shrunk(*counted(text), law, DOCUMENT_WEIGHT)
        p = _ordinary(token, codes, encoding, chi, symbols, changes)
        level = min(LEVELS - 1, int(-10 * math.log10(max(p, 1e-300))))
        found.append((start, end, sum(len(token) > x for x in LENGTHS), level))
    return found


def discovery_levels(docs: DataFrame, *, text_col: str = "text", false_share: float = FALSE_SHARE) -> Levels:
    """For each length class the least level that counts as a discovery, over all documents.

    Benjamini-Hochberg: the largest p with p <= share * (tokens at p or below) / (tokens looked at). What reaches the
    driver is the histogram, of at most 4 * LEVELS rows.
    """
    law = corpus_law(docs, text_col=text_col)

    def levels(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter = Counter()
            for text in batch.column(0):
                t = text.as_py() or ""
                count.update((size, level) for _, _, size, level in candidates(t, base_spans(t), law))
            rows = [(s, v, n) for (s, v), n in count.items()]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["size", "level", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(levels, "size long, level long, n long")
    table = np.zeros((len(LENGTHS) + 1, LEVELS), np.int64)
    for row in counted.groupBy("size", "level").agg(F.sum("n").alias("n")).collect():
        table[row["size"], row["level"]] = row["n"]
    least = Levels()
    least.law = law
    for counts in table:
        at_or_above, total = counts[::-1].cumsum()[::-1], counts.sum()
        good = [v for v in range(LEVELS) if at_or_above[v] and 10 ** (-v / 10) * total <= false_share * at_or_above[v]]
        least.append(min(good, default=LEVELS))
    return least


def all_spans(text: str, least: list[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The patterns' spans, and those together with the discoveries."""
    base = base_spans(text)
    more = [(start, 3, end) for start, end, size, level in candidates(text, base, getattr(least, "law", Levels.law)) if level >= least[size]]
    return base, sorted(base + more)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame, least: list[int], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of every document."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digests, spans = [], []
            for text in batch.column("text"):
                base, every = all_spans(text.as_py() or "", least)
                kinds = Counter(kind for _, kind, _ in every)
                for kind, column in enumerate(counts):
                    column.append(kinds[kind])
                digests.append(hashlib.sha256(_written(base).encode()).hexdigest())
                spans.append(_written(every))
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts[:3])]
            columns += [pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(counts[3], pa.int64())]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    return rows.mapInArrow(scan, schema)


def masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """The text with the union of the spans replaced, each stretch by one mask."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redactor(least: list[int], mask: str = "[SECRET]") -> Callable:
    """A column function that masks the secrets of a text; null stays null."""

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else masked(t, all_spans(t, least)[1], mask))

    return redact


def mask_secrets(docs: DataFrame, least: list[int], *, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns of `docs`, secrets masked. A length column, if there is one, follows texts that change."""
    before, name = F.col(text_col), "masked" + "_" * max(map(len, docs.columns))  # longer than any name there is
    out = docs.withColumn(name, redactor(least)(before))
    changed = ~before.eqNullSafe(F.col(name))
    more = {length_col: F.when(changed, F.length(name)).otherwise(F.col(length_col))} if length_col in docs.columns else {}
    out = out.withColumns({**more, text_col: F.col(name)}).drop(name)
    return out.select([F.col(f"`{c}`").cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
