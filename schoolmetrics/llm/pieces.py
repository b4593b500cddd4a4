"""SentencePiece encoding and decoding as a relational lattice.

White space becomes "▁", one "▁" is put in front, and the text falls apart into words that no piece crosses (checked when
the model is read). A word's lattice is a relation: its substrings up to the longest piece, equi-joined to the piece
table. The edges are grouped by word again and folded by a higher-order `aggregate`:

    unigram models   Viterbi: for each end the best score over the edges that end there
    BPE models       the neighbours whose joined piece has the highest score merge, the leftmost of equals, until none do

For a BPE model Viterbi gives other ids than the library, which merges; so the second fold is the right one there.
Characters without a piece become the pieces of their bytes.

`encode` builds that relation for the `DICTIONARY` most frequent words of all documents. It is a table of bounded size and
is shipped to tasks, which then read whole texts with it. Words beyond it are folded in the task by the same rule, all
new ones of some documents at once; joining their occurrences back to the documents instead would shuffle several times
the input.

Cases: a null text counts as empty, and an empty text has no ids; a repeated row is encoded again; a null id is carried; an
empty table gives no rows; "▁" in a text is read as a space, as by the library. Decoding gives the text back otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolmetrics.llm.common import stored

SPACE = "▁"
DICTIONARY = 1 << 15
#: Words: spaces and then letters, digits or other marks; both engines read the pattern alike.
WORD = rf"{SPACE}*[\p{{L}}\p{{M}}]+|{SPACE}*\p{{Nd}}+|{SPACE}*[^\p{{L}}\p{{M}}\p{{Nd}}{SPACE}]+|{SPACE}+"
#: Spaces and what follows up to the next; words don't cross these, so distinct ones are cut into words.
CHUNK = " +[^ ]*"
FAR = re.compile("[\U00010000-\U0010ffff]")
#: Words up to this length are folded many at once.
SHORT = 32
BYTE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass(frozen=True)
class Pieces:
    """Pieces with ids and scores, and the ids of the 256 bytes."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: tuple[int, ...]
    names: tuple[str, ...]

    @property
    def longest(self) -> int:
        return max(map(len, self.ids))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(p, i, self.scores[p]) for p, i in self.ids.items()]
        return spark.createDataFrame(rows, "piece string, id int, score double")


def read_model(path: str | None = None) -> Pieces:
    """The pieces of a model file; by default the public `piece_bpe_32k`."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    plain = [i for i in range(len(names)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    by_byte = {int(BYTE.fullmatch(n).group(1), 16): i for i, n in enumerate(names) if model.is_byte(i)}
    whole = regex.compile(WORD)
    crossing = [names[i] for i in plain if not whole.fullmatch(names[i])]
    if crossing:
        raise ValueError(f"pieces that cross words: {crossing[:5]}")
    return Pieces(
        {names[i]: i for i in plain},
        {names[i]: model.get_score(i) for i in plain},
        tuple(by_byte[b] for b in range(256)),
        tuple(names),
    )


def marked(text: Column) -> Column:
    """The text with spaces as marks and one in front; null and empty texts are empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text == "", text).otherwise(F.concat(F.lit(SPACE), F.translate(text, " ", SPACE)))


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """word, edges: the pieces among a word's substrings, as structs of start, end (from 0, exclusive), id and score.

    The piece table has a fixed size, so it is broadcast. A word without any edge keeps an empty list.
    """
    n = F.length("word")
    starts = F.sequence(F.lit(0), n - 1)
    ends = lambda s: F.sequence(s + 1, F.least(n, s + F.lit(pieces.longest)))
    parts = F.flatten(
        F.transform(starts, lambda s: F.transform(ends(s), lambda e: F.struct(s.alias("start"), e.alias("end"))))
    )
    split = words.where(n > 0).select("word", F.explode(parts).alias("part"))
    split = split.select("word", "part.start", "part.end", F.expr("substring(word, part.start + 1, part.end - part.start)").alias("piece"))
    edges = split.join(F.broadcast(pieces.table(words.sparkSession)), "piece", "left")
    edge = F.when(F.col("id").isNotNull(), F.struct("start", "end", "id", "score"))
    return edges.groupBy("word").agg(F.collect_list(edge).alias("edges"))


def _byte_ids(character: Column, pieces: Pieces) -> Column:
    """Ids of the bytes of a character."""
    table = F.array(*map(F.lit, pieces.bytes_))
    code = F.hex(F.encode(character, "UTF-8"))
    each = F.sequence(F.lit(1), F.length(code), F.lit(2))
    return F.transform(each, lambda i: F.element_at(table, F.conv(F.substring(code, i, F.lit(2)), 16, 10).cast("int") + 1))


def _key(start: Column, end: Column) -> Column:
    return start * 10_000 + end


def merged(lattices: DataFrame, pieces: Pieces) -> DataFrame:
    """Fold of a BPE model: word, ids.

    Scores and ids of the edges become maps in a step of their own, since the fold looks them up again and again.
    """
    by_place = lambda value: F.map_from_entries(
        F.transform("edges", lambda x: F.struct(_key(x.start, x.end), x[value]))
    )
    mapped = lattices.select("word", by_place("score").alias("scores"), by_place("id").alias("ids"))
    cuts = mapped.select("word", "ids", _merge_cuts(F.col("word"), F.col("scores")).alias("cuts"))
    return cuts.select("word", _cut_ids(F.col("word"), F.col("cuts"), F.col("ids"), pieces).alias("ids"))


def _merge_cuts(word: Column, scores: Column) -> Column:
    """Places where the word stays cut after all merges."""
    lowest = F.lit(float("-inf"))
    cuts = F.sequence(F.lit(0), F.length(word))

    def step(cuts: Column, _: Column) -> Column:
        inner = F.when(F.size(cuts) > 2, F.sequence(F.lit(1), F.size(cuts) - 2)).otherwise(F.array().cast("array<int>"))
        options = F.transform(
            inner,
            lambda i: F.struct(
                F.coalesce(F.element_at(scores, _key(F.get(cuts, i - 1), F.get(cuts, i + 1))), lowest).alias("score"),
                (-F.get(cuts, i)).alias("cut"),
            ),
        )
        best = F.array_max(options)
        return F.when(best.score > lowest, F.filter(cuts, lambda c: c != -best.cut)).otherwise(cuts)

    return F.aggregate(F.sequence(F.lit(1), F.length(word)), cuts, step)


def _cut_ids(word: Column, cuts: Column, ids: Column, pieces: Pieces) -> Column:
    spans = F.transform(F.sequence(F.lit(1), F.size(cuts) - 1), lambda i: F.struct(F.get(cuts, i - 1).alias("s"), F.get(cuts, i).alias("e")))
    return F.flatten(
        F.transform(
            spans,
            lambda x: F.coalesce(
                F.when(F.map_contains_key(ids, _key(x.s, x.e)), F.array(F.element_at(ids, _key(x.s, x.e)))),
                _byte_ids(F.substring(word, x.s + 1, x.e - x.s), pieces),
            ),
        )
    )


def viterbi(lattices: DataFrame, pieces: Pieces, unknown: float = -1e6) -> DataFrame:
    """Fold of a unigram model: word, ids of the best path. A character without a piece costs `unknown`."""
    word, edges = F.col("word"), F.col("edges")
    nothing = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))

    def step(best: Column, end: Column) -> Column:
        ending = F.filter(edges, lambda x: x.end == end)
        paths = F.transform(
            ending,
            lambda x: F.struct(
                (F.get(best, x.start).score + x.score).alias("score"),
                F.concat(F.get(best, x.start).ids, F.array(x.id)).alias("ids"),
            ),
        )
        last = F.get(best, end - 1)
        spelled = F.struct(
            (last.score + unknown).alias("score"),
            F.concat(last.ids, _byte_ids(F.substring(word, end, F.lit(1)), pieces)).alias("ids"),
        )
        return F.concat(best, F.array(F.array_max(F.concat(paths, F.array(spelled)))))

    best = F.element_at(F.aggregate(F.sequence(F.lit(1), F.length(word)), nothing, step), -1)
    return lattices.select("word", best.ids.alias("ids"))


def encode_words(words: DataFrame, pieces: Pieces, fold=merged) -> DataFrame:
    """word, ids of distinct words."""
    return fold(lattice(words, pieces), pieces)


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = DICTIONARY) -> DataFrame:
    """Up to `most` of the most frequent words of all documents.

    The least count comes from a histogram over eighths of powers of two, so no task puts all candidates in order.
    """
    text = F.col(text_col)
    every = F.regexp_extract_all(F.concat(F.lit(" "), text), F.lit(CHUNK), F.lit(0))
    chunks = docs.where(text != "").select(F.explode(every).alias("chunk")).groupBy("chunk").agg(F.count("*").alias("n"))
    words = chunks.select("n", F.explode(F.regexp_extract_all(F.translate("chunk", " ", SPACE), F.lit(WORD), F.lit(0))).alias("word"))
    counted = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "words")
    step = F.floor(F.log2("n") * 8)
    sizes = counted.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()  # a few hundred rows
    least, held = None, 0
    for row in sorted(sizes, key=lambda r: -r.step):
        if held + row.words > most:
            break
        least, held = row.step, held + row.words
    return counted.where(step >= least if least is not None else F.lit(False)).select("word")


@dataclass(frozen=True)
class Merges:
    """What may be joined, for folding many words at once: symbols are pieces by their ids, and further characters of pieces."""

    by_point: np.ndarray
    """Symbol of each code point; the last one stands for all characters in no piece, and joins with nothing."""
    pairs: np.ndarray
    """left * symbols + right, sorted."""
    joined: np.ndarray
    """The piece each pair makes, and -1 for no pair."""
    scores: np.ndarray
    """By piece; the last entry stands for no piece."""
    bytes_of: dict[int, bytes]
    """Ids of the bytes of characters that are no pieces, as bytes."""

    @staticmethod
    def of(pieces: Pieces) -> Merges:
        symbols = {c: pieces.ids.get(c, -1) for c in sorted(set("".join(pieces.ids)))}
        spelled = [c for c, i in symbols.items() if i < 0]
        symbols |= {c: len(pieces.names) + k for k, c in enumerate(spelled)}
        by_point = np.full(max(map(ord, symbols), default=0) + 2, len(pieces.names) + len(spelled), np.int32)
        for c, i in symbols.items():
            by_point[ord(c)] = i
        symbols |= pieces.ids
        pairs = sorted(
            (symbols[p[:k]] * (int(by_point[-1]) + 1) + symbols[p[k:]], i)
            for p, i in pieces.ids.items()
            for k in range(1, len(p))
            if p[:k] in symbols and p[k:] in symbols
        )
        scores = np.full(len(pieces.names) + 1, -np.inf)
        for p, i in pieces.ids.items():
            scores[i] = pieces.scores[p]
        end = [(np.iinfo(np.int64).max, -1)]  # every search ends at an entry
        keys, made = zip(*pairs, *end, strict=True)
        of = {by_point[ord(c)].item(): np.array([pieces.bytes_[b] for b in c.encode()], "<i4").tobytes() for c in spelled}
        return Merges(by_point, np.array(keys, np.int64), np.array((*made, -1), np.int32), scores, of)

    def _join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pieces that pairs of symbols make, or -1."""
        wanted = left.astype(np.int64) * (int(self.by_point[-1]) + 1) + right
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.joined[at], np.int32(-1))

    def fold(self, words: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """Words with their symbols after all merges, a row each. All words have one length, so each merge makes all shorter by one."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
        parts, rows = self.by_point[np.minimum(points, len(self.by_point) - 1)], np.arange(len(words))
        joined = self._join(parts[:, :-1], parts[:, 1:])
        while joined.shape[1]:
            score, each = self.scores[joined], np.arange(len(rows))
            best = score.argmax(axis=1)  # the leftmost of equals
            live = score[each, best] > -np.inf
            yield [words[i] for i in rows[~live].tolist()], parts[~live]
            if not live.any():
                return
            rows, parts, joined, best = rows[live], parts[live], joined[live], best[live]
            each, width = np.arange(len(rows)), joined.shape[1]
            parts[each, best] = joined[each, best]
            stay = np.arange(width + 1) != best[:, None] + 1
            parts = parts[stay].reshape(-1, width)
            joined = joined[np.arange(width) != best[:, None]].reshape(len(rows), width - 1)
            i = np.flatnonzero(best > 0)
            joined[i, best[i] - 1] = self._join(parts[i, best[i] - 1], parts[i, best[i]])
            i = np.flatnonzero(best < width - 1)
            joined[i, best[i]] = self._join(parts[i, best[i]], parts[i, best[i] + 1])
        yield [words[i] for i in rows.tolist()], parts

    def ids(self, words: Iterable[str], pieces: Pieces) -> dict[str, bytes]:
        """Ids of words as bytes, by the rule of `fold_word`, which long words and those with other characters go to."""
        by_length: dict[int, list[str]] = {}
        found: dict[str, bytes] = {}
        alone = []
        for word in words:
            if len(word) <= SHORT:
                by_length.setdefault(len(word), []).append(word)
            else:
                alone.append(word)
        other, n = int(self.by_point[-1]), len(self.scores) - 1
        for these in by_length.values():
            for some, parts in self.fold(these):
                data, size = parts.astype("<i4").tobytes(), 4 * parts.shape[1]
                for k, (word, most) in enumerate(zip(some, parts.max(axis=1, initial=-1).tolist(), strict=True)):
                    if most < n:
                        found[word] = data[k * size : (k + 1) * size]
                    elif most == other:
                        alone.append(word)
                    else:
                        found[word] = b"".join(self.bytes_of.get(i) or i.to_bytes(4, "little") for i in parts[k].tolist())
        for word in alone:
            found[word] = np.array(fold_word(word, pieces), "<i4").tobytes()
        return found


class Ids(dict):
    """Word -> ids as bytes; words beyond the dictionary are folded here, and remembered up to a bound."""

    BOUND = 300_000

    def __init__(self, known: dict[str, bytes], pieces: Pieces, merges: Merges):
        super().__init__(known)
        self._known, self._pieces, self._merges = known, pieces, merges

    def learn(self, words: set[str]) -> None:
        """Remember these words; those of earlier calls may be forgotten."""
        fresh = [w for w in words if w not in self]
        if len(self) + len(fresh) > len(self._known) + self.BOUND:
            self.clear()
            self.update(self._known)
            fresh = [w for w in words if w not in self]
        self.update(self._merges.ids(fresh, self._pieces))


def plain_word() -> str:
    """WORD for `re` and texts of the first 65,536 characters: it looks their classes up in a table, and so finds words faster."""
    every = "".join(map(chr, range(0x10000)))

    def members(kind: str) -> str:
        return "".join(f"\\u{m.start():04x}-\\u{m.end() - 1:04x}" for m in regex.finditer(kind, every))

    letters, digits = members(r"[\p{L}\p{M}]+"), members(r"\p{Nd}+")
    return rf"{SPACE}*[{letters}]+|{SPACE}*[{digits}]+|{SPACE}*[^{letters}{digits}{SPACE}]+|{SPACE}+"


def fold_word(word: str, pieces: Pieces) -> list[int]:
    """The fold of a BPE model for one word."""
    parts, scores = list(word), pieces.scores
    joined = [scores.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
    while True:
        best, at = None, -1
        for i, score in enumerate(joined):
            if score is not None and (best is None or score > best):
                best, at = score, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del joined[at]
        if at:
            joined[at - 1] = scores.get(parts[at - 1] + parts[at])
        if at < len(joined):
            joined[at] = scores.get(parts[at] + parts[at + 1])
    ids: list[int] = []
    for part in parts:
        one = pieces.ids.get(part)
        ids += [one] if one is not None else [pieces.bytes_[b] for b in part.encode()]
    return ids


def encode(
    docs: DataFrame, pieces: Pieces, *, id_col: str = "doc_id", text_col: str = "text", dictionary: int = DICTIONARY
) -> DataFrame:
    """doc_id, n_ids, ids of every document, by a BPE model."""
    spark = docs.sparkSession
    words = frequent_words(docs, text_col, dictionary).repartition("word")
    known = stored(encode_words(words, pieces), "dictionary")
    rows = known.toPandas()  # at most `dictionary` short rows
    shipped = {w: np.array(i, "<i4").tobytes() for w, i in zip(rows["word"], rows["ids"], strict=True)}
    parts = (pieces.ids, pieces.scores, pieces.bytes_, pieces.names)
    shared = spark.sparkContext.broadcast((shipped, parts, tuple(vars(Merges.of(pieces)).values())))
    plain = plain_word()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own, merges = shared.value
        ids_of = Ids(known, Pieces(*own), Merges(*merges))
        find_plain, find = re.compile(plain).findall, regex.compile(WORD).findall
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                split = []
                for text in part.column("text"):
                    text = text.as_py()
                    whole = SPACE + text.replace(" ", SPACE) if text else ""
                    split.append((find if FAR.search(whole) else find_plain)(whole))
                ids_of.learn(set().union(*split))
                data = [b"".join(map(ids_of.__getitem__, words)) for words in split]
                ends = np.cumsum([0] + [len(d) // 4 for d in data]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(data), "<i4"), pa.int32())
                ids = pa.ListArray.from_arrays(pa.array(ends), flat)
                columns = [part.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)), ids]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_ids long, ids array<int>")


def decode(encoded: DataFrame, pieces: Pieces, ids_col: str = "ids") -> Column:
    """A column with the text of ids."""
    by_id = {i: bytes([b]) for b, i in enumerate(pieces.bytes_)} | {i: p.encode() for p, i in pieces.ids.items()}
    table = [by_id.get(i, b"") for i in range(len(pieces.names))]
    spaced = [x.replace(SPACE.encode(), b" ") for x in table]
    spelling = np.zeros(len(table), bool)
    spelling[list(pieces.bytes_)] = True

    # Texts go into one buffer as they are decoded; rows as objects would hold several times the batch in every worker.
    # Pieces are put together for some rows at once; only where bytes are spelled are they read as characters.
    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        ends = ids.offsets.to_numpy()
        values, whole = ids.values.to_numpy(zero_copy_only=False), pa.array(spaced, pa.binary())
        texts, places = bytearray(), np.zeros(len(ids) + 1, np.int32)
        for at in range(0, len(ids), 500):
            cut = ends[at : at + 501]
            here = values[cut[0] : cut[-1]]
            _, starts, data = whole.take(pa.array(here)).buffers()
            edges = np.frombuffer(starts, np.int32)[cut - cut[0]].tolist() if len(here) else [0] * len(cut)
            before = np.concatenate(([0], np.cumsum(spelling[here])))[cut - cut[0]]
            spelled, data = (np.diff(before) > 0).tolist(), memoryview(data or b"")
            for row, (start, end) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if spelled[row]:
                    own = b"".join(map(table.__getitem__, here[cut[row] - cut[0] : cut[row + 1] - cut[0]].tolist()))
                    texts += own.decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ").encode()
                else:
                    texts += data[start + (start < end and data[start] == 32) : end]
                places[at + row + 1] = len(texts)
        valid = ids.is_valid().buffers()[1] if ids.null_count else None
        return pa.StringArray.from_buffers(len(ids), pa.py_buffer(places), pa.py_buffer(texts), valid, ids.null_count)

    return text_of(F.col(ids_col))
