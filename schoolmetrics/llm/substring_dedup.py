"""Repeated passages, found by sliding spans of sentences and by runs of words.

A text is cut into sentences: at white space after a full stop, question or exclamation mark, at line ends, and before a
capitalised word, since pasted passages often begin in the middle of a sentence. From every sentence a span runs on until
it has at least `SENTENCES` sentences and `WORDS` words (a sentence of `ALONE` words is a span by itself). Equal passages
thus have equal spans wherever they stand. Spans are hashed to 96 bits and joined over all documents; a span is repeated
where its document isn't the one with the smallest id that has it, or where the same document had it before. Sentences
covered by a repeated span are removed, so every passage stays once.

Sentences may be cut by the passage's ends. So every run of `RUN` words is compared as well, wherever it begins: a run is
repeated by the same rule, and its words are removed, from within sentences too. Comparing all runs of all documents would
send each word many times. Two runs can only be equal if the smallest hash among their groups of `GROUP` words is (winnowing).
Neighbouring runs with the same smallest hash make a block, of 13 runs on average. A document first sends its blocks. An equal
block in a document with a smaller id settles all its runs. Where one smallest hash has different blocks, the first holder
of each sends the block's runs, and these are compared. Characters of scripts without spaces count as words, and so do those of words longer than `LONG`.

A document sends each of its spans once, so counting is a plain hash aggregation with partial sums, and the join back can be
split where a passage is very common. No list of the holders of a span is built.

Cases: null stays null, empty and blank texts stay as they are, texts shorter than a span have none; a row without an id
keeps its text and makes no other text repeated; rows with one id count as one document, so equal rows with one id both
stay; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolmetrics.llm.common import stored
from schoolmetrics.llm.shingles import constants, mix

SENTENCES, WORDS, ALONE = 2, 20, 50
RUN, GROUP, LONG = 50, 25, 100
#: Thai to Burmese, Khmer, kana and Han: written without spaces.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
SOME_UNSPACED = re.compile(f"[{UNSPACED}]")
UNIT = re.compile(rf"[{UNSPACED}]|[^\s{UNSPACED}]+")
#: By code point, whether it is white space; the last entry stands for all further ones, none of which is.
SPACE = np.array([chr(c).isspace() for c in range(0x3002)])
#: By code point, a value for hashes of words: none for white space, and the same for A-Z as for a-z. Further ones are mixed.
VALUES = constants(1 << 16, 17)
VALUES[: len(SPACE)][SPACE] = 0
VALUES[65:91] = VALUES[97:123]
#: A factor for each place in a word; no word is longer than `LONG`.
PLACES = constants(LONG + 1, 19) | np.uint64(1)
#: Bases of the rolling hashes, odd.
BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
#: So many powers of a base are kept by a task; those of longer texts are computed where they are needed.
POWERS = 1 << 14
#: A sentence ends before white space that follows a mark, holds a line end, or comes before a capital. The pattern
#: begins with the white space itself, so that the search passes over all other characters at once.
BOUNDARY = re.compile(
    r"""\s(?:(?<=[.!?]\s)\s*|(?<=[.!?]["')\]]\s)\s*|(?<=\n)\s*|[^\S\n]*\n\s*|\s*(?=[^\W\d_a-zß-öø-ÿ]))"""
)


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text, in code points, without the white space around them."""
    found, at = [], 0
    for m in BOUNDARY.finditer(text):
        if m.start() > at:
            found.append((at, m.start()))
        at = m.end()
    if at < len(text):
        found.append((at, len(text)))
    return found


def spans(text: str, cuts: list[tuple[int, int]] | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(first sentence, one past the last, normalised bytes) of every span. A-Z and white space are made alike."""
    split = [text[s:e].split() for s, e in (sentences(text) if cuts is None else cuts)]
    parts = [" ".join(words).encode().lower() for words in split]
    words = [len(s) for s in split]
    starts, at = [], 0
    for p in parts:
        starts.append(at)
        at += len(p) + 1
    whole, end, held = b" ".join(parts), 0, 0
    for first in range(len(parts)):
        if end <= first:
            end, held = first, 0
        while end < len(parts) and not (held >= WORDS and (end - first >= SENTENCES or held >= ALONE)):
            held += words[end]
            end += 1
        if held < WORDS or (end - first < SENTENCES and held < ALONE):
            return
        yield first, end, whole[starts[first] : starts[end - 1] + len(parts[end - 1])]
        held -= words[first]


def _codes(text: str, cuts: list[tuple[int, int]] | None = None) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """96-bit code -> the (first, end) of its spans in this text, in order. `cuts` are its sentences, if known."""
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for first, end, data in spans(text, cuts):
        code = xxhash.xxh3_128_intdigest(data)
        found.setdefault((code & (1 << 64) - 1, code >> 96), []).append((first, end))
    return found


def units(text: str) -> list[tuple[int, int]]:
    """(start, end) of the words of a text; where it has no spaces, of its characters."""
    found: list[tuple[int, int]] = []
    for m in UNIT.finditer(text):
        start, end = m.span()
        found += [(start, end)] if end - start <= LONG else [(i, i + 1) for i in range(start, end)]
    return found


def _points(text: str) -> np.ndarray:
    """The code points of a text."""
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _entries(table: np.ndarray, points: np.ndarray) -> np.ndarray:
    """A table's entries for code points; all beyond it have its last one."""
    return table[points if points.dtype == np.uint8 else np.minimum(points, len(table) - 1)]


def unit_starts(text: str, points: np.ndarray | None = None) -> np.ndarray:
    """Where the units of a text start. Words between white space need no list of their places."""
    if not text.isascii() and SOME_UNSPACED.search(text):
        return np.array([start for start, _ in units(text)], np.int64)
    points = _points(text) if points is None else points
    edge = np.diff(np.concatenate(([True], _entries(SPACE, points), [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(start) and (end - start).max() > LONG:
        return np.array([start for start, _ in units(text)], np.int64)
    return start


def unit_codes(text: str) -> np.ndarray:
    """A 64-bit hash of each unit, A-Z made alike: its characters' values by their places, all units of a text at once."""
    points = _points(text)
    start = unit_starts(text, points)
    if not len(start):
        return np.empty(0, np.uint64)
    points, start = points[start[0] :], start - start[0]
    values = _entries(VALUES, points)
    if points.dtype != np.uint8 and points.max() >= len(VALUES) - 1:
        far = points >= len(VALUES) - 1
        values[far] = mix(points[far].astype(np.uint64))
    # White space behind a unit counts as part of it and adds nothing.
    place = np.arange(len(points)) - np.repeat(start, np.diff(start, append=len(points)))
    return mix(np.add.reduceat(values * PLACES[np.minimum(place, LONG)], start))


@cache
def _first_powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd base and of its inverse, from the first on; they wrap."""
    forth, back = (np.cumprod(np.full(POWERS, b, np.uint64)) for b in (base, pow(base, -1, 1 << 64)))
    return forth, back


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n powers of an odd base and of its inverse; texts of up to `POWERS` words share theirs."""
    if n <= POWERS:
        return tuple(p[:n] for p in _first_powers(base))
    return tuple(np.cumprod(np.full(n, b, np.uint64)) for b in (base, pow(base, -1, 1 << 64)))


def rolled(codes: np.ndarray, width: int, base: int) -> np.ndarray:
    """A hash of every `width` neighbouring units. Sums and products wrap, and an odd base has an inverse."""
    n = len(codes)
    if n < width:
        return np.empty(0, np.uint64)
    forth, back = powers(base, n)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * forth)))
    return mix((total[width:] - total[:-width]) * back[: n - width + 1])


def smallest(codes: np.ndarray) -> np.ndarray:
    """For each run of `RUN` units the smallest hash of its groups of `GROUP` units."""
    least, width, wanted = rolled(codes, GROUP, BASES[0]), 1, RUN - GROUP + 1
    if len(least) < wanted:
        return np.empty(0, np.uint64)
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def blocks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Smallest hash, first run, one past the last run, and 64-bit content hash of each block of runs."""
    least = smallest(codes)
    if not len(least):
        return least, *(np.empty(0, np.int64) for _ in range(2)), least
    begin = np.concatenate((np.zeros(1, np.int64), np.flatnonzero(least[1:] != least[:-1]) + 1))
    end = np.concatenate((begin[1:], np.array([len(least)])))
    # A block's hash is over all its runs: where a text repeats itself there may be many, with others between.
    every = rolled(mix(codes), RUN, BASES[1])
    forth, back = powers(BASES[0], len(every))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(every * forth)))
    return least[begin], begin, end, mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))


def _own_blocks(codes: np.ndarray) -> dict[tuple[int, int], bool]:
    """(smallest hash, content hash) of a text's blocks, and whether the smallest hash is that of runs that don't overlap."""
    first: dict[int, int] = {}
    own: dict[tuple[int, int], bool] = {}
    for code, low, high, block in zip(*(x.tolist() for x in blocks(codes)), strict=True):
        own[code, block] = own.get((code, block), False) or high - 1 - first.setdefault(code, low) >= RUN
    return own


def runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes and 32-bit checks of all runs, by their first unit."""
    return rolled(codes, RUN, BASES[0]), (rolled(mix(codes), RUN, BASES[1]) >> np.uint64(32)).astype(np.uint32)


def _within(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Of n runs, which are in one of the blocks."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


def _run_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct runs of the wanted blocks of each text."""
    for batch in batches:
        kind = batch.column("doc_id").type
        for doc_id, text, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("wanted"), strict=True):
            codes = unit_codes(text.as_py() or "")
            _, begin, end, block = blocks(codes)
            code, check = runs(codes)
            these = np.isin(block, wanted.values.to_numpy(zero_copy_only=False).view(np.uint64))
            code, at = np.unique(np.where(_within(begin[these], end[these], len(code)), code, 0), return_index=True)
            code, check = code[code != 0], check[at[code != 0]]
            columns = [pa.array([doc_id] * len(code), kind), pa.array(code.view(np.int64)), pa.array(check.view(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "code", "check"])


def _span_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:

    def batch_of(ids: list, codes: list, again: list, block: list, kind: pa.DataType) -> pa.RecordBatch:
        low, high = zip(*codes, strict=True)
        columns = [
            pa.array(ids, kind),
            pa.array(np.array(low, np.uint64).view(np.int64)),
            pa.array(np.array(high, np.uint32).view(np.int32)),
            pa.array(again, pa.bool_()),
            pa.array(block, pa.uint64()).view(pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "code", "check", "again", "block"])

    for batch in batches:
        kind, ids, codes, again, block = batch.column("doc_id").type, [], [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            text = text.as_py() or ""
            own, more = _codes(text), _own_blocks(unit_codes(text))
            ids += [doc_id] * (len(own) + len(more))
            codes += [*own, *((code, 0) for code, _ in more)]
            again += [*(bool(_further(places)) for places in own.values()), *more.values()]
            block += [*[None] * len(own), *(b for _, b in more)]
            if len(ids) > 100_000:
                yield batch_of(ids, codes, again, block, kind)
                ids, codes, again, block = [], [], [], []
        if ids:
            yield batch_of(ids, codes, again, block, kind)


def _further(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The places of a span in one text after its first, as far as they don't overlap that."""
    return [p for p in places[1:] if p[0] >= places[0][1]]


def _elsewhere(found: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `found` whose keys a document with a smaller id has as well."""
    first = found.groupBy(*keys).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    first = first.where("first_id < last_id").select(*keys, "first_id")
    return found.join(first, keys).where("doc_id > first_id").drop("first_id")


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, code, check, kind) of what is repeated: spans, blocks and runs that a document with a smaller id has as well.

    Kinds `span again` and `run again` say that a text may have something again. Spans, blocks and runs are computed once and stored.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = stored(rows.mapInArrow(_span_batches, f"doc_id {kind}, code long, check int, again boolean, block long"), "spans")
    of_spans = found.where("block IS NULL").select("doc_id", "code", "check")
    of_blocks = found.where("block IS NOT NULL").select("doc_id", "code", "block")
    common = of_blocks.groupBy("code").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("code")
    shared = stored(of_blocks.join(common, "code"), "blocks")
    holders = shared.groupBy("code", "block").agg(F.min("doc_id").alias("of_id"))
    several = holders.groupBy("code").agg(F.count("*").alias("n")).where("n > 1").select("code")
    wanted = holders.join(several, "code").groupBy("of_id").agg(F.collect_set("block").alias("wanted"))
    texts = rows.join(wanted, rows.doc_id == wanted.of_id).select("doc_id", "text", "wanted")
    of_runs = stored(texts.mapInArrow(_run_batches, f"doc_id {kind}, code long, check int"), "runs")

    def marks(df: DataFrame, name: str) -> DataFrame:
        return df.select("doc_id", "code", "check", F.lit(name).alias("kind"))

    out = marks(_elsewhere(of_spans, ["code", "check"]), "span").unionByName(marks(_elsewhere(of_runs, ["code", "check"]), "run"))
    whole = _elsewhere(shared, ["code", "block"]).select("doc_id", F.col("block").alias("code"), F.lit(0).alias("check"))
    out = out.unionByName(marks(whole, "block")).unionByName(marks(found.where("again AND block IS NULL"), "span again"))
    return out.unionByName(marks(found.where("again AND block IS NOT NULL"), "run again"))


def _marks(repeated: pa.ListArray) -> Iterator[dict[str, list[tuple[int, int]]]]:
    """For each row the codes and checks of what is repeated, by kind. A null row has none."""
    code, check, kind = repeated.values.flatten()
    code, check, kind = code.to_numpy().tolist(), check.to_numpy().tolist(), kind.dictionary_encode()
    names = kind.dictionary.to_pylist()
    kinds, ends = kind.indices.to_numpy().tolist(), repeated.offsets.to_numpy().tolist()
    for start, end in zip(ends[:-1], ends[1:], strict=True):
        found: dict[str, list[tuple[int, int]]] = {}
        for i in range(start, end):
            found.setdefault(names[kinds[i]], []).append((code[i], check[i]))
        yield found


def _clean_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for text, marks in zip(batch.column("text"), _marks(batch.column("repeated")), strict=True):
            text = text.as_py()
            row = (0, 0, "", text)
            if marks:
                codes = lambda kind: [c for c, _ in marks.get(kind, ())]  # noqa: B023, E731
                held = (codes("block"), codes("run")) if marks.keys() & {"block", "run", "run again"} else None
                row = cleaned(text, set(marks.get("span", ())) if marks.keys() & {"span", "span again"} else None, held)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))]
        names = ["doc_id", "n_removed", "n_removed_words", "removed_spans", "text"]
        yield pa.RecordBatch.from_arrays(columns, names)


def run_stretches(text: str, of_blocks: list[int], of_runs: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the runs of a text that are repeated elsewhere or that it had before, joined where they touch."""
    codes = unit_codes(text)
    code = rolled(codes, RUN, BASES[0])
    if not len(code):
        return []
    _, first, of = np.unique(code, return_index=True, return_inverse=True)
    again = np.arange(len(code)) - first[of] >= RUN
    among = lambda x, held: np.isin(x, np.array(held, np.int64).view(np.uint64))
    _, begin, end, block = blocks(codes)
    these = among(block, of_blocks)
    gone = again | among(code, of_runs) | _within(begin[these], end[these], len(code))
    if not gone.any():
        return []
    places, out = unit_starts(text).tolist(), []
    for at in np.flatnonzero(gone).tolist():
        if out and at <= out[-1][1]:
            out[-1][1] = at + RUN
        else:
            out.append([at, at + RUN])
    return [(places[a], places[b] if b < len(places) else len(text)) for a, b in out]


def cleaned(
    text: str | None, elsewhere: set[tuple[int, int]] | None, held: tuple[list[int], list[int]] | None
) -> tuple[int, int, str, str | None]:
    """Sentences that lose words, removed words, removed stretches as start:end, and what stays of the text.

    `elsewhere` are the spans and `held` the blocks and runs that another document keeps; None if no span, or run, can be
    repeated.
    """
    if not text:
        return 0, 0, "", text
    cuts, gone = sentences(text), set()
    for (low, high), places in (_codes(text, cuts) if elsewhere is not None else {}).items():
        signed = (low - (1 << 64) if low >> 63 else low, high - (1 << 32) if high >> 31 else high)
        for first, end in places if signed in elsewhere else _further(places):
            gone.update(range(first, end))
    found = [(cuts[i][0], cuts[i + 1][0] if i + 1 < len(cuts) else len(text)) for i in gone]
    found += run_stretches(text, *held) if held is not None else []
    if not found:
        return 0, 0, "", text
    stretches: list[list[int]] = []
    for start, end in sorted(found):
        if stretches and stretches[-1][1] >= start:
            stretches[-1][1] = max(end, stretches[-1][1])
        else:
            stretches.append([start, end])
    kept, at = [], 0
    for start, end in stretches:
        kept.append(text[at:start])
        at = end
    words = sum(len(text[s:e].split()) for s, e in stretches)
    # Sentences and stretches are in order and neither overlap: a sentence is touched if the first stretch that ends
    # behind its start begins before its end.
    touched, i = 0, 0
    for start, end in cuts:
        while i < len(stretches) and stretches[i][1] <= start:
            i += 1
        touched += i < len(stretches) and stretches[i][0] < end
    return touched, words, ",".join(f"{s}:{e}" for s, e in stretches), "".join([*kept, text[at:]])


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_removed (sentences that lose words), n_removed_words, removed_spans, text (what stays)."""
    found = repeated_spans(docs, id_col=id_col, text_col=text_col)
    each = found.groupBy(F.col("doc_id").alias("of_id")).agg(F.collect_list(F.struct("code", "check", "kind")).alias("repeated"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = rows.join(each, rows.doc_id == each.of_id, "left").select("doc_id", "text", "repeated")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_removed long, n_removed_words long, removed_spans string, text string"
    return both.mapInArrow(_clean_batches, schema)
