"""Vectors compressed to codes of their parts, with codebooks from Lloyd's rounds over active entries.

Every vector is cut into equal parts, and each part is replaced by the index of an entry in its position's codebook.
A round assigns all parts and moves every entry to the floor of the mean of its parts.

Only entries that moved are active. A part whose entry stayed where it was still has its stored distance, exact as it
is a whole number, and no entry at rest can have become nearer: it is compared with the active entries alone. A part
whose entry moved is compared with the whole codebook. Equal distances go to the lower index in both cases.

Vectors travel in blocks of up to BLOCK rows, as whole numbers of the least width that holds them, with the codes and
distances of the round before. A round is one pass without a shuffle that writes the blocks anew, together with the
sums of their parts by entry; the sums alone, `parts * entries` of them for each block, are then added up. The driver
holds the codebooks, whose size is set by parameters, and nothing that grows with the table.

Cases: rows whose vector is null or holds null or non-finite components are dropped, as are vectors of another length
than most have, or of one that doesn't divide into parts; rows without an id are coded but never begin a codebook, and
of rows with one id the lesser vectors come first; fewer rows than entries make shorter codebooks; labels may be null;
an empty table gives an empty result. Components beyond 2^27 are refused, since their distances do not fit. Only id,
vector and label are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolmetrics.llm.common import stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors in a block.
BLOCK = 4096
#: Components of this size or more are refused.
LARGEST = 1 << 27


def whole_parts(table: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, parts: int) -> DataFrame:
    """vec_id, label and vector (whole numbers) of the rows that are coded, all of one length."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), x.alias("x")).where(fine)
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    usual = lengths.where((F.col("length") > 0) & (F.col("length") % parts == 0))
    most = usual.orderBy(F.desc("n"), F.desc("length")).first()
    refused = F.raise_error(F.lit(f"components of {LARGEST // scale} or more are not supported"))
    small = F.forall("x", lambda v: F.abs(v) < LARGEST / scale)
    whole = F.transform("x", lambda v: F.floor(v * scale).cast("long"))
    chosen = rows.where(F.size("x") == F.lit(most["length"] if most else -1))
    return chosen.select("vec_id", "label", F.when(small, whole).otherwise(refused).alias("vector"))


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, in the least width that holds them all; the width follows from the length."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return values.astype(kind).tobytes()


def widen(data: bytes, n: int, columns: int) -> np.ndarray:
    """n rows of whole numbers from `narrow`."""
    width = len(data) // (n * columns)
    return np.frombuffer(data, f"<i{width}").reshape(n, columns).astype(np.int64)


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x from every entry, one component at a time."""
    total = np.zeros((len(x), len(book)), np.int64)
    for j in range(x.shape[1]):
        step = x[:, j, None] - book[None, :, j]
        total += step * step
    return total


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and distance of the nearest entry; the lower index where several are as near."""
    d = distances(x, book)
    code = d.argmin(axis=1)
    return code, d[np.arange(len(x)), code]


def reassign(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What `nearest` gives, from the assignment before the entries named in `moved` moved."""
    code, distance = code.copy(), distance.copy()
    left = moved[code]
    rescanned, resting, active = np.flatnonzero(left), np.flatnonzero(~left), np.flatnonzero(moved)
    if len(rescanned):
        code[rescanned], distance[rescanned] = nearest(x[rescanned], book)
    if len(active) and len(resting):
        place, near = nearest(x[resting], book[active])
        new, old, known = active[place], code[resting], distance[resting]
        closer = (near < known) | ((near == known) & (new < old))
        code[resting], distance[resting] = np.where(closer, new, old), np.where(closer, near, known)
    return code, distance


def sums_by_entry(x: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """For each entry the number of its parts and the sum of their components."""
    out = np.zeros((entries, x.shape[1] + 1), np.int64)
    out[:, 0] = np.bincount(code, minlength=entries)
    for j in range(x.shape[1]):
        # Blocks and components are small enough for sums in floating point to be exact.
        out[:, j + 1] = np.bincount(code, weights=x[:, j], minlength=entries).astype(np.int64)
    return out


def _assigned(vectors: np.ndarray, books: np.ndarray, moved: np.ndarray | None, codes, known):
    """Codes and distances of all parts of a block."""
    n, (parts, _, width) = len(vectors), books.shape
    new_codes, new_known = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
    for p in range(parts):
        x = vectors[:, p * width : (p + 1) * width]
        if moved is None:
            new_codes[:, p], new_known[:, p] = nearest(x, books[p])
        else:
            new_codes[:, p], new_known[:, p] = reassign(x, books[p], moved[p], codes[:, p], known[:, p])
    return new_codes, new_known


def _block(ids: pa.Array, labels: pa.Array, vectors: np.ndarray, codes: np.ndarray, known: np.ndarray, books: np.ndarray):
    entries, width = books.shape[1:]
    sums = [sums_by_entry(vectors[:, p * width : (p + 1) * width], codes[:, p], entries) for p in range(len(books))]
    one = [0, len(vectors)]
    columns = [
        pa.ListArray.from_arrays(one, ids),
        pa.ListArray.from_arrays(one, labels),
        pa.array([narrow(vectors)], pa.binary()),
        pa.array([codes.astype(np.uint8).tobytes()], pa.binary()),
        pa.array([narrow(known)], pa.binary()),
        pa.array([np.concatenate([s.ravel() for s in sums])], pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["ids", "labels", "vectors", "codes", "known", "sums"])


def _opened(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple]:
    """Ids, labels, vectors, codes and distances of every block of a batch."""
    parts, width = books.shape[0], books.shape[2]
    for i in range(batch.num_rows):
        row = batch.slice(i, 1)
        ids, labels = row.column("ids").flatten(), row.column("labels").flatten()
        vectors, codes, known = (row.column(c)[0].as_py() for c in ("vectors", "codes", "known"))
        n = len(ids)
        old = np.frombuffer(codes, np.uint8).reshape(n, parts).astype(np.int64)
        yield ids, labels, widen(vectors, n, parts * width), old, widen(known, n, parts)


def _first_round(books: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                vectors = flat.reshape(part.num_rows, -1)
                codes, known = _assigned(vectors, books, None, None, None)
                yield _block(part.column("vec_id"), part.column("label"), vectors, codes, known, books)

    return run


def _next_round(books: np.ndarray, moved: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, vectors, codes, known in _opened(batch, books):
                codes, known = _assigned(vectors, books, moved, codes, known)
                yield _block(ids, labels, vectors, codes, known, books)

    return run


def _last_round(books: np.ndarray, moved: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = 2 * len(books)
        for batch in batches:
            for ids, labels, vectors, codes, known in _opened(batch, books):
                codes, known = _assigned(vectors, books, moved, codes, known)
                text = codes.astype(np.uint8).tobytes().hex()
                names = pa.array([text[k : k + digits] for k in range(0, len(text), digits)], pa.string())
                columns = [ids, labels, names, pa.array(known.sum(axis=1), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return run


def _moved_books(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every used entry at the floor of the mean of its parts: one sum for each component of each entry."""
    summed = blocks.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    totals = {r["at"]: r["value"] for r in summed.collect()}
    parts, entries, width = books.shape
    new = books.copy()
    for p in range(parts):
        for e in range(entries):
            at = (p * entries + e) * (width + 1)
            if count := totals.get(at, 0):
                new[p, e] = [totals[at + 1 + j] // count for j in range(width)]
    return new


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def lloyd_codes(
    table: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every coded vector, and the codebooks by part, entry and position."""
    if not 0 < entries <= 256 or rounds < 1:
        raise ValueError("two hex digits hold 1 to 256 entries, which need a round at least")
    rows = whole_parts(table, id_col, vector_col, label_col, scale, parts)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    coded = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    first = rows.where(F.col("vec_id").isNotNull()).orderBy("vec_id", "vector").limit(entries).collect()
    if not first:
        return table.sparkSession.createDataFrame([], coded), np.empty((parts, 0, 0), np.int64)
    start = np.array([r["vector"] for r in first], np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, -1).transpose(1, 0, 2))

    kept = (
        f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, "
        "vectors binary, codes binary, known binary, sums array<long>"
    )
    blocks = stored(rows.mapInArrow(_first_round(books), kept), "blocks")
    for _ in range(1, rounds):
        new = _moved_books(blocks, books)
        moved = (new != books).any(axis=2)
        blocks = stored(blocks.drop("sums").mapInArrow(_next_round(new, moved), kept), "blocks")
        books = new
    new = _moved_books(blocks, books)
    moved = (new != books).any(axis=2)
    return blocks.drop("sums").mapInArrow(_last_round(new, moved), coded), new


def vector_codes(table: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error (of all rows with the label, those without one together), codebooks_sha256."""
    coded, books = lloyd_codes(table, **options)
    coded = stored(coded, "codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, coded["label"].eqNullSafe(by_label["of_label"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
