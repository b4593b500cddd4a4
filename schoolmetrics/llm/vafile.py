"""Exact top-k search by inner product with a vector-approximation file.

Vectors are whole numbers, floor(256 x) of each component. They are kept in blocks, cells and exact vectors in
columns of their own: a cell is four bits for each component, between the block's lowest and highest value of it.

1. Cells. Every block of queries meets every block of cells. From the ends of its cells a vector's product with a query
   has a lower and an upper bound; both are matrix products. The k largest lower bounds of a query over all blocks give
   the least value its kth result can have, and each block reports how far its best upper bound reaches.
2. Exact vectors. Only blocks that reach that value are read. In a block the vectors are read in the order of their upper
   bounds, best first, until the next bound falls below the kth best product found, or the least value of step 1.
3. The k best of the blocks' results are the answer, equal products by smaller id.

Queries are a stated set (ids divisible by `every`). They meet blocks by an equi-join on block names, so neither side is broadcast and
no pairs of rows are made.

Cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without an id; vectors
of another length than the query's are no candidates; rows with the query's id are its own (the
least vector asks if they differ); a repeated row is a candidate twice, under the same id; fewer than k candidates give fewer rows; an empty table gives none. Components beyond 2^31 are
refused. Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from schoolmetrics.llm.common import stored

K = 5
EVERY = 50
SCALE = 256
BITS = 4
#: Vectors in a block, and queries in a block.
BLOCK, QUERIES = 4096, 512
#: Parts over which the pairing of block names is spread.
SPREAD = 64
#: Products up to here are exact in floating point, which multiplies matrices much faster.
EXACT = 2**53


def whole_vectors(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, vector (whole numbers) and dim of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), fine.alias("fine"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("fine") & (F.size("x") > 0))
    whole = F.transform("x", lambda v: F.floor(v * scale))
    refused = F.raise_error(F.lit("components beyond 2^31 are not supported"))
    small = F.forall(whole, lambda v: F.abs(v) < 2**31)
    return rows.select("vec_id", F.when(small, whole).otherwise(refused).alias("vector"), F.size("x").alias("dim"))


def _blocks(rows: list[tuple[int, list[int]]], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(rows), size):
        part = rows[at : at + size]
        yield np.array([r[0] for r in part], np.int64), np.array([r[1] for r in part], np.int64)


def _pack_batches(batches: Iterable[pa.RecordBatch], size: int, with_cells: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of equal dimension: first id as part of the name, ids, vectors, and cells with the ends they lie between."""
    for batch in batches:
        by_dim: dict[int, list] = {}
        for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist(), strict=True):
            by_dim.setdefault(len(vector), []).append((vec_id, vector))
        out: list[tuple] = []
        for dim, rows in by_dim.items():
            for ids, vectors in _blocks(rows, size):
                row = (dim, len(ids), ids.astype("<i8").tobytes(), vectors.astype("<i8").tobytes())
                if with_cells:
                    low, step, cells = approximate(vectors)
                    row += (low.astype("<i8").tobytes(), step.astype("<i8").tobytes(), pack_cells(cells))
                out.append(row)
        names = ["dim", "n", "ids", "vectors"] + (["low", "step", "cells"] if with_cells else [])
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * (len(names) - 2)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)


def approximate(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowest value and cell width of each component, and the cell of each value."""
    low = vectors.min(axis=0)
    step = (vectors.max(axis=0) - low) // (1 << BITS) + 1
    return low, step, ((vectors - low) // step).astype(np.uint8)


def pack_cells(cells: np.ndarray) -> bytes:
    """Two cells in a byte."""
    flat = cells.ravel()
    if len(flat) % 2:
        flat = np.append(flat, np.uint8(0))
    return (flat[::2] << 4 | flat[1::2]).astype(np.uint8).tobytes()


def unpack_cells(data: bytes, n: int, dim: int) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8)
    return np.stack((flat >> 4, flat & 15), axis=1).ravel()[: n * dim].reshape(n, dim)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    if exact.size and max(abs(int(x)) for x in exact.ravel()) >= 2**63:
        raise OverflowError("a product does not fit 64 bits")
    return exact.astype(np.int64)


def bounds(queries: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the products of queries with the vectors in the cells."""
    least = low + cells.astype(np.int64) * step
    most = least + step - 1
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return product(up, least) + product(down, most), product(up, most) + product(down, least)


def _array(data: bytes, dim: int | None = None) -> np.ndarray:
    flat = np.frombuffer(data, "<i8")
    return flat if dim is None else flat.reshape(-1, dim)


def _scan_batches(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """For every query of a pair of blocks: its k largest lower bounds and its largest upper bound there."""
    for batch in batches:
        for row in batch.to_pylist():
            q_ids, queries, ids = _array(row["q_ids"]), _array(row["q_vectors"], row["dim"]), _array(row["ids"])
            cells = unpack_cells(row["cells"], row["n"], row["dim"])
            lower, upper = bounds(queries, _array(row["low"]), _array(row["step"]), cells)
            none = np.iinfo(np.int64).min
            own = q_ids[:, None] == ids[None, :]
            lower[own], upper[own] = none, none
            take = min(k, lower.shape[1])
            best = -np.partition(-np.maximum(lower, none + 1), take - 1, axis=1)[:, :take]
            columns = [
                pa.array(q_ids, pa.int64()),
                pa.array([row["block"]] * len(q_ids), pa.int64()),
                pa.array(list(best), pa.list_(pa.int64())),
                pa.array(upper.max(axis=1), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "block", "lower", "reach"])


def read_in_order(query: np.ndarray, upper: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
    """(product, id) of the k best, exact vectors read best bound first until no further one can matter."""
    best: list[tuple[int, int]] = []
    order = np.argsort(-upper, kind="stable")
    for at in range(0, len(order), 64):
        part = order[at : at + 64]
        floor = max(least, best[k - 1][0]) if len(best) >= k else least
        part = part[upper[part] >= floor]
        if not len(part):
            break
        found = product(query[None, :], vectors[part])[0]
        best = sorted([*best, *zip(found.tolist(), ids[part].tolist(), strict=True)], key=lambda r: (-r[0], r[1]))[:k]
    return best


def _read_batches(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """One row for each block and query block, with the queries that reach into the block."""
    for batch in batches:
        out: list[tuple[int, int, int]] = []
        for row in batch.to_pylist():
            wanted = {w["query_id"]: w["least"] for w in row["wanted"]}
            q_ids, queries, ids = _array(row["q_ids"]), _array(row["q_vectors"], row["dim"]), _array(row["ids"])
            asked = np.flatnonzero(np.isin(q_ids, list(wanted)))
            cells = unpack_cells(row["cells"], row["n"], row["dim"])
            _, upper = bounds(queries[asked], _array(row["low"]), _array(row["step"]), cells)
            vectors = _array(row["vectors"], row["dim"])
            for i, bound in zip(asked, upper, strict=True):
                other = ids != q_ids[i]
                best = read_in_order(queries[i], bound[other], ids[other], vectors[other], k, wanted[int(q_ids[i])])
                out += [(int(q_ids[i]), vec_id, score) for score, vec_id in best]
        arrays = [pa.array([r[i] for r in out], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])


def top_k(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every row whose id is divisible by `every`."""
    vectors = whole_vectors(table, id_col=id_col, vector_col=vector_col)
    base = "dim int, n int, ids binary, vectors binary"

    def pack_all(batches):
        return _pack_batches(batches, BLOCK, True)

    def pack_queries(batches):
        return _pack_batches(batches, QUERIES, False)

    numbered = F.monotonically_increasing_id()
    blocks = stored(
        vectors.mapInArrow(pack_all, base + ", low binary, step binary, cells binary").withColumn("block", numbered),
        "va-file",
    )
    asked = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = asked.withColumn("dim", F.size("vector"))
    asked = asked.repartition(max(1, -(-asked.count() // QUERIES)), "vec_id")
    queries = stored(asked.mapInArrow(pack_queries, base).withColumn("q_block", numbered), "queries")
    queries = queries.select("q_block", F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))

    names = queries.select("q_block", F.col("q_dim").alias("dim"))
    cells = blocks.select("block", "dim", "n", "ids", "low", "step", "cells")
    # A row for each block and query block of its dimension: names only, the vectors are joined to it.
    spread = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    meets = blocks.select("block", "dim", F.pmod(F.xxhash64("block"), F.lit(SPREAD)).cast("int").alias("slot"))
    meets = meets.join(names.withColumn("slot", spread), ["dim", "slot"]).select("block", "q_block")
    scanned = stored(
        cells.join(meets, "block")
        .join(queries, "q_block")
        .mapInArrow(lambda b: _scan_batches(b, k), "query_id long, block long, lower array<long>, reach long"),
        "bounds",
    )
    bound = scanned.select("query_id", F.explode("lower").alias("lower"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("lower"))
    least = bound.withColumn("place", F.row_number().over(by_query)).where(F.col("place") == k)
    least = least.select("query_id", F.col("lower").alias("least"))
    none = F.lit(int(np.iinfo(np.int64).min))
    reaching = scanned.select("query_id", "block", "reach").join(least, "query_id", "left")
    reaching = reaching.withColumn("least", F.coalesce("least", none)).where(F.col("reach") >= F.col("least"))
    in_block = stored(_query_homes(queries), "homes")
    wanted = reaching.join(in_block, "query_id").groupBy("block", "q_block")
    wanted = wanted.agg(F.collect_list(F.struct("query_id", "least")).alias("wanted"))  # at most QUERIES
    found = (
        blocks.join(wanted, "block")
        .join(queries, "q_block")
        .mapInArrow(lambda b: _read_batches(b, k), "query_id long, vec_id long, score long")
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", place.cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _query_homes(queries: DataFrame) -> DataFrame:
    """(query_id, q_block)."""

    def homes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _array(row["q_ids"])
                columns = [pa.array(ids, pa.int64()), pa.array([row["q_block"]] * len(ids), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "q_block"])

    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("q_block", T.LongType())])
    return queries.select("q_block", "q_ids").mapInArrow(homes, schema)
