"""The trie of conversation prefixes: shared turns, and what storing them once saves.

1. Turns. Each conversation becomes a path, a 128-bit digest and the text's bytes of every turn. `rebuilt` replaces a
   conversation's first turns by those of another, by an equi-join on that conversation and the place.
2. Shards. Paths are range-partitioned and sorted by path, then conversation, so a shard is a stretch of the trie's
   leaves in order, and copies of one conversation may fill several shards.
3. In a shard the trie is a sequence of balanced parentheses, opened and closed as paths part. Its excess is kept with
   the minima of blocks, in a tree of minima above them. `findclose` (the next place where the excess falls below that
   of an opening) delimits each subtree; the rank of leaf pairs "()" counts its leaves, and cumulative arrays over the
   openings give what it saves: members times bytes, less the bytes of every node once.
4. Spines. Only prefixes of a shard's first and last path can occur in other shards. These partial nodes are merged by
   the digest of their path. All that is added up is disjoint: conversations by nature; a node's bytes count in the
   first shard that has it, and a leaf in the last. One row for each shard tells it where its neighbours' paths part.

Ids that end at a node are hashed where they lie; those of a spine are hashed chunk by chunk in order of shards, so no
list of them is ever held whole.

Cases: null roles and texts are empty; turns are ordered by their number (null first), equal numbers by digest; rows
without a conversation take no part, a conversation without any turn left is a member of the root; a repeated row is a turn of
its own; an empty table gives an empty result. A conversation's path (16 bytes a turn) must fit a row. Only id, turn,
role and text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from schoolmetrics.llm.common import stored
from schoolmetrics.sources.scratch import durable

#: Conversations are rebuilt in families of so many ids, with fewer than SHARED turns of the family's first.
FAMILY, SHARED = 5, 9
#: Parentheses in a block of the excess.
SPAN = 64
#: Turns for each shard.
PER_SHARD = 100_000
DIGEST = 16

NODE = (
    "shard long, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved long, ends binary, ends_sha256 string"
)


class Parentheses:
    """A balanced sequence with range min-max blocks over its excess."""

    def __init__(self, opens: np.ndarray) -> None:
        """`opens` is True for an opening and False for a closing."""
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = max(1, -(-len(opens) // SPAN))
        padded = np.full(blocks * SPAN, np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        self.blocks = padded.reshape(blocks, SPAN)
        # levels[k][i] is the least excess of 2^k blocks, from block i * 2^k on.
        self.levels = [self.blocks.min(axis=1)]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            if len(below) % 2:
                below = np.append(below, np.iinfo(np.int64).max)
            self.levels.append(below.reshape(-1, 2).min(axis=1))

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """For each opening the place of its closing, where the excess first falls below the opening's."""
        out = np.empty(len(at), np.int64)
        for start in range(0, len(at), 1 << 14):
            out[start : start + (1 << 14)] = self._close(at[start : start + (1 << 14)])
        return out

    def _close(self, at: np.ndarray) -> np.ndarray:
        target = self.excess[at] - 1
        block = at // SPAN
        here = (self.blocks[block] <= target[:, None]) & (np.arange(SPAN) > (at % SPAN)[:, None])
        found = here.any(axis=1)
        out = np.where(found, block * SPAN + here.argmax(axis=1), -1)
        away = np.flatnonzero(~found)
        if len(away):
            block = self._next_block(block[away], target[away])
            out[away] = block * SPAN + (self.blocks[block] <= target[away, None]).argmax(axis=1)
        return out

    def _next_block(self, block: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first later block whose minimum reaches the target: up the tree to the right, then down to the left."""
        node, level = block.copy(), np.zeros(len(block), np.int64)
        climbing = np.ones(len(block), bool)
        for k, minima in enumerate(self.levels):
            up = np.flatnonzero(climbing)
            beside = node[up] + 1
            right = (node[up] % 2 == 0) & (beside < len(minima))
            reached = right & (minima[np.minimum(beside, len(minima) - 1)] <= target[up])
            node[up] = np.where(reached, beside, node[up] // 2)
            level[up[reached]] = k
            climbing[up[reached]] = False
        for k in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(level == k)
            left = node[down] * 2
            node[down] = np.where(self.levels[k - 1][left] <= target[down], left, left + 1)
            level[down] = k - 1
        return node

    def leaf_rank(self, counted: np.ndarray) -> np.ndarray:
        """How many counted leaf pairs begin before each place."""
        pair = self.opens & np.append(~self.opens[1:], False)
        return np.concatenate(([0], np.cumsum(pair & counted)))


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with alike, by halving."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * DIGEST] == b[: middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


def path_keys(path: bytes, depth: int) -> list[bytes]:
    """A 128-bit digest of every prefix of a path, the empty one first."""
    running = hashlib.blake2b(digest_size=DIGEST)
    keys = [running.digest()]
    for d in range(depth):
        running.update(path[d * DIGEST : (d + 1) * DIGEST])
        keys.append(running.copy().digest())
    return keys


class Shard:
    """The trie of a sorted stretch of conversations, built as they come."""

    def __init__(self, shard: int, before: int, goes_on: bool) -> None:
        """`before`: turns shared with the last path of the shard before, -1 for the first shard.

        `goes_on`: the next shard extends or repeats the last path.
        """
        self.shard, self.before, self.goes_on = shard, before, goes_on
        self.opens: list[bool] = []
        self.at: list[int] = []
        self.depth: list[int] = []
        self.parent: list[int] = []
        self.bytes: list[int] = []
        self.members: list[int] = []
        self.low: list[int] = []
        self.ends: list[list[int]] = []
        self.stack: list[int] = []
        self.first = self.last = b""

    def _open(self, size: int) -> None:
        node = len(self.at)
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.at.append(len(self.opens))
        self.depth.append(len(self.stack))
        self.bytes.append(size)
        self.members.append(0)
        self.low.append(0)
        self.ends.append([])
        self.stack.append(node)
        self.opens.append(True)

    def _close_to(self, depth: int) -> None:
        while len(self.stack) > depth + 1:
            node = self.stack.pop()
            self.opens.append(False)
            parent = self.stack[-1]
            self.members[parent] += self.members[node]
            self.low[parent] = min(self.low[parent], self.low[node]) if self.members[parent] > self.members[node] else self.low[node]

    def add(self, conv_id: int, path: bytes, sizes: list[int]) -> None:
        if not self.at:
            self.first = path
            self._open(0)
        else:
            self._close_to(_shared(self.last, path))
        for size in sizes[len(self.stack) - 1 :]:
            self._open(size)
        node = self.stack[-1]
        self.low[node] = min(self.low[node], conv_id) if self.members[node] else conv_id
        self.members[node] += 1
        self.ends[node].append(conv_id)
        self.last = path

    def rows(self) -> pa.RecordBatch:
        """All nodes: whole ones, and the parts of those on a spine, which have keys."""
        last_spine = list(self.stack)
        self._close_to(0)
        self.opens.append(False)
        n = len(self.at)
        at, depth, parent = np.array(self.at), np.array(self.depth), np.array(self.parent)
        members, sizes = np.array(self.members), np.array(self.bytes)
        tree = Parentheses(np.array(self.opens))
        close = tree.findclose(at)

        # The first path is the leftmost branch: its nodes are numbered as they were opened, root first.
        first_spine = list(range(len(self.first) // DIGEST + 1))
        owned = np.ones(n, bool)
        owned[first_spine[: self.before + 1]] = False
        counted = np.ones(len(self.opens), bool)
        if self.goes_on:
            counted[at[last_spine[-1]]] = False
        leaves = tree.leaf_rank(counted)
        number = np.concatenate(([0], np.cumsum(tree.opens)))
        gained = np.concatenate(([0], np.cumsum(members * sizes - np.where(owned, sizes, 0))))
        children = np.bincount(parent[1:], weights=owned[1:], minlength=n).astype(np.int64)

        on_spine = np.zeros(n, bool)
        keys: list[bytes | None] = [None] * n
        for spine, path in ((first_spine, self.first), (last_spine, self.last)):
            on_spine[spine] = True
            for node, key in zip(spine, path_keys(path, len(spine) - 1), strict=True):
                keys[node] = key
        above = [keys[p] if p >= 0 and on_spine[p] else None for p in self.parent]
        low = np.array(self.low)
        texts = [",".join(map(str, ends)).encode() for ends in self.ends]
        columns = [
            pa.array(np.full(n, self.shard), pa.int64()),
            pa.array(keys, pa.binary()),
            pa.array(above, pa.binary()),
            pa.array(low, pa.int64()),
            pa.array(depth, pa.int64()),
            pa.array(np.where(parent >= 0, low[parent], 0), pa.int64(), mask=(parent < 0) | on_spine[parent]),
            pa.array(members, pa.int64()),
            pa.array(children, pa.int64()),
            pa.array(leaves[close] - leaves[at], pa.int64()),
            pa.array(gained[number[close]] - gained[number[at]], pa.int64()),
            pa.array([t if k is not None else None for t, k in zip(texts, keys, strict=True)], pa.binary()),
            pa.array([None if k is not None else hashlib.sha256(t).hexdigest() for t, k in zip(texts, keys, strict=True)]),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in NODE.split(", ")])


def _shard_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shard, before, goes_on, conv_id, path, sizes in order -> nodes."""
    trie = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("shard", "before", "goes_on", "conv_id", "path", "sizes")]
        for shard, before, goes_on, conv_id, path, sizes in zip(*columns, strict=True):
            if trie is None or trie.shard != shard:
                if trie is not None:
                    yield trie.rows()
                trie = Shard(shard, before, goes_on)
            trie.add(conv_id, path, sizes)
    if trie is not None:
        yield trie.rows()


def _hash_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, ends in order of key and shard -> key, ends_sha256; chunks are hashed as they come."""

    def done(key: bytes, running) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"])

    last, running, any_before = None, None, False
    for batch in batches:
        for key, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if key != last:
                if last is not None:
                    yield done(last, running)
                last, running, any_before = key, hashlib.sha256(), False
            if ends:
                running.update(b"," + ends if any_before else ends)
                any_before = True
    if last is not None:
        yield done(last, running)


def numbered_turns(
    conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """conv_id, place (from 1), digest (hex) and bytes of every turn; texts stay where they are read."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    # The role's length comes first, so that no other role and text give the same bytes.
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"),
        F.octet_length(text).alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), "digest", "size")


def rebuilt(turns: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """Every conversation c with the first h turns of c - c % family in the place of its own; h is crc32(c) % shared.

    conv_id, place, digest, size; one row with place 0 for each conversation besides its turns.
    """
    own_id = F.col("conv_id")
    h = F.crc32(own_id.cast("string").cast("binary")) % shared
    convs = turns.where("place = 1").select("conv_id", h.alias("h"))
    own = turns.where(F.col("place") > h)
    base = turns.where(F.col("place") < shared).withColumnRenamed("conv_id", "base_id")
    heads = convs.withColumn("base_id", own_id - own_id % family).join(base, "base_id").where("place <= h")
    roots = convs.select("conv_id", F.lit(0).alias("place"), F.lit("").alias("digest"), F.lit(0).alias("size"))
    columns = ["conv_id", "place", "digest", "size"]
    return own.select(columns).unionByName(heads.select(columns)).unionByName(roots)


def conversation_paths(turns: DataFrame) -> DataFrame:
    """conv_id, path (the turns' digests end to end) and sizes, from rows with place, digest and size."""
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "size"))).alias("turns"))
    real = F.filter("turns", lambda t: t["place"] > 0)
    path = F.unhex(F.array_join(F.transform(real, lambda t: t["digest"]), ""))
    return listed.select("conv_id", path.alias("path"), F.transform(real, lambda t: t["size"]).alias("sizes"))


def _placed(paths: DataFrame, per_shard: int) -> DataFrame:
    """Paths in shards by (path, conv_id), each with what its neighbours begin with."""
    spark = paths.sparkSession
    turns = paths.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(turns / per_shard))
    order = ["path", "conv_id"]
    placed = durable(
        paths.repartitionByRange(shards, *order).sortWithinPartitions(*order).withColumn("shard", F.spark_partition_id().cast("long"))
    )
    edges = placed.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    along = Window.orderBy("shard")  # one row for each shard
    shared = F.udf(lambda a, b: -1 if a is None or b is None else _shared(bytes(a), bytes(b)), "int")
    edges = edges.select(
        "shard", "first", "last", F.lag("last").over(along).alias("earlier"), F.lead("first").over(along).alias("later")
    )
    goes_on = F.coalesce(F.substring("later", 1, F.length("last")) == F.col("last"), F.lit(False))
    edges = edges.select(F.col("shard").alias("of_shard"), shared("earlier", "first").alias("before"), goes_on.alias("goes_on"))
    return placed.join(F.broadcast(edges), placed["shard"] == edges["of_shard"]).select(
        "shard", "before", "goes_on", "conv_id", "path", "sizes"
    )


def trie_nodes(paths: DataFrame, per_shard: int = PER_SHARD) -> DataFrame:
    """One row per node of the trie of paths; `paths` has conv_id, path and sizes, one row per conversation."""
    parts = stored(_placed(stored(paths, "paths"), per_shard).mapInArrow(_shard_batches, NODE), "trie")
    spine = parts.where(F.col("key").isNotNull())
    chunks = spine.select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
    hashes = chunks.select("key", "ends").mapInArrow(_hash_batches, "key binary, ends_sha256 string")
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    above = F.max("parent_key").alias("parent_key")
    merged = spine.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), above, *total)
    merged = stored(merged.join(hashes, "key"), "spine")

    # Parents on a spine are looked up by shard as well, so that children of a common node don't meet in one task.
    lowest = merged.select("key", F.col("conv_id").alias("parent_low"))
    by_shard = spine.select("shard", "key").join(lowest, "key").select(
        F.col("shard").alias("in_shard"), F.col("key").alias("parent_key"), "parent_low"
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    whole = parts.where(F.col("key").isNull())
    below = whole.where(F.col("parent_key").isNotNull()).drop("parent_conv_id")
    hung = below.join(by_shard, (below["shard"] == by_shard["in_shard"]) & (below["parent_key"] == by_shard["parent_key"]))
    hung = hung.withColumnRenamed("parent_low", "parent_conv_id").select(columns)
    spines = merged.join(lowest.withColumnRenamed("key", "parent_key"), "parent_key", "left")
    spines = spines.withColumnRenamed("parent_low", "parent_conv_id").select(columns)
    inner = whole.where(F.col("parent_key").isNull()).select(columns)
    return inner.unionByName(hung).unionByName(spines).withColumnRenamed("saved", "saved_tokens")


def prefix_trie(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    family: int = FAMILY,
    shared: int = SHARED,
    per_shard: int = PER_SHARD,
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    turns = stored(numbered_turns(conversations, conv_col, turn_col, role_col, text_col), "turns")
    return trie_nodes(conversation_paths(rebuilt(turns, family, shared)), per_shard)
