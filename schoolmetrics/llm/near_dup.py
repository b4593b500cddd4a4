"""Near-duplicate groups: MinHash bands propose, odd sketches sift, full shingle sets decide.

1. Every text becomes a set of hashed 5-word shingles, 128 MinHash samples of it, 20 band keys of 4 samples each, and an
   odd sketch: the samples folded into a bitmap of parities. Texts with equal sets become one node from here on.
2. Nodes that share a band key share a bucket. The pairs of a bucket are never listed. Its member that shares the most
   buckets with others is its centre, and only (centre, member) pairs are formed.
3. Where a centre has one partner, the odd sketches are compared first: the number of bits in which they differ is at most
   twice the number of differing samples, so beyond `sketch_limit` the pair cannot be near.
4. (centre, member) pairs are decided on full sets. Members linked to their centre are in one component and need no pair
   between them. Where some aren't linked to it, the bucket's members are described by their differences from a common
   set of n, the centre's with every shingle turned over that most members have otherwise. Let a member lack l and add b
   shingles; with weight w = 100 l + p b (p the percentage) and W = (100 - p) n, two members with o common differences are
   linked exactly if w1 + w2 <= W + (100 + p) o.
   - All are held against the member of least weight w*. If x isn't linked to it, w_x + w* > W, so x can be linked to no
     member at all without a common difference.
   - Either both add a common shingle. What replaces a word is rarely the same in two copies, so these meet seldom.
   - Or all they share are shingles that both lack. Then o >= b_y + (w_x - W) / p, so only the first few lacked shingles
     have to be looked at (as in prefix filters).
   Members are gathered by (centre, difference). Pairs are not listed there either: a few pivots of each gathering are
   (the lightest of every component) are held against members of other components, found pairs are sifted by sketch and
   decided on full sets, and what became one component is dropped. Pivots leave, and there are more in each next round,
   until no gathering has two components left. Each row meets a bounded number in a round, so that gatherings that hang
   together cost a multiple of their size.
5. Links are contracted to components.

A pair at the threshold shares no band key with probability (1 - 0.85^4)^20 = 4e-7, less above it; the sketch loses a
pair with probability below 1e-7. No bucket, centre or partner list is capped.

Cases: a null or blank text has an empty set and is linked with nothing; fewer than five words are one shingle; equal
texts share their component; rows with one id count as one document with several texts; a row without an id takes the
component of its equals, and is not kept; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolmetrics.llm.common import stored
from schoolmetrics.llm.components import components
from schoolmetrics.llm.shingles import WordHashes, constants, linked, mix, shingle_set

SAMPLES = 128
BANDS = 20
ROWS = 4
BITS = 512
PERCENT = 85
#: Components of a gathering of which each has a pivot in the first round; where there are more, so many parts of them.
PIVOTS = 16
#: Whole numbers in the signature of a member's differences.
SIGNS = 8
SIGNED = [f"sign{i}" for i in range(SIGNS)]
#: Shingles handled at a time, so that a block of samples stays in a core's cache.
BLOCK = 1 << 16

SCALE = (constants(SAMPLES, 21) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
SHIFT = (constants(SAMPLES, 22) >> np.uint64(32)).astype(np.uint32)
SALT = constants(SAMPLES, 23)
BAND_SALT = constants(BANDS * ROWS, 24) | np.uint64(1)

SKETCHES = "doc_id {id}, n_shingles long, code binary, bands array<long>, odd array<long>"


def min_samples(sets: list[np.ndarray]) -> np.ndarray:
    """SAMPLES minima for each of the sets, none of them empty."""
    lengths = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), SAMPLES), np.uint32)
    for k in range(SAMPLES):
        out[:, k] = np.minimum.reduceat(flat * SCALE[k] + SHIFT[k], starts)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; keys of different bands don't meet."""
    part = samples[:, : BANDS * ROWS].astype(np.uint64) * BAND_SALT
    return mix(part.reshape(len(samples), BANDS, ROWS).sum(axis=2) + constants(BANDS, 25)).view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps: each sample flips one bit, chosen by a hash of the sample and its place."""
    bit = (mix(samples.astype(np.uint64) + SALT) % np.uint64(BITS)).astype(np.int64)
    rows = np.arange(len(samples))[:, None] * BITS
    parity = np.bincount((rows + bit).ravel(), minlength=len(samples) * BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(len(samples), BITS), axis=1).view(np.int64)


def sketch_limit(percent: int, loss: float = 1e-7) -> int:
    """Differing bits that a pair at the threshold exceeds with probability below `loss`.

    The number of differing samples is binomial, and each of them flips at most two bits.
    """
    p, tail, most = 1 - percent / 100, 0.0, SAMPLES
    while most and tail + (more := math.comb(SAMPLES, most) * p**most * (1 - p) ** (SAMPLES - most)) <= loss:
        tail, most = tail + more, most - 1
    return 2 * most


def _sketch_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()

    def done(ids: list, sets: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        bands, odd = [None] * len(sets), [None] * len(sets)
        if full:
            samples = min_samples([sets[i] for i in full])
            for i, keys, bits in zip(full, band_keys(samples), odd_sketches(samples), strict=True):
                bands[i], odd[i] = keys, bits
        codes = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        columns = [
            pa.array(ids, kind),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array(codes, pa.binary()),
            pa.array(bands, pa.list_(pa.int64())),
            pa.array(odd, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "code", "bands", "odd"])

    for batch in batches:
        ids, sets, held = [], [], 0
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            ids.append(doc_id.as_py())
            sets.append(shingle_set(text.as_py(), hashes))
            held += len(sets[-1])
            if held >= BLOCK:
                yield done(ids, sets, batch.column(0).type)
                ids, sets, held = [], [], 0
        if ids:
            yield done(ids, sets, batch.column(0).type)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, code (128 bits of the whole set), bands and odd sketch of each text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(_sketch_batches, SKETCHES.format(id=rows.schema["doc_id"].dataType.simpleString()))


def _far(odd_a: str, odd_b: str) -> F.Column:
    """Bits in which two odd sketches differ."""
    each = F.zip_with(odd_a, odd_b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda total, n: total + n)


def _decide_batches(batches: Iterable[pa.RecordBatch], percent: int, close: bool) -> Iterator[pa.RecordBatch]:
    """a, b, text_a, text_b -> a, b, near; with `close` also the differences of b from a, if they are not too many."""
    hashes, last, first_set = WordHashes(), None, None
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            near, differences = [], []
            part = batch.slice(at, 1000)
            for text_a, text_b in zip(part.column("text_a"), part.column("text_b"), strict=True):
                text_a = text_a.as_py()
                if text_a != last:
                    last, first_set = text_a, shingle_set(text_a, hashes)
                other = shingle_set(text_b.as_py(), hashes)
                near.append(linked(first_set, other, percent))
                if close:
                    found = np.setxor1d(first_set, other, assume_unique=True)
                    differences.append(found.view(np.int64) if len(found) <= len(first_set) else None)
            columns = [part.column("a"), part.column("b"), pa.array(near, pa.bool_())]
            if close:
                columns.append(pa.array(differences, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "near", "differences"][: len(columns)])


def signature(differences: np.ndarray) -> np.ndarray:
    """A bitmap with one bit set for each difference, as SIGNS whole numbers."""
    bits = np.zeros(64 * SIGNS, bool)
    bits[differences.astype(np.uint64) % np.uint64(64 * SIGNS)] = True
    return np.packbits(bits).view(np.int64)


def _describe_batches(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """a, b, near, turned, text_a, text_b -> a, node, near, and how b differs from a's set with `turned` turned over."""
    hashes, last, common = WordHashes(), None, None
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            added, lacked, excess, weight, signs = [], [], [], [], []
            for text_a, text_b, turned in zip(part.column("text_a"), part.column("text_b"), part.column("turned"), strict=True):
                key = (text_a.as_py(), turned.as_py())
                if key != last:
                    flips = np.unique(np.array(key[1] or [], np.int64).view(np.uint64))
                    last, common = key, np.setxor1d(shingle_set(key[0], hashes), flips, assume_unique=True)
                other = shingle_set(text_b.as_py(), hashes)
                added.append(np.setdiff1d(other, common, assume_unique=True).view(np.int64))
                lacked.append(np.setdiff1d(common, other, assume_unique=True).view(np.int64))
                weight.append(100 * len(lacked[-1]) + percent * len(added[-1]))
                excess.append(weight[-1] - (100 - percent) * len(common))
                signs.append(signature(np.concatenate((added[-1], lacked[-1])).view(np.uint64)))
            columns = [
                part.column("a"), part.column("b"), part.column("near"),
                pa.array(excess, pa.int64()), pa.array(weight, pa.int64()),
                pa.array(added, pa.list_(pa.int64())), pa.array(lacked, pa.list_(pa.int64())),
                *(pa.array([x[i] for x in signs], pa.int64()) for i in range(SIGNS)),
            ]
            names = ["a", "node", "near", "excess", "weight", "added", "lacked", *SIGNED]
            yield pa.RecordBatch.from_arrays(columns, names)


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    text_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    text_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(text_b, "b").join(text_a, "a").select(*pairs.columns, "text_a", "text_b")


def _decide(pairs: DataFrame, texts: DataFrame, percent: int, close: bool = False) -> DataFrame:
    """Decide pairs (a, b) on the full sets of their texts."""
    kind = pairs.schema["a"].dataType.simpleString()

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decide_batches(batches, percent, close)

    more = ", differences array<long>" if close else ""
    return _with_texts(pairs.select("a", "b"), texts).mapInArrow(decide, f"a {kind}, b {kind}, near boolean{more}")


def _described(grouped: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The members of every centre that some member isn't linked to, the centre included, by their differences.

    a, node, near (to a), excess (w - W), weight, added, lacked and a signature of both. What most close members have otherwise than the centre
    is turned over in the set they are compared with, so that differences are what sets a member apart.
    """
    kind = grouped.schema["a"].dataType.simpleString()
    broken = grouped.groupBy("a").agg(F.count("*").alias("members"), F.min("near").alias("whole")).where(~F.col("whole"))
    broken = broken.select("a", "members")
    of = grouped.join(broken, "a")
    each = of.where("differences IS NOT NULL").select("a", "members", F.explode("differences").alias("d"))
    often = each.groupBy("a", "d").agg(F.count("*").alias("n"), F.max("members").alias("members"))
    turned = often.where("2 * n > members + 1").groupBy("a").agg(F.collect_list("d").alias("turned"))
    itself = broken.select("a", F.col("a").alias("b"), F.lit(True).alias("near"))
    rows = of.select("a", "b", "near").unionByName(itself).join(turned, "a", "left")

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _describe_batches(batches, percent)

    schema = f"a {kind}, node {kind}, near boolean, excess long, weight long, added array<long>, lacked array<long>"
    return _with_texts(rows, texts).mapInArrow(describe, ", ".join([schema, *(f"{c} long" for c in SIGNED)]))


def _least(members: DataFrame, percent: int) -> DataFrame:
    """Members with the weight of the least one of their centre, that member as `least`, and whether they're linked to it."""
    row = F.struct("weight", "node", "added", "lacked")
    least = members.groupBy("a").agg(F.min(row).alias("of"))
    both = members.join(least, "a")
    common = F.size(F.array_intersect("added", "of.added")) + F.size(F.array_intersect("lacked", "of.lacked"))
    by_least = F.col("excess") + F.col("of.weight") <= (100 + percent) * common
    return both.select(
        *members.columns, F.col("of.node").alias("least"), F.col("of.weight").alias("least_weight"),
        (by_least | (F.col("node") == F.col("of.node"))).alias("by_least"),
    )


def _gathered(members: DataFrame, percent: int) -> DataFrame:
    """A row for each difference to look at: whether it is lacked, its place, and if it counts as unlinked and as partner."""
    n_added, n_lacked = F.size("added").cast("long"), F.size("lacked").cast("long")
    apart = percent * (n_added - n_lacked) - F.col("least_weight")
    added_least = F.greatest(F.lit(1), F.floor(apart / (100 + percent)) + 1)
    lacked_open = F.greatest(F.lit(1), F.ceil(F.col("excess") / percent))
    lacked_least = F.greatest(F.lit(1), n_added + F.ceil((1 - F.col("least_weight")) / percent))
    rows = members.select(
        "a", "node", "near", "by_least", "excess", "weight", n_added.alias("n_added"), n_lacked.alias("n_lacked"),
        (n_added - added_least).alias("added_to"), (n_lacked - lacked_open).alias("open_to"),
        (n_lacked - lacked_least).alias("lacked_to"), "added", "lacked", *SIGNED,
    )
    columns = ["a", "node", "near", "excess", "weight", "n_added", "n_lacked", *SIGNED]
    opened = ~F.col("by_least")
    added = rows.select(*columns, "by_least", "added_to", F.posexplode("added").alias("at", "d")).select(
        *columns, "d", "at", F.lit(False).alias("lacked"), opened.alias("opens"), (F.col("at") <= F.col("added_to")).alias("meets")
    )
    lacked = rows.select(*columns, "by_least", "open_to", "lacked_to", F.posexplode("lacked").alias("at", "d")).select(
        *columns, "d", "at", F.lit(True).alias("lacked"),
        (opened & (F.col("at") <= F.col("open_to"))).alias("opens"), (F.col("at") <= F.col("lacked_to")).alias("meets"),
    )
    return added.unionByName(lacked).where("opens OR meets")


GATHERING = ["a", "lacked", "d"]
PIVOT = ["weight", "node", "at", "opens", "meets", "excess", "n_lacked", "n_added", "near", "label", *SIGNED]


def _crowded(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of gatherings that still hold a pair of two components, with their component and how many there are."""
    rows = rows.drop("label", "labels").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    found = rows.groupBy(*GATHERING).agg(
        F.approx_count_distinct("label").alias("labels"), F.max("opens").alias("opens"), F.max("meets").alias("meets"),
        F.min("label").alias("low"), F.max("label").alias("high"),
    )
    return rows.join(found.where("opens AND meets AND low < high").select(*GATHERING, "labels"), GATHERING)


def _missing(signs: dict[str, F.Column], others: dict[str, F.Column]) -> F.Column:
    """Bits set in a signature that aren't in the other."""
    return reduce(add, [F.bit_count(signs[c].bitwiseAND(F.bitwise_not(others[c]))) for c in SIGNED])


def _pivot_pairs(rows: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """(a, b) between pivots and other members of their gatherings that can be linked, as far as their places tell.

    From where two members share a difference, at most the shorter rest of the two lists can be shared; and no difference
    is whose bit the other's signature lacks.
    """
    of = {c: F.col(f"pivot.{c}") for c in PIVOT}
    length = F.when(F.col("lacked"), F.col("n_lacked")).otherwise(F.col("n_added"))
    length_of = F.when(F.col("lacked"), of["n_lacked"]).otherwise(of["n_added"])
    rest = F.least(length - F.col("at"), length_of - of["at"])
    shared = rest + F.when(F.col("lacked"), 0).otherwise(F.least("n_lacked", of["n_lacked"]))
    own = F.col("n_added") + F.col("n_lacked") - _missing({c: F.col(c) for c in SIGNED}, of)
    others = of["n_added"] + of["n_lacked"] - _missing(of, {c: F.col(c) for c in SIGNED})
    enough = of["excess"] + F.col("weight") <= (100 + percent) * F.least(shared, own, others)
    roles = (F.col("opens") & of["meets"]) | (of["opens"] & F.col("meets"))
    apart = (F.col("label") != of["label"]) & ~(F.col("near") & of["near"])
    pairs = rows.join(pivots, GATHERING).where(enough & roles & apart)
    return pairs.select(F.least("node", of["node"]).alias("a"), F.greatest("node", of["node"]).alias("b")).distinct()


def _links_between_members(
    grouped: DataFrame, known: DataFrame, odd: tuple[DataFrame, DataFrame], texts: DataFrame, percent: int
) -> DataFrame:
    """Links between members of a centre of which one isn't linked to it; `known` has the links found before."""
    members = stored(_described(grouped, texts, percent), "members")
    members = stored(_least(members, percent), "members")
    by_least = members.where(F.col("by_least") & (F.col("least") != F.col("node")))
    known = known.union(by_least.select(F.col("least").alias("a"), F.col("node").alias("b")))
    known = stored(known, "links")
    limit, width, rows = sketch_limit(percent), PIVOTS, _gathered(members, percent)
    while not (rows := stored(_crowded(rows, components(known)), "gathered")).isEmpty():
        # The lightest member of each component, or of parts of them where there are many; more in later rounds.
        of_component = F.when(F.col("labels") <= width, F.xxhash64("label")).otherwise(F.pmod(F.xxhash64("label"), F.lit(width)))
        part = F.struct(of_component, F.pmod(F.xxhash64("node"), F.lit(width // PIVOTS)))
        pivots = rows.groupBy(*GATHERING, part.alias("part")).agg(F.min(F.struct(*PIVOT)).alias("pivot"))
        pivots = stored(pivots.select(*GATHERING, "pivot"), "pivots")
        pairs = _pivot_pairs(rows, pivots, percent).join(odd[0], "a").join(odd[1], "b")
        pairs = pairs.where(_far("odd_a", "odd_b") <= limit).select("a", "b")
        known = stored(known.union(_decide(pairs, texts, percent).where("near").select("a", "b")), "links")
        tested = pivots.select(*GATHERING, F.col("pivot.node").alias("node"))
        rows = rows.join(tested, [*GATHERING, "node"], "left_anti")
        width *= 8
    return known


def near_links(docs: DataFrame, found: DataFrame, *, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Links (a, b) between nodes, from stored sketches; enough of them to connect whatever is connected."""
    limit = sketch_limit(percent)
    nodes = stored(
        found.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("code")
        .agg(F.min("doc_id").alias("node"), F.any_value(F.struct("bands", "odd")).alias("of"))
        .select("node", "of.bands", "of.odd"),
        "nodes",
    )
    banded = nodes.select("node", F.explode("bands").alias("band"))
    crowd = banded.groupBy("band").agg(F.count("*").alias("crowd")).where("crowd > 1")
    members = stored(banded.join(crowd, "band"), "members")
    degree = members.groupBy("node").agg(F.sum("crowd").alias("degree"))
    centre = (
        members.join(degree, "node")
        .groupBy("band")
        .agg(F.min(F.struct(-F.col("degree"), F.col("node"))).getField("node").alias("a"))
    )
    stars = members.select("band", F.col("node").alias("b")).join(centre, "band").where("a <> b")
    stars = stored(stars.select("a", "b").distinct(), "stars")

    odd_a, odd_b = (nodes.select(F.col("node").alias(x), F.col("odd").alias(f"odd_{x}")) for x in "ab")
    partners = stars.groupBy("a").agg(F.count("*").alias("partners"))
    sifted = stars.join(partners, "a").join(odd_a, "a").join(odd_b, "b")
    sifted = sifted.where((F.col("partners") > 1) | (_far("odd_a", "odd_b") <= limit))
    stars = stored(sifted.select("a", "b", "partners"), "sifted")

    wanted = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    rows = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("binary").alias("text"))
    texts = stored(rows.join(wanted.hint("merge"), "node", "left_semi"), "texts")  # planned alike at every size
    single = _decide(stars.where("partners = 1"), texts, percent).where("near").select("a", "b")
    grouped = stored(_decide(stars.where("partners > 1"), texts, percent, close=True), "decided")

    known = single.union(grouped.where("near").select("a", "b"))
    return _links_between_members(grouped, known, (odd_a, odd_b), texts, percent)


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (its smallest id), kept."""
    found = stored(sketches(docs, id_col, text_col), "sketches")
    labels = components(near_links(docs, found, id_col=id_col, text_col=text_col, percent=percent))
    smallest = F.min("doc_id").alias("node")
    nodes = found.where("n_shingles > 0").groupBy("code").agg(smallest)
    lowest = labels.groupBy("label").agg(F.min("node").alias("low"))
    joined = nodes.join(labels, "node", "left").join(lowest, "label", "left")
    joined = joined.select(F.col("code").alias("of_code"), F.coalesce("low", "node").alias("component"))
    rows = found.select("doc_id", "n_shingles", "code")
    rows = rows.join(joined, (rows.code == joined.of_code) & (rows.n_shingles > 0), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def row_key(id_: F.Column, text: F.Column, kind: str) -> F.Column:
    """Bytes that sort by id (rows without one last), and set rows with one id and different texts apart."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        shown = F.lpad(F.hex(id_.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    else:
        shown = F.hex(id_.cast("string").cast("binary"))
    content = F.coalesce(F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.lit(""))
    content = F.when(text.isNull(), "").otherwise(content)
    return F.unhex(F.concat(F.coalesce(F.concat(F.lit("00"), shown), F.lit("01")), content))


def drop_near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of `docs` that stay, one of each group, with all their columns.

    The row with the smallest id stays, of several with that id the one of least content hash, and of rows equal in id
    and text any one; a row without an id stays where no row of its group has one. Blank texts all stay.
    """
    key = row_key(F.col(id_col), F.col(text_col), docs.schema[id_col].dataType.simpleString())
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = docs.select(key.alias("key"), row.alias("row")).groupBy("key").agg(F.any_value("row").alias("row"))
    groups = near_duplicates(docs.select(key.alias("doc_id"), F.col(text_col).alias("text")), percent=percent)
    kept = groups.where("kept").select(F.col("doc_id").alias("key"))
    return one.join(kept, "key", "left_semi").select("row.*")
