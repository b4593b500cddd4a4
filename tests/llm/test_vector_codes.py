"""Vector codes against Lloyd's rounds in plain Python, on small tables with ties, repeats and unusable rows."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from schoolmetrics.llm import vector_codes

TABLE = "vec_id long, embedding array<float>, label int, code string, ids string, vectors int, error long"


def frame(spark, rows):
    """Vectors with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, v, label, "c", "i", 1, 2) for i, v, label in rows], TABLE)


def lloyd(rows, parts=8, entries=16, rounds=6, scale=4096):
    """code, error, label error and digest by row, with full scans in every round."""
    fine = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, v, _ in fine if v and len(v) % parts == 0]
    length = max(set(lengths), key=lambda n: (lengths.count(n), n), default=0)
    fine = [r for r in fine if len(r[1]) == length and length]
    width = length // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in fine]
    order = sorted((k for k in range(len(fine)) if fine[k][0] is not None), key=lambda k: (fine[k][0], fine[k][1]))
    books = [[list(cut[k][p]) for k in order[:entries]] for p in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = [best(c[p], books[p])[1] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, x in zip(cut, of, strict=True) if x == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    found = [[best(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    total = {label: sum(e for e, r in zip(errors, fine, strict=True) if r[2] == label) for label in {r[2] for r in fine}}
    return [
        (r[0], "".join(f"{e:02x}" for _, e in f), err, total[r[2]], digest)
        for r, f, err in zip(fine, found, errors, strict=True)
    ]


def rows_like(seed, n, dim=16, spread=3):
    """Few different values, so that distances tie, entries go unused and rows repeat."""
    rng = random.Random(seed)
    rows = [(rng.randrange(n), [rng.randrange(-spread, spread) / 4096 * 5 for _ in range(dim)], rng.choice([None, 1, 2])) for _ in range(n)]
    return rows + rows[:3]


def key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize(("seed", "n", "dim"), [(1, 300, 16), (2, 90, 8), (3, 9, 24)])
def test_codes_match_full_scans(spark, seed, n, dim):
    rows = rows_like(seed, n, dim)
    nan, inf = float("nan"), float("inf")
    odd = [(0, None, 1), (1, [nan] * dim, 1), (2, [inf] + [0.0] * (dim - 1), 1), (3, [None] * dim, 1), (4, [], 1), (5, [1.0] * 5, 2)]
    rows += [*odd, (6, [0.5] * (dim * 2), 1), (None, rows[0][1], 2)]
    got = vector_codes.vector_codes(frame(spark, rows).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert key(got.collect()) == key(lloyd(rows))


def test_continuous_vectors_in_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16)], int(i % 4) or None) for i in range(700)]
    monkeypatch.setattr(vector_codes, "BLOCK", 64)
    got = vector_codes.vector_codes(frame(spark, rows).repartition(4))
    assert key(got.collect()) == key(lloyd(rows))


def test_options_and_empty_tables(spark):
    rows = rows_like(5, 40)
    coded, books = vector_codes.lloyd_codes(frame(spark, rows), parts=4, entries=3, rounds=1, scale=16)
    assert key((r.vec_id, r.code, r.error) for r in coded.collect()) == key(r[:3] for r in lloyd(rows, 4, 3, 1, 16))
    assert books.shape == (4, 3, 4)
    for none in ([], [(1, None, 1)], [(None, [1.0] * 8, 1)]):
        assert vector_codes.vector_codes(frame(spark, none)).collect() == []
    with pytest.raises(Exception, match="not supported"):
        vector_codes.vector_codes(frame(spark, [(1, [1e9] * 8, 1)])).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 6))
def test_active_entries_give_what_full_scans_give(seed, n, entries):
    rng = np.random.default_rng(seed)
    x = rng.integers(-3, 4, size=(n, 2))
    before = rng.integers(-3, 4, size=(entries, 2))
    after = np.where(rng.random((entries, 1)) < 0.5, before, rng.integers(-3, 4, size=(entries, 2)))
    code, distance = vector_codes.nearest(x, before)
    got = vector_codes.reassign(x, after, (before != after).any(axis=1), code, distance)
    wanted = vector_codes.nearest(x, after)
    assert (got[0] == wanted[0]).all() and (got[1] == wanted[1]).all()


@pytest.mark.parametrize("top", [100, 40_000, 1 << 40])
def test_whole_numbers_survive_packing(top):
    values = np.random.default_rng(top).integers(-top, top, size=(7, 8))
    assert (vector_codes.widen(vector_codes.narrow(values), 7, 8) == values).all()
