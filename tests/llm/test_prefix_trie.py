"""The prefix trie against nested dictionaries, in shards so small that most nodes lie on a spine."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from schoolmetrics.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, place int, digest string, shard long, key binary, size int"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def frame(spark, rows):
    """Turns with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, 1, "d", 2, b"k", 3) for r in rows], TURNS)


def brute_force(rows):
    convs: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(conv, []).append((turn is not None, turn or 0, tie, role, text))
    original = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(original.get(c - c % 5, [])[:h] + own[h:])
    members: dict[tuple, list] = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for node, of in members.items():
        inside = [p for p in members if p[: len(node)] == node]
        leaf = [p for p in inside if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)]
        ends = ",".join(map(str, sorted(c for c in of if built[c] == node)))
        out.append((
            min(of), len(node), min(members[node[:-1]]) if node else None, len(of),
            sum(len(p) == len(node) + 1 for p in inside), len(leaf),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in inside if p),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def talk(seed, convs, texts=3, turns=7):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, turns)):
            rows.append((c * rng.choice([1, 1, 3]), t, rng.choice(["user", "bot", None]), rng.choice(["é", "ab", "", None, "x" * 9][:texts])))
    return rows


def key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize(("seed", "convs", "texts"), [(1, 60, 2), (2, 150, 5), (3, 9, 1)])
def test_matches_nested_dictionaries(spark, seed, convs, texts):
    rows = talk(seed, convs, texts)
    rows += [(None, 0, "user", "nobody"), (7, None, "user", "first"), (7, None, "user", "first"), (11, 0, None, None)]
    got = prefix_trie.prefix_trie(frame(spark, rows).repartition(3), per_shard=5)
    assert got.columns == COLUMNS
    assert key(got.collect()) == key(brute_force(rows))


def test_copies_of_one_conversation_fill_several_shards(spark):
    """Also a very long one, and conversations that extend the copies."""
    rows = [(c, t, "user", f"t{t}") for c in range(200) for t in range(10 if c % 7 else 12)]
    rows += [(1000, t, "bot", f"long {t % 50}") for t in range(2000)]
    got = prefix_trie.prefix_trie(frame(spark, rows), per_shard=100)
    wanted = brute_force([r for r in rows if r[0] != 1000])
    assert {r for r in key(got.collect()) if r[0] != 1000 and r[1]} == {r for r in wanted if r[1]}
    long = {r.depth: r for r in got.where("conv_id = 1000").collect()}
    assert len(long) in (2000, 2000 + 1) and long[2000].n_children == 0 and long[5].n_leaves == 1
    root = got.where("depth = 0").collect()
    assert len(root) == 1 and root[0].n_convs == 201 and root[0].conv_id == 0


def test_empty_and_turnless(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).collect() == []
    c = next(c for c in range(1, 50) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(c, 0, "user", "gone"), (c, 1, "bot", "gone")]
    got = prefix_trie.prefix_trie(frame(spark, rows)).collect()
    assert key(got) == key(brute_force(rows)) and len(got) == 1 and got[0].n_leaves == 1


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400))
def test_findclose_matches_a_stack(seed, n):
    rng = random.Random(seed)
    opens, depth, left = [], 0, n
    steep = rng.random()
    while left or depth:
        if left and (depth == 0 or rng.random() < steep):
            opens.append(True)
            depth, left = depth + 1, left - 1
        else:
            opens.append(False)
            depth -= 1
    stack, close = [], {}
    for i, o in enumerate(opens):
        if o:
            stack.append(i)
        else:
            close[stack.pop()] = i
    tree = prefix_trie.Parentheses(np.array(opens))
    at = np.flatnonzero(opens)
    assert tree.findclose(at).tolist() == [close[i] for i in at]
    assert tree.leaf_rank(np.ones(len(opens), bool))[-1] == sum(close[i] == i + 1 for i in at)
