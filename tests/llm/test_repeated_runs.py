"""Places of words and sentences as the removal of repeated runs takes them."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from schoolmetrics.llm import substring_dedup as s

TEXTS = st.text(st.sampled_from("aB .!?\")\n\t\x1cAé  　漢ß\U0001f600"), max_size=80)
PLAIN = re.compile(r"""(?<=[.!?])\s+|(?<=[.!?]["')\]])\s+|\s*\n\s*|\s+(?=[^\W\d_a-zß-öø-ÿ])""")


@given(TEXTS)
def test_starts_are_those_of_the_units(text):
    for t in (text, text + " " + "x" * (s.LONG + 1)):
        assert s.unit_starts(t).tolist() == [start for start, _ in s.units(t)]


@given(TEXTS)
def test_sentences_end_where_the_rule_says(text):
    ends = [0, *(x for m in PLAIN.finditer(text) for x in m.span()), len(text)]
    assert s.sentences(text) == [(a, b) for a, b in zip(ends[::2], ends[1::2], strict=True) if a < b]


def test_kept_powers_are_those_computed():
    for base in s.BASES:
        for kept, own in zip(s.powers(base, 9), s.powers(base, s.POWERS + 1), strict=True):
            assert np.array_equal(kept, own[:9])


@given(st.lists(TEXTS, max_size=6))
def test_codes_tell_units_apart_and_nothing_else(texts):
    """Equal hashes for equal units wherever they stand, A-Z made alike, and other hashes for others."""
    known: dict[str, int] = {}
    for t in [*texts, "x" * (s.LONG + 1) + " Xx \uffff \U00010000 \U00010001", *(t.swapcase() for t in texts)]:
        low = t.encode().lower().decode()
        own, codes = [low[a:b] for a, b in s.units(low)], s.unit_codes(t).tolist()
        assert len(own) == len(codes) and all(known.setdefault(u, c) == c for u, c in zip(own, codes, strict=True))
    assert len(set(known.values())) == len(known)


def test_marks_are_read_by_kind_without_row_objects():
    kind = pa.list_(pa.struct([("code", pa.int64()), ("check", pa.int32()), ("kind", pa.string())]))
    rows = [[{"code": 1, "check": -2, "kind": "span"}, {"code": 3, "check": 0, "kind": "block"}], None, [], [{"code": -(1 << 63), "check": 5, "kind": "span"}]]
    found = [{"span": [(1, -2)], "block": [(3, 0)]}, {}, {}, {"span": [(-(1 << 63), 5)]}]
    assert list(s._marks(pa.array(rows, kind))) == found
    assert list(s._marks(pa.array(rows, kind).slice(1))) == found[1:]
    assert list(s._marks(pa.array([None], kind))) == [{}]
