import pytest
import itertools
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vigil.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def cheapest(positions, penalties, window):
    """Cost of the best cuts by trying all of them."""
    best = None
    for keep in itertools.product([0, 1], repeat=len(positions) - 1):
        cuts = [p for p, k in zip(positions, keep, strict=False) if k] + [positions[-1]]
        if all(b - a <= window for a, b in itertools.pairwise([0, *cuts])):
            best = min(cost(cuts, positions, penalties, window), float("inf") if best is None else best)
    return best


def cost(cuts, positions, penalties, window):
    at = dict(zip(positions, penalties, strict=True))
    return sum(window - b + a for a, b in itertools.pairwise([0, *cuts])) + sum(at[c] for c in cuts[:-1])


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 12), st.lists(st.tuples(st.integers(1, 12), st.sampled_from([0, 1, 4])), min_size=1, max_size=9))
def test_cuts_are_cheapest(window, steps):
    positions = list(itertools.accumulate(min(s, window) for s, _ in steps))
    penalties = [p for _, p in steps]
    cuts = packing.choose_cuts(positions, penalties, window)
    assert cost(cuts, positions, penalties, window) == cheapest(positions, penalties, window)


def check(pieces, rows, window):
    """Every id of every row in exactly one piece; sequences gapless and at most a window."""
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    want = []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, ids))
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for (i, n), own in by_doc.items():
        same = [ids for d, ids in want if d == i and len(ids) == n]
        own.sort(key=lambda p: p.start)
        spans = sorted((p.start, p.start + p.length) for p in own)
        assert len([s for s in spans if s[0] == 0]) == len(same)
        assert sum(b - a for a, b in spans) == n * len(same)
        for p in own:
            assert p.ids_crc32 in {zlib.crc32(ids[p.start:p.start + p.length].tobytes()) for ids in same}
    assert sum(p.length for p in pieces) == sum(len(ids) for _, ids in want)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert own[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in itertools.pairwise(own))
        assert sum(p.length for p in own) <= window
    return sequences


def test_pieces_hold_every_id_once(frame, odd_rows):
    pieces = packing.pack(frame(odd_rows).coalesce(2), PATH).collect()
    check(pieces, odd_rows, 2048)


def test_stretches_join_and_padding_is_small(frame):
    rows = [(i, f"Sentence one of document {i}. " * (i % 37)) for i in range(400)]
    pieces = packing.pack(frame(rows).coalesce(1), PATH, window=256, stretch=2048).collect()
    sequences = check(pieces, rows, 256)
    total = sum(p.length for p in pieces)
    assert 1 - total / (256 * len(sequences)) < 0.04
    # documents keep their order
    starts = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    assert [k for k, _ in itertools.groupby(p.doc_id for p in starts)] == [i for i, _ in rows]


def test_empty_table(frame):
    assert packing.pack(frame([]), PATH).count() == 0


@pytest.mark.parametrize("window,stretch", [(64, 63), (0, 100)])
def test_a_stretch_holds_a_window(frame, window, stretch):
    with pytest.raises(ValueError, match="stretch"):
        packing.pack(frame([(1, "a")]), public_tokenizers.path("word_bpe_49k.json"), window=window, stretch=stretch)
