"""Word and shingle hashes, signatures and overlaps against plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from loomcat.llm import words as W
from loomcat.llm.near_dedup import bag_minhash


def plain(text):
    words = [re.sub(r"[\x00-\x7f]", lambda m: m[0] if m[0].isalnum() else "", w) for w in re.split(r"[\s]+", text.lower())]
    return [w for w in words if w]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAB1é ,.-\n\t'ß", max_size=40), max_size=8))
def test_equal_words_have_equal_hashes(texts):
    hashes, starts, _ = W.word_hashes(pa.array(texts, pa.string()))
    seen = {}
    for i, t in enumerate(texts):
        own = hashes[starts[i] : starts[i + 1]].tolist()
        assert len(own) == len(plain(t))
        for w, h in zip(plain(t), own, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_pieces_make_no_difference(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "bb", "c,c", "dddd", "é"]) for _ in range(rng.randrange(60))) for _ in range(30)] + ["x" * 500, None, ""]
    whole = W.word_hashes(pa.array(texts, pa.string()), 4)
    monkeypatch.setattr(W, "PIECE", 16)
    for a, b in zip(whole, W.word_hashes(pa.array(texts, pa.string()), 4), strict=True):
        assert np.array_equal(a, b)


def test_sliced_arrays_and_other_spaces():
    a = pa.array(["skip", "one two three", "Ones two　x"]).slice(1)
    hashes, starts, short = W.word_hashes(a, 3)
    assert starts.tolist() == [0, 3, 6] and hashes[1] == hashes[4] and short[0] == short[3] and hashes[0] != hashes[3]


def test_shingles_of_short_texts():
    words, starts, _ = W.word_hashes(pa.array(["", "a b", "a b c d e f", "a b"]))
    items, begin = W.shingles(words, starts)
    assert np.diff(begin).tolist() == [0, 1, 2, 1] and items[0] == items[3]
    assert np.diff(W.shingles(words, starts, short_texts=False)[1]).tolist() == [0, 0, 2, 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=20), st.lists(st.integers(0, 5), max_size=20))
def test_weighted_overlap(a, b):
    x, y = collections.Counter(a), collections.Counter(b)
    most = sum((x | y).values())
    wanted = sum((x & y).values()) / most if a and b else 0.0
    assert abs(W.weighted_overlap(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)) - wanted) < 1e-12


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    size = 512
    for _ in range(6):
        keys = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
        same = rng.integers(0, 300)
        b[:same] = a[:same]
        owner = np.repeat([0, 1], 300)
        counts = np.concatenate([a, b])
        items = np.concatenate([keys, keys])
        full = counts > 0
        sign = bag_minhash(items[full], counts[full], owner[full], 2, size)
        wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((sign[0] == sign[1]).mean() - wanted) < 5 * (wanted * (1 - wanted) / size) ** 0.5 + 0.01


def test_few_words_have_the_same_signature_in_any_batch():
    one = bag_minhash(np.array([7], np.uint64), np.array([3]), np.zeros(1, int), 1, 252)
    for n in (2, 50, 3000):
        many = bag_minhash(np.arange(7, 7 + n, dtype=np.uint64), np.full(n, 3), np.arange(n), n, 252)
        assert np.array_equal(one[0], many[0])


def test_signatures_do_not_depend_on_company():
    keys = np.arange(1, 40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.arange(1, 40) % 7 + 1
    alone = bag_minhash(keys, counts, np.zeros(39, int), 1, 64)
    order = np.random.default_rng(0).permutation(39)
    both = bag_minhash(np.concatenate([keys[order], keys[:1]]), np.concatenate([counts[order], [3]]), np.append(np.zeros(39, int), 1), 2, 64)
    assert np.array_equal(alone[0], both[0])
