"""Hashes of the words and word shingles of whole texts, with numpy over Arrow's buffers.

A word is a run of characters without white space, lower-cased, less its ASCII
punctuation; a run of punctuation only is no word. Null and empty texts have none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loomcat.llm.common import mix64

SHINGLE = 5
OTHER_SPACE = "[\u0085   -     　]"
PIECE = 1 << 20  # bytes that are hashed at once

_code = np.arange(256)
_IS_SPACE = np.isin(_code, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
_IS_WORD = (_code >= 128) | ((_code >= 48) & (_code <= 57)) | ((_code >= 97) & (_code <= 122)) | ((_code >= 65) & (_code <= 90))
_VALUE = np.where(_IS_WORD, mix64((np.arange(256) + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), 0).astype(np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = mix64(np.arange(1, SHINGLE + 1).astype(np.uint64) * _BASE) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _BASE, dtype=np.uint64))


def _hash_piece(data: np.ndarray, begins: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the bytes of a piece, which starts at a word's start: word hashes, their first bytes' places, prefix hashes."""
    keep = np.flatnonzero(_IS_WORD[data] | _IS_SPACE[data] | begins)
    chars = data[keep]
    word = _IS_WORD[chars]
    starts_new = np.empty(len(chars), dtype=bool)
    if not len(chars):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64)
    starts_new[0] = True
    starts_new[1:] = ~word[:-1] & (_IS_SPACE[chars[:-1]])
    starts_new |= begins[keep]
    # a document's first byte may be punctuation: the word then starts behind it
    runs = np.flatnonzero(starts_new)
    run_of = np.cumsum(starts_new) - 1
    seen = np.cumsum(word)
    place = np.maximum(seen - 1 - (seen - word)[runs][run_of], 0)  # punctuation that begins a text has no place
    values = _VALUE[chars] * _powers(int(place.max()) + 1)[place]
    hashes = np.add.reduceat(values, runs)
    letters = np.add.reduceat(word.astype(np.int32), runs)
    real = letters > 0
    short = np.add.reduceat(np.where(place < prefix, values, np.uint64(0)), runs)[real] if prefix else np.empty(0, np.uint64)
    return mix64(hashes[real]), keep[runs[real]], mix64(short ^ np.uint64(0x5851F42D4C957F2D))


def _next_start(data: np.ndarray, begins: np.ndarray, at: int) -> int:
    """The first place from `at` on that no word crosses."""
    while at < len(data):
        ahead = begins[at : at + PIECE].copy()
        ahead |= _IS_SPACE[data[at - 1 : at - 1 + len(ahead)]]
        hit = int(ahead.argmax())
        if ahead[hit]:
            return at + hit
        at += len(ahead)
    return len(data)


def word_hashes(texts: pa.Array, prefix: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, where each text's words begin (one more at the end), hashes of words' first bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    if pc.any(pc.match_substring_regex(texts, OTHER_SPACE)).as_py():
        texts = pc.replace_substring_regex(texts, OTHER_SPACE, " ")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    begins = np.zeros(len(data), dtype=bool)
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    parts, at = [], 0
    while at < len(data):
        end = _next_start(data, begins, at + PIECE)
        hashes, places, short = _hash_piece(data[at:end], begins[at:end], prefix)
        parts.append((hashes, places + at, short))
        at = end
    hashes = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.uint64)
    places = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int64)
    short = np.concatenate([p[2] for p in parts]) if parts else np.empty(0, np.uint64)
    return hashes, np.searchsorted(places, offsets), short


def shingles(words: np.ndarray, starts: np.ndarray, short_texts: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of five words, and where each text's runs begin.

    With short_texts, a text of one to four words has one shingle of all its words.
    """
    counts = np.diff(starts)
    full = np.maximum(counts - SHINGLE + 1, 0)
    size = np.where((counts > 0) & (full == 0), 1, full) if short_texts else full
    begin = np.concatenate([[0], np.cumsum(size)])
    first = np.repeat(starts[:-1] - begin[:-1], size) + np.arange(begin[-1])
    stop = np.repeat(starts[1:], size)
    total = np.zeros(len(first), dtype=np.uint64)
    for j in range(SHINGLE):
        at = first + j
        inside = at < stop
        if inside.all():
            total += words[at] * _STEP[j]
        else:
            total[inside] += words[at[inside]] * _STEP[j]
    return mix64(total), begin


def bag_overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser counts over the sum of the greater ones, of two multisets as sorted items and counts; 0 for two empty ones."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


def weighted_overlap(a: np.ndarray, b: np.ndarray) -> float:
    """bag_overlap of two lists of items."""
    return bag_overlap(np.unique(a, return_counts=True), np.unique(b, return_counts=True))
