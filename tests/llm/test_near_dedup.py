"""Near-duplicate classes against brute force."""

import collections
import math
import random

import pytest

from loomcat.llm import common, near_dedup
from tests.llm.test_words import plain

SCHEMA = "doc_id long, text string, key string, id int"


def bag(text):
    w = plain(text)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def classes(rows):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    bags = [bag(t) if t is not None else None for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if bags[i] is None or bags[j] is None:
                continue
            most = sum((bags[i] | bags[j]).values())
            if rows[i][1] == rows[j][1] or most and sum((bags[i] & bags[j]).values()) / most >= 0.8:
                parent[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i in range(len(rows)):
        least[root(i)].append(rows[i][0])
    return [min((x for x in least[root(i)] if x is not None), default=None) for i in range(len(rows))]


def noisy(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(5)
    rows = [(10, None), (11, None), (12, ""), (13, ""), (14, "!!!"), (15, "one two"), (16, "One, two"), (None, "one two"), (17, "one three")]
    number = 100
    passage = [f"p{i}" for i in range(60)]
    for group in range(6):
        base = [f"g{group}x{rng.randrange(40)}" for _ in range(120 if group else 400)]
        for copy in range(40 if group == 1 else 6):
            rows.append((number, noisy(rng, base, copy % 7)))
            number += 1
    for _ in range(30):
        rows.append((number, " ".join(passage + [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))])))
        number += 1
    rows += [(number + i, rows[20][1]) for i in range(5)] + [rows[30], rows[30]]
    rng.shuffle(rows)
    return rows


def test_classes_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    found = collections.Counter((r.id, r.class_id) for r in near_dedup.near_duplicates(df).collect())
    assert found == collections.Counter(zip([i for i, _ in rows], classes(rows), strict=True))


def test_blocks_find_what_hubs_miss(spark, monkeypatch):
    """With one band of one row all texts with a common shingle meet, and the hubs alone would lose links."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rows = [(i, t) for i, t in corpus() if i is not None and i >= 100][:60]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    found = dict((r.id, r.class_id) for r in near_dedup.near_duplicates(df, bands=60, rows=1).collect())
    assert found == dict(zip([i for i, _ in rows], classes(rows), strict=True))


def test_one_of_each_keeps_columns_and_null_texts(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    kept = near_dedup.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(str(r.doc_id) for r in kept.collect())
    named = list(zip(rows, classes(rows), strict=True))
    wanted = sorted([str(i) for (i, t), _ in named if t is None] + [str(c) for c in {c for (_, t), c in named if t is not None}])
    assert got == wanted


def test_one_of_each_keeps_a_row_of_every_class_whatever_its_ids(spark):
    """Different texts with null ids, and different texts under one repeated id."""
    other = "six other words for this text"
    rows = [(None, "a b c d e f"), (None, "g h i j k l"), (None, "g h i j k l"), (7, "m n o p q r"), (7, other), (7, other), (8, other), (None, None), (None, None)]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    kept = [(r.doc_id, r.text) for r in near_dedup.one_of_each(df).collect()]
    assert collections.Counter(kept) == collections.Counter([(None, "a b c d e f"), (None, "g h i j k l"), (7, "m n o p q r"), (7, other), (None, None), (None, None)])


def test_clashing_columns_stay_as_they_are(spark):
    """Columns with the names of helpers."""
    names = ["doc_id", "text", "__none", "__row", "__text_key", "__key", "__salt", "__hot", "label", "class_id"]
    rows = [(i, t, *(f"{n}{k}" for n in names[2:])) for k, (i, t) in enumerate([(1, "a b c d e f"), (2, "a b c d e f"), (3, "other"), (None, None)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names[2:]))
    kept = near_dedup.one_of_each(df)
    assert kept.columns == names and sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)


def test_hot_hubs_and_labels_are_dealt_over_salts(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY_ROWS", 4)
    monkeypatch.setattr(common, "SALTS", 3)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    found = collections.Counter((r.id, r.class_id) for r in near_dedup.near_duplicates(df).collect())
    assert found == collections.Counter(zip([i for i, _ in rows], classes(rows), strict=True))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, None), (None, "a"), (None, "a")]])
def test_empty_and_null_tables(spark, rows):
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    assert near_dedup.near_duplicates(df).count() == len(rows)
    assert near_dedup.one_of_each(df).count() == len({t for _, t in rows if t is not None}) + sum(t is None for _, t in rows)


def test_signatures_lose_fewer_pairs_than_bands():
    """For a pair just at the threshold, the chance that too few components agree is below that of no common band."""
    n, p = near_dedup.BANDS * near_dedup.ROWS, near_dedup.THRESHOLD
    few = [k for k in range(n) if k / n < p - near_dedup.MARGIN]
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in few) < (1 - p**near_dedup.ROWS) ** near_dedup.BANDS


def test_long_texts(spark):
    long = "word " * 300_000
    df = spark.createDataFrame([(1, long, "k", 1), (2, long + "end", "k", 1), (3, "x" * 2_000_000, "k", 1)], SCHEMA)
    assert {r.id: r.class_id for r in near_dedup.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3}
