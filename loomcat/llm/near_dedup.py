"""Near-duplicate classes: BagMinHash signatures, banding, exact multiset overlap.

A text is the multiset of its five-word shingles (one shingle of all words, if it has
fewer); two texts are linked if sum(min) / sum(max) of the counts is `threshold` or more.
Each distinct shingle with count w holds the part (0, w] of a Poisson process over weight
and time, cut at the weights 1, 2, 4, ...; points of the last, cut block are thinned by
their own weight. Component i of a signature is the first point that falls in bucket i, so
two signatures agree in a component with the weighted Jaccard similarity as probability.

Candidates share a band. A bucket's least member is compared with all others (no pairs
within a bucket are emitted); buckets that still hold several classes are then compared
in pairs of blocks: first signatures alone tell which members have a close partner of
another class, then the texts of these are verified from the closest pair on while their classes
differ, and only links that join two classes leave the task. Every link is verified on the exact
multisets. A pair whose signatures agree in less than threshold - MARGIN of the components is not
verified; the chance of that at the threshold is below that of sharing no band. Joins on hubs
and labels, which may hold a third of all rows, are dealt over salts.

Defined results: equal texts, and so all empty ones, are of one class. A null text, and a
text without words that has no equal, is a class of its own; a null text's class is its own
id. class_id is the least non-null id of a class. Ids may repeat or be null. Columns of the
input other than id and text are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcat.llm.common import fresh, mapped, mix64, own_columns, slices, spread_join, text_key, written
from loomcat.llm.words import bag_overlap, shingles, weighted_overlap, word_hashes

BANDS, ROWS = 42, 6  # at similarity 0.8 a pair shares no band with probability 3e-6
THRESHOLD = 0.8
MARGIN = 0.13  # five deviations of the estimate from a signature: closer pairs are verified, a pair at 0.8 is not with probability 5e-7
BLOCK, BLOCK_WORDS = 256, 1 << 20  # members and words that a block has on average at most

TICKS = 2.0**34

_GAMMA = np.uint64(0x9E3779B97F4A7C15)


def _processes(hashes: np.ndarray, counts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Seeds, owners, rates, first weights and bounds on weight of the blocks (0, 1], (1, 2], (2, 4], ... below each count."""
    seeds, owners, rates, low, bound = [hashes], [owner], [np.ones(len(hashes))], [np.zeros(len(hashes))], [counts.astype(float)]
    level, start = 1, 1
    more = np.flatnonzero(counts > 1)
    while len(more):
        seeds.append(mix64(hashes[more] + np.array([level], dtype=np.uint64) * _GAMMA))
        owners.append(owner[more])
        rates.append(np.full(len(more), float(start)))
        low.append(np.full(len(more), float(start)))
        bound.append(counts[more].astype(float))
        level, start = level + 1, start * 2
        more = more[counts[more] > start]
    return tuple(np.concatenate(x) for x in (seeds, owners, rates, low, bound))


def bag_minhash(hashes: np.ndarray, counts: np.ndarray, owner: np.ndarray, texts: int, size: int) -> np.ndarray:
    """The signatures (texts x size, uint64) of weighted sets, given as elements, counts and owners.

    Times are whole numbers of TICKS, so that their sums don't depend on how points are grouped.
    """
    seed, doc, rate, low, bound = _processes(hashes, counts, owner)
    first = np.full(texts * size, np.iinfo(np.int64).max)
    time, point, run = np.zeros(len(seed), dtype=np.int64), 0, 1
    while len(seed):
        n = np.arange(point + 1, point + run + 1, dtype=np.uint64) * _GAMMA
        x = mix64(seed[:, None] + n[None, :])
        y = mix64(x + _GAMMA)
        gaps = -np.log(((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53)
        at = time[:, None] + np.cumsum((gaps * (TICKS / rate[:, None])).astype(np.int64), axis=1)
        bucket = ((y >> np.uint64(40)) % np.uint64(size)).astype(np.int64) + doc[:, None] * size
        weight = low[:, None] + rate[:, None] * ((y & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) * 2.0**-32
        good = weight < bound[:, None]
        np.minimum.at(first, bucket[good], at[good])
        time = at[:, -1]
        last = first.reshape(texts, size).max(axis=1)
        alive = time < last[doc]
        seed, doc, rate, low, bound, time = (v[alive] for v in (seed, doc, rate, low, bound, time))
        point += run
        run = max(run, min(64, (1 << 16) // max(1, len(seed)))) if point >= 4 else 1
    return mix64(first.view(np.uint64)).reshape(texts, size)


def _elements(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles, their counts and texts; the number of shingles of each text."""
    words, starts, _ = word_hashes(texts)
    items, begin = shingles(words, starts)
    sizes = np.diff(begin)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((items, owner))
    items, owner = items[order], owner[order]
    new = np.ones(len(items), dtype=bool)
    new[1:] = (items[1:] != items[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    return items[heads], np.diff(np.append(heads, len(items))), owner[heads], sizes


def _signed(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                items, counts, owner, sizes = _elements(part.column(2))
                signs = bag_minhash(items, counts, owner, part.num_rows, bands * rows)
                band = np.zeros((part.num_rows, bands), dtype=np.uint64)
                for r in range(rows):
                    band = mix64(band * _GAMMA + signs[:, r::rows])
                band = mix64(band + np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _GAMMA).view(np.int64)
                some = sizes > 0
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32), band[some].ravel())
                small = (signs & np.uint64(0xFF)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array([x.tobytes() for x in small], pa.binary()), lists], ["id", "key", "n", "sign", "bands"]
                )

    return run


def _close(least: float):
    """Keeps pairs whose signatures agree in so large a part of the components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
            keep = pa.array((a == b).mean(axis=1) >= least)
            yield batch.select([0, 1]).filter(keep)

    return run


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[bytes, np.ndarray] | None = None
        for batch in batches:
            a, b = [], []
            for part in slices(batch, 3):
                words, starts, _ = word_hashes(part.column(3))
                items, begin = shingles(words, starts)
                for i, key in enumerate(part.column(0).to_pylist()):
                    if known is None or known[0] != key:
                        w, s, _ = word_hashes(part.column(2).slice(i, 1))
                        known = (key, shingles(w, s)[0])
                    if weighted_overlap(known[1], items[begin[i] : begin[i + 1]]) >= threshold:
                        a.append(key)
                        b.append(part.column(1)[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return run


def _pairs(signs: np.ndarray, bands: np.ndarray, labels: list[bytes], blocks: np.ndarray, one: int, two: int, bucket: int, least: float) -> list[tuple[float, int, int]]:
    """(-agreement, i, j) of members of two blocks whose classes differ and whose signatures agree enough, in their first common band only."""
    kinds = np.unique(np.array(labels, dtype=object), return_inverse=True)[1]
    rows, close = np.flatnonzero(blocks == two), []
    for i in np.flatnonzero(blocks == one):
        other = rows[rows > i] if one == two else rows
        other = other[kinds[other] != kinds[i]]
        like = (signs[other] == signs[i]).mean(axis=1)
        for j, x in zip(other[like >= least], like[like >= least], strict=True):
            if bands[i][np.argmax(bands[i] == bands[j])] == bucket:
                close.append((-float(x), int(i), int(j)))
    return close


def _read_group(t: pa.Table) -> tuple:
    column = lambda c: t.column(c).combine_chunks()
    signs = np.frombuffer(b"".join(column("sign").to_pylist()), dtype=np.uint8).reshape(t.num_rows, -1)
    bands = np.asarray(column("bands").flatten()).reshape(t.num_rows, -1)
    return signs, bands, column("label").to_pylist(), np.asarray(column("block")), column("one")[0].as_py(), column("two")[0].as_py(), column("bucket")[0].as_py()


def _partnered(least: float):
    """Of the members in two blocks of a bucket, those with a close partner of another class."""

    def run(t: pa.Table) -> pa.Table:
        close = _pairs(*_read_group(t), least)
        found = pa.array(sorted({i for _, *pair in close for i in pair}), pa.int64())
        return t.select(["bucket", "one", "two", "key"]).take(found)

    return run


def _joined(least: float, threshold: float):
    """Links that join different classes, of members in two blocks of a bucket: close pairs are verified from the closest on, while their classes differ."""

    def run(t: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(t, sort_keys=[("key", "ascending")])
        t = t.take(order)
        group = _read_group(t)
        keys, labels = t.column("key").to_pylist(), group[2]
        words, starts, _ = word_hashes(t.column("text"))
        items, begin = shingles(words, starts)
        bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        above = {x: x for x in labels}

        def root(x: bytes) -> bytes:
            while above[x] != x:
                x = above[x] = above[above[x]]
            return x

        links = []
        for _, i, j in sorted(_pairs(*group, least)):
            a, b = root(labels[i]), root(labels[j])
            if a == b:
                continue
            for k in (i, j):
                if k not in bags:
                    bags[k] = np.unique(items[begin[k] : begin[k + 1]], return_counts=True)
            if bag_overlap(bags[i], bags[j]) >= threshold:
                above[a] = b
                links.append((min(keys[i], keys[j]), max(keys[i], keys[j])))
        return pa.table({"a": pa.array([x[0] for x in links], pa.binary()), "b": pa.array([x[1] for x in links], pa.binary())})

    return run


def row_keys(df: DataFrame, names: list[str], id_col: Column, key_col: Column) -> DataFrame:
    """df with three columns, of the given names, that tell rows by id and text, with no nulls, so that a join's partitioning serves again."""
    return df.withColumns(dict(zip(names, (id_col.isNull(), F.coalesce(id_col, F.lit(0)), key_col), strict=True)))


def components(links: DataFrame) -> DataFrame:
    """(key, label) of every end of links (a, b): label is the least key that is reached."""
    both = links.select(F.col("a").alias("key"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("key"), F.col("a").alias("other")))
    both = written(both.distinct(), "links")
    labels = written(both.groupBy("key").agg(F.min("other").alias("o")).select("key", F.least("key", "o").alias("label")), "labels")
    while True:
        seen = spread_join(both, labels.select(F.col("key").alias("other"), F.col("label").alias("l")), "other").groupBy("key").agg(F.min("l").alias("l"))
        low = written(labels.join(seen, "key").select("key", F.least("label", "l").alias("label"), F.col("label").alias("was")), "labels")
        jump = low.select(F.col("key").alias("label"), F.col("label").alias("next"))
        after = written(spread_join(low, jump, "label", "left").select("key", F.least("label", F.coalesce("next", "label")).alias("label"), "was"), "labels")
        labels = after.select("key", "label")
        if after.filter("label <> was").isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, margin: float = MARGIN
) -> DataFrame:
    """One row per row of docs: id, class_id, key, by which equal texts are told, and label, by which classes are told (null for a null text)."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    signed = mapped(base.filter("text is not null"), _signed(bands, rows), "id long, key binary, n long, sign binary, bands array<long>")
    reps = written(signed.groupBy("key").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.any_value("sign").alias("sign"), F.any_value("bands").alias("bands")), "reps")

    members = reps.select("key", F.col("n").alias("words"), F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("key").alias("hub"), F.max("key").alias("last")).filter("hub <> last").select("bucket", "hub")
    shared = written(members.join(shared, "bucket"), "buckets")
    row = ["none", "row", "text_key"]

    def texts_of(keys: DataFrame) -> DataFrame:
        """(key, text) of the keys, each once."""
        wanted = row_keys(keys.join(reps.select("key", "id"), "key"), row, F.col("id"), F.col("key")).select(*row)
        return written(row_keys(base, row, F.col("id"), F.col("key")).join(wanted, row, "left_semi").groupBy("key").agg(F.any_value("text").alias("text")), "texts")

    pairs = shared.filter("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
    side = lambda x: reps.select(F.col("key").alias(x), F.col("n").alias(f"n{x}"), F.col("sign").alias(f"s{x}"))
    pairs = spread_join(written(pairs.join(side("b"), "b"), "pairs"), side("a"), "a").filter(f"least(na, nb) >= {threshold} * greatest(na, nb)")
    pairs = written(mapped(pairs.select("a", "b", "sa", "sb"), _close(threshold - margin), "a binary, b binary"), "close")
    texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    side = lambda x: texts.select(F.col("key").alias(x), F.col("text").alias(f"t{x}"))
    pairs = spread_join(pairs.join(side("b"), "b"), side("a"), "a").select("a", "b", "ta", "tb")  # a hub's pairs stand together
    links = written(mapped(pairs, _verified(threshold), "a binary, b binary"), "links")
    labels = components(links)

    named = shared.join(labels, "key", "left").select("bucket", "key", "words", F.coalesce("label", "key").alias("label"))
    sizes = named.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    most = F.max_by(F.struct("label", "n", "w"), F.struct("n", "label"))
    mixed = sizes.groupBy("bucket").agg(most.alias("m"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.count("*").alias("labels")).filter("labels > 1 and n > 2")
    blocks = lambda n, w: F.ceil(F.greatest(n / BLOCK, w / BLOCK_WORDS))
    blocks = mixed.select("bucket", F.col("m.label").alias("most"), blocks(F.col("n") - F.col("m.n"), F.col("w") - F.col("m.w")).alias("few"), blocks(F.col("m.n"), F.col("m.w")).alias("many"))
    split = written(named.drop("words").join(blocks, "bucket"), "mixed")
    if not split.isEmpty():
        # blocks 0 to few - 1 have the smaller classes; a bucket's largest class needs no comparison with itself
        rest, signs, pair = F.col("label") != F.col("most"), reps.select("key", "sign", "bands"), ["bucket", "one", "two"]

        def dealt(members: DataFrame) -> DataFrame:
            """members once for each block that theirs is compared with."""
            out = members.withColumn("block", F.when(rest, F.pmod(F.xxhash64("key"), "few")).otherwise(F.col("few") + F.pmod(F.xxhash64("key"), "many")))
            out = out.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.when(rest, F.col("few") + F.col("many")).otherwise(F.col("few")) - 1)))
            return out.withColumns({"one": F.least("block", "with"), "two": F.greatest("block", "with")}).drop("most", "few", "many", "with")

        found = written(dealt(split.join(signs, "key")).groupBy(*pair).applyInArrow(_partnered(threshold - margin), "bucket long, one long, two long, key binary"), "partnered")
        if not found.isEmpty():
            near = dealt(split).join(found, [*pair, "key"], "left_semi").join(signs, "key").join(texts_of(found.select("key").distinct()), "key")
            more = written(near.groupBy(*pair).applyInArrow(_joined(threshold - margin, threshold), "a binary, b binary").distinct(), "links")
            if not more.isEmpty():
                labels = components(links.unionByName(more))

    classes = written(reps.join(labels, "key", "left").select("key", "id", F.coalesce("label", "key").alias("label")), "classes")
    classes = spread_join(classes.select("key", "label"), classes.groupBy("label").agg(F.min("id").alias("class_id")), "label")
    some = spread_join(base.filter("key is not null").select("id", "key"), classes, "key").select("id", "class_id", "key", "label")
    none = base.filter("key is null").select("id", F.col("id").alias("class_id"), "key", F.lit(None).cast("binary").alias("label"))
    return some.unionByName(none)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with one row of each class: that with the class's least id (any one of its repeats). All columns stay as they are, whatever their names."""
    found = near_duplicates(docs, id_col, text_col, **options)
    least = F.min(F.struct(F.col("id").isNull(), "id", "key"))
    # by label: a class_id is null for all classes without an id, and may be that of several classes if ids repeat
    kept = found.filter("key is not null").groupBy("label").agg(least.alias("r")).select("r.id", "r.key")
    row = fresh(["none", "row", "text_key"], docs)
    wanted = row_keys(kept, row, F.col("id"), F.col("key")).select(*row)
    tagged = row_keys(docs, row, F.col(id_col).cast("long"), text_key(text_col))
    once = tagged.filter(F.col(row[2]).isNotNull()).join(wanted, row, "left_semi").dropDuplicates(row)
    return once.unionByName(tagged.filter(F.col(row[2]).isNull())).select(*own_columns(docs))
