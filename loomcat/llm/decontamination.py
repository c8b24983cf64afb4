"""Benchmark decontamination: SimHash of item-sized windows, multi-index blocks, exact check.

A window of a document has as many words as a benchmark item; for an item that is longer than the
document, the whole document is the one window. A window's fingerprint has 64
signs of the summed hashes of its five-word shingles. The items' fingerprints are indexed by
four blocks of 16 bits; a window looks up all values within `radius // 4` bits of each of its
blocks, so that by the pigeonhole principle every item of its size within `radius` bits is found. What is
found is verified: the overlap of the two shingle multisets must reach `threshold`.

Documents are read once, whatever the benchmark: a filter of bounded size over the benchmark's shingles tells
the regions of a text, which are all windows of any size at least half of whose shingles the filter has.
A window that reaches the threshold has eight of nine, so this loses nothing. Only the regions go on, each once for equal texts,
and they meet the items in parts: an item's part is told by its hash, and a region goes to the parts that hold
some of its shingles. Parts with many regions are dealt over blocks. Nothing of the benchmark but the filter is at
the driver.

Defined results: null texts, texts of fewer than five words and items of fewer than five
words are in no pair. Equal items are each reported. Repeated ids are reported once; of equal texts under one id
windows count once. Very long texts are read whole. Columns of the documents keep their names and values, whatever they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcat.llm.common import fresh, mapped, mix64, own_columns, slices, spread_join, text_key, written
from loomcat.llm.words import SHINGLE, bag_overlap, shingles, word_hashes

THRESHOLD = 0.8
RADIUS = 19  # two multisets with overlap 0.8 differ in 9.7 of 64 bits on average, with deviation 2.9
LOAD, MOST_BITS = 32, 1 << 27  # bits of the filter for each shingle of the benchmark, and bits at most: a fuller filter only makes regions longer
PART_SHINGLES = 1 << 20  # shingles of the items in a part
BLOCK_ROWS, BLOCK_SHARE = 256, 400  # regions of a part that meet in one task, at least, and one for so many of the part's shingles
REGION = 1 << 15  # windows that are fingerprinted at once
BROADCAST_KEYS = 1 << 20  # keys of 16 bytes

ITEMS = "item_id long, n int, runs array<long>, part int"
REGIONS = "id long, key binary, first long, whole boolean, runs array<long>"
MATCHES = "key binary, item_id long, first_word long, n_words long, similarity double"

_BITS = np.arange(1 << 16, dtype=np.uint32)
_BITS = _BITS[np.argsort(np.bitwise_count(_BITS), kind="stable")]


def fingerprints(items: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The 64-bit fingerprints of the windows of `size` shingles from each of the starts on."""
    bits = np.unpackbits(items.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(items) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    more = 2 * (sums[starts + size] - sums[starts]) > size
    return np.packbits(more, axis=1, bitorder="little").view(np.uint64).ravel()


class Index:
    """Items by id: bags of shingles, sizes, and by size the blocks of their fingerprints."""

    def __init__(self, ids: list, runs: list[np.ndarray], threshold: float = THRESHOLD, radius: int = RADIUS):
        self.ids, self.threshold, self.radius = ids, threshold, radius
        self.bags = [np.unique(r, return_counts=True) for r in runs]
        self.sizes = np.array([len(r) for r in runs], dtype=np.int64)
        self.prints = np.array([fingerprints(r, np.zeros(1, dtype=np.int64), len(r))[0] for r in runs], dtype=np.uint64)
        self.near = _BITS[np.bitwise_count(_BITS) <= radius // 4]
        self.blocks: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for size in np.unique(self.sizes).tolist():
            own, tables = np.flatnonzero(self.sizes == size), []
            for b in range(4):
                value = ((self.prints[own] >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint32)
                order = np.argsort(value, kind="stable")
                names, begin = np.unique(value[order], return_index=True)
                tables.append((names, np.append(begin, len(own)), own[order]))
            self.blocks[size] = tables
        flat = np.concatenate([*runs, np.empty(0, dtype=np.uint64)])
        size = np.repeat(self.sizes, self.sizes)
        order = np.lexsort((size, flat))
        flat, size = flat[order], size[order]
        new = np.ones(len(flat), dtype=bool)
        new[1:] = (flat[1:] != flat[:-1]) | (size[1:] != size[:-1])
        flat, self.holders = flat[new], size[new]  # the sizes of the items that hold a shingle, in the order of shingles
        self.shingles, begin = np.unique(flat, return_index=True)
        self.holds = np.append(begin, len(flat))

    def within(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items of that size whose fingerprints are within the radius."""
        windows, items = [], []
        for b, (names, begin, own) in enumerate(self.blocks[size]):
            value = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint32)
            if len(names) <= len(self.near):  # fewer full buckets than values within reach: the buckets are gone through
                w, k = np.nonzero(np.bitwise_count(value[:, None] ^ names[None, :]) <= self.radius // 4)
            else:
                probe = value[:, None] ^ self.near[None, :]
                at = np.minimum(np.searchsorted(names, probe), len(names) - 1)
                w, hit = np.nonzero(names[at] == probe)
                k = at[w, hit]
            count = begin[k + 1] - begin[k]
            windows.append(np.repeat(w, count))
            items.append(own[np.repeat(begin[k] - np.cumsum(count) + count, count) + np.arange(count.sum())])
        w, i = np.concatenate(windows), np.concatenate(items)
        close = np.bitwise_count(prints[w] ^ self.prints[i]) <= self.radius
        found = np.unique(w[close] * len(self.ids) + i[close])
        return found // len(self.ids), found % len(self.ids)

    def matches(self, runs: np.ndarray, whole: bool) -> Iterator[tuple[int, int, int, float]]:
        """(item, first shingle, shingles, similarity) of all windows of a region that reach the threshold. whole: the region is all of its text."""
        at = np.minimum(np.searchsorted(self.shingles, runs), max(0, len(self.shingles) - 1))
        hit = self.shingles[at] == runs if len(self.shingles) else np.zeros(len(runs), dtype=bool)
        if not hit.any():
            return
        spots = np.unique(at[hit])
        sizes = np.unique(np.concatenate([self.holders[self.holds[s] : self.holds[s + 1]] for s in spots]))
        sums = np.concatenate([[0], np.cumsum(hit)])
        for size in sizes.tolist():
            n = min(size, len(runs))
            if size > len(runs) and not (whole and n >= self.threshold * size):
                continue
            windows = np.flatnonzero(2 * (sums[n:] - sums[: len(sums) - n]) >= n)
            yield from self._checked(runs, windows, n, size)

    def _checked(self, runs: np.ndarray, windows: np.ndarray, n: int, size: int) -> Iterator[tuple[int, int, int, float]]:
        while len(windows):
            base = windows[0]
            part = windows[windows < base + REGION]
            windows = windows[len(part) :]
            prints = fingerprints(np.ascontiguousarray(runs[base : part[-1] + n]), part - base, n)
            for i in range(0, len(part), 256):
                for w, item in zip(*self.within(prints[i : i + 256], size), strict=True):
                    first = int(part[i + w])
                    score = bag_overlap(np.unique(runs[first : first + n], return_counts=True), self.bags[item])
                    if score >= self.threshold:
                        yield int(item), first, n, score


def _itemized(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                words, starts, _ = word_hashes(part.column(1))
                runs, begin = shingles(words, starts, short_texts=False)
                n = np.diff(begin)
                some = np.flatnonzero(n)
                where = np.array([int(mix64(np.bitwise_xor.reduce(runs[begin[i] : begin[i + 1]], keepdims=True))[0] % np.uint64(parts)) for i in some], dtype=np.int32)
                lists = pa.ListArray.from_arrays(np.append(begin[some], begin[-1]).astype(np.int32), pa.array(runs.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(some)), pa.array(n[some], pa.int32()), lists, pa.array(where, pa.int32())], ["item_id", "n", "runs", "part"])

    return run


def benchmark_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """ITEMS: those that have a shingle, each in a part that its shingles tell."""
    rows = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0  # at least as many as shingles
    return written(mapped(rows, _itemized(max(1, -(-total // PART_SHINGLES))), ITEMS), "items")


def _probes(runs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return runs & np.uint64(bits - 1), mix64(runs ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(bits - 1)


def _set_bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.zeros(bits // 64, dtype=np.uint64)
        for batch in batches:
            runs = np.asarray(batch.column(0).flatten()).view(np.uint64)
            for place in _probes(runs, bits):
                np.bitwise_or.at(mark, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        full = np.flatnonzero(mark)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(mark[full].view(np.int64))], ["word", "bits"])

    return run


def shingle_filter(items: DataFrame, total: int) -> np.ndarray:
    """The bits of the items' shingles, as words of 64; at most MOST_BITS."""
    bits = min(MOST_BITS, 1 << max(16, (LOAD * total - 1).bit_length()))
    got = mapped(items.select("runs"), _set_bits(bits), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    mark = np.zeros(bits // 64, dtype=np.uint64)
    mark[np.asarray(got.column("word"))] = np.asarray(got.column("bits")).view(np.uint64)
    return mark


def spans(hit: np.ndarray) -> list[tuple[int, int]]:
    """The runs of places that lie in any stretch with as many hits as misses at least."""
    sums = np.concatenate([[0], np.cumsum(np.where(hit, 1, -1))])
    low, high = np.minimum.accumulate(sums[:-1]), np.maximum.accumulate(sums[:0:-1])[::-1]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (high >= low).astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _found_regions(sent, least: int, threshold: float):
    """Regions that can hold a window of the least item's size, or all of a text that can be one."""
    short = max(1, int(np.ceil(threshold * least)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = sent.value
        bits = 64 * len(mark)
        for batch in batches:
            for part in slices(batch, 2):
                words, starts, _ = word_hashes(part.column(2))
                runs, begin = shingles(words, starts, short_texts=False)
                hit = np.ones(len(runs), dtype=bool)
                for place in _probes(runs, bits):
                    hit &= (mark[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
                count = np.concatenate([[0], np.cumsum(hit)])
                rows, first, whole, lists = [], [], [], []
                for i in np.flatnonzero(count[begin[1:]] - count[begin[:-1]] >= (short + 1) // 2):
                    own = slice(begin[i], begin[i + 1])
                    for a, b in spans(hit[own]):
                        full = b - a == begin[i + 1] - begin[i]
                        if b - a >= (short if full else least):
                            rows.append(i)
                            first.append(a)
                            whole.append(full)
                            lists.append(runs[begin[i] + a : begin[i] + b])
                at = pa.array(rows, pa.int64())
                flat = np.concatenate([*lists, np.empty(0, np.uint64)])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(first, pa.int64()), pa.array(whole, pa.bool_()), pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64)))], ["id", "key", "first", "whole", "runs"]
                )

    return run


def _matched(threshold: float, radius: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            lists = lambda t: [np.asarray(x.values).view(np.uint64) for x in t.column("runs")]
            index = Index(right.column("item_id").to_pylist(), lists(right), threshold, radius)
            for key, first, whole, runs in zip(left.column("key").to_pylist(), left.column("first").to_pylist(), left.column("whole").to_pylist(), lists(left), strict=True):
                rows += [(key, index.ids[item], first + at, n + SHINGLE - 1, score) for item, at, n, score in index.matches(runs, whole)]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table({x.split()[0]: pa.array([r[k] for r in rows], kinds[k]) for k, x in enumerate(MATCHES.split(", "))})

    return run


def regions(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """REGIONS of the documents, which are read once."""
    spark = docs.sparkSession
    total, least = items.agg(F.sum("n"), F.min("n")).first()
    if not total:
        return spark.createDataFrame([], REGIONS)
    sent = spark.sparkContext.broadcast(shingle_filter(items, total))
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return written(mapped(rows, _found_regions(sent, least, threshold), REGIONS), "regions")


def matches(found: DataFrame, items: DataFrame, threshold: float, radius: int) -> DataFrame:
    """MATCHES of the regions, each once for equal texts."""
    once = found.drop("id").dropDuplicates(["key", "first"])
    sizes = items.groupBy("part").agg(F.sum("n").alias("shingles"))
    if sizes.count() > 1:
        held = items.select("part", F.explode("runs").alias("s")).distinct()
        routes = spread_join(once.select("key", "first", F.explode(F.array_distinct("runs")).alias("s")), held, "s").select("key", "first", "part").distinct()
        once = once.join(routes, ["key", "first"])
    else:
        once = once.withColumn("part", F.lit(0))
    once = written(once, "routed")
    rows = F.greatest(F.lit(BLOCK_ROWS), F.col("shingles") / BLOCK_SHARE)
    dealt = written(once.groupBy("part").agg(F.count("*").alias("n")).join(sizes, "part").select("part", F.ceil(F.col("n") / rows).alias("blocks")), "dealt")  # a row for each part
    left = once.join(F.broadcast(dealt), "part").withColumn("block", F.pmod(F.xxhash64("key", "first"), "blocks")).drop("blocks")
    right = items.join(F.broadcast(dealt), "part").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    return left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(_matched(threshold, radius), MATCHES)


def contaminations(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, radius: int = RADIUS
) -> DataFrame:
    """One row per (id, item_id) with a window that matches: the best window's first word, its words, the similarity, and the number of windows."""
    items = benchmark_items(benchmark, item_id, item_text)
    found = regions(docs, items, id_col, text_col, threshold)
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("f"), "n_words"))
    pairs = written(matches(found, items, threshold, radius).groupBy("key", "item_id").agg(best.alias("b"), F.count("*").alias("w")), "pairs")
    owners = found.select("id", "key").distinct()
    pairs = spread_join(owners, pairs, "key").groupBy("id", "item_id").agg(F.max("b").alias("b"), F.sum("w").alias("n_windows"))
    return pairs.select("id", "item_id", (-F.col("b.f")).alias("first_word"), "b.n_words", "b.similarity", "n_windows")


def kept(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """The rows of docs without a window that matches an item."""
    items = benchmark_items(benchmark, item_id, item_text)
    (none, key) = fresh(["none", "key"], docs)
    found = regions(docs.withColumn(none, F.lit(None).cast("long")), items, none, text_col, threshold)
    bad = written(matches(found, items, threshold, radius).select(F.col("key").alias(key)).distinct(), "contaminated")
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_KEYS else bad
    return docs.withColumn(key, text_key(text_col)).join(bad, key, "left_anti").select(*own_columns(docs))
