"""Exact top-k by inner product with a pivot-distance index.

Every component x becomes the integer floor(256 x). A last component makes all vectors equally
long (M, the greatest length), so that the order of inner products with a query is the order
of distances from it. Vectors are keyed by (nearest pivot, distance from it) and range-sorted
into segments; a segment's part of one pivot is an annulus. By the triangle inequality no
vector of an annulus [low, high] is nearer to a query at distance d from the pivot than
max(0, low - d, d - high). Each query first searches its nearest annuli until they hold k
vectors, which bounds its k-th distance; then it searches all others that the bound does not
rule out, and in them the distances that it does not rule out. Pivots are chosen on a bounded
sample; the index holds every row, and the results are exact.

Annuli are at most MAX_SEGMENTS + PIVOTS, so their bounds can be broadcast. Many queries of one
annulus are dealt in blocks, and the vectors of an annulus that has more than MOST_ROWS in chunks, so that no task holds
more than a block and a chunk, however many vectors there are.

Defined results: vectors that are null or empty or hold null or non-finite components take no
part. Shorter vectors count as padded with zeros. Every row is a candidate, and a query if its id is one: rows of a repeated id
are told apart, each answers for itself and may be found by the others. A row with a null id may be found, but is no
query. Ties go to the lesser id, nulls last. Columns other than id and vector aren't looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcat.llm.common import mapped, written

PIVOTS, SAMPLE = 64, 4096
SEGMENT_ROWS, MAX_SEGMENTS = 2048, 1 << 16
QUERY_BLOCK, MOST_ROWS = 1024, 1 << 16
EXACT = 2**53
FOUND = "q long, found long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    good = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(good).select("id", F.transform("v", lambda x: F.floor(x * 256).cast("long")).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of numbers, padded with zeros to the width."""
    offsets = np.asarray(column.offsets)
    flat = np.asarray(column.values)[offsets[0] : offsets[-1]] if len(column) else np.empty(0, np.int64)
    sizes = np.diff(offsets)
    out = np.zeros((len(column), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    if len(a) and len(b) and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def choose_pivots(points: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Means of clusters, from points spread over the sample."""
    if not len(points):
        return points
    pivots = np.unique(points[:: max(1, len(points) // count)][:count], axis=0)
    for _ in range(rounds):
        near = ((points**2).sum(1)[:, None] - 2 * points @ pivots.T + (pivots**2).sum(1)[None, :]).argmin(1)
        pivots = np.array([points[near == i].mean(0) if (near == i).any() else pivots[i] for i in range(len(pivots))])
    return pivots


def _raised(x: np.ndarray, longest: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(longest - (x**2).sum(1), 0.0))[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)[None, :], 0.0))


def _keyed(sent, width: int, longest: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = _distances(_raised(matrix(b.column(2), width), longest), sent.value)
            near = d.argmin(1) if b.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(near, pa.int32()), pa.array(d[np.arange(len(near)), near], pa.float64())], ["row", "id", "v", "pivot", "far"])

    return run


def _routes(sent, width: int, k: int, first: bool, slack: float) -> Callable:
    """From queries (row, v[, limit, least]) to the annuli that they search: those nearest that hold k + 1 vectors, or the others within the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, pivot, low, high, size, number = sent.value
        for b in batches:
            q = matrix(b.column(1), width).astype(np.float64)
            d = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)[:, pivot]
            bound = np.maximum(np.maximum(low[None, :] - d, d - high[None, :]), 0.0)
            rows, cols = [], []
            for i in range(len(q)):
                order = np.lexsort((np.abs(d[i] - (low + high) / 2), bound[i]))
                enough = int(np.searchsorted(np.cumsum(size[order]), k + 1)) + 1
                if first:
                    cols.append(order[:enough])
                else:
                    rest = order[enough:]
                    cols.append(rest[bound[i][rest] <= b.column(2)[i].as_py() + slack])
                rows.append(np.full(len(cols[-1]), i))
            row = np.concatenate(rows) if rows else np.empty(0, np.int64)
            col = np.concatenate(cols) if cols else np.empty(0, np.int64)
            at = pa.array(row, pa.int64())
            limit, least = (b.column(2).take(at), b.column(3).take(at)) if not first else (pa.nulls(len(row), pa.float64()), pa.nulls(len(row), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), limit, least, pa.array(number[col], pa.int64()), pa.array(d[row, col], pa.float64())], ["q", "qv", "limit", "least", "annulus", "away"])

    return run


def _searched(width: int, k: int, slack: float) -> Callable:
    """The k best of an annulus for each of its queries, without what a query's limit rules out."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in FOUND.split(", ")]
        empty = pa.table({n: pa.array([], pa.int64()) for n in names})
        if not left.num_rows or not right.num_rows:
            return empty
        column = lambda t, c: t.column(c).combine_chunks()
        far = np.asarray(column(right, "far"))
        order = np.argsort(far, kind="stable")
        far = far[order]
        away, limit = np.asarray(column(left, "away")), np.asarray(column(left, "limit").fill_null(np.inf))
        begin = int(np.searchsorted(far, (away - limit - slack).min()))
        end = int(np.searchsorted(far, (away + limit + slack).max(), side="right"))
        order = order[begin:end]
        rows, ids = np.asarray(column(right, "row"))[order], column(right, "id").take(pa.array(order))
        none, ids = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0))
        x, q = matrix(column(right, "v"), width)[order], matrix(column(left, "qv"), width)
        own, least = np.asarray(column(left, "q")), np.asarray(column(left, "least").fill_null(np.iinfo(np.int64).min))
        out: list[tuple] = []
        for at in range(0, len(q), 256):
            s = products(q[at : at + 256], x)
            for i in range(len(s)):
                good = np.flatnonzero((rows != own[at + i]) & (s[i] >= least[at + i]))
                best = good[np.lexsort((rows[good], ids[good], none[good], -s[i][good]))[:k]]
                out += [(own[at + i], rows[j], None if none[j] else int(ids[j]), s[i][j]) for j in best]
        if not out:
            return empty
        return pa.table({n: pa.array([None if r[c] is None else int(r[c]) for r in out], pa.int64()) for c, n in enumerate(names)})

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "found")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, seen: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score. is_query: a condition on the column `id`. seen: gets the numbers of queries, vectors and annuli, of searches of an annulus, and of vectors in them."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vector_col).select(F.monotonically_increasing_id().alias("row"), "id", "v")
    rows = written(rows, "vectors")  # numbered once, so that a row's number stays
    empty = "query_id long, rank int, vec_id long, score long"
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    count, width, longest = rows.agg(F.count("*"), F.max(F.size("v")), F.max(norm)).first()
    if not count:
        return spark.createDataFrame([], empty)
    sample = rows.orderBy(F.xxhash64("id", "v"), "id", "v").limit(SAMPLE).toArrow().column("v").combine_chunks()
    points = spark.sparkContext.broadcast(choose_pivots(_raised(matrix(sample, width), longest), pivots))
    slack = 1e-6 * max(1.0, longest) ** 0.5

    keyed = mapped(rows, _keyed(points, width, longest), "row long, id long, v array<long>, pivot int, far double")
    parts = min(MAX_SEGMENTS, max(1, -(-count // SEGMENT_ROWS)))
    index = keyed.repartitionByRange(parts, "pivot", "far", "row").withColumn("annulus", F.spark_partition_id().cast("long") * (1 << 16) + F.col("pivot"))
    index = written(index, "annuli")
    rings = index.groupBy("annulus", "pivot").agg(F.min("far").alias("low"), F.max("far").alias("high"), F.count("*").alias("n")).orderBy("annulus").toArrow()
    bounds = [np.asarray(rings.column(c)) for c in ("pivot", "low", "high", "n", "annulus")]
    sent = spark.sparkContext.broadcast((points.value, *bounds))
    sizes = spark.createDataFrame(pa.table({"annulus": rings.column("annulus"), "chunks": pa.array(-(-bounds[3] // MOST_ROWS), pa.int64()), "n": rings.column("n")}))

    def searched(routes: DataFrame) -> DataFrame:
        routes = written(routes, "routes")
        blocks = routes.groupBy("annulus").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("blocks"), F.count("*").alias("queries"))
        dealt = written(blocks.join(sizes, "annulus"), "dealt")  # a row for each annulus at most
        if seen is not None:
            got = dealt.agg(F.sum("queries").alias("searches"), F.sum(F.col("queries") * F.col("n")).alias("compared")).first()
            seen["searches"], seen["compared"] = seen.get("searches", 0) + (got.searches or 0), seen.get("compared", 0) + (got.compared or 0)
        upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        dealt = dealt.drop("queries", "n")
        left = routes.join(F.broadcast(dealt), "annulus").withColumn("block", F.pmod(F.xxhash64("q"), "blocks")).withColumn("chunk", upto("chunks")).drop("blocks", "chunks")
        right = index.join(F.broadcast(dealt), "annulus").withColumn("chunk", F.pmod(F.xxhash64("row"), "chunks")).withColumn("block", upto("blocks")).drop("blocks", "chunks", "pivot")
        key = ["annulus", "block", "chunk"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_searched(width, k, slack), FOUND)

    schema = "q long, qv array<long>, limit double, least long, annulus long, away double"
    queries = rows.filter(is_query & F.col("id").isNotNull())
    first = written(_best(searched(mapped(queries.select("row", "v"), _routes(sent, width, k, True, slack), schema)), k), "first")
    last = first.groupBy("q").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    last = queries.join(last, queries["row"] == last["q"], "left").withColumn("least", F.when(F.col("n") >= k, F.col("least")))
    own = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    limit = F.when(F.col("least").isNull(), F.lit(float("inf"))).otherwise(F.sqrt(F.greatest(F.lit(0.0), own + F.lit(longest) - F.lit(2.0) * F.col("least"))))
    rest = mapped(last.select("row", "v", limit.alias("limit"), "least"), _routes(sent, width, k, False, slack), schema)
    found = _best(first.select("q", "found", "vec_id", "score").unionByName(searched(rest)), k)
    if seen is not None:
        seen |= {"vectors": count, "queries": queries.count(), "annuli": len(bounds[0])}
    named = queries.select(F.col("row").alias("q"), F.col("id").alias("query_id"))
    return found.join(named, "q").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
