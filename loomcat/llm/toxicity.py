"""Toxicity by a chain of linear classifiers.

The categories are 0/1 columns of the label table, predicted in order; each model takes the
text's features and the probabilities of the earlier categories. In training these are
out-of-fold predictions: features are chosen and weights are fitted without the fold's rows. Features: which
words, and which first four bytes of words, a text holds, hashed; the `FEATURES` that tell a
category best are used. The models are fitted on the `sample_rows` labelled texts with the least hash of
their id (a documented bound), in the driver; counts and scores are over whole texts.

Defined results: null and empty texts get the models' base rates; without labelled rows
every probability is 0. Labels that are null for a category leave the row out. Very long texts
are read whole; a feature counts once however often it occurs. Repeated rows and ids are rows each. Ties
among features go to the lesser hash; a probability just at the threshold rejects. Columns of
the input keep their names and values, whatever they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcat.llm.common import fresh, mapped, own_columns, ship, slices
from loomcat.llm.words import word_hashes

SAMPLE = 8000
FEATURES = 2000
LEAST_DEVIATION = 3.0  # deviations by which a feature's rate in a category differs from the category's
FOLDS = 3
SPACE = 1 << 20
PREFIX = 4
CHAIN = {"low_quality": "1 - quality", "toxic": "toxic"}
THRESHOLD = 0.4


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text places and feature ids, each pair once."""
    words, starts, short = word_hashes(texts, PREFIX)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    ids = np.concatenate([words % np.uint64(SPACE), short % np.uint64(SPACE) + np.uint64(SPACE)]).astype(np.int64)
    pairs = np.unique(np.concatenate([owner, owner]) * (2 * SPACE) + ids)
    return pairs // (2 * SPACE), pairs % (2 * SPACE)


def _collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 0):
            owner, ids = text_features(part.column(0))
            begin = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(begin, pa.array(ids, pa.int32())), part.column(1)], ["ids", "y"])


def _fit(rows: np.ndarray, cols: np.ndarray, n: int, width: int, extra: np.ndarray, y: np.ndarray, penalty: float = 0.03, steps: int = 400) -> np.ndarray:
    """Weights of features, extra columns and a constant: penalised logistic loss, accelerated gradient steps."""
    size = width + extra.shape[1] + 1
    one = np.ones((n, 1))
    dense = np.hstack([extra, one])

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=w[cols], minlength=n) + dense @ w[width:]

    def back(r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(cols, weights=r[rows], minlength=width), dense.T @ r])

    v = np.ones(size)
    for _ in range(12):
        v = back(times(v))
        bound = np.linalg.norm(v)
        v /= max(bound, 1e-9)
    step = 1.0 / (0.25 * bound * 1.05 + penalty)
    w = ahead = np.zeros(size)
    for k in range(steps):
        grad = back(1 / (1 + np.exp(-np.clip(times(ahead), -30, 30))) - y) + penalty * np.append(ahead[:-1], 0)
        new = ahead - step * grad
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _chosen(rows: np.ndarray, cols: np.ndarray, width: int, labels: np.ndarray, use: np.ndarray, features: int) -> np.ndarray:
    """The places of the features that tell a category best, by the rows that may be used."""
    n, own = int(use.sum()), use[rows]
    rows, cols = rows[own], cols[own]
    seen = np.bincount(cols, minlength=width)
    best = np.zeros(width)
    for y in labels.T:
        rate = y[use].mean() if n else 0.0
        got = np.bincount(cols, weights=y[rows], minlength=width)
        best = np.maximum(best, np.abs(got - seen * rate) / np.sqrt(seen * rate * (1 - rate) + 1))
    best[(seen < 3) | (seen > n - 3)] = 0
    chosen = np.sort(np.argsort(-best, kind="stable")[:features])
    return chosen[best[chosen] >= LEAST_DEVIATION]


def _narrowed(rows: np.ndarray, cols: np.ndarray, width: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.full(width, -1)
    place[chosen] = np.arange(len(chosen))
    cols = place[cols]
    return rows[cols >= 0], cols[cols >= 0]


def fit_chain(lists: list[np.ndarray], labels: np.ndarray, features: int = FEATURES, folds: int = FOLDS) -> dict:
    """From feature ids and 0/1 labels (rows x categories): {"ids", "weights" of each category}."""
    n, kinds = labels.shape
    if not n:
        return {"ids": np.empty(0, np.int64), "weights": []}
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in lists])
    names, cols = np.unique(np.concatenate(lists), return_inverse=True)
    labels = labels.astype(float)
    fold = np.arange(n) % folds
    chosen = _chosen(rows, cols, len(names), labels, np.ones(n, dtype=bool), features)
    own_rows, own_cols = _narrowed(rows, cols, len(names), chosen)
    in_fold = []
    for f in range(folds if kinds > 1 else 0):
        best = _chosen(rows, cols, len(names), labels, fold != f, features)
        in_fold.append((len(best), *_narrowed(rows, cols, len(names), best)))
    extra, weights = np.empty((n, 0)), []
    for k in range(kinds):
        y = labels[:, k]
        weights.append(_fit(own_rows, own_cols, n, len(chosen), extra, y))
        if k + 1 < kinds:
            out = np.zeros(n)
            for f, (width, r, c) in enumerate(in_fold):
                use = fold != f
                train, number = use[r], np.cumsum(use) - 1
                w = _fit(number[r[train]], c[train], int(use.sum()), width, extra[use], y[use])
                z = np.bincount(r, weights=w[c], minlength=n) + np.hstack([extra, np.ones((n, 1))]) @ w[width:]
                out[~use] = 1 / (1 + np.exp(-z[~use]))
            extra = np.hstack([extra, _logit(out)[:, None]])
    return {"ids": names[chosen], "weights": weights}


def rows_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column, as views of its buffers."""
    out = []
    for chunk in column.chunks:
        offsets, values = np.asarray(chunk.offsets), np.asarray(chunk.values)
        out += [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return out


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: dict[str, str] = CHAIN, sample_rows: int = SAMPLE, features: int = FEATURES) -> dict:
    marks = labels.select(F.col(id_col).alias("i"), F.array(*[F.expr(x).cast("int") for x in chain.values()]).alias("y"))
    marks = marks.filter(F.col("i").isNotNull() & ~F.exists("y", lambda v: v.isNull()))
    first = marks.withColumn("h", F.xxhash64("i")).orderBy("h", "i", "y").limit(sample_rows).select("i", "y")
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("text"))
    got = mapped(texts.join(F.broadcast(first), "i").select("text", "y"), _collected, "ids array<int>, y array<int>").toArrow()
    lists, marks = rows_of(got.column("ids")), rows_of(got.column("y"))
    del got
    order = sorted(range(len(lists)), key=lambda i: (len(lists[i]), lists[i].tobytes()))  # rows arrive in any order
    marks = np.array(marks, dtype=np.int64).reshape(len(lists), len(chain))
    return fit_chain([lists[i] for i in order], marks[order], features) | {"names": list(chain)}


def scorer(model: dict) -> Callable[[pa.Array], np.ndarray]:
    """A function from texts to probabilities (texts x categories)."""
    ids, weights = model["ids"], model["weights"]
    place = np.full(2 * SPACE, -1, dtype=np.int32)
    place[ids] = np.arange(len(ids))

    def score(texts: pa.Array) -> np.ndarray:
        out = np.zeros((len(texts), len(model["names"])))
        if not weights:
            return out
        words, starts, short = word_hashes(texts, PREFIX)
        owner = np.repeat(np.arange(len(texts)), np.diff(starts))
        cols = np.concatenate([place[(words % np.uint64(SPACE)).astype(np.int64)], place[(short % np.uint64(SPACE)).astype(np.int64) + SPACE]])
        hit = cols >= 0
        pairs = np.unique(np.concatenate([owner, owner])[hit] * len(ids) + cols[hit])
        rows, cols = pairs // max(1, len(ids)), pairs % max(1, len(ids))
        for k, w in enumerate(weights):
            z = np.bincount(rows, weights=w[cols], minlength=len(texts)) + _logit(out[:, :k]) @ w[len(ids) : len(ids) + k] + w[-1]
            out[:, k] = 1 / (1 + np.exp(-z))
        return out

    return score


def probabilities(docs: DataFrame, model: dict, text_col: str = "text") -> Column:
    """A struct with a probability for each category."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    state: dict = {}
    names = model["names"]

    @F.arrow_udf(", ".join(f"`{x}` double" for x in names))
    def udf(texts: pa.Array) -> pa.Array:
        if "score" not in state:
            state["score"] = scorer(sent.value)
        parts = [state["score"](p.column(0)) for p in slices(pa.RecordBatch.from_arrays([texts], ["t"]), 0)]
        found = np.vstack(parts) if parts else np.empty((0, len(names)))
        return pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(names))], names)

    return udf(F.col(text_col).cast("string"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per row of docs: id, p_<category> of each, and the last category as a boolean (its probability reaches the threshold)."""
    model = learn(docs, labels, id_col, text_col, **options)
    names = model["names"]
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("p", probabilities(docs, model))
    return found.select("id", *[F.col("p")[x].alias(f"p_{x}") for x in names], (F.col("p")[names[-1]] >= threshold).alias(names[-1]))


def kept(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are not rejected."""
    (told,) = fresh(["told"], docs)
    return docs.withColumn(told, probabilities(docs, model, text_col)).filter(F.col(told)[model["names"][-1]] < threshold).select(*own_columns(docs))
