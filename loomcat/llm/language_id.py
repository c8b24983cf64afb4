"""Language ID by word-first backoff.

A word that the model knows scores by its log frequency in each language; an unseen word by
the longest order of character n-grams (5 to 1, with the word's borders) of which the model
knows at least half. A text's score is the sum over its words. The model is counted on a
bounded sample: of each language the `per_language` labelled texts with the least hash of
their id and text, equal rows once; whole texts are counted and whole texts are scored. Words and
n-grams are looked up by 64-bit hashes, all words of a batch at once.

A word is a run of letters, with the marks that follow them, in lower case; texts that are learned and
texts that are scored are cut by the same function.

Defined results: a null text, and one without a letter, is `und` with score 0; so is every
text if nothing could be learned. Ties go to the first language by name. Null ids are never
learned from and are not held out. Repeated rows are rows each. Very long texts are read whole. Columns of the
input keep their names and values, whatever they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcat.llm.common import fresh, mapped, mix64, own_columns, ship, slices

UNKNOWN = "und"
PER_LANGUAGE = 700
ORDERS = (5, 4, 3, 2, 1)
SPARE = 1.5  # times as many rows as wanted pass the first cut by hash, and 200 more
BORDER = r"(?:\A|[^\p{L}\p{M}]+)\p{M}+|[^\p{L}\p{M}]+"
EVIDENCE = 20.0  # words from which on the score grows no surer

_BASE = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """(lang, text) of at most per_language labelled texts of each language.

    Rows are cut by a threshold of their hash before any meet, so what meets for a language has a size that does not grow.
    """
    rows = docs.filter(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    part = lambda n: min(1.0, (SPARE * per_language + 200) / n)
    cuts = [x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(2**63 - 1, int(part(n) * 2**64) - 2**63)))]
    some = rows.filter(F.col("h") <= F.create_map(*cuts)[F.col("lang")]) if cuts else rows.limit(0)
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return some.dropDuplicates(["lang", "h"]).withColumn("r", order).filter(F.col("r") <= per_language).select("lang", "text")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and where each text's words begin (one more at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), BORDER, " ")
    lists = pc.split_pattern(pc.utf8_trim(plain, " "), " ")
    words, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    full = np.asarray(pc.binary_length(words)) > 0  # an empty text has one empty piece
    return words.filter(pa.array(full)), np.concatenate([[0], np.cumsum(full)])[offsets - offsets[0]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            words, begin = words_of(part.column(1))
            langs = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), np.diff(begin))))
            got = pa.table({"lang": langs, "word": words.cast(pa.string())}).group_by(["lang", "word"]).aggregate([([], "count_all")])
            yield from got.select(["lang", "word", "count_all"]).rename_columns(["lang", "word", "n"]).cast(pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])).combine_chunks().to_batches()


def _chars(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words with their borders, the place of each one's word, and its place within the word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    points = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    return points, owner, np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _BASE, dtype=np.uint64))


def word_keys(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not words:
        return np.empty(0, np.uint64)
    points, _, place = _chars(words)
    return mix64(np.add.reduceat(mix64(points + _BASE) * _powers(int(place.max()) + 1)[place], np.flatnonzero(place == 0)))


def gram_keys(chars: tuple[np.ndarray, np.ndarray, np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of an order, and the words that they are of."""
    points, owner, _ = chars
    if len(points) < order:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.arange(len(points) - order + 1)
    first = first[owner[first] == owner[first + order - 1]]
    total = np.zeros(len(first), dtype=np.uint64)
    for j, p in enumerate(_powers(order)):
        total += mix64(points[first + j] + _BASE) * p
    return mix64(total + np.uint64(order)), owner[first]


def _logs(keys: np.ndarray, langs: np.ndarray, counts: np.ndarray, kinds: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of what occurs often enough, and its logs of frequencies in each language."""
    names, place = np.unique(keys, return_inverse=True)
    every = np.bincount(place * kinds + langs, weights=counts, minlength=len(names) * kinds).reshape(len(names), kinds)
    names, every = names[every.sum(axis=1) >= least], every[every.sum(axis=1) >= least]
    return names, np.log((every + 0.5) / (every.sum(axis=0) + 0.5 * len(names))) if len(names) else every


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> dict:
    """Log frequencies: {"langs", "words", "grams" by order}, each as sorted hashes and a table of languages' logs."""
    words = mapped(sample(docs, id_col, text_col, lang_col, per_language).select("lang", "text"), _counted, "lang string, word string, n long")
    counted = words.groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counted.column("lang").to_pylist()))
    place = {x: i for i, x in enumerate(langs)}
    own = np.array([place[x] for x in counted.column("lang").to_pylist()], dtype=np.int64)
    names, counts = counted.column("word").to_pylist(), np.asarray(counted.column("n"), dtype=np.float64)
    chars = _chars(names)
    grams = {}
    for k in ORDERS:
        keys, owner = gram_keys(chars, k)
        grams[k] = _logs(keys, own[owner], counts[owner], len(langs), 3)
    return {"langs": langs, "words": _logs(word_keys(names), own, counts, len(langs), 2), "grams": grams}


def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the hashes a table has, and their rows."""
    names = table[0]
    at = np.minimum(np.searchsorted(names, keys), max(0, len(names) - 1))
    return (names[at] == keys if len(names) else np.zeros(len(keys), dtype=bool)), at


def known(table: tuple[np.ndarray, np.ndarray], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return _found(table, word_keys(words))


def word_scores(model: dict, words: list[str]) -> np.ndarray:
    """The logs of each word (words x languages): zeros where no order of n-grams is known."""
    out = np.zeros((len(words), len(model["langs"])))
    has, at = known(model["words"], words)
    out[has] = model["words"][1][at[has]]
    rest = np.flatnonzero(~has)
    for k in ORDERS:
        if not len(rest):
            break
        keys, owner = gram_keys(_chars([words[i] for i in rest]), k)
        has, at = _found(model["grams"][k], keys)
        windows, hits = np.bincount(owner, minlength=len(rest)), np.bincount(owner[has], minlength=len(rest))
        good = (hits > 0) & (2 * hits >= windows)
        rows = model["grams"][k][1][at[has]]
        for x in range(out.shape[1] if good.any() else 0):
            out[rest[good], x] = (np.bincount(owner[has], weights=rows[:, x], minlength=len(rest)) / np.maximum(hits, 1))[good]
        rest = rest[~good]
    return out


def scorer(model: dict) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function from texts to the language's place (-1: unknown) and the score."""
    count = len(model["langs"])

    def score(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, begin = words_of(texts)
        seen = np.diff(begin)
        if not count:
            return np.full(len(texts), -1), np.zeros(len(texts))
        coded = words.dictionary_encode()
        table = word_scores(model, coded.dictionary.to_pylist())
        codes, sums, filled = np.asarray(coded.indices), np.zeros((len(texts), count)), np.flatnonzero(seen)
        for x in range(count if len(filled) else 0):
            sums[filled, x] = np.add.reduceat(table[:, x][codes], begin[:-1][filled])
        logs = sums * (np.minimum(seen, EVIDENCE) / np.maximum(seen, 1))[:, None]
        odds = np.exp(logs - logs.max(axis=1, keepdims=True))
        best = odds.argmax(axis=1)
        return np.where(seen > 0, best, -1), np.where(seen > 0, odds.max(axis=1) / odds.sum(axis=1), 0.0)

    return score


def predicted(docs: DataFrame, model: dict, text_col: str = "text") -> Column:
    """A struct (lang_pred, score) for each row's whole text."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    state: dict = {}

    @F.arrow_udf("lang_pred string, score double")
    def udf(texts: pa.Array) -> pa.Array:
        if "score" not in state:
            state["score"] = scorer(sent.value)
        names = np.array([*sent.value["langs"], UNKNOWN], dtype=object)
        langs, scores = [], []
        for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), 0):
            best, value = state["score"](part.column(0))
            langs.append(best)
            scores.append(value)
        best = np.concatenate(langs) if langs else np.empty(0, int)
        return pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["lang_pred", "score"])

    return udf(F.col(text_col).cast("string"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per row of docs: id, held_out, lang_pred, score."""
    model = learn(docs, id_col, text_col, lang_col, per_language)
    found = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return found.withColumn("p", predicted(found, model)).select("id", "held_out", "p.lang_pred", "p.score")


def kept(docs: DataFrame, model: dict, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs whose language is told with at least that score."""
    (told,) = fresh(["told"], docs)
    found = docs.withColumn(told, predicted(docs, model, text_col))
    return found.filter((F.col(told)["lang_pred"] != UNKNOWN) & (F.col(told)["score"] >= least)).select(*own_columns(docs))
