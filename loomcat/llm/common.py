"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcat.sources.folders import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


HEAVY_ROWS, HEAVY_KEYS, SALTS = 512, 1024, 64  # keys with so many rows, and at most so many keys, are dealt over so many salts


def new_path(spark: SparkSession, name: str) -> str:
    return new_folder(spark, name)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each Spark application."""
    context = spark.sparkContext
    if getattr(context, "_loomcat_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="loomcat-")) / "loomcat_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(target))
    context._loomcat_shipped = True


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written as Parquet in the shared folder: it cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of df by name, whatever characters the names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def text_key(text_col: str) -> Column:
    """The MD5 of a text, by which equal texts are told."""
    return F.unhex(F.md5(F.col(text_col).cast("string").cast("binary")))


def fresh(names: Iterable[str], *frames: DataFrame) -> list[str]:
    """Column names like the given ones that no frame has, whatever the case."""
    taken = {c.lower() for df in frames for c in df.columns}
    out = []
    for name in names:
        own, k = f"__{name}", 0
        while own.lower() in taken:
            own, k = f"__{name}_{k}", k + 1
        taken.add(own.lower())
        out.append(own)
    return out


def spread_join(rows: DataFrame, facts: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) with facts on one column of the same name; facts have a row for each key.

    The keys with most rows (HEAVY_KEYS at most, of HEAVY_ROWS rows at least) are dealt over SALTS tasks each, and their
    facts are repeated for each salt: fewer copies than an eighth of the rows. The list of heavy keys, which has a bounded
    number of rows, goes through the driver and is broadcast.
    """
    count, hot, salt = fresh(["n", "hot", "salt"], rows, facts)
    heavy = rows.groupBy(key).agg(F.count("*").alias(count)).filter(F.col(count) >= HEAVY_ROWS).dropna(subset=[key]).orderBy(F.desc(count), key).limit(HEAVY_KEYS).collect()
    if not heavy:
        return rows.join(facts, key, how)
    kind = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField(hot, T.BooleanType())])
    heavy = F.broadcast(rows.sparkSession.createDataFrame([(r[key], True) for r in heavy], kind))
    mark = lambda x: F.when(F.col(hot), x)
    left = rows.join(heavy, key, "left").withColumn(salt, mark(F.pmod(F.xxhash64(*own_columns(rows)), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop(hot)
    right = facts.join(heavy, key, "left").withColumn(salt, F.explode(mark(F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop(hot)
    return left.join(right, [key, salt], how).drop(salt)


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on between stages, beside their executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: int, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about `size` bytes, or one row that is longer."""
    if not batch.num_rows:
        return
    texts = batch.column(column)
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
    group = np.concatenate([[0], np.cumsum(lengths)[:-1]]) // size
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(int(a), int(b - a))
    give_back()


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
