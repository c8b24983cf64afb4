"""Keyed joins and their checks. Checks return the rows that break them; `demand_none` fails on any."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcat.functions.values import norm_key

SMALL_BYTES = 64 << 20


class CheckError(ValueError):
    """Data breaks a rule that a job demands."""


def demand_none(rows: DataFrame, rule: str, sample: int = 5) -> None:
    found = [r.asDict(recursive=True) for r in rows.limit(sample).collect()]
    if found:
        raise CheckError(f"{rule}: {found}")


def if_small(df: DataFrame, most: int = SMALL_BYTES) -> DataFrame:
    """Hints a broadcast where the optimizer's size estimate is known to be small, and leaves it to adaptive joins otherwise."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= most else df


def keyed(df: DataFrame, key: str, to: str = "__key", strip: bool = True) -> DataFrame:
    """df with its normalised key; rows with a blank key are dropped."""
    return df.withColumn(to, norm_key(F.coalesce(F.col(key), F.lit("")), strip)).filter(F.col(to) != "")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count; null keys are not compared."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of child with a key that parent lacks; null keys refer to nothing."""
    keys = parent.select(*[F.col(p).alias(f"__{c}") for c, p in on.items()]).distinct()
    present = child.dropna(subset=list(on))
    test = None
    for c in on:
        one = present[c] == keys[f"__{c}"]
        test = one if test is None else test & one
    return present.join(keys, test, "left_anti")


def key_differences(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """(key, side) of keys on one side only: left is `missing` on the right, right is `extra`."""
    a = left.select(F.col(key).alias("key")).distinct()
    b = right.select(F.col(right_key or key).alias("key")).distinct()
    both = a.withColumn("l", F.lit(1)).join(b.withColumn("r", F.lit(1)), "key", "full")
    return both.filter("l is null or r is null").select("key", F.when(F.col("r").isNull(), "missing").otherwise("extra").alias("side"))


def same_keys(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> bool:
    return key_differences(left, right, key, right_key).isEmpty()


def first_of_each_side(differences: DataFrame, n: int = 5) -> DataFrame:
    """The first n keys of each side, in order."""
    parts = [differences.filter(F.col("side") == s).orderBy("key").limit(n) for s in ("missing", "extra")]
    return parts[0].unionByName(parts[1])


def has_columns(df: DataFrame, names: Iterable[str]) -> bool:
    return set(names) <= set(df.columns)


def conflicting(rows: DataFrame, allowed: str, partner: str) -> DataFrame:
    """Joined rows that have a partner though they are not allowed one (J8)."""
    return rows.filter(F.col(partner).isNotNull() & ~F.coalesce(F.col(allowed), F.lit(False)))


def enriched(left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns: Iterable[str]) -> DataFrame:
    """left with columns of right for an equal key; rows without a match stay with nulls."""
    side = right.select(F.col(right_key).alias("__right"), *columns)
    return left.join(side, left[left_key] == side["__right"], "left").drop("__right")
