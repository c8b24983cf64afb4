"""The progress summary: totals, zero-filled stages, and a frontier by status matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcat.functions.values import angle, fold, percent, strictly_true
from loomcat.operators.stats import zero_filled
from loomcat.schemas import AUTHORIZATION_STAGES, FRONTIERS, TRANSLATION_STAGES

# The metrics of the matrix.
METRICS = ["total", "allowed", "blocked", "machine-draft", "human-review", "published"]


def stage_counts(records: DataFrame, column: str, stages: list[str]) -> DataFrame:
    """(position, stage, count, percent) of all stages and of other."""
    folded = records.select(fold(F.col(column), stages).alias("stage")).groupBy("stage").agg(F.count("*").alias("count"))
    out = zero_filled(folded, "stage", stages, ["count"], "other")
    return out.withColumn("percent", percent(F.col("count"), F.sum("count").over(Window.partitionBy())))


def translation_progress(records: DataFrame, column: str = "translation_status") -> DataFrame:
    return stage_counts(records, column, TRANSLATION_STAGES)


def authorization_progress(records: DataFrame, column: str = "authorization_status") -> DataFrame:
    return stage_counts(records, column, AUTHORIZATION_STAGES)


def publication_totals(records: DataFrame, allowed: str = "publication_allowed") -> DataFrame:
    """One row: total, allowed, blocked, allowed_percent and allowed_angle; only a true opens."""
    t = records.agg(F.count("*").alias("total"), F.count_if(strictly_true(F.col(allowed))).alias("allowed"))
    return t.select("total", "allowed", (F.col("total") - F.col("allowed")).alias("blocked"), percent(F.col("allowed"), F.col("total")).alias("allowed_percent"), angle(F.col("allowed"), F.col("total")).alias("allowed_angle"))


def matrix(records: DataFrame, members: str = "frontiers", allowed: str = "publication_allowed", status: str = "translation_status", domain: dict[str, str] = FRONTIERS, stages: tuple[str, ...] = ("machine-draft", "human-review", "published")) -> DataFrame:
    """(position, code, name, total, allowed, blocked, stages ..., bar): a record counts once in each of its known members."""
    opened = strictly_true(F.col(allowed))
    rows = records.select(F.explode(F.array_distinct(members)).alias("code"), opened.alias("o"), F.col(status).alias("s")).filter(F.col("code").isin(list(domain)))
    counted = rows.groupBy("code").agg(F.count("*").alias("total"), F.count_if("o").alias("allowed"), F.count_if(~F.col("o")).alias("blocked"), *[F.count_if(F.col("s") == s).alias(s) for s in stages])
    out = zero_filled(counted, "code", list(domain), ["total", "allowed", "blocked", *stages])
    names = out.sparkSession.createDataFrame(list(domain.items()), "code string, name string")
    out = out.join(F.broadcast(names), "code").withColumn("bar", percent(F.col("total"), F.max("total").over(Window.partitionBy())))
    return out.select("position", "code", "name", "total", "allowed", "blocked", *stages, "bar")


def sorted_matrix(found: DataFrame, key: str | None = None, ascending: bool = True) -> DataFrame:
    """The matrix in official order, or by name or a metric, with each row's place; ties keep the official order either way. Its rows are those of the domain."""
    by: Column | None = None if key is None else F.collate("name", "UNICODE_CI_AI") if key == "name" else F.col(f"`{key}`")
    order = [F.asc("position")] if by is None else [by.asc() if ascending else by.desc(), F.asc("position")]
    return found.withColumn("place", F.row_number().over(Window.orderBy(*order))).orderBy("place")


def next_sort(current: tuple[str, bool] | None, key: str) -> tuple[str, bool]:
    """The sort that a choice of a column leads to: (key, ascending); choosing an ascending column again turns it."""
    return (key, not (current is not None and current[0] == key and current[1]))
