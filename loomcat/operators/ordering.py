"""Running totals and positions over an order, in range partitions: no task sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcat.sources.folders import shared_folder


def settled(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the shared folder, so that it is the same wherever it is read. Spark removes it when it is no longer used, if spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def running_totals(df: DataFrame, order: list[Column], amounts: dict[str, Column]) -> DataFrame:
    """df with, for each name, the amount's sum up to and with a row (name) and over all rows (all_name).

    Rows go to range partitions of the order, which must tell all rows apart. The partitions are
    settled, since another evaluation could cut them elsewhere; one row of each meets in one place.
    """
    ranged = df.withColumns({f"__{n}": a for n, a in amounts.items()}).repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    ranged = settled(ranged)
    sums = ranged.groupBy("__part").agg(*[F.sum(f"__{n}").alias(f"__sum_{n}") for n in amounts])
    before, every = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    offsets = sums.select("__part", *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__before_{n}") for n in amounts], *[F.sum(f"__sum_{n}").over(every).alias(f"all_{n}") for n in amounts])
    local = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumns({n: F.sum(f"__{n}").over(local) for n in amounts}).join(F.broadcast(offsets), "__part")
    return out.withColumns({n: F.col(n) + F.col(f"__before_{n}") for n in amounts}).drop("__part", *[f"__{n}" for n in amounts], *[f"__before_{n}" for n in amounts])


def numbered(df: DataFrame, order: list[Column], to: str = "position", of: str = "of") -> DataFrame:
    """df with each row's place in an order that tells all rows apart, and the number of rows."""
    return running_totals(df, order, {to: F.lit(1)}).withColumnRenamed(f"all_{to}", of)


def previous(df: DataFrame, key: str, order: list[Column], value: str, to: str) -> DataFrame:
    """df with the value of the key's row before, in an order that tells a key's rows apart; a key with very many rows is spread over partitions."""
    full = [F.col(key), *order]
    pair = F.struct(F.col(key).alias("k"), F.col(value).alias("v"))
    ranged = settled(df.repartitionByRange(*full).withColumn("__part", F.spark_partition_id()))
    ends = ranged.groupBy("__part").agg(F.max_by(pair, F.struct(*full)).alias("__end"))
    ends = ends.select("__part", F.lag("__end").over(Window.orderBy("__part")).alias("__end"))
    before = F.coalesce(F.lag(pair).over(Window.partitionBy("__part").orderBy(*full)), F.col("__end"))
    out = ranged.join(F.broadcast(ends), "__part").withColumn("__before", before)
    return out.withColumn(to, F.when(F.col("__before.k").eqNullSafe(F.col(key)), F.col("__before.v"))).drop("__part", "__end", "__before")
