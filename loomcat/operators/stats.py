"""Statistics over records: counts, summaries with nearest ranks, group measures, percentiles and rankings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcat.functions.values import or_unknown
from loomcat.operators.ordering import numbered, running_totals


def counts(df: DataFrame, column: Column, name: str = "key", unknown: bool = False) -> DataFrame:
    """(name, count) by value; nulls are dropped, or counted as unknown."""
    rows = df.select((or_unknown(column) if unknown else column).cast("string").alias(name))
    return rows.dropna().groupBy(name).agg(F.count("*").alias("count"))


def counts_by(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(kind, key, count) by value of each column (kind: column), nulls dropped, in one pass."""
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), c.cast("string").alias("key")) for kind, c in columns.items()])
    return df.select(F.explode(each).alias("x")).select("x.*").filter("key is not null").groupBy("kind", "key").agg(F.count("*").alias("count"))


def list_counts(df: DataFrame, column: str, name: str = "key", once: bool = False) -> DataFrame:
    """(name, count) over list items; a repeated item of a record counts each time, or once."""
    items = F.array_distinct(column) if once else F.col(column)
    return df.select(F.explode(items).alias(name)).groupBy(name).agg(F.count("*").alias("count"))


def as_map(counted: DataFrame, name: str = "key", count: str = "count") -> DataFrame:
    """One row with one map, its keys in order. For domains of bounded size."""
    return counted.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, count)))).alias("counts"))


def facet_values(df: DataFrame, column: str, many: bool = False) -> DataFrame:
    """Distinct values without null and empty ones, in order."""
    values = df.select((F.explode(column) if many else F.col(column)).alias("value"))
    return values.filter(F.coalesce(F.col("value"), F.lit("")) != "").distinct().orderBy("value")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(v, n, upto, rows): each distinct non-null value, its count, the count up to it, and the count of all, in range partitions."""
    each = df.select(F.col(column).alias("v")).dropna().groupBy("v").agg(F.count("*").alias("n"))
    return running_totals(each, [F.col("v")], {"upto": F.col("n")}).withColumnRenamed("all_upto", "rows")


def _measures(digits: int | None, extremes: bool) -> tuple[list[Column], list[Column]]:
    """The aggregates over (v, n, upto, rows), and the columns made of them. A quartile is the value at the index round((n - 1) q), half to even."""
    last = F.col("rows") - 1
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("v")))
    found = [
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.coalesce(F.sum(F.col("v") * F.col("n")), F.lit(0)).alias("total"),
        ((at(F.floor(last / 2)) + at(F.ceil(last / 2))) / 2).alias("median"), at(F.bround(last * F.lit(0.25))).alias("p25"), at(F.bround(last * F.lit(0.75))).alias("p75"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    ]
    mean = F.when(F.col("count") > 0, F.col("total") / F.col("count"))
    names = ["count", "total", (mean if digits is None else F.bround(mean, digits)).alias("mean"), "median", "p25", "p75", *(["min", "max"] if extremes else [])]
    return found, [F.col(c) if isinstance(c, str) else c for c in names]


def summary(df: DataFrame, column: str, digits: int | None = 2, extremes: bool = False) -> DataFrame:
    """count, total, mean, median, p25 and p75 of the non-null values; one row also for none."""
    found, names = _measures(digits, extremes)
    return value_counts(df, column).agg(*found).select(*names)


def summaries(df: DataFrame, columns: dict[str, str], digits: int | None = 2, extremes: bool = False) -> DataFrame:
    """(metric, ...): the summaries of several columns (metric: column) as doubles, in one pass; a metric without values has no row."""
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("v")) for m, c in columns.items()])
    values = df.select(F.explode(each).alias("x")).select("x.*").filter("v is not null").groupBy("metric", "v").agg(F.count("*").alias("n"))
    totals = running_totals(values, [F.col("metric"), F.col("v")], {"upto": F.col("n")}).drop("all_upto")
    starts = totals.groupBy("metric").agg(F.min(F.col("upto") - F.col("n")).alias("start"), F.sum("n").alias("rows"))  # a row for each metric
    found, names = _measures(digits, extremes)
    return totals.join(F.broadcast(starts), "metric").withColumn("upto", F.col("upto") - F.col("start")).groupBy("metric").agg(*found).select("metric", *names)


def shares(list_column: str) -> Column:
    """1 / size of a list, as a double; null for none."""
    size = F.size(list_column)
    return F.when(size > 0, F.lit(1.0) / size)


def group_statistics(
    records: DataFrame, group: Column, frontiers: str = "frontiers", citations: str = "citation_count", velocity: str = "citations_per_year", title: str = "title", record_id: str = "record_id"
) -> DataFrame:
    """The measures of each group: group is a list (records count in each of their groups, once) or a single value.

    The fraction of a record is always one over its number of frontiers. Ties for the most cited go to the least id.
    """
    kind = dict(records.select(group.alias("g")).dtypes)["g"]
    own = F.array_distinct(group) if kind.startswith("array") else F.array(group)
    rows = records.select(
        F.explode(own).alias("group"), shares(frontiers).alias("w"), F.col(citations).alias("c"), F.col(velocity).alias("y"), F.col(title).alias("t"), F.col(record_id).alias("i")
    )
    first = F.min_by(F.struct("t", "i", "c"), F.when(F.col("c").isNotNull(), F.struct((-F.col("c")).alias("c"), "i")))
    out = rows.groupBy("group").agg(
        F.count("*").alias("paper_count"), F.sum("w").alias("fractional_paper_count"), F.count("c").alias("citable_paper_count"), F.sum("c").alias("total_citations"),
        F.avg("c").alias("mean_citations"), F.median("c").alias("median_citations"), F.avg("y").alias("mean_citations_per_year"), first.alias("top"),
    ).withColumn("catalog", records.agg(F.count("*")).scalar())
    return out.select(
        "group", "paper_count", (F.col("paper_count") / F.col("catalog")).alias("share_of_catalog"), "fractional_paper_count", "citable_paper_count",
        (F.col("citable_paper_count") / F.col("paper_count")).alias("citation_coverage"), F.coalesce("total_citations", F.lit(0)).alias("total_citations"), "mean_citations", "median_citations",
        "mean_citations_per_year", F.col("top.t").alias("top_cited_title"), F.col("top.i").alias("top_cited_id"), F.col("top.c").alias("top_cited_count"),
    )


def by_count(grouped: DataFrame, count: str = "paper_count", name: str = "group", to: str = "n") -> DataFrame:
    """grouped with each group's place: by count from the greatest down, then by name."""
    return numbered(grouped, [F.desc(count), F.asc(name)], to).drop("of")


def mid_rank(df: DataFrame, column: str, to: str) -> DataFrame:
    """df with the mid-rank percentile of a column, among its non-null values: (less + half of the equal) / n."""
    ranks = value_counts(df, column).select(F.col("v").alias("__v"), ((F.col("upto") - F.col("n") * F.lit(0.5)) / F.col("rows")).alias(to))
    return df.join(ranks, df[column] == ranks["__v"], "left").drop("__v")


def impact_proxy(df: DataFrame, citations: str, velocity: str, to: str = "impact_proxy_score_0_100") -> DataFrame:
    """100 (0.7 percentile of citations + 0.3 percentile of velocity), for rows that have citations."""
    cited = df.withColumn("__y", F.when(F.col(citations).isNotNull(), F.col(velocity)))
    both = mid_rank(mid_rank(cited, citations, "__pc"), "__y", "__py")
    return both.withColumn(to, 100 * (F.lit(0.7) * F.col("__pc") + F.lit(0.3) * F.col("__py"))).drop("__y", "__pc", "__py")


def ranking(df: DataFrame, by: Iterable[Column], n: int | None = None) -> DataFrame:
    """Rows with their rank in an order that tells them apart; the first n only (then no more than n rows of each task meet), or all, in range partitions."""
    order = list(by)
    if n is None:
        return numbered(df, order, "rank").drop("of")
    return df.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def member_ranking(records: DataFrame, members: str, frontiers: str, citations: str, record_id: str = "record_id", count: str = "papers") -> DataFrame:
    """(member, papers, distinct frontiers, citations): lists are exploded apart, so that citations count once for each record."""
    own = records.select(record_id, F.explode(F.array_distinct(members)).alias("member"), frontiers, citations)
    totals = own.groupBy("member").agg(F.count("*").alias(count), F.coalesce(F.sum(citations), F.lit(0)).alias("citations"))
    fields = own.select("member", F.explode(frontiers).alias("f")).groupBy("member").agg(F.count_distinct("f").alias("frontiers"))
    return totals.join(fields, "member", "left").select("member", count, F.coalesce("frontiers", F.lit(0)).alias("frontiers"), "citations")


def deduplicated(placements: DataFrame, key: str, lists: dict[str, str]) -> DataFrame:
    """One row for each key: sorted distinct values of each column (new name: column), and the placements."""
    return placements.groupBy(key).agg(*[F.array_sort(F.collect_set(c)).alias(n) for n, c in lists.items()], F.count("*").alias("placement_count"))


def coverage(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(column).alias("present"), F.count("*").alias("rows"), (F.count(column) / F.count("*")).alias("coverage"))


def deltas(declared: DataFrame, counted: DataFrame, key: str, declared_value: str, counted_value: str) -> DataFrame:
    """Declared less counted values by key; a side without the key counts as 0."""
    both = declared.select(key, F.col(declared_value).alias("declared")).join(counted.select(key, F.col(counted_value).alias("counted")), key, "full")
    both = both.select(key, F.coalesce("declared", F.lit(0)).alias("declared"), F.coalesce("counted", F.lit(0)).alias("counted"))
    return both.withColumn("delta", F.col("declared") - F.col("counted"))


def zero_filled(counted: DataFrame, key: str, domain: list[str], values: Iterable[str], other: str | None = None) -> DataFrame:
    """A row for each value of a domain (and other), in its order, with zeros where nothing was counted."""
    names = [*domain, *([other] if other else [])]
    base = counted.sparkSession.createDataFrame([(i, n) for i, n in enumerate(names)], f"position int, `{key}` string")
    return base.join(counted, key, "left").select("position", key, *[F.coalesce(v, F.lit(0)).alias(v) for v in values])
