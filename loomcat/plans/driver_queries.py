"""The operators as queries over the benchmark tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcat import schemas as S
from loomcat.functions import texts as X
from loomcat.functions import values as V
from loomcat.operators import audit, gate, keys, ordering, progress, search, stats, workflow
from loomcat.plans import instances as I
from loomcat.plans import manifest
from loomcat.plans.instances import t
from loomcat.sources import readers, sinks
from loomcat.sources.folders import new_folder, put_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *ctes: str) -> Callable:
    """Registers a query, by its function's name, with its SQL below some common table expressions."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (f"with {', '.join(ctes)} " if ctes else "") + sql
        return f

    return register


def r(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)


# ---------------------------------------------------------------- group statistics

_GROUP = """
, g as ({rows}), top as (
    select g, title, o_orderkey, citation_count, row_number() over (partition by g order by citation_count desc, o_orderkey) as n from g where citation_count is not null
), s as (
    select g, count(*) as paper_count, sum(1.0::double / len(frontiers)) as f, count(citation_count) as citable, cast(coalesce(sum(citation_count), 0) as bigint) as total, avg(citation_count) as mean_c,
        median(citation_count) as median_c, avg(citations_per_year) as mean_y from g group by g
)
select cast(s.g as varchar) as "group", paper_count, round(paper_count / (select count(*) from recs), 6) as share_of_catalog, round(f, 6) as fractional_paper_count, citable as citable_paper_count,
    round(citable / paper_count, 6) as citation_coverage, total as total_citations, round(mean_c, 6) as mean_citations, round(median_c, 6) as median_citations, round(mean_y, 6) as mean_citations_per_year,
    top.title as top_cited_title, top.o_orderkey as top_cited_id, top.citation_count as top_cited_count
from s left join top on s.g = top.g and top.n = 1"""


def _groups(spark: SparkSession, sf_dir: str, group: Column) -> DataFrame:
    found = stats.group_statistics(I.orders(spark, sf_dir), group, record_id="o_orderkey")
    doubles = {n for n, k in found.dtypes if k == "double"}
    return found.select(*[r(n) if n in doubles else F.col(n).cast("string").alias(n) if n == "group" else F.col(n) for n in found.columns])


def _group_query(name: str, group: Callable[[], Column], rows: str) -> None:
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _groups(spark, sf_dir, group())

    f.__name__ = name
    QUERIES[name] = f
    ORACLES[name] = f"with {I.ORDERS_SQL} " + _GROUP.format(rows=rows)


PRIORITIES = {"1-URGENT": "fast", "2-HIGH": "fast", "3-MEDIUM": "slow"}
_group_query("a16_frontier_statistics", lambda: F.col("frontiers"), "select *, unnest(frontiers) as g from recs")
_group_query("a17_topic_statistics", lambda: F.transform("frontiers", lambda f: F.concat(f, F.lit(": "), F.col("o_orderstatus"))), "select *, unnest(frontiers) || ': ' || o_orderstatus as g from recs")
_group_query("a18_category_statistics", lambda: F.col("o_orderpriority"), "select *, o_orderpriority as g from recs")
_group_query("a19_family_statistics", lambda: V.family(F.col("o_orderpriority"), PRIORITIES), "select *, case o_orderpriority when '1-URGENT' then 'fast' when '2-HIGH' then 'fast' when '3-MEDIUM' then 'slow' else o_orderpriority end as g from recs")
_group_query("a20_year_statistics", lambda: F.col("year"), "select *, year as g from recs")

# ---------------------------------------------------------------- gate and record table


@query("select record_id, source_license, permits_adaptation, license_decision, authorization_status, publication_allowed, publication_basis, array_to_string(publication_conditions, ',') as conditions from records", I.RECORDS_SQL)
def p08_p13_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.records(spark, sf_dir).select(
        "record_id", "source_license", "permits_adaptation", "license_decision", "authorization_status", "publication_allowed", "publication_basis", F.array_join("publication_conditions", ",").alias("conditions")
    )


@query("select record_id from records where doc_id % 11 = 0", I.RECORDS_SQL)
def v10_gate_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh record has its gate turned round."""
    rows = I.records(spark, sf_dir).withColumn("publication_allowed", F.when(F.col("doc_id") % 11 == 0, ~F.col("publication_allowed")).otherwise(F.col("publication_allowed")))
    return gate.gate_breaches(rows).select("record_id")


@query("select role, count(*) filter (role = 'owner' or role = 'public' and publication_allowed) as n from records, (values ('owner'), ('public'), ('stranger')) r(role) group by role", I.RECORDS_SQL)
def v08_default_deny(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What roles with and without a grant read."""
    rows, grants = I.records(spark, sf_dir).select("publication_allowed"), {"owner": F.lit(True), "public": F.col("publication_allowed")}
    parts = [workflow.readable(rows, role, grants).agg(F.count("*").alias("n")).select(F.lit(role).alias("role"), "n") for role in ("owner", "public", "stranger")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("select * from public", I.RECORDS_SQL, I.SOURCES_SQL)
def p01_p07_j01_j04_public_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 38 public columns of the six sources; lists are joined by commas."""
    rows = manifest.public_records(manifest.merged(I.sources(spark, sf_dir)))
    return rows.select(*[X.joined(F.col(n), ",").alias(n) if k == "array<string>" else F.col(n) for n, k in rows.dtypes])


@query("select max(left(nullif(public_updated_at, ''), 10)) as d from public", I.RECORDS_SQL, I.SOURCES_SQL)
def f07_snapshot_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.snapshot_date(I.sources(spark, sf_dir).rights)


@query("select record_id, row_number() over (order by lower(title), lower(record_id)) as position from titled", I.TITLED_SQL)
def o01_canonical_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.numbered(I.titled(spark, sf_dir), search.canonical_columns()).select("record_id", "position")


@query("select record_id, row_number() over (order by title collate nocase.noaccent, lower(title), lower(record_id), record_id) as by_title, row_number() over (order by title collate nocase.noaccent, lower(title), lower(record_id), record_id) as by_unknown_key from titled", I.TITLED_SQL)
def o02_o04_title_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.titled(spark, sf_dir)
    for sort, to in (("title", "by_title"), ("unheard-of", "by_unknown_key")):
        rows = ordering.numbered(rows, search.order_columns(sort), to).drop("of")
    return rows.select("record_id", "by_title", "by_unknown_key")


@query("select record_id from (select *, case when doc_id % 2 = 0 then 'CC-BY-SA-4.0' end as tl from records) where tl is not null and (source_license is null or source_license not in ('CC0-1.0', 'CC-BY-4.0', 'CC-BY-SA-4.0'))", I.RECORDS_SQL)
def v16_incompatible_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir).withColumn("translation_license", F.when(F.col("doc_id") % 2 == 0, "CC-BY-SA-4.0"))
    return gate.incompatible_licenses(rows).select("record_id")


@query("""select paper_id, record_id, title, authors, array_to_string(frontiers, ',') as frontiers, status, coalesce(cast(quality as integer), -1) as quality from (
    select 'p' || doc_id as paper_id, record_id, case when doc_id % 5 = 0 then record_id else title end as title, coalesce(nullif(case when doc_id % 3 = 0 then '' else lang end, ''), source) as authors, frontiers,
    coalesce(translation_status, 'not-started') as status, quality from records left join (select doc_id as k, max(quality) as quality from labels group by 1) l on k = doc_id)""", I.RECORDS_SQL)
def p01_p04_merged_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir)
    side = t(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = keys.enriched(rows, side, "doc_id", "doc_id", ["quality"])
    title = V.first_text(F.when(F.col("doc_id") % 5 != 0, F.col("title")).otherwise(""), F.col("record_id"))
    authors = V.first_text(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")), F.col("source"))
    return rows.select(
        F.concat(F.lit("p"), "doc_id").alias("paper_id"), "record_id", title.alias("title"), authors.alias("authors"), X.joined(V.first_list(F.col("frontiers")), ",").alias("frontiers"),
        V.default(F.col("translation_status"), "not-started").alias("status"), F.coalesce("quality", F.lit(-1)).alias("quality"),
    )


# ---------------------------------------------------------------- counts and summaries


@query("""select 'license' as kind, coalesce(source_license, 'unknown') as key, count(*) as count from records group by 2 union all select 'authorization', authorization_status, count(*) from records group by 2
    union all select 'translation', translation_status, count(*) from records group by 2 union all select 'year', cast(publication_year as varchar), count(*) from records group by 2""", I.RECORDS_SQL)
def a02_a04_a07_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir)
    return stats.counts_by(rows, {"license": V.or_unknown(F.col("source_license")), "authorization": F.col("authorization_status"), "translation": F.col("translation_status"), "year": F.col("publication_year")})


@query("select key, count(*) as count from (select unnest(frontiers) as key from records) group by 1", I.RECORDS_SQL)
def a05_list_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.list_counts(I.records(spark, sf_dir), "frontiers")


@query("select key, count(*) as count from (select unnest(list_distinct(frontiers)) as key from records) group by 1", I.RECORDS_SQL)
def a06_list_counts_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.list_counts(I.records(spark, sf_dir), "frontiers", once=True)


@query("select count(*) as catalog_count, count(*) filter (publication_allowed) as allowed, count(*) filter (not publication_allowed) as blocked, count(distinct record_id) as ids, cast(max(earliest_date) as varchar) as last_date from records", I.RECORDS_SQL)
def a01_a08_a09_a32_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir)
    return rows.agg(
        F.count("*").alias("catalog_count"), F.count_if("publication_allowed").alias("allowed"), (F.count("*") - F.count_if("publication_allowed")).alias("blocked"), F.count_distinct("record_id").alias("ids"),
        F.max(V.iso_date(F.col("earliest_date").cast("string"))).alias("last_date"),
    )


_SUMMARY = """select {name} as metric, count(v) as count, cast(coalesce(sum(v), 0) as double) as total, round(avg(v), 2) as mean, cast(median(v) as double) as median,
    cast(list_sort(list(v))[1 + cast(round_even((count(v) - 1) * 0.25, 0) as integer)] as double) as p25, cast(list_sort(list(v))[1 + cast(round_even((count(v) - 1) * 0.75, 0) as integer)] as double) as p75 from {rows}"""


@query(" union all ".join(_SUMMARY.format(name=f"'{n}'", rows=f"(select {c} as v from records where {c} is not null)") for n, c in (("chars", "n_chars"), ("citations", "citation_count"), ("pages", "page_count"))), I.RECORDS_SQL)
def a10_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.summaries(I.records(spark, sf_dir), {"chars": "n_chars", "citations": "citation_count", "pages": "page_count"})


@query("select 0 as count, 0::double as total, null::double as mean, null::double as median, null::double as p25, null::double as p75")
def a11_empty_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.summary(t(spark, sf_dir, "documents").filter("n_chars < 0").select(F.col("n_chars").cast("double").alias("v")), "v")


@query("""select 'translation' as kind, position, stage, coalesce(n, 0) as count from (values (0, 'not-started'), (1, 'machine-draft'), (2, 'human-review'), (3, 'published'), (4, 'other')) d(position, stage)
    left join (select case when translation_status in ('not-started', 'machine-draft', 'human-review', 'published') then translation_status else 'other' end as s, count(*) as n from records group by 1) on s = stage
    union all select 'authorization', position, stage, coalesce(n, 0) from (values (0, 'license-cleared'), (1, 'needs-permission'), (2, 'contacted'), (3, 'response-pending'), (4, 'permission-granted'), (5, 'permission-denied'), (6, 'other')) d(position, stage)
    left join (select authorization_status as s, count(*) as n from records group by 1) on s = stage""", I.RECORDS_SQL)
def a12_f09_j09_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir)
    a = progress.translation_progress(rows).withColumn("kind", F.lit("translation"))
    b = progress.authorization_progress(rows).withColumn("kind", F.lit("authorization"))
    return a.unionByName(b).select("kind", "position", "stage", "count")


_MATRIX = """, m as (select code, count(*) as total, count(*) filter (publication_allowed) as allowed, count(*) filter (not publication_allowed) as blocked, count(*) filter (translation_status = 'machine-draft') as md,
    count(*) filter (translation_status = 'human-review') as hr, count(*) filter (translation_status = 'published') as pb from (select *, unnest(list_distinct(frontiers)) as code from records) group by code),
d as (select * from (values (0, 'AF'), (1, 'CEF'), (2, 'CompF'), (3, 'CF'), (4, 'EF'), (5, 'IF'), (6, 'NF'), (7, 'RPF'), (8, 'TF'), (9, 'UF')) d(position, code)),
z as (select position, code, coalesce(total, 0) as total, coalesce(allowed, 0) as allowed, coalesce(blocked, 0) as blocked, coalesce(md, 0) as "machine-draft", coalesce(hr, 0) as "human-review", coalesce(pb, 0) as published from d left join m using (code))
"""


@query(_MATRIX + "select *, cast(case when max(total) over () = 0 then 0 else floor(total * 100.0::double / max(total) over () + 0.5) end as integer) as bar from z", I.RECORDS_SQL)
def a13_a14_p28_p30_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.matrix(I.records(spark, sf_dir)).drop("name")


@query(_MATRIX + "select code, total, row_number() over (order by total desc, position) as place, row_number() over (order by published, position) as rising from z", I.RECORDS_SQL)
def o05_sorted_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    falling = progress.sorted_matrix(progress.matrix(I.records(spark, sf_dir)), "total", False)
    rising = progress.sorted_matrix(falling.drop("place"), "published").select("code", F.col("place").alias("rising"))
    return falling.select("code", "total", "place").join(rising, "code")


@query("select k.key as current, a.up as ascending, c.key as chosen, not (k.key = c.key and a.up) as next_ascending from (select unnest(['name', 'total', 'allowed']) as key) k, (select unnest([true, false]) as up) a, (select unnest(['name', 'total', 'allowed']) as key) c")
def o06_next_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that each choice of a column leads to."""
    found = [(k, up, c, *progress.next_sort((k, up), c)) for k in ("name", "total", "allowed") for up in (True, False) for c in ("name", "total", "allowed")]
    return spark.createDataFrame(found, "current string, ascending boolean, chosen string, next string, next_ascending boolean").drop("next")


@query("select count(*) as total, count(*) filter (publication_allowed) as allowed, count(*) filter (not publication_allowed) as blocked, cast(floor(count(*) filter (publication_allowed) * 100.0::double / count(*) + 0.5) as integer) as allowed_percent, round(count(*) filter (publication_allowed) * 360.0::double / count(*), 6) as allowed_angle from records", I.RECORDS_SQL)
def a15_p29_publication_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.publication_totals(I.records(spark, sf_dir)).withColumn("allowed_angle", F.round("allowed_angle", 6))


@query("select m.member, papers, frontiers, citations from (select member, count(*) as papers, cast(coalesce(sum(citation_count), 0) as bigint) as citations from (select *, unnest(members) as member from recs) group by 1) m join (select member, count(distinct f) as frontiers from (select member, unnest(frontiers) as f from (select frontiers, unnest(members) as member from recs)) group by 1) f on m.member = f.member", I.ORDERS_SQL)
def a23_member_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.member_ranking(I.orders(spark, sf_dir), "members", "frontiers", "citation_count", "o_orderkey")


@query("select case when page_count < 10 then '<10' when page_count < 20 then '10-19' when page_count < 40 then '20-39' when page_count < 80 then '40-79' when page_count < 120 then '80-119' else '>=120' end as bucket, count(*) as count from records group by 1", I.RECORDS_SQL)
def a24_p40_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.counts(I.records(spark, sf_dir), V.page_bucket(F.col("page_count")), "bucket")


_LENGTHS = {"pages": "n_chars // 100", "tokens": r"len(regexp_extract_all(text, '[\p{L}\p{N}]+'))", "words": r"len(regexp_extract_all(text, '\p{Latin}+'))", "chars": r"length(regexp_replace(text, '[ \t\n\v\f\r]', '', 'g'))"}


@query(" union all ".join(_SUMMARY.format(name=f"'{m}'", rows=f"(select {c} as v from documents)").replace("round(avg(v), 2) as mean", "round(avg(v), 6) as mean, cast(min(v) as double) as min, cast(max(v) as double) as max") for m, c in _LENGTHS.items()))
def a25_length_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("text")
    rows = t(spark, sf_dir, "documents").select(F.floor(F.col("n_chars") / 100).alias("pages"), X.unicode_tokens(c).alias("tokens"), X.latin_words(c).alias("words"), X.chars_without_space(c).alias("chars"))
    found = stats.summaries(rows, {m: m for m in _LENGTHS}, digits=None, extremes=True)
    return found.withColumn("mean", F.round("mean", 6))


@query("select source, count(*) as count, cast(sum(n_chars) as bigint) as chars from documents group by 1")
def a26_provenance_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("count"), F.sum("n_chars").alias("chars"))


@query("select coalesce(license_decision, 'manual-review') as decision, coalesce(source_license, 'unknown') as license, count(*) as count from records group by 1, 2", I.RECORDS_SQL)
def a27_p12_p15_decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir)
    return rows.groupBy(V.default(V.null_on_blank(F.col("license_decision")), "manual-review").alias("decision"), V.or_unknown(F.col("source_license")).alias("license")).agg(F.count("*").alias("count"))


@query("select f as frontier, count(*) as placements, count(distinct record_id) as records from (select record_id, unnest(frontiers) as f from records) group by 1", I.RECORDS_SQL)
def a28_placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.records(spark, sf_dir).select("record_id", F.explode("frontiers").alias("frontier")).groupBy("frontier").agg(F.count("*").alias("placements"), F.count_distinct("record_id").alias("records"))


@query("select sha256(text) as key, array_to_string(list_sort(list(distinct source)), ',') as sources, array_to_string(list_sort(list(distinct lang)), ',') as langs, count(*) as placement_count from documents group by 1")
def a29_p44_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "documents").withColumn("key", X.content_hash(F.col("text")))
    return stats.deduplicated(rows, "key", {"sources": "source", "langs": "lang"}).select("key", X.joined(F.col("sources"), ",").alias("sources"), X.joined(F.col("langs"), ",").alias("langs"), "placement_count")


@query("select count(citation_count) as present, count(*) as rows, round(count(citation_count) / count(*), 6) as coverage from records", I.RECORDS_SQL)
def a30_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.coverage(I.records(spark, sf_dir), "citation_count").withColumn("coverage", F.round("coverage", 6))


@query("select 'frontier' as facet, v as value from (select distinct unnest(frontiers) as v from records) union all select 'license', source_license from records where source_license is not null group by 2", I.RECORDS_SQL)
def a31_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir)
    a, b = stats.facet_values(rows, "frontiers", many=True), stats.facet_values(rows, "source_license")
    return a.select(F.lit("frontier").alias("facet"), "value").unionByName(b.select(F.lit("license").alias("facet"), "value"))


@query("select o_orderkey, round(declared, 2) as declared, round(counted, 2) as counted, round(declared - counted, 2) as delta from (select o_orderkey, o_totalprice as declared, coalesce(p, 0) as counted from orders left join (select l_orderkey, sum(l_extendedprice) as p from lineitem group by 1) on l_orderkey = o_orderkey)")
def a34_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("p"))
    found = stats.deltas(t(spark, sf_dir, "orders"), counted, "o_orderkey", "o_totalprice", "p")
    return found.select("o_orderkey", r("declared", 2), r("counted", 2), r("delta", 2))


@query("select sum(n) = (select count(*) from records) as conserved from (select translation_status, count(*) as n from records group by 1)", I.RECORDS_SQL)
def v14_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir).select("translation_status")
    return progress.translation_progress(rows).agg(F.sum("count").alias("n")).crossJoin(rows.agg(F.count("*").alias("m"))).select((F.col("n") == F.col("m")).alias("conserved"))


# ---------------------------------------------------------------- ranks, windows, pages


@query("""select c_custkey, round((a.l + 0.5::double * a.e) / n, 6) as pct_bal, round(100 * (0.7::double * (a.l + 0.5::double * a.e) / n + 0.3::double * (b.l + 0.5::double * b.e) / n), 6) as score from (
    select c_custkey, c_acctbal as x, c_acctbal / (1 + c_nationkey) as y, count(*) over () as n from customer) c
    join (select x, sum(e) over (order by x) - e as l, e from (select c_acctbal as x, count(*) as e from customer group by 1)) a on a.x = c.x
    join (select y, sum(e) over (order by y) - e as l, e from (select c_acctbal / (1 + c_nationkey) as y, count(*) as e from customer group by 1)) b on b.y = c.y""")
def w01_p34_mid_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", (F.col("c_acctbal") / (1 + F.col("c_nationkey"))).alias("per"))
    found = stats.impact_proxy(stats.mid_rank(rows, "c_acctbal", "pct_bal"), "c_acctbal", "per", "score")
    return found.select("c_custkey", r("pct_bal"), r("score"))


@query("select record_id, title, row_number() over (order by lower(title), record_id) as position, count(*) over () as of, case when row_number() over (order by lower(title), record_id) >= 100 then cast(row_number() over (order by lower(title), record_id) as varchar) else lpad(cast(row_number() over (order by lower(title), record_id) as varchar), 3, '0') end as label from records", I.RECORDS_SQL)
def w02_w03_p31_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir).select("record_id", "title")
    found = ordering.numbered(rows, [F.lower("title"), F.col("record_id")])
    return found.select("record_id", "title", "position", "of", V.padded(F.col("position")).alias("label"))


@query("select * from (select doc_id, n_chars, row_number() over (order by n_chars desc, doc_id) as rank from documents) where rank <= 20")
def w04_w05_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.ranking(t(spark, sf_dir, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), F.asc("doc_id")], 20)


@query("""select record_id, row_number() over (order by citation_count desc nulls last, record_id) as by_citations, row_number() over (order by citations_per_year desc nulls last, record_id) as by_velocity,
    row_number() over (order by proxy desc nulls last, record_id) as by_proxy from records left join (
    select record_id, round(100 * (0.7::double * (a.l + 0.5::double * a.e) / n + 0.3::double * (b.l + 0.5::double * b.e) / n), 6) as proxy from (
        select record_id, citation_count as x, citations_per_year as y, count(*) over () as n from records where citation_count is not null) c
        join (select x, sum(e) over (order by x) - e as l, e from (select citation_count as x, count(*) as e from records where citation_count is not null group by 1)) a on a.x = c.x
        join (select y, sum(e) over (order by y) - e as l, e from (select citations_per_year as y, count(*) as e from records where citation_count is not null group by 1)) b on b.y = c.y) using (record_id)""", I.RECORDS_SQL)
def w04_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir).select("record_id", "citation_count", "citations_per_year")
    out = stats.impact_proxy(rows, "citation_count", "citations_per_year", "proxy").withColumn("proxy", r("proxy"))
    for by, to in (("citation_count", "by_citations"), ("citations_per_year", "by_velocity"), ("proxy", "by_proxy")):
        out = ordering.numbered(out, [F.desc_nulls_last(by), F.col("record_id")], to).drop("of")
    return out.select("record_id", "by_citations", "by_velocity", "by_proxy")


@query("select event_id, request_id, new_status, lag(new_status) over (partition by request_id order by occurred_at, event_id) as previous_status from log", I.LOG_SQL)
def w07_previous_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.with_previous(I.log(spark, sf_dir)).select("event_id", "request_id", "new_status", "previous_status")


@query("select request_id, max(occurred_at) as last_event_at, arg_max(new_status, occurred_at) as status from log group by 1", I.LOG_SQL)
def w08_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.latest(I.log(spark, sf_dir))


@query("""select p.n as current, q.n as pages, x.page, coalesce(x.page - lag(x.page) over (partition by p.n, q.n order by x.page) > 1, false) as gap_before from (select unnest(range(1, 26)) as n) p, (select unnest(range(1, 26)) as n) q,
    lateral (select distinct unnest([1, q.n, p.n - 2, p.n - 1, p.n, p.n + 1, p.n + 2]) as page) x where p.n <= q.n and q.n > 1 and x.page between 1 and q.n""")
def w09_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = t(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).alias("n"))
    rows = n.select(F.col("n").alias("current")).join(n.select(F.col("n").alias("pages")), F.expr("current <= pages"))
    return search.page_links(rows, "current", "pages").select("current", "pages", F.inline("links"))


@query("select c_custkey, c_acctbal, cast((count(*) over () + 23) // 24 as bigint) as pages from (select *, row_number() over (order by c_acctbal desc nulls last, c_name, c_custkey) as n from customer) qualify n between 25 and 48")
def o03_o09_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    pages = rows.agg(F.ceil(F.count("*") / search.PAGE_SIZE).alias("pages"))
    return search.page_of(rows, search.order_columns("citations", "c_name", "c_custkey", {"citations": "c_acctbal"}), 2).drop("c_name").crossJoin(F.broadcast(pages))


@query("select record_id, row_number() over (order by citation_count desc nulls last, title) as n from records where publication_allowed and list_contains(frontiers, 'AF') qualify n <= 24", I.RECORDS_SQL)
def o02_f02_f04_search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = search.CatalogQuery(frontier="AF", publication="allowed", sort="citations")
    rows = search.filtered(I.records(spark, sf_dir), q)
    return stats.ranking(rows, search.order_columns(q.sort), search.PAGE_SIZE).select("record_id", F.col("rank").alias("n"))


@query("select \"group\", paper_count, row_number() over (order by paper_count desc, \"group\") as n from (select unnest(topics) as \"group\", count(*) as paper_count from records group by 1)", I.RECORDS_SQL)
def o07_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = stats.list_counts(I.records(spark, sf_dir), "topics", "group").withColumnRenamed("count", "paper_count")
    return stats.by_count(counted)


@query("select array_to_string(list(k || '=' || n order by k), ',') as counts from (select o_orderpriority as k, count(*) as n from orders group by 1)")
def o08_sorted_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.as_map(stats.counts(t(spark, sf_dir, "orders"), F.col("o_orderpriority")))
    return found.select(F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("counts"))


# ---------------------------------------------------------------- search and filters


@query("select record_id from records where contains(lower(concat_ws(' ', record_id, title, array_to_string(frontiers, ' '), array_to_string(topics, ' '))), 'en: src1') and translation_status = 'published' and source_license is null and not publication_allowed", I.RECORDS_SQL)
def f01_f03_p25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = X.search_document(F.col("record_id"), F.col("title"), F.col("frontiers"), F.col("topics"))
    rows = I.records(spark, sf_dir).filter("source_license is null")
    for p in search.predicates(search.CatalogQuery(q=" EN: src1 ", translation="published", publication="blocked"), document):
        rows = rows.filter(p)
    return rows.select("record_id")


@query("select record_id from records where record_id = 'doc:17'", I.RECORDS_SQL)
def f11_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.by_id(I.records(spark, sf_dir), "doc:17").select("record_id")


@query("select record_id from records where lower(replace(record_id, ':', '%3A')) = 'doc%3a17'", I.RECORDS_SQL)
def f12_by_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.by_slug(I.records(spark, sf_dir).withColumn("source_url", F.lit(None).cast("string")), "DOC%3A17").select("record_id")


@query(r"""select doc_id, rule, line, found from (select doc_id, line, 'email address' as rule, unnest(regexp_extract_all(content, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) as found from (
    select doc_id, unnest(string_split(text, chr(10))) as content, generate_subscripts(string_split(text, chr(10)), 1) as line from documents)) where lower(found) <> 'user0@example.com'
    union all select doc_id, 'API token', line, unnest(regexp_extract_all(content, '(?:sk|rk|ghp|github_pat)-[A-Za-z0-9_\-]{12,}')) from (select doc_id, unnest(string_split(text, chr(10))) as content, generate_subscripts(string_split(text, chr(10)), 1) as line from documents)
    union all select doc_id, 'private key', line, unnest(regexp_extract_all(content, 'BEGIN (?:RSA|OPENSSH|EC|PGP) PRIVATE KEY')) from (select doc_id, unnest(string_split(text, chr(10))) as content, generate_subscripts(string_split(text, chr(10)), 1) as line from documents)""")
def f13_f14_p42_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.text_findings(t(spark, sf_dir, "documents"), "doc_id", exempt={"email address": ["user0@example.com"]}).withColumn("line", F.col("line").cast("long"))


@query(r"select path, rule from (select path, unnest(list_filter([case when starts_with(path, 'tmp/') then 'forbidden path' end, case when starts_with(path, 'private/') and path <> 'private/README.md' then 'private path' end, case when length > 5000 then 'too large' end], lambda x: x is not null)) as rule from (select case page_id % 4 when 0 then 'tmp/' when 1 then 'private/' else 'site/' end || case when page_id % 8 = 1 then 'README.md' else cast(page_id as varchar) end as path, strlen(html) as length from pages))")
def f15_f17_a33_path_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    top = F.when(k % 4 == 0, "tmp/").when(k % 4 == 1, "private/").otherwise("site/")
    files = t(spark, sf_dir, "pages").select(F.concat(top, F.when(k % 8 == 1, "README.md").otherwise(k.cast("string"))).alias("path"), F.octet_length("html").alias("length"))
    return audit.path_findings(files, most=5000)


@query(r"select doc_id from documents where not regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') and not regexp_matches(text, '(?:sk|rk|ghp|github_pat)-[A-Za-z0-9_\-]{12,}') and not regexp_matches(text, 'BEGIN (?:RSA|OPENSSH|EC|PGP) PRIVATE KEY')")
def f18_clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.clean_texts(t(spark, sf_dir, "documents")).select("doc_id")


@query(r"select doc_id from documents where regexp_matches(text || ' ' || case when doc_id % 3 = 0 then '' else '1' end || (530 + doc_id % 20) || '.', '(^|[^0-9])(541|273|268)($|[^0-9])')")
def f19_numbers_alone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that end with a number, which every third time is no part of a longer one."""
    k = F.col("doc_id")
    text = F.concat("text", F.lit(" "), F.when(k % 3 == 0, "").otherwise("1"), 530 + k % 20, F.lit("."))
    return t(spark, sf_dir, "documents").filter(X.numbers_alone(text, ["541", "273", "268"])).select("doc_id")


# ---------------------------------------------------------------- sources and sinks


@query("select n_nationkey, n_name, n_regionkey from nation")
def s01_s09_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as one array, and read again by its schema."""
    rows, path = t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), f"{new_folder(spark, 'json')}/nation.json"
    sinks.json_file(rows.orderBy("n_nationkey"), path)
    return readers.json_records(spark, path, rows.schema)


@query("select 'present' as kind, count(*) as n from region union all select 'absent', 0")
def s02_optional_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, folder = t(spark, sf_dir, "region"), new_folder(spark, "optional")
    sinks.json_file(rows, f"{folder}/region.json")
    count = lambda name, kind: readers.optional(spark, f"{folder}/{name}.json", rows.schema).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count("region", "present").unionByName(count("none", "absent"))


@query("select 'm1' as machine_model, 'r' || r_regionkey as record_id, r_name as title_zh, cast(null as varchar) as status from region")
def s03_wrapped_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_folder(spark, 'titles')}/titles.json"
    found = [{"record_id": f"r{r.r_regionkey}", "title_zh": r.r_name} for r in t(spark, sf_dir, "region").collect()]
    put_text(spark, path, json.dumps({"machine_model": " m1 ", "translations": found}))
    return readers.titles(spark, path)


@query("select r_regionkey, r_name from region")
def s04_fetched_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = t(spark, sf_dir, "region").select("r_regionkey", "r_name"), f"{new_folder(spark, 'fetched')}/region.json"
    sinks.json_file(rows, path)
    return readers.fetched(spark, path if "://" in path else f"file://{path}", rows.schema)


@query("select 'in/' || lower(r_name) || '.txt' as path, strlen(r_name) as length, true as dated from region")
def s05_s15_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "files")
    for r in t(spark, sf_dir, "region").collect():  # five rows
        put_text(spark, f"{folder}/in/{r.r_name.lower()}.txt", r.r_name)
    return readers.files(spark, folder).select("path", "length", F.col("modified").isNotNull().alias("dated"))


@query("select doc_id, length(text) as n from documents where doc_id % 3 <> 0 and text is not null")
def s06_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third file begins with a byte that is no UTF-8, and is skipped."""
    content = F.concat(F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))), F.col("text").cast("binary"))
    return audit.decoded(t(spark, sf_dir, "documents").select("doc_id", content.alias("content"))).select("doc_id", F.length("text").alias("n"))


@query("select cast(p_partkey as integer) as number, p_name || ' | ' || p_type as title, p_brand as authors, 'arXiv:' || p_partkey as external_id, case when p_partkey % 2 = 0 then 'AF,CF' else 'TF' end as frontiers, case when p_partkey % 2 = 0 then 'AF: x;CF: y' else 'TF: ' || p_type end as topics, p_size as placements from part")
def s07_markdown_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    even, cell = F.col("p_partkey") % 2 == 0, F.lit(" | ")
    line = F.concat(
        F.lit("| "), "p_partkey", cell, "p_name", F.lit(" \\| "), "p_type", cell, "p_brand", cell, F.lit("arXiv:"), "p_partkey", cell, F.when(even, "AF, CF").otherwise("TF"), cell,
        F.when(even, F.lit("AF: x; CF: y")).otherwise(F.concat(F.lit("TF: "), "p_type")), cell, "p_size", F.lit(" |"),
    )
    folder = new_folder(spark, "markdown")
    t(spark, sf_dir, "part").select(line.alias("value")).write.text(folder)
    put_text(spark, f"{folder}/head.md", "# Papers\n\n| # | Title | Authors | Record | Frontiers | Topics | Placements |\n|---:|---|---|---|---|---|---:|\n")
    rows = readers.white_papers(spark, folder)
    return rows.withColumns({"frontiers": X.joined(F.col("frontiers"), ","), "topics": X.joined(F.col("topics"), ";")})


@query("select c_custkey, c_name || ', \"' || c_mktsegment || '\"' as label, c_acctbal from customer")
def s08_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("label"), "c_acctbal")
    folder = new_folder(spark, "csv")
    sinks.csv_folder(rows, folder)
    return readers.csv_table(spark, folder, rows.schema)


@query("select count(*) as records, '2026-08-' || lpad(cast(max(1 + n_nationkey) filter (n_nationkey % 5 <> 4) as varchar), 2, '0') as source_snapshot_date, count(*) filter (n_nationkey % 4 < 2) as publication_allowed, count(*) filter (n_nationkey % 4 >= 2) as needs_permission from nation")
def s10_s11_summary_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest built from six files, by options, and its summary line."""
    root = new_folder(spark, "manifest")
    rows = sorted((r.n_nationkey, r.n_name) for r in t(spark, sf_dir, "nation").collect())  # 25 rows
    licenses = ["CC-BY-4.0", "CC0-1.0", "ARXIV", None]
    rights = [{"record_id": n, "source_license": licenses[k % 4], "permits_adaptation": True, "license_checked_at": "" if k % 5 == 4 else f"2026-08-{k + 1:02d}T00:00:00Z"} for k, n in rows]
    given = manifest.paths_of(["--root", root, "--titles-zh", f"{root}/zh.json"])
    for name, value in (("rights", rights), ("catalog", []), ("analysis", []), ("lengths", [{"record_id": rows[0][1], "page_count": 3}]), ("titles_zh", {"machine_model": "m", "translations": [{"record_id": n, "title_zh": "z"} for _, n in rows]})):
        put_text(spark, given[name], json.dumps(value))
    line = manifest.run(spark, given.pop("out_dir"), titles=given.pop("titles_zh"), **given)
    return spark.createDataFrame([tuple(line.values())], "records long, source_snapshot_date string, publication_allowed long, needs_permission long")


@query("select cast(r_regionkey as bigint) as r_regionkey, r_name, cast(null as varchar) as note from region")
def s12_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended to a table, and read in the columns and types of a schema."""
    folder = new_folder(spark, "table")
    sinks.appended(t(spark, sf_dir, "region").withColumn("note", F.lit(None).cast("string")), folder)
    return readers.table(spark, folder, S.T.StructType([S.T.StructField("r_regionkey", S.LONG), S.T.StructField("r_name", S.STRING), S.T.StructField("note", S.STRING)]))


# ---------------------------------------------------------------- joins and key checks


@query("select d.doc_id, lang, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id")
def j01_j05_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.enriched(t(spark, sf_dir, "documents").select("doc_id", "lang"), t(spark, sf_dir, "labels"), "doc_id", "doc_id", ["quality", "toxic"])


@query("select lower(trim(o_orderpriority)) as __key, count(*) as n from orders group by 1 having count(*) > 1")
def j06_p06_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.duplicate_keys(keys.keyed(t(spark, sf_dir, "orders"), "o_orderpriority"), "__key")


@query("select doc_id as key, 'missing' as side from documents where doc_id not in (select doc_id from labels) union all select distinct doc_id, 'extra' from labels where doc_id not in (select doc_id from documents)")
def j07_u01_key_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.key_differences(t(spark, sf_dir, "documents"), t(spark, sf_dir, "labels"), "doc_id")


@query("select key, 'missing' as side from (select doc_id as key from documents where doc_id not in (select doc_id from labels) order by 1 limit 5)")
def o10_first_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.first_of_each_side(keys.key_differences(t(spark, sf_dir, "documents"), t(spark, sf_dir, "labels"), "doc_id"))


@query("select record_id from records where not publication_allowed and doc_id in (select doc_id from labels)", I.RECORDS_SQL)
def j08_conflicting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keys.enriched(I.records(spark, sf_dir), t(spark, sf_dir, "labels").select("doc_id", "quality").withColumn("has", F.lit(1)), "doc_id", "doc_id", ["has"])
    return keys.conflicting(rows, "publication_allowed", "has").select("record_id").distinct()


@query("select n_name, coalesce(r_name, '?') as region, case n_regionkey when 0 then 'zero' when 1 then 'one' else cast(n_regionkey as varchar) end as label from nation left join region on r_regionkey = n_regionkey")
def j10_p22_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keys.enriched(t(spark, sf_dir, "nation"), t(spark, sf_dir, "region"), "n_regionkey", "r_regionkey", ["r_name"])
    return rows.select("n_name", F.coalesce("r_name", F.lit("?")).alias("region"), V.label(F.col("n_regionkey").cast("string"), {"0": "zero", "1": "one"}).alias("label"))


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F') and l_quantity > 45")
def j11_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = t(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return t(spark, sf_dir, "lineitem").filter("l_quantity > 45").join(some, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def j12_missing_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "documents").select("doc_id").join(t(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("select l_orderkey, l_linenumber from (select case when l_linenumber = 1 and l_orderkey % 50 = 0 then l_orderkey + 1000000000 else l_orderkey end as l_orderkey, l_linenumber from lineitem) where l_orderkey not in (select o_orderkey from orders)")
def j13_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some lines point to orders that don't exist."""
    k = F.col("l_orderkey")
    lines = t(spark, sf_dir, "lineitem").select(F.when((F.col("l_linenumber") == 1) & (k % 50 == 0), k + 1_000_000_000).otherwise(k).alias("l_orderkey"), "l_linenumber")
    return keys.orphans(lines, t(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}).select("l_orderkey", "l_linenumber")


@query("select doc_id, coalesce(case when doc_id % 3 = 0 then lang end, case when doc_id % 2 = 0 then source end, 'listed') as value, case when doc_id % 3 = 0 then 'first' when doc_id % 2 = 0 then 'second' else 'third' end as origin from documents")
def j14_s14_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "documents").select("doc_id", F.expr("case when doc_id % 3 = 0 then lang end").alias("a"), F.expr("case when doc_id % 2 = 0 then source end").alias("b"), F.lit("listed").alias("c"))
    from loomcat.sources.readers import first_source

    value, name = first_source({"first": "a", "second": "b", "third": "c"})
    return rows.select("doc_id", value.alias("value"), name.alias("origin"))


# ---------------------------------------------------------------- scalar functions


@query("select n_nationkey, case n_nationkey % 10 when 0 then 12.5 when 1 then 1 when 2 then 0 when 3 then 10 when 4 then 1 when 5 then -2000 when 9 then 0.5 end::double as v from nation")
def p05_to_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(*[F.lit(x) for x in (" 12.5 ", "true", "false", "1_0", "1", "-2e3", "abc", "", None, ".5")]), F.col("n_nationkey") % 10 + 1)
    return t(spark, sf_dir, "nation").select("n_nationkey", V.to_number(raw).alias("v"))


@query("select code, zh, en, coalesce(f.n, code) as family from (values ('AF', '加速器前沿', 'Accelerator Frontier'), ('CF', '宇宙前沿', 'Cosmic Frontier'), ('EF', '能量前沿', 'Energy Frontier'), ('TF', '理论前沿', 'Theory Frontier'), ('NF', '中微子前沿', 'Neutrino Frontier'), ('XX', 'XX', 'XX')) l(code, zh, en) left join (select 'none' as c, 'none' as n) f on c = code where code in (select unnest(frontiers) from records)", I.RECORDS_SQL)
def p22_j10_labels_in_two_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stats.facet_values(I.records(spark, sf_dir), "frontiers", many=True)
    c, names = F.col("value"), S.LABELS["frontier"]
    return rows.select(c.alias("code"), V.localized(c, names, chinese=True).alias("zh"), V.localized(c, names).alias("en"), V.family(c, S.FAMILIES).alias("family"))


@query(r"""select page_id, case page_id % 4 when 0 then '2203.' || page_id when 1 then 'cds-' || page_id when 2 then 'hal-0' || page_id else 'id%20' || page_id || '%2Fx' end as slug,
    case when page_id % 4 = 0 then '2203.' || page_id else 'x y' end as wanted, case when page_id % 2 = 0 then url else '#' end as safe from pages""")
def p17_p19_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    record = F.when(k % 4 == 0, F.concat(F.lit("arxiv:2203."), k)).when(k % 4 == 3, F.concat(F.lit("id "), k, F.lit("/x"))).otherwise(F.concat(F.lit("r"), k))
    source = F.when(k % 4 == 1, F.concat(F.lit("https://cds.cern.ch/record/"), k)).when(k % 4 == 2, F.concat(F.lit("https://example.invalid/hal-0"), k))
    path = F.when(k % 4 == 0, F.concat(F.lit("/paper/arXiv:2203."), k, F.lit("/"))).otherwise(F.lit("/paper/x%20y"))
    given = F.when(k % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("javascript:"), "url"))
    return t(spark, sf_dir, "pages").select("page_id", X.slug(record, source).alias("slug"), X.requested_slug(path).alias("wanted"), X.safe_url(given).alias("safe"))


@query(r"""select page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) as protocol, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) as host, regexp_extract(url, '[?&]page=([^&#]*)', 1) as page,
    regexp_extract(url, '[?&]ref=([^&#]*)', 1) as ref, regexp_extract(url, '#(.*)$', 1) as fragment from pages""")
def s13_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return t(spark, sf_dir, "pages").select("page_id", X.url_part(u, "protocol").alias("protocol"), X.url_part(u, "host").alias("host"), X.parameter(u, "page").alias("page"), X.parameter(u, "ref").alias("ref"), X.url_part(u, "fragment").alias("fragment"))


@query("select page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#039;') as escaped from pages")
def p20_escape_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "pages").select("page_id", X.escape_html(F.col("html")).alias("escaped"))


@query("select o_orderkey, format('{:,}', cast(floor(o_totalprice) as bigint)) as whole, strftime(o_orderdate, '%B ') || day(o_orderdate) || ', ' || year(o_orderdate) as day, strftime(o_orderdate, '%Y-%m-%d') as iso, year(o_orderdate) || '年' || month(o_orderdate) || '月' || day(o_orderdate) || '日' as day_zh from orders")
def p14_p21_p32_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("o_orderdate")
    return t(spark, sf_dir, "orders").select("o_orderkey", V.number_text(F.floor("o_totalprice")).alias("whole"), V.long_date(date.cast("string")).alias("day"), V.iso_date(date.cast("string")).alias("iso"), V.long_date(date.cast("string"), chinese=True).alias("day_zh"))


@query("""select record_id, case when authorization_status = 'license-cleared' then 'badge-cleared' else 'badge-pending' end as auth, case translation_status when 'published' then 'badge-cleared' when 'withdrawn' then 'badge-blocked'
    when 'machine-draft' then 'badge-pending' when 'human-review' then 'badge-pending' else '' end as trans, case when permits_adaptation is null then 'unknown' when permits_adaptation then 'yes' else 'no' end as permits,
    array_to_string(frontiers, ' · ') as listed, case when publication_allowed then 'https://example.invalid/' || doc_id end as link from records""", I.RECORDS_SQL)
def p23_p24_p26_p27_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.records(spark, sf_dir).select(
        "record_id", V.badge(F.col("authorization_status"), S.BADGES).alias("auth"), V.badge(F.col("translation_status"), S.BADGES).alias("trans"), V.three_way(F.col("permits_adaptation"), "yes", "no", "unknown").alias("permits"),
        X.joined(F.col("frontiers"), " · ").alias("listed"), X.published_link(F.col("publication_allowed"), F.concat(F.lit("https://example.invalid/"), "doc_id")).alias("link"),
    )


@query("select record_id, round(citation_count * 365.25 / date_diff('day', earliest_date, date '2026-08-09'), 6) as velocity, case when doc_id % 5 = 0 then 2022 else year(earliest_date) end::integer as year, case when doc_id % 5 = 0 then 'fallback' else 'earliest_date' end as year_source from records", I.RECORDS_SQL)
def p33_p35_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir)
    year = V.publication_year(F.when(F.col("doc_id") % 5 != 0, F.col("earliest_date").cast("string")))
    return rows.select("record_id", F.round(V.velocity(F.col("citation_count"), F.col("earliest_date"), "2026-08-09"), 6).alias("velocity"), year.alias("y")).select("record_id", "velocity", "y.*")


@query(r"select doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}]+')) as tokens, len(regexp_extract_all(text, '\p{Latin}+')) as latin, length(regexp_replace(text, '[ \t\n\v\f\r]', '', 'g')) as chars, round(len(regexp_extract_all(text, '\p{Latin}+')) / (1 + n_chars // 2000), 1) as per_page from documents")
def p37_p39_p41_text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("text")
    rows = t(spark, sf_dir, "documents").select("doc_id", X.unicode_tokens(c).alias("tokens"), X.latin_words(c).alias("latin"), X.chars_without_space(c).alias("chars"), (1 + F.floor(F.col("n_chars") / 2000)).alias("pages"))
    return rows.select("doc_id", "tokens", "latin", "chars", V.ratio(F.col("latin"), F.col("pages")).alias("per_page"))


@query(r"select doc_id, array_to_string(regexp_extract_all(text, '(?i)[^\n]*licen[sc]e[^\n]*'), '|') as notices from documents where len(regexp_extract_all(text, '(?i)[^\n]*licen[sc]e[^\n]*')) > 0")
def p43_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "documents").withColumn("n", X.license_sentences(F.col("text")))
    return rows.filter(F.size("n") > 0).select("doc_id", X.joined(F.col("n"), "|").alias("notices"))


@query("""select doc_id, coalesce(case when doc_id % 2 = 0 then translation_status end, 'not-started') as translation_status, coalesce(case when doc_id % 3 = 0 then publication_basis end, 'manual-hold') as publication_basis,
    true as has_id, true as has_time from records""", I.RECORDS_SQL)
def p45_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.records(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("translation_status")).alias("translation_status"), F.when(F.col("doc_id") % 3 == 0, F.col("publication_basis")).alias("publication_basis"))
    found = workflow.with_defaults(rows.withColumns({"contact_id": F.lit(None).cast("string"), "created_at": F.lit(None).cast("timestamp")}))
    return found.select("doc_id", "translation_status", "publication_basis", (F.length("contact_id") == 36).alias("has_id"), F.col("created_at").isNotNull().alias("has_time"))


# ---------------------------------------------------------------- sets


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def u01_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "documents").select("doc_id").exceptAll(t(spark, sf_dir, "labels").select("doc_id").distinct())


@query("select (select count(*) from (select o_orderkey from orders except select l_orderkey from lineitem)) = 0 and (select count(*) from (select l_orderkey from lineitem except select o_orderkey from orders)) = 0 as same, true as has_columns")
def u02_u03_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, line = t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem")
    differ = keys.key_differences(o, line, "o_orderkey", "l_orderkey").limit(1).agg((F.count("*") == 0).alias("same"))
    return differ.withColumn("has_columns", F.lit(keys.has_columns(o, ["o_orderkey", "o_custkey"])))


@query("select record_id, array_to_string(case when frontiers[1] = frontiers[2] then [frontiers[1]] else frontiers end, ',') as once from records", I.RECORDS_SQL)
def u04_distinct_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.records(spark, sf_dir).select("record_id", X.joined(F.array_distinct("frontiers"), ",").alias("once"))


# ---------------------------------------------------------------- workflow


@query("""select key, rule, value from (
    select record_id as key, 'record_id unique' as rule, cast(count(*) as varchar) as value from papers where record_id is not null group by 1 having count(*) > 1
    union all select record_id, 'source_license is required', source_license from papers where source_license is null
    union all select record_id, 'translation_status in its domain', translation_status from papers where translation_status = 'lost'
    union all select record_id, 'authorization_status in its domain', authorization_status from papers where authorization_status = 'gone'
    union all select record_id, 'allowed has a basis', null from papers where publication_allowed and publication_basis = 'manual-hold')""", I.PAPERS_SQL)
def v01_v02_v03_v11_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.paper_breaches(I.papers(spark, sf_dir))


@query("""select array_to_string([record_id, email], '|') as key, 'record_id, email unique' as rule, cast(count(*) as varchar) as value from contacts group by record_id, email having count(*) > 1
    union all select contact_id, 'record_id exists', record_id from contacts where record_id not in (select record_id from papers)
    union all select contact_id, 'role in its domain', role from contacts where role = 'friend'""", I.PAPERS_SQL, I.CONTACTS_SQL)
def v01_v02_j13_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.contact_breaches(I.contacts(spark, sf_dir), I.papers(spark, sf_dir))


@query("""select record_id || '|' || contact_id || '|' || request_type as key, 'record_id, contact_id, request_type unique' as rule, cast(count(*) as varchar) as value from requests
        where status not in ('closed', 'cancelled', 'bounced') group by record_id, contact_id, request_type having count(*) > 1
    union all select request_id, 'record_id exists', record_id from requests where record_id not in (select record_id from papers)
    union all select request_id, 'contact_id exists', contact_id from requests where contact_id not in (select contact_id from contacts)
    union all select request_id, 'status in its domain', status from requests where status = 'unheard'
    union all select request_id, 'approval before sending', null from requests where status in ('sent', 'closed') and (approved_by is null or approved_at is null)
    union all select request_id, 'grant has evidence', null from requests where permission_decision = 'granted' and evidence_sha256 is null""", I.PAPERS_SQL, I.CONTACTS_SQL, I.REQUESTS_SQL)
def v04_v05_v06_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.request_breaches(I.requests(spark, sf_dir), I.papers(spark, sf_dir), I.contacts(spark, sf_dir))


@query("""select event_id as key, 'request_id exists' as rule, request_id as value from log where request_id not in (select request_id from requests)
    union all select event_id, 'actor_type in its domain', actor_type from log where actor_type = 'robot'""", I.REQUESTS_SQL, I.LOG_SQL)
def v02_j13_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.event_breaches(I.log(spark, sf_dir), I.requests(spark, sf_dir))


@query("select event_id as key, case when cast(substr(event_id, 2) as bigint) % 17 = 0 then 'deleted' else 'updated' end as rule, cast(null as varchar) as value from log where cast(substr(event_id, 2) as bigint) % 17 in (0, 1)", I.LOG_SQL)
def v07_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = I.log(spark, sf_dir)
    k = F.pmod(F.substring("event_id", 2, 20).cast("long"), F.lit(17))
    after = before.filter(k != 0).withColumn("new_status", F.when(k == 1, "other").otherwise(F.col("new_status")))
    return workflow.rewritten(before, after)


def _edges(domain: list[str], edges: list[tuple[str, str]], kind: str) -> str:
    allowed = ", ".join(f"('{a}', '{b}')" for a, b in edges)
    return f"""select '{kind}' as kind, event_id, previous_status, new_status from (select *, lag(new_status) over (partition by request_id order by occurred_at, event_id) as previous_status from ({I.states_sql(domain)}))
        where previous_status is not null and previous_status <> new_status and (previous_status, new_status) not in ({allowed})"""


@query(_edges(S.TRANSLATION_STATES, S.TRANSLATION_EDGES, "translation") + " union all " + _edges(S.PRIVATE_AUTHORIZATION_STATES, S.AUTHORIZATION_EDGES, "authorization"))
def v09_forbidden_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes over the real domains that their edges don't allow."""
    parts = []
    for kind, domain, edges in (("translation", S.TRANSLATION_STATES, S.TRANSLATION_EDGES), ("authorization", S.PRIVATE_AUTHORIZATION_STATES, S.AUTHORIZATION_EDGES)):
        found = workflow.forbidden_changes(workflow.with_previous(I.states(spark, sf_dir, domain)), edges)
        parts.append(found.select(F.lit(kind).alias("kind"), "event_id", "previous_status", "new_status"))
    return parts[0].unionByName(parts[1])


@query("select case when doc_id % 17 = 0 then 'dox:' || doc_id else record_id end as key, unnest(list_filter([case when doc_id % 13 = 0 then 'title differs' end, case when doc_id % 17 = 0 then 'prefix' end], lambda x: x is not null)) as rule from records where doc_id % 13 = 0 or doc_id % 17 = 0", I.RECORDS_SQL)
def v12_v13_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some titles are the record's id, and some ids have another prefix."""
    k = F.col("doc_id")
    rows = I.records(spark, sf_dir).withColumn("record_id", F.when(k % 17 == 0, F.concat(F.lit("dox:"), k)).otherwise(F.col("record_id")))
    rows = rows.withColumn("title", F.when(k % 13 == 0, F.col("record_id")).otherwise(F.col("title")))
    return workflow.breaches(rows, "record_id", {"title differs": F.col("title") != F.col("record_id"), "prefix": F.col("record_id").startswith("doc:")}).select("key", "rule")


@query("""select email, contact_id, request_id from (select *, row_number() over (partition by split_part(email, '@', 2) order by request_id) as m from (
    select q.*, c.email, row_number() over (partition by c.email order by request_id) as n from requests q join contacts c using (contact_id)
    where suppressed_at is null and verification_status <> 'bounced' and email not in (select email from requests join contacts using (contact_id) where first_sent_at > timestamp '2001-07-30')) where n = 1) where m <= 5""", I.CONTACTS_SQL, I.REQUESTS_SQL)
def v15_mailable(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = I.requests(spark, sf_dir)
    found = workflow.mailable(asked.select("request_id", "contact_id"), I.contacts(spark, sf_dir), asked.select("contact_id", "first_sent_at"), "2001-08-29 00:00:00", 30, 5)
    return found.select("email", "contact_id", "request_id")
