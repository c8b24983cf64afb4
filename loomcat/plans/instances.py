"""Instances of the catalog's tables, made from the benchmark tables, with the SQL that makes the same ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcat.operators import gate
from loomcat.schemas import TRANSLATION_STATES

#: Notices in texts, and the licences that they stand for here.
NOTICES = {"MIT License": "CC0-1.0", "Apache License": "CC-BY-4.0", "GNU General Public License": "CC-BY-SA-4.0", "CC BY-NC": "CC-BY-NC-ND-4.0", "All rights reserved": "HAL-AUTHORIZATION-V1"}


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record table from documents: licences from notices, states from the gate, measures from lengths."""
    d = t(spark, sf_dir, "documents")
    license_ = F.when(F.lit(False), "")
    for notice, name in NOTICES.items():
        license_ = license_.when(F.contains("text", F.lit(notice)), name)
    k = F.col("doc_id")
    first = F.when(F.col("lang") == "en", "AF").when(F.col("lang") == "fr", "CF").when(F.col("lang") == "de", "EF").otherwise("TF")
    second = F.when(k % 3 == 0, "AF").when(k % 3 == 1, "NF").otherwise("XX")
    status = F.element_at(F.array(*[F.lit(s) for s in TRANSLATION_STATES]), (k % 6 + 1).cast("int"))
    out = d.select(
        "doc_id", F.concat(F.lit("doc:"), k).alias("record_id"), F.concat(F.lit("Document "), F.lpad(k.cast("string"), 9, "0")).alias("title"), "text", "lang", "source", "n_chars",
        F.array(first, second).alias("frontiers"), F.array(F.concat("lang", F.lit(": "), "source"), F.concat(F.lit("all: "), "source")).alias("topics"), license_.alias("source_license"), status.alias("translation_status"),
        F.when(k % 10 != 0, (F.col("n_chars") % 97).cast("double")).alias("citation_count"), F.floor(F.col("n_chars") / 100).cast("double").alias("page_count"),
        (2019 + k % 4).cast("int").alias("publication_year"), F.date_add(F.lit("2019-01-01").cast("date"), (k % 1200).cast("int")).alias("earliest_date"),
    )
    out = out.withColumn("citations_per_year", F.col("citation_count") * 365.25 / F.datediff(F.lit("2026-08-09").cast("date"), "earliest_date"))
    out = out.withColumn("permits_adaptation", gate.permits_adaptation(F.col("source_license"))).withColumn("license_decision", F.when(F.col("source_license").isNotNull(), gate.license_decision(F.col("source_license"))))
    return out.withColumn("__s", gate.state(F.col("source_license"), F.col("permits_adaptation"), F.col("license_decision"))).select("*", "__s.*").drop("__s")


RECORDS_SQL = """
r0 as (
    select doc_id, 'doc:' || doc_id as record_id, 'Document ' || lpad(cast(doc_id as varchar), 9, '0') as title, text, lang, source, n_chars,
        [case lang when 'en' then 'AF' when 'fr' then 'CF' when 'de' then 'EF' else 'TF' end, case doc_id % 3 when 0 then 'AF' when 1 then 'NF' else 'XX' end] as frontiers,
        [lang || ': ' || source, 'all: ' || source] as topics,
        case when contains(text, 'MIT License') then 'CC0-1.0' when contains(text, 'Apache License') then 'CC-BY-4.0' when contains(text, 'GNU General Public License') then 'CC-BY-SA-4.0'
             when contains(text, 'CC BY-NC') then 'CC-BY-NC-ND-4.0' when contains(text, 'All rights reserved') then 'HAL-AUTHORIZATION-V1' end as source_license,
        case doc_id % 6 when 0 then 'not-started' when 1 then 'machine-draft' when 2 then 'human-review' when 3 then 'published' when 4 then 'superseded' else 'withdrawn' end as translation_status,
        case when doc_id % 10 <> 0 then cast(n_chars % 97 as double) end as citation_count, cast(n_chars // 100 as double) as page_count,
        cast(2019 + doc_id % 4 as integer) as publication_year, date '2019-01-01' + cast(doc_id % 1200 as integer) as earliest_date
    from documents
), r1 as (
    select *, citation_count * 365.25 / date_diff('day', earliest_date, date '2026-08-09') as citations_per_year,
        case when source_license in ('CC0-1.0', 'CC-BY-4.0', 'CC-BY-SA-4.0') then true when source_license = 'CC-BY-NC-ND-4.0' then false end as permits_adaptation,
        case source_license when 'CC0-1.0' then 'eligible-after-attribution-check' when 'CC-BY-4.0' then 'eligible-after-attribution-check' when 'CC-BY-SA-4.0' then 'eligible-after-sharealike-check'
             when 'CC-BY-NC-ND-4.0' then 'hold-no-public-adaptation' when 'HAL-AUTHORIZATION-V1' then 'hold-hal-authorization-manual-review' end as license_decision
    from r0
), records as (
    select *, coalesce(permits_adaptation, false) as publication_allowed,
        case when permits_adaptation then 'license-cleared' else 'needs-permission' end as authorization_status,
        case when permits_adaptation then 'source-license' else 'manual-hold' end as publication_basis,
        case source_license when 'CC0-1.0' then [] when 'CC-BY-4.0' then ['attribution', 'indicate-changes'] when 'CC-BY-SA-4.0' then ['attribution', 'indicate-changes', 'share-alike']
             when 'CC-BY-NC-ND-4.0' then ['no-public-adaptation-under-current-source-license'] when 'HAL-AUTHORIZATION-V1' then ['HAL-distribution-authorization-is-not-adaptation-permission']
             else ['written-rightsholder-permission-required'] end as publication_conditions
    from r1
)"""


#: Titles whose order by case and accents matters.
TITLES = ["éa", "Ea", "b", "A", "zeta", "résumé", "Resume", "_x"]


def titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with titles that differ in case and accents."""
    k = F.col("doc_id")
    name = F.element_at(F.array(*[F.lit(x) for x in TITLES]), (k % 8 + 1).cast("int"))
    return t(spark, sf_dir, "documents").select(F.concat(F.lit("Doc:"), k).alias("record_id"), F.concat(name, F.lit(" "), F.lpad(F.floor(k / 40).cast("string"), 9, "0")).alias("title"))


TITLED_SQL = "titled as (select 'Doc:' || doc_id as record_id, [" + ", ".join(f"'{x}'" for x in TITLES) + "][1 + doc_id % 8] || ' ' || lpad(cast(doc_id // 40 as varchar), 9, '0') as title from documents)"


def sources(spark: SparkSession, sf_dir: str):
    """The six sources of the manifest, made from documents: keys differ in case and spaces, values are missing, blank or no number."""
    from loomcat.plans.manifest import Sources

    r, k = records(spark, sf_dir), F.col("doc_id")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    none = F.lit(None).cast("string")
    nothing = F.array().cast("array<string>")
    rights = r.select(
        text("Doc:", k).alias("record_id"), F.when(k % 2 == 0, text("p", k)).alias("paper_id"), F.when(k % 3 != 0, F.col("title")).otherwise("").alias("title"), F.lit("").alias("authors_as_listed"),
        F.when(k % 5 == 0, nothing).otherwise(F.col("frontiers")).alias("frontiers"), F.lit(None).cast("array<string>").alias("topics"), F.when(k % 4 == 0, "").otherwise(text("https://r.invalid/", k)).alias("source_url"),
        F.lit("v1").alias("source_version"), "source_license", none.alias("source_license_url"), "permits_adaptation", "license_decision",
        F.when(k % 7 == 0, "").otherwise(text(F.col("earliest_date").cast("string"), "T01:02:03Z")).alias("license_checked_at"), F.when(k % 2 == 0, F.col("translation_status")).alias("translation_status"),
        none.alias("translation_license"), F.lit("m0").alias("machine_model"), nothing.alias("human_reviewers"),
    )
    catalog = r.filter(k % 6 != 1).select(
        text(" DOC:", k, " ").alias("record_id"), text("Listed ", k).alias("title"), F.when(k % 2 == 0, text("Author ", k)).alias("authors_as_listed"), F.array(F.lit("XX")).alias("frontiers"), "topics",
        text("https://c.invalid/", k).alias("external_url"), F.lit(1).alias("number"), F.lit(1).alias("placement_count"),
    )
    analysis = r.filter(k % 4 != 2).select(
        text("doc:", k).alias("record_id"), text("Analysed ", k).alias("title"), "publication_year", F.col("citation_count").cast("long").cast("string").alias("citation_count"), F.lit("n/a").alias("citation_count_without_self_citations"),
        F.lit("").alias("citations_per_year"), F.lit("1_0.5").alias("impact_proxy_score_0_100"), F.lit(None).cast("array<string>").alias("frontier_labels"), F.when(k % 3 == 0, "").otherwise("hep-ph").alias("primary_arxiv_category"),
    )
    lengths = r.select(text("doc:", k).alias("record_id"), none.alias("title"), F.col("page_count").cast("long").cast("string").alias("page_count"), F.when(k % 8 == 0, "x").otherwise(F.col("n_chars").cast("string")).alias("unicode_token_count"))
    titles = r.select(F.lit("m1").alias("machine_model"), text("doc:", k).alias("record_id"), text("T", k).alias("title_zh"), F.when(k % 9 == 0, "reviewed").alias("status"))
    translations = r.filter(F.col("publication_allowed") & (k % 2 == 0)).select(
        text("doc:", k).alias("record_id"), F.lit("published").alias("translation_status"), F.lit("CC-BY-4.0").alias("translation_license"), F.lit("").alias("machine_model"), F.array(F.lit("R")).alias("human_reviewers"),
        text("https://t.invalid/", k).alias("publication_translation_url"), F.lit("ab").alias("publication_translation_sha256"), F.lit(12).cast("long").alias("publication_translation_size_bytes"),
        F.lit("1").alias("translation_version"), F.lit("2026-08-09").alias("translation_published_at"),
    )
    return Sources(rights, catalog, analysis, lengths, titles, translations)


SOURCES_SQL = """
public as (
    select case when doc_id % 2 = 0 then 'p' || doc_id else 'Doc:' || doc_id end as paper_id, 'Doc:' || doc_id as record_id,
        case when doc_id % 3 <> 0 then title when doc_id % 6 <> 1 then 'Listed ' || doc_id else 'Analysed ' || doc_id end as title,
        'T' || doc_id as title_zh, case when doc_id % 9 = 0 then 'reviewed' else 'machine-draft' end as title_zh_status, 'm1' as title_zh_model,
        case when doc_id % 6 <> 1 and doc_id % 2 = 0 then 'Author ' || doc_id else '' end as authors_as_listed,
        case when doc_id % 5 <> 0 then array_to_string(frontiers, ',') when doc_id % 6 <> 1 then 'XX' else '' end as frontiers, case when doc_id % 6 <> 1 then array_to_string(topics, ',') else '' end as topics,
        case when doc_id % 4 <> 0 then 'https://r.invalid/' || doc_id when doc_id % 6 <> 1 then 'https://c.invalid/' || doc_id end as source_url, 'v1' as source_version, source_license,
        cast(null as varchar) as source_license_url, permits_adaptation, license_decision,
        case when tr then 'published' when doc_id % 2 = 0 then translation_status else 'not-started' end as translation_status, case when tr then 'CC-BY-4.0' end as translation_license, 'm0' as machine_model,
        case when tr then 'R' else '' end as human_reviewers, authorization_status, publication_allowed, publication_basis, array_to_string(publication_conditions, ',') as publication_conditions,
        case when tr then 'https://t.invalid/' || doc_id end as publication_translation_url, case when tr then 'ab' end as publication_translation_sha256, cast(case when tr then 12 end as bigint) as publication_translation_size_bytes,
        case when tr then '1' end as translation_version, case when tr then '2026-08-09' end as translation_published_at,
        case when doc_id % 7 = 0 then '' else cast(earliest_date as varchar) || 'T01:02:03Z' end as public_updated_at, case when doc_id % 4 <> 2 then publication_year end as publication_year,
        case when doc_id % 4 <> 2 then citation_count end as citation_count, cast(null as double) as citation_count_without_self_citations, cast(null as double) as citations_per_year,
        cast(case when doc_id % 4 <> 2 then 10.5 end as double) as impact_proxy_score_0_100, page_count, cast(case when doc_id % 8 <> 0 then n_chars end as double) as unicode_token_count, '' as frontier_labels,
        case when doc_id % 4 <> 2 and doc_id % 3 <> 0 then 'hep-ph' end as primary_arxiv_category
    from (select *, publication_allowed and doc_id % 2 = 0 as tr from records)
)"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records: the flags of their lines as frontiers, their suppliers as members, quantities as citations."""
    lines = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set("l_returnflag")).alias("frontiers"), F.array_sort(F.collect_set("l_suppkey")).alias("members"), F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"), F.count("*").alias("lines")
    )
    o = t(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
    o = o.withColumn("citation_count", F.when(F.col("o_orderkey") % 7 != 0, F.floor("quantity").cast("long"))).withColumn("title", F.concat(F.lit("Order "), "o_orderkey"))
    days = F.datediff(F.lit("2026-08-09").cast("date"), F.col("o_orderdate").cast("date"))
    return o.withColumn("citations_per_year", F.col("citation_count") * 365.25 / days).withColumn("year", F.year("o_orderdate"))


ORDERS_SQL = """
lines as (
    select l_orderkey, list_sort(list(distinct l_returnflag)) as frontiers, list_sort(list(distinct l_suppkey)) as members, sum(l_quantity) as quantity, sum(l_extendedprice) as price, count(*) as lines
    from lineitem group by 1
), o0 as (
    select o.*, l.* exclude (l_orderkey), case when o_orderkey % 7 <> 0 then cast(floor(quantity) as bigint) end as citation_count, 'Order ' || o_orderkey as title
    from orders o join lines l on o_orderkey = l_orderkey
), recs as (
    select *, citation_count * 365.25 / date_diff('day', cast(o_orderdate as date), date '2026-08-09') as citations_per_year, cast(year(o_orderdate) as integer) as year from o0
)"""


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as papers of the private store, some of which break its rules."""
    k = F.col("c_custkey")
    return t(spark, sf_dir, "customer").select(
        F.concat(F.lit("p"), k - F.when(k % 100 == 0, 1).otherwise(0)).alias("record_id"), F.concat(F.lit("x"), k).alias("paper_id"), F.concat(F.lit("https://example.invalid/"), k).alias("source_url"),
        F.when(k % 50 != 0, "c_mktsegment").alias("__l"), F.when(k % 50 != 0, F.col("c_mktsegment")).alias("source_license"),
        F.when(k % 40 == 0, "lost").otherwise("published").alias("translation_status"), F.when(k % 30 == 0, "gone").otherwise("license-cleared").alias("authorization_status"),
        (k % 2 == 0).alias("publication_allowed"), F.when(k % 20 == 0, "manual-hold").otherwise("source-license").alias("publication_basis"),
    ).drop("__l")


PAPERS_SQL = """
papers as (
    select 'p' || (c_custkey - case when c_custkey % 100 = 0 then 1 else 0 end) as record_id, 'x' || c_custkey as paper_id, 'https://example.invalid/' || c_custkey as source_url,
        case when c_custkey % 50 <> 0 then c_mktsegment end as source_license, case when c_custkey % 40 = 0 then 'lost' else 'published' end as translation_status,
        case when c_custkey % 30 = 0 then 'gone' else 'license-cleared' end as authorization_status, c_custkey % 2 = 0 as publication_allowed,
        case when c_custkey % 20 = 0 then 'manual-hold' else 'source-license' end as publication_basis
    from customer
)"""


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return t(spark, sf_dir, "supplier").select(
        F.concat(F.lit("c"), k).alias("contact_id"), F.concat(F.lit("p"), k).alias("record_id"), F.concat(F.lit("n"), k % 50, F.lit("@"), F.lit("d"), k % 3, F.lit(".example.invalid")).alias("email"),
        F.when(k % 9 == 0, "friend").otherwise("publisher").alias("role"), F.lit("paper").alias("source_type"), F.when(k % 5 == 0, "bounced").otherwise("verified").alias("verification_status"),
        F.when(k % 11 == 0, F.lit("2026-01-01").cast("timestamp")).alias("suppressed_at"),
    )


CONTACTS_SQL = """
contacts as (
    select 'c' || s_suppkey as contact_id, 'p' || s_suppkey as record_id, 'n' || (s_suppkey % 50) || '@d' || (s_suppkey % 3) || '.example.invalid' as email,
        case when s_suppkey % 9 = 0 then 'friend' else 'publisher' end as role, 'paper' as source_type, case when s_suppkey % 5 = 0 then 'bounced' else 'verified' end as verification_status,
        case when s_suppkey % 11 = 0 then timestamp '2026-01-01' end as suppressed_at
    from supplier
)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.element_at(F.array(*[F.lit(s) for s in ("draft", "sent", "closed", "cancelled", "unheard")]), (k % 5 + 1).cast("int"))
    return t(spark, sf_dir, "orders").select(
        F.concat(F.lit("q"), k).alias("request_id"), F.concat(F.lit("p"), "o_custkey").alias("record_id"), F.concat(F.lit("c"), k % 60).alias("contact_id"), F.lit("translation-and-publication").alias("request_type"),
        status.alias("status"), F.when(k % 4 != 0, "someone").alias("approved_by"), F.when(k % 6 != 0, F.col("o_orderdate")).alias("approved_at"), F.col("o_orderdate").alias("first_sent_at"),
        F.when(k % 8 == 0, "granted").otherwise("unknown").alias("permission_decision"), F.when(k % 16 == 0, F.sha2(F.col("o_orderpriority"), 256)).alias("evidence_sha256"),
    )


REQUESTS_SQL = """
requests as (
    select 'q' || o_orderkey as request_id, 'p' || o_custkey as record_id, 'c' || (o_orderkey % 60) as contact_id, 'translation-and-publication' as request_type,
        case o_orderkey % 5 when 0 then 'draft' when 1 then 'sent' when 2 then 'closed' when 3 then 'cancelled' else 'unheard' end as status,
        case when o_orderkey % 4 <> 0 then 'someone' end as approved_by, case when o_orderkey % 6 <> 0 then o_orderdate end as approved_at, o_orderdate as first_sent_at,
        case when o_orderkey % 8 = 0 then 'granted' else 'unknown' end as permission_decision, case when o_orderkey % 16 = 0 then sha256(o_orderpriority) end as evidence_sha256
    from orders
)"""


def states(spark: SparkSession, sf_dir: str, domain: list[str]) -> DataFrame:
    """The events as a log over a domain's states."""
    state = F.element_at(F.array(*[F.lit(x) for x in domain]), (F.col("event_id") % len(domain) + 1).cast("int"))
    return t(spark, sf_dir, "events").select(F.concat(F.lit("e"), "event_id").alias("event_id"), F.concat(F.lit("q"), "user_id").alias("request_id"), F.col("ts").alias("occurred_at"), state.alias("new_status"))


def states_sql(domain: list[str]) -> str:
    names = ", ".join(f"'{x}'" for x in domain)
    return f"select 'e' || event_id as event_id, 'q' || user_id as request_id, ts as occurred_at, [{names}][1 + event_id % {len(domain)}] as new_status from events"


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a log of states: a user's events are a request's."""
    return t(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), "event_id").alias("event_id"), F.concat(F.lit("q"), "user_id").alias("request_id"), F.col("ts").alias("occurred_at"), F.col("event_type").alias("new_status"),
        F.when(F.col("event_id") % 13 == 0, "robot").otherwise("system").alias("actor_type"),
    )


LOG_SQL = """
log as (
    select 'e' || event_id as event_id, 'q' || user_id as request_id, ts as occurred_at, event_type as new_status, case when event_id % 13 = 0 then 'robot' else 'system' end as actor_type from events
)"""
