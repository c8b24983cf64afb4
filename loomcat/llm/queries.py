"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcat.llm import chat_format, decontamination, html_text, language_id, license_scan, mixing, near_dedup, toxicity, vector_search, warc
from loomcat.llm.common import table, written

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (the least doc_id of the near-duplicate class)."""
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the probability of each category of the chain, toxic."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, scope, license_id and digest of what matches."""
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(more, "conv_id long, turn long, role string, text string"))
    return chat_format.digests(written(chat_format.format_windows(turns, TOKENIZER), "windows"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id and the best window of each pair that matches."""
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, mix_tokens, mix_rate, mix_copies."""
    found = mixing.document_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_html_text": op2_html_text,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_language_id": op5_language_id,
    "op6_license_scan": op6_license_scan,
    "op7_chat_format": op7_chat_format,
    "op8_decontamination": op8_decontamination,
    "op9_mixing": op9_mixing,
    "op10_vector_search": op10_vector_search,
}
ORACLES: dict[str, str] = {
    # Every pair that shares a shingle, and classes by a walk over the links.
    "op1_near_dedup": r"""
        with recursive words as (
            select doc_id, list_filter(list_transform(regexp_split_to_array(lower(text), '\s+'), lambda x: regexp_replace(x, '[\x00-\x2f\x3a-\x60\x7b-\x7f]', '', 'g')), lambda x: x <> '') as w
            from documents where text is not null
        ), shingles as (
            select doc_id, s, count(*) as n from (
                select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words
            ) group by all
        ), sizes as (select doc_id, sum(n) as n from shingles group by 1),
        common as (select a.doc_id as a, b.doc_id as b, sum(least(a.n, b.n)) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
        links as (
            select a, b from common c join sizes x on x.doc_id = a join sizes y on y.doc_id = b where c.n >= 0.8 * (x.n + y.n - c.n)
            union select min(doc_id) over (partition by text), doc_id from documents where text is not null
        ), both_ways as (select a, b from links union select b, a from links),
        reached as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reached r join both_ways l on l.a = r.b)
        select a as doc_id, min(b) as class_id from reached group by 1
    """,
    # Base32: 32 groups of five bits of the digest.
    "op4_warc": """
        with digests as (
            select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h, cast(cast(unhex(sha1(coalesce(html, ''))) as bit) as varchar) as bits from pages
        ), named as (
            select page_id, payload_bytes, min(page_id) over (partition by h) as first,
                   array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(list_sum(list_transform(range(5), lambda j: cast(substr(bits, i * 5 + j + 1, 1) as integer) * (16 >> j))) as integer) + 1, 1)), '') as payload_digest
            from digests
        )
        select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from named
    """,
    "op6_license_scan": license_scan.oracle(),
    # Every window of an item's size that has one of its shingles; of a document that is shorter than the item, all of it.
    "op8_decontamination": r"""
        with texts as (
            select 'd' as kind, doc_id as id, text from documents union all select 'i', item_id, text from benchmark
        ), words as (
            select kind, id, list_filter(list_transform(regexp_split_to_array(lower(text), '\s+'), lambda x: regexp_replace(x, '[\x00-\x2f\x3a-\x60\x7b-\x7f]', '', 'g')), lambda x: x <> '') as w from texts where text is not null
        ), shingles as (
            select kind, id, len(w) - 4 as n, unnest(range(0, len(w) - 4)) as pos, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as s from words where len(w) >= 5
        ), item as (select id as item_id, n, s, count(*) as c from shingles where kind = 'i' group by all),
        doc as (select id as doc_id, n, pos, s from shingles where kind = 'd'),
        starts as (
            select distinct doc_id, item_id, i.n as size, least(i.n, d.n) as n, case when i.n > d.n then 0 else d.pos - unnest(range(0, i.n)) end as start, d.n as most from doc d join item i on d.s = i.s where d.n >= 0.8 * i.n
        ), counted as (
            select t.doc_id, t.item_id, t.size, t.n, t.start, d.s, count(*) as c from starts t join doc d on d.doc_id = t.doc_id and d.pos >= t.start and d.pos < t.start + t.n
            where t.start >= 0 and t.start + t.n <= t.most group by all
        ), scored as (
            select k.doc_id, k.item_id, k.start, k.n, sum(least(k.c, i.c)) / (k.size + k.n - sum(least(k.c, i.c))) as similarity from counted k join item i on i.item_id = k.item_id and i.s = k.s group by k.doc_id, k.item_id, k.start, k.size, k.n
        )
        select doc_id, item_id, min(start) filter (similarity = m) as first_word, n + 4 as n_words, m as similarity, count(*) as n_windows
        from (select *, max(similarity) over (partition by doc_id, item_id) as m from scored where similarity >= 0.8) group by doc_id, item_id, n, m
    """,
    "op10_vector_search": """
        with v as (
            select vec_id, row_number() over () as n, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.n, q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
            from v q join v c on q.n <> c.n
            where q.vec_id % 50 = 0
        ), ranked as (
            select *, cast(row_number() over (partition by n order by score desc, vec_id nulls last) as integer) as rank from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
}
