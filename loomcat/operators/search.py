"""Faceted search over the record table: filters, orders, pages and single records."""

from __future__ import annotations

from dataclasses import dataclass, replace
from urllib.parse import parse_qsl, urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcat.functions.texts import search_document, slug
from loomcat.functions.values import norm_key

PAGE_SIZE = 24
SEARCHED = ["paper_id", "record_id", "title", "title_zh", "authors_as_listed", "frontiers", "frontier_labels", "topics", "primary_arxiv_category"]
ORDERS = {"citations": "citation_count", "impact": "impact_proxy_score_0_100", "pages": "page_count", "year": "publication_year"}


@dataclass(frozen=True)
class CatalogQuery:
    """A query of the catalog; empty texts filter nothing."""

    q: str = ""
    frontier: str = ""
    license: str = ""
    authorization: str = ""
    translation: str = ""
    publication: str = ""
    sort: str = "title"
    page: int = 1

    @classmethod
    def from_url(cls, query: str) -> CatalogQuery:
        """From a url's query string; unknown parameters and pages that are no number are ignored."""
        given = {k: v for k, v in parse_qsl(query.lstrip("?")) if v and k in cls.__dataclass_fields__}
        digits = ""
        for c in given.pop("page", "").strip():
            if not c.isdigit():
                break
            digits += c
        return cls(**given, page=max(1, int(digits or 1)))

    def to_url(self) -> str:
        """The query string without what is default."""
        values = replace(self, q=self.q.strip())
        return urlencode([(k, str(v)) for k, v in values.__dict__.items() if v and not (k == "sort" and v == "title") and not (k == "page" and v == 1)])


def predicates(query: CatalogQuery, document: Column | None = None) -> list[Column]:
    out = []
    text = query.q.strip().lower()
    if text:
        out.append(F.contains(search_document(*[F.col(c) for c in SEARCHED]) if document is None else document, F.lit(text)))
    if query.frontier:
        out.append(F.array_contains("frontiers", query.frontier))
    for value, column in ((query.license, "source_license"), (query.authorization, "authorization_status"), (query.translation, "translation_status")):
        if value:
            out.append(F.col(column) == value)
    allowed = F.coalesce(F.col("publication_allowed"), F.lit(False))
    if query.publication == "allowed":
        out.append(allowed)
    elif query.publication == "blocked":
        out.append(~allowed)
    return out


def filtered(records: DataFrame, query: CatalogQuery) -> DataFrame:
    for p in predicates(query):
        records = records.filter(p)
    return records


def order_columns(sort: str, title: str = "title", record_id: str = "record_id", orders: dict[str, str] = ORDERS) -> list[Column]:
    """By title without regard to case and accents, or by a number from the greatest down (missing last) and then by title; ids decide ties."""
    by_title = [F.collate(title, "UNICODE_CI_AI"), F.lower(title), F.lower(record_id), F.col(record_id)]
    if sort not in orders:
        return by_title
    number = F.col(orders[sort]).cast("double")
    return [F.when(~F.isnan(number), number).desc_nulls_last(), *by_title]


def canonical_columns(title: str = "title", record_id: str = "record_id") -> list[Column]:
    return [norm_key(F.col(title), strip=False), norm_key(F.col(record_id), strip=False)]


def canonical(records: DataFrame) -> DataFrame:
    """By case-folded title and id."""
    return records.orderBy(*canonical_columns())


def page(records: DataFrame, query: CatalogQuery, size: int = PAGE_SIZE) -> tuple[DataFrame, int, int]:
    """(rows of the page, page, pages): the page is held within what there is, and there is one page at least."""
    found = filtered(records, query)
    pages = max(1, -(-found.count() // size))
    number = min(max(1, query.page), pages)
    return found.orderBy(*order_columns(query.sort)).offset((number - 1) * size).limit(size), number, pages


def page_of(rows: DataFrame, order: list[Column], number: int, size: int = PAGE_SIZE) -> DataFrame:
    """One page by an order, as a top-k: no more than number * size rows of each task meet."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def page_links(rows: DataFrame, current: str, pages: str) -> DataFrame:
    """rows with links, a list of (page, gap_before): the first, the last and two on either side of the current page."""
    near = F.array(F.lit(1), F.col(pages), *[F.col(current) + k for k in range(-2, 3)])
    shown = F.array_sort(F.array_distinct(F.filter(near, lambda p: (p >= 1) & (p <= F.col(pages)))))
    with_gaps = F.transform(F.sequence(F.lit(1), F.size("__p")), lambda i: F.struct(F.element_at("__p", i).alias("page"), F.coalesce(F.element_at("__p", i) - F.try_element_at("__p", F.when(i > 1, i - 1)) > 1, F.lit(False)).alias("gap_before")))
    empty = F.array().cast("array<struct<page: int, gap_before: boolean>>")
    return rows.withColumn("__p", shown).withColumn("links", F.when(F.col(pages) > 1, with_gaps).otherwise(empty)).drop("__p")


def by_id(records: DataFrame, record_id: str) -> DataFrame:
    return records.filter(F.col("record_id") == record_id).limit(1)


def by_slug(records: DataFrame, wanted: str) -> DataFrame:
    """The first record, in canonical order, with a slug, without regard to case."""
    return canonical(records.filter(F.lower(slug(F.col("record_id"), F.col("source_url"))) == wanted.lower())).limit(1)
