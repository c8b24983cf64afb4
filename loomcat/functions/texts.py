"""Texts, tokens, addresses and escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(record_id: Column, url: Column) -> Column:
    """A record's address: the part behind arxiv:, else cds-N or hal-N from its url, else its id percent-encoded."""
    record, url = F.coalesce(record_id, F.lit("")), F.coalesce(url, F.lit(""))
    cds, hal = F.regexp_extract(url, r"cds\.cern\.ch/record/(\d+)", 1), F.regexp_extract(url, r"hal-(\d+)", 1)
    return (
        F.when(record.startswith("arxiv:"), F.substring(record, 7, 2**31 - 1))
        .when(cds != "", F.concat(F.lit("cds-"), cds))
        .when(hal != "", F.concat(F.lit("hal-"), hal))
        .otherwise(encode_component(record))
    )


def encode_component(c: Column) -> Column:
    """Percent-encoding that leaves letters, digits and - _ . ! ~ * ' ( ) as they are."""
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def decode_component(c: Column) -> Column:
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def requested_slug(path: Column) -> Column:
    """The slug that a path /paper/<slug>/ asks for."""
    return F.regexp_replace(decode_component(F.regexp_extract(path, r"/paper/(.+?)/?$", 1)), r"(?i)^arxiv:", "")


def permalink(record_id: Column, url: Column) -> Column:
    return F.concat(F.lit("paper/"), slug(record_id, url), F.lit("/"))


def safe_url(c: Column) -> Column:
    """The url if it is one of http or https, else #."""
    return F.when(F.regexp_extract(c, r"^\s*([A-Za-z][A-Za-z0-9+.-]*):", 1).rlike("(?i)^https?$"), F.trim(c)).otherwise("#")


def url_part(c: Column, part: str) -> Column:
    """protocol, host, path or fragment."""
    pattern = {"protocol": r"^([A-Za-z][A-Za-z0-9+.-]*)://", "host": r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", "path": r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", "fragment": r"#(.*)$"}[part]
    return F.regexp_extract(c, pattern, 1)


def parameter(c: Column, name: str) -> Column:
    """A parameter of a url's query; empty if it has none."""
    return F.regexp_extract(c, rf"[?&]{name}=([^&#]*)", 1)


def escape_html(c: Column) -> Column:
    out = F.coalesce(c.cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def joined(c: Column, separator: str = ", ") -> Column:
    return F.array_join(F.coalesce(c, F.array().cast("array<string>")), separator)


def search_document(*cs: Column) -> Column:
    """Texts and lists of texts, joined by spaces, in lower case; nulls leave no space."""
    return F.lower(F.concat_ws(" ", *cs))


def published_link(allowed: Column, url: Column) -> Column:
    return F.when(F.coalesce(allowed, F.lit(False)) & (F.coalesce(url, F.lit("")) != ""), safe_url(url))


def unicode_tokens(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[\p{L}\p{N}]+"))


def latin_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\p{IsLatin}+"))


def chars_without_space(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"\s", ""))


def license_sentences(c: Column) -> Column:
    """Whole lines that speak of a licence. Lines are cut first: one pattern for whole lines backtracks over long ones."""
    return F.filter(F.split(c, "\n"), lambda line: line.rlike("(?i)licen[sc]e"))


def numbers_alone(c: Column, numbers: list[str]) -> Column:
    """Whether a text holds one of the numbers, not as part of a longer one."""
    return c.rlike(rf"(?<!\d)({'|'.join(numbers)})(?!\d)")


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)
