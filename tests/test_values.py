"""Column functions on small values."""

import pytest
from pyspark.sql import functions as F

from loomcat import schemas as S
from loomcat.functions import texts as X
from loomcat.functions import values as V


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(("given", "wanted"), [("12", 12.0), (" 1.5 ", 1.5), ("1_000", 1000.0), ("true", 1.0), ("", None), ("abc", None), ("1e3", 1000.0), (".5", 0.5), ("-7", -7.0), (None, None), ("0x10", None), ("12f", None)])
def test_to_number(spark, given, wanted):
    assert one(spark, V.to_number(F.lit(given).cast("string"))) == wanted


def test_to_number_of_numbers_and_booleans(spark):
    assert one(spark, V.to_number(F.lit(3))) == 3.0
    assert one(spark, V.to_number(F.lit(True))) == 1.0
    assert one(spark, V.to_number(F.lit("nan"))) != one(spark, V.to_number(F.lit("1")))


def test_fallbacks(spark):
    assert one(spark, V.first_text(F.lit(None).cast("string"), F.lit(""), F.lit("b"))) == "b"
    empty = F.array().cast("array<string>")
    assert one(spark, V.first_list(F.lit(None).cast("array<string>"), empty)) == []
    assert one(spark, V.first_list(empty, F.array(F.lit("a")))) == ["a"]
    assert one(spark, V.default(F.lit(None).cast("string"), "x")) == "x"


def test_keys_fold_case(spark):
    assert one(spark, V.norm_key(F.lit("  STRAßE "))) == "strasse"
    assert one(spark, V.norm_key(F.lit(" A"), strip=False)) == " a"


def test_null_never_opens(spark):
    assert one(spark, V.strictly_true(F.lit(None).cast("boolean"))) is False
    assert one(spark, ~V.strictly_true(F.lit(None).cast("boolean"))) is True
    assert [one(spark, V.three_way(F.lit(v).cast("boolean"), "y", "n", "?")) for v in (True, False, None)] == ["y", "n", "?"]


def test_percent_rounds_half_up_and_knows_nothing(spark):
    assert [one(spark, V.percent(F.lit(a), F.lit(b))) for a, b in ((1, 3), (1, 8), (0, 0), (5, 200))] == [33, 13, 0, 3]
    assert one(spark, V.angle(F.lit(1), F.lit(3))) == pytest.approx(120)
    assert one(spark, V.angle(F.lit(0), F.lit(0))) is None


def test_numbers_and_dates(spark):
    assert [one(spark, V.number_text(F.lit(x).cast("double"), 2)) for x in (1234.5, 1000.0, float("nan"), None)] == ["1,234.5", "1,000", "—", "—"]
    assert one(spark, V.number_text(F.lit(1234567))) == "1,234,567"
    assert [one(spark, V.padded(F.lit(x))) for x in (7, 1234)] == ["007", "1234"]
    assert one(spark, V.long_date(F.lit("2026-08-09T06:00:00Z"))) == "August 9, 2026"
    assert tuple(one(spark, V.publication_year(F.lit("2021-05-01")))) == (2021, "earliest_date")
    assert tuple(one(spark, V.publication_year(F.lit(None).cast("string")))) == (2022, "fallback")
    assert one(spark, V.velocity(F.lit(1620), F.lit("2022-03-03").cast("date"), "2026-08-09")) == pytest.approx(365.25, rel=1e-2)


def test_labels_badges_families_buckets(spark):
    assert one(spark, V.label(F.lit("AF"), S.FRONTIERS)) == "Accelerator Frontier"
    assert one(spark, V.label(F.lit("ZZ"), S.FRONTIERS)) == "ZZ"
    assert [one(spark, V.badge(F.lit(x).cast("string"), S.BADGES)) for x in ("published", "contacted", "withdrawn", "not-started", None)] == ["badge-cleared", "badge-pending", "badge-blocked", "", ""]
    assert [one(spark, V.family(F.lit(x).cast("string"), S.FAMILIES)) for x in ("hep-th", "cs.LG", "", None)] == ["Formal theory / quantum gravity", "cs.LG", "Unknown", "Unknown"]
    assert [one(spark, V.page_bucket(F.lit(x))) for x in (9, 10, 39, 40, 119, 120)] == ["<10", "10-19", "20-39", "40-79", "80-119", ">=120"]
    assert one(spark, V.fold(F.lit("superseded"), S.TRANSLATION_STAGES)) == "other"


def test_slugs(spark):
    slug = lambda r, u=None: one(spark, X.slug(F.lit(r).cast("string"), F.lit(u).cast("string")))
    assert slug("arxiv:2203.07864") == "2203.07864"
    assert slug("ext:1", "https://cds.cern.ch/record/12345") == "cds-12345"
    assert slug("ext:1", "https://x.invalid/hal-0042v1") == "hal-0042"
    assert slug("a b/c(d)!~é") == "a%20b%2Fc(d)!~%C3%A9"
    assert slug(None) == ""
    assert one(spark, X.requested_slug(F.lit("/paper/arXiv%3A2203.1/"))) == "2203.1"
    assert one(spark, X.requested_slug(F.lit("/elsewhere"))) == ""


def test_urls_and_escapes(spark):
    assert [one(spark, X.safe_url(F.lit(u).cast("string"))) for u in ("https://a.invalid/x", "HTTP://b", "javascript:alert(1)", "ftp://c", None)] == ["https://a.invalid/x", "HTTP://b", "#", "#", "#"]
    assert one(spark, X.escape_html(F.lit("<a href=\"x\">'&"))) == "&lt;a href=&quot;x&quot;&gt;&#039;&amp;"
    assert one(spark, X.escape_html(F.lit(None).cast("string"))) == ""
    assert one(spark, X.published_link(F.lit(None).cast("boolean"), F.lit("https://a"))) is None
    assert one(spark, X.published_link(F.lit(True), F.lit("https://a"))) == "https://a"


def test_text_metrics(spark):
    text = F.lit("Größe 12 mm, 中文 ok\n")
    assert one(spark, X.unicode_tokens(text)) == 5
    assert one(spark, X.latin_words(text)) == 3
    assert one(spark, X.chars_without_space(text)) == 14
    assert one(spark, X.license_sentences(F.lit("a\nUnder the MIT Licence.\nb license c"))) == ["Under the MIT Licence.", "b license c"]
    assert one(spark, X.numbers_alone(F.lit("x541y"), ["541"])) is True
    assert one(spark, X.numbers_alone(F.lit("5410"), ["541"])) is False
    assert one(spark, X.search_document(F.lit("A"), F.lit(None).cast("string"), F.array(F.lit("B"), F.lit("C")))) == "a b c"
