"""The published figures of the catalog that this engine rebuilds."""

import pytest
from pyspark.sql import functions as F

from loomcat import schemas as S
from loomcat.functions import values as V
from loomcat.operators import gate, progress, stats

# How many of the 541 records have which frontiers.
FRONTIERS = {
    "AF": 60, "CEF": 27, "CF": 33, "CompF": 28, "EF": 59, "IF": 30, "NF": 15, "RPF": 30, "TF": 42, "AF CEF": 6, "AF CompF": 2, "AF EF": 14, "AF NF": 5, "AF RPF": 1, "CEF CompF": 1,
    "CF CompF": 3, "CF EF": 4, "CF IF": 5, "CF NF": 1, "CF TF": 13, "CompF EF": 2, "CompF NF": 2, "CompF TF": 11, "EF IF": 10, "EF NF": 1, "EF RPF": 3, "EF TF": 28, "IF NF": 7, "IF RPF": 1,
    "NF RPF": 2, "NF TF": 5, "RPF TF": 3, "AF CEF NF": 1, "AF CompF EF": 1, "AF EF IF": 2, "AF EF NF": 1, "AF EF RPF": 2, "AF EF TF": 3, "AF IF NF": 1, "AF NF RPF": 4, "AF RPF TF": 1,
    "CEF CompF IF": 1, "CF CompF TF": 1, "CF EF NF": 1, "CF EF RPF": 1, "CF EF TF": 3, "CF IF NF": 6, "CF IF RPF": 1, "CF IF TF": 3, "CF NF RPF": 1, "CF NF TF": 1, "CF RPF TF": 1,
    "CompF EF TF": 3, "CompF NF TF": 1, "CompF RPF TF": 2, "EF IF RPF": 1, "EF NF RPF": 1, "EF NF TF": 1, "EF RPF TF": 2, "IF NF UF": 1, "NF RPF TF": 1, "AF CF EF TF": 1, "AF CF IF RPF": 1,
    "AF CompF EF TF": 2, "AF CompF IF TF": 1, "AF EF IF TF": 1, "AF NF RPF TF": 1, "CF CompF IF TF": 1, "CF EF RPF TF": 1, "CF IF NF TF": 1, "CF IF NF UF": 4, "CF IF RPF TF": 1,
    "CF NF RPF TF": 1, "IF NF RPF UF": 1, "AF CEF IF NF UF": 1, "AF CF IF RPF TF": 1, "AF CF NF RPF UF": 1, "AF EF NF RPF TF": 1, "CF CompF EF IF NF": 1, "CF CompF EF NF RPF": 1,
    "CF CompF EF NF TF": 1, "CF EF NF RPF TF": 1, "CF IF NF RPF UF": 2, "AF CF EF NF RPF TF": 1, "AF CF EF NF RPF UF": 1, "AF EF IF NF RPF TF": 1, "CF CompF EF IF NF RPF": 1,
    "CF CompF EF NF RPF TF": 1, "CF EF IF NF TF UF": 1, "AF CF EF IF NF RPF TF": 1, "CEF CF CompF IF NF RPF UF": 1, "AF CEF CF EF IF NF RPF TF": 1, "AF CEF CF CompF EF IF NF RPF TF UF": 2,
}
# Records, and the sum of their fractions, by frontier.
BY_FRONTIER = {
    "AF": (122, 82.851), "CEF": (41, 31.835), "CF": (107, 58.127), "CompF": (70, 43.776), "EF": (163, 101.051), "IF": (93, 51.694), "NF": (87, 38.911), "RPF": (81, 45.344), "TF": (148, 84.351), "UF": (15, 3.060),
}
# Records by licence, by decision, and by state of the gate.
LICENSES = {"ARXIV": 239, "CC-BY-4.0": 246, "CC-BY-NC-ND-4.0": 28, "CC-BY-NC-SA-4.0": 14, "CC-BY-SA-4.0": 2, "CC0-1.0": 11, "HAL-AUTHORIZATION-V1": 1}
DECISIONS = {
    "eligible-after-attribution-check": 257, "eligible-after-sharealike-check": 2, "eligible-noncommercial-only-after-sharealike-check": 14, "hold-hal-authorization-manual-review": 1, "hold-manual-license-review": 239,
    "hold-no-public-adaptation": 28,
}
AUTHORIZATION = {"license-cleared": 273, "needs-permission": 268}
# The first rows of the ranking by proxy: percentage points.
PROXY = [99.91, 99.72, 99.53]


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [(f"r{i}", f"t{i}", codes.split()) for i, codes in enumerate(x for x, n in FRONTIERS.items() for _ in range(n))]
    return spark.createDataFrame([(*r, None, None) for r in rows], "record_id string, title string, frontiers array<string>, citation_count long, citations_per_year double")


def test_frontiers(catalog):
    found = {r.group: r for r in stats.group_statistics(catalog, F.col("frontiers")).collect()}
    assert catalog.count() == 541 and sum(r.paper_count for r in found.values()) == 927
    assert {k: (r.paper_count, round(r.fractional_paper_count, 3)) for k, r in found.items()} == BY_FRONTIER
    assert found["EF"].share_of_catalog == pytest.approx(0.30129390018484287) and sum(r.fractional_paper_count for r in found.values()) == pytest.approx(541)
    order = [r.group for r in stats.by_count(stats.list_counts(catalog, "frontiers", "group").withColumnRenamed("count", "paper_count")).orderBy("n").collect()]
    assert order == sorted(BY_FRONTIER, key=lambda k: (-BY_FRONTIER[k][0], k))
    matrix = progress.matrix(catalog.withColumns({"translation_status": F.lit("not-started"), "publication_allowed": F.lit(False)}))
    assert {r.code: r.total for r in matrix.collect()} == {k: n for k, (n, _) in BY_FRONTIER.items()}


def test_licences_decisions_and_gate(spark):
    rows = spark.createDataFrame([(x,) for x, n in LICENSES.items() for _ in range(n)], "source_license string")
    rows = rows.withColumns({"d": gate.license_decision(F.col("source_license")), "p": gate.permits_adaptation(F.col("source_license"))})
    rows = rows.withColumn("s", gate.state(F.col("source_license"), F.col("p"), F.col("d"))).select("source_license", "d", "s.*")
    counted = lambda c: {r.key: r["count"] for r in stats.counts(rows, F.col(c)).collect()}
    assert counted("source_license") == LICENSES and counted("d") == DECISIONS and counted("authorization_status") == AUTHORIZATION
    totals = progress.publication_totals(rows).first()
    assert (totals.total, totals.allowed, totals.blocked) == (541, 273, 268)


def test_proxy_of_the_first_rows(spark):
    """Distinct citations and velocities of 537 records: the first three by both have the published scores."""
    rows = spark.createDataFrame([(i, i, float(i)) for i in range(537)], "i int, c int, y double")
    got = stats.impact_proxy(rows, "c", "y", "s").orderBy(F.desc("s")).limit(3).collect()
    assert [round(r.s, 2) for r in got] == PROXY


def test_single_figures(spark):
    one = spark.range(1)
    assert one.select(V.ratio(F.lit(193985), F.lit(429))).first()[0] == 452.2
    # a group of one record with one citation and 0.22700435052827841 a year: 1609 days
    assert one.select(V.velocity(F.lit(1), F.date_sub(F.lit("2026-08-09").cast("date"), 1609), "2026-08-09")).first()[0] == pytest.approx(0.22700435052827841)
    pages = spark.createDataFrame([(x,) for x in (9, 10, 19, 20, 39, 40, 79, 80, 119, 120)], "p int").select(V.page_bucket(F.col("p")).alias("b"))
    assert [r.b for r in pages.collect()] == ["<10", "10-19", "10-19", "20-39", "20-39", "40-79", "40-79", "80-119", "80-119", ">=120"]
    assert len(S.PUBLIC) == 38 and S.FRONTIERS == {k: en for k, (_, en) in S.LABELS["progress"].items()}
