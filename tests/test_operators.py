"""Gate, keys, statistics, progress, search, audit and workflow on small tables."""

import random
import statistics as st

import pytest
from pyspark.sql import functions as F

from loomcat import schemas as S
from loomcat.operators import audit, gate, keys, ordering, progress, search, stats, workflow


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


GATE = [
    ("CC-BY-4.0", True, "x", True, ["attribution", "indicate-changes"]),
    ("CC0-1.0", True, None, True, []),
    ("CC-BY-SA-4.0", True, "", True, ["attribution", "indicate-changes", "share-alike"]),
    ("CC-BY-NC-SA-4.0", True, None, True, ["attribution", "indicate-changes", "share-alike", "non-commercial"]),
    ("CC-BY-4.0", None, None, False, ["written-rightsholder-permission-required"]),
    ("CC-BY-4.0", False, "hold-manual-license-review", False, ["verify-current-rightsholder-and-license-before-publication"]),
    ("CC-BY-NC-ND-4.0", True, "hold-no-public-adaptation", False, ["no-public-adaptation-under-current-source-license"]),
    ("HAL-AUTHORIZATION-V1", None, "hold-hal-authorization-manual-review", False, ["HAL-distribution-authorization-is-not-adaptation-permission"]),
    (None, True, None, False, ["written-rightsholder-permission-required"]),
]


@pytest.mark.parametrize(("license_", "permits", "decision", "allowed", "conditions"), GATE)
def test_gate(spark, license_, permits, decision, allowed, conditions):
    row = spark.range(1).select(gate.state(F.lit(license_).cast("string"), F.lit(permits).cast("boolean"), F.lit(decision).cast("string")).alias("s")).first().s
    assert (row.publication_allowed, row.publication_conditions) == (allowed, conditions)
    assert (row.authorization_status, row.publication_basis) == (("license-cleared", "source-license") if allowed else ("needs-permission", "manual-hold"))


def test_decisions_by_license(spark):
    df = spark.createDataFrame([(x,) for x in ("CC0-1.0", "CC-BY-ND-3.0", "CC-BY-NC-ND-4.0", "ARXIV", None)], "l string")
    found = [r.d for r in df.select(gate.license_decision(F.col("l")).alias("d")).collect()]
    assert found == ["eligible-after-attribution-check", "hold-no-public-adaptation", "hold-no-public-adaptation", "hold-manual-license-review", "hold-manual-license-review"]


def test_gate_breaches_find_an_open_record_without_a_grant(spark):
    base = ("CC-BY-4.0", True, "license-cleared", True, "source-license")
    bad = [("ND", True, "license-cleared", True, "source-license"), ("ND", None, "needs-permission", False, None), ("ND", None, "needs-permission", True, "permission-granted")]
    good = [base, ("ND", None, "permission-granted", True, "permission-granted"), ("ND", None, "needs-permission", None, "manual-hold")]
    df = spark.createDataFrame(bad + good, "source_license string, permits_adaptation boolean, authorization_status string, publication_allowed boolean, publication_basis string")
    assert gate.gate_breaches(df).count() == len(bad)


def test_key_checks(spark):
    df = spark.createDataFrame([(" A",), ("a",), ("",), (None,), ("b",)], "record_id string")
    assert rows(keys.duplicate_keys(keys.keyed(df, "record_id"), "__key")) == [{"__key": "a", "n": 2}]
    with pytest.raises(keys.CheckError, match="twice"):
        keys.demand_none(keys.duplicate_keys(keys.keyed(df, "record_id"), "__key"), "twice")
    a, b = (spark.createDataFrame([(x,) for x in s], "k string") for s in ("abcdefgh", "hz"))
    first = rows(keys.first_of_each_side(keys.key_differences(a, b, "k"), 3).orderBy("side", "key"))
    assert [(r["side"], r["key"]) for r in first] == [("extra", "z"), ("missing", "a"), ("missing", "b"), ("missing", "c")]
    assert not keys.same_keys(a, b, "k") and keys.same_keys(a, a, "k")
    child = spark.createDataFrame([("a",), ("q",), (None,)], "k string")
    assert rows(keys.orphans(child, a, {"k": "k"})) == [{"k": "q"}]


def expected_summary(values):
    if not values:
        return (0, 0, None, None, None, None)
    v = sorted(values)
    pick = lambda q: v[round((len(v) - 1) * q)]
    return (len(v), sum(v), sum(v) / len(v), st.median(v), pick(0.25), pick(0.75))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7, 11, 40])
def test_summary_takes_nearest_ranks(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(9) for _ in range(n)]
    for kind in ("long", "double"):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v long").select(F.col("v").cast(kind)).repartition(3)
        assert tuple(stats.summary(df, "v", digits=None).first()) == pytest.approx(expected_summary(values))


def test_summary_extremes_and_digits(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,)], "v double")
    r = stats.summary(df, "v", extremes=True).first()
    assert (r.mean, r.min, r.max) == (1.67, 1.0, 2.0)


def test_two_list_counts_differ_on_repeats(spark):
    df = spark.createDataFrame([(["AF", "TF", "AF"],), (["AF"],), ([],), (None,)], "f array<string>")
    assert {r.key: r["count"] for r in stats.list_counts(df, "f").collect()} == {"AF": 3, "TF": 1}
    assert {r.key: r["count"] for r in stats.list_counts(df, "f", once=True).collect()} == {"AF": 2, "TF": 1}
    assert [r.value for r in stats.facet_values(df, "f", many=True).collect()] == ["AF", "TF"]


def test_counts_and_maps(spark):
    df = spark.createDataFrame([("b",), ("a",), ("",), (None,), ("a",)], "k string")
    found = stats.counts(df, F.col("k"), unknown=True)
    assert {r.key: r["count"] for r in found.collect()} == {"a": 2, "b": 1, "unknown": 2}
    assert list(stats.as_map(found).first().counts.items()) == [("a", 2), ("b", 1), ("unknown", 2)]


def test_group_statistics(spark):
    df = spark.createDataFrame(
        [("r1", "One", ["AF", "TF"], 10, 2.0), ("r2", "Two", ["AF", "AF"], 10, 4.0), ("r3", "Three", ["TF"], None, None), ("r4", "Four", [], 1, 1.0)], "record_id string, title string, frontiers array<string>, citation_count long, citations_per_year double"
    )
    got = {r.group: r for r in stats.group_statistics(df, F.col("frontiers")).collect()}
    af, tf = got["AF"], got["TF"]
    assert (af.paper_count, af.fractional_paper_count, af.share_of_catalog, af.citation_coverage) == (2, 1.0, 0.5, 1.0)
    assert (af.total_citations, af.mean_citations, af.median_citations, af.mean_citations_per_year) == (20, 10.0, 10.0, 3.0)
    assert (af.top_cited_id, af.top_cited_title, af.top_cited_count) == ("r1", "One", 10)
    assert (tf.paper_count, tf.fractional_paper_count, tf.citable_paper_count, tf.citation_coverage) == (2, 1.5, 1, 0.5)
    single = {r.group: r.paper_count for r in stats.group_statistics(df, F.col("citation_count")).collect()}
    assert single == {10: 2, None: 1, 1: 1}


def test_group_without_citations_has_no_top(spark):
    df = spark.createDataFrame([("r", "T", ["UF"], None, None)], "record_id string, title string, frontiers array<string>, citation_count long, citations_per_year double")
    r = stats.group_statistics(df, F.col("frontiers")).first()
    assert (r.total_citations, r.mean_citations, r.top_cited_id, r.citation_coverage) == (0, None, None, 0.0)


def test_mid_rank_and_proxy(spark):
    df = spark.createDataFrame([("a", 5, 1.0), ("b", 5, 2.0), ("c", 1, 3.0), ("d", None, 9.0)], "i string, c long, y double")
    got = {r.i: r.p for r in stats.mid_rank(df, "c", "p").collect()}
    assert got["c"] == pytest.approx(0.5 / 3) and got["a"] == got["b"] == pytest.approx(2 / 3) and got["d"] is None
    score = {r.i: r.s for r in stats.impact_proxy(df, "c", "y", "s").collect()}
    assert score["b"] == pytest.approx(100 * (0.7 * 2 / 3 + 0.3 * 0.5)) and score["d"] is None
    top = spark.createDataFrame([(i, float(i)) for i in range(537)], "i int, v double")
    assert round(100 * stats.mid_rank(top, "v", "p").agg(F.max("p")).first()[0], 2) == 99.91


def test_member_ranking_counts_citations_once(spark):
    df = spark.createDataFrame([("r1", ["x", "y", "x"], ["AF", "TF"], 5), ("r2", ["x"], ["AF"], None)], "record_id string, who array<string>, f array<string>, c long")
    got = {r.member: (r.papers, r.frontiers, r.citations) for r in stats.member_ranking(df, "who", "f", "c").collect()}
    assert got == {"x": (2, 2, 5), "y": (1, 2, 5)}


def test_mixed_set_of_progress(spark):
    df = spark.createDataFrame(
        [(["AF"], "published", "license-cleared", True), (["AF", "TF", "AF"], "machine-draft", "needs-permission", False), (["TF"], "unknown", "contacted", None)], "frontiers array<string>, translation_status string, authorization_status string, publication_allowed boolean"
    )
    totals = progress.publication_totals(df).first()
    assert (totals.total, totals.allowed, totals.blocked, totals.allowed_percent, totals.allowed_angle) == (3, 1, 2, 33, 120.0)
    stages = {r.stage: r["count"] for r in progress.translation_progress(df).collect()}
    assert stages == {"not-started": 0, "machine-draft": 1, "human-review": 0, "published": 1, "other": 1}
    m = {r.code: r for r in progress.matrix(df).collect()}
    assert (m["AF"].total, m["AF"].allowed, m["AF"].blocked, m["AF"].published, m["AF"]["machine-draft"]) == (2, 1, 1, 1, 1)
    assert (m["TF"].total, m["UF"].total, m["TF"].bar, len(m)) == (2, 0, 100, 10)


def test_empty_progress(spark):
    df = spark.createDataFrame([], "frontiers array<string>, translation_status string, authorization_status string, publication_allowed boolean")
    totals = progress.publication_totals(df).first()
    assert (totals.total, totals.allowed_percent, totals.allowed_angle) == (0, 0, None)
    assert {r.total for r in progress.matrix(df).collect()} == {0} and {r.bar for r in progress.matrix(df).collect()} == {0}


def test_sorted_matrix_keeps_official_order_among_ties(spark):
    df = spark.createDataFrame([(["AF"],)] + [(["TF"],)] * 2 + [(["UF"],)] * 3, "frontiers array<string>").withColumns({"translation_status": F.lit("published"), "publication_allowed": F.lit(True)})
    m = progress.matrix(df).cache()
    codes = lambda *a: [r.code for r in progress.sorted_matrix(m, *a).collect()]
    official = list(S.FRONTIERS)
    assert codes() == official
    assert codes("total", True)[-3:] == ["AF", "TF", "UF"] and codes("total", True)[:7] == [c for c in official if c not in ("AF", "TF", "UF")]
    assert codes("total", False)[:3] == ["UF", "TF", "AF"] and codes("total", False)[3:] == [c for c in official if c not in ("AF", "TF", "UF")]
    assert codes("name", False)[:3] == ["UF", "TF", "RPF"]
    assert progress.next_sort(None, "total") == ("total", True)
    assert progress.next_sort(("total", True), "total") == ("total", False)
    assert progress.next_sort(("total", False), "total") == ("total", True)


RECORDS = "paper_id string, record_id string, title string, title_zh string, authors_as_listed string, frontiers array<string>, frontier_labels array<string>, topics array<string>, primary_arxiv_category string, source_url string, source_license string, authorization_status string, translation_status string, publication_allowed boolean, citation_count double"


def catalog(spark, n=60):
    return spark.createDataFrame(
        [(f"p{i}", f"r{i}", ["éa", "Ea", "b", "A", "zeta", "résumé", "Resume", "_x"][i % 8] + f" {i // 8}", None, "Someone", ["AF"] if i % 2 else ["TF"], None, ["Topic: X"], "hep-ph", None, "CC0-1.0" if i % 3 else None, "license-cleared", "published", [True, False, None][i % 3], float(i) if i % 5 else None) for i in range(n)], RECORDS
    )


def test_search_pages_are_clamped(spark):
    df = catalog(spark)
    got, number, pages = search.page(df, search.CatalogQuery(page=99))
    assert (number, pages, got.count()) == (3, 3, 12)
    got, number, pages = search.page(df, search.CatalogQuery(q="nothing like it"))
    assert (number, pages, got.count()) == (1, 1, 0)
    assert search.filtered(df, search.CatalogQuery(publication="blocked")).count() == 40
    assert search.filtered(df, search.CatalogQuery(q="  TOPIC: x ", frontier="AF", license="CC0-1.0")).count() == 20


def test_orders(spark):
    df = catalog(spark, 8)
    titles = [r.title for r in df.orderBy(*search.order_columns("title")).collect()]
    # without case and accents éa equals Ea and résumé equals Resume; of equals, the lower-cased title decides
    assert titles == ["_x 0", "A 0", "b 0", "Ea 0", "éa 0", "Resume 0", "résumé 0", "zeta 0"]
    cited = [r.citation_count for r in catalog(spark, 12).orderBy(*search.order_columns("citations")).collect()]
    assert cited[:3] == [11.0, 9.0, 8.0] and cited[-3:] == [None, None, None]
    assert [str(c) for c in search.order_columns("unheard")] == [str(c) for c in search.order_columns("title")]


def test_query_strings():
    q = search.CatalogQuery.from_url("?q=dark%20matter&frontier=CF&page=3abc&sort=year&other=1")
    assert (q.q, q.frontier, q.page, q.sort) == ("dark matter", "CF", 3, "year")
    assert search.CatalogQuery.from_url("page=-2").page == 1 and search.CatalogQuery.from_url("").page == 1
    assert search.CatalogQuery().to_url() == "" and q.to_url() == "q=dark+matter&frontier=CF&sort=year&page=3"
    assert search.CatalogQuery.from_url(q.to_url()) == q


def test_positions_links_and_lookups(spark):
    df = catalog(spark)
    got = sorted((r.position, r.of, r.title) for r in ordering.numbered(df.select("title", "record_id"), [F.col("title"), F.col("record_id")]).collect())
    assert [g[0] for g in got] == list(range(1, 61)) and {g[1] for g in got} == {60} and [g[2] for g in got] == sorted(g[2] for g in got)
    links = search.page_links(spark.createDataFrame([(6, 12), (1, 1)], "c int, n int"), "c", "n").collect()
    assert [tuple(x) for x in links[0].links] == [(1, False), (4, True), (5, False), (6, False), (7, False), (8, False), (12, True)]
    assert links[1].links == []
    assert search.by_slug(df, "R7").first().record_id == "r7" and search.by_id(df, "zz").count() == 0


def test_running_totals_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), (F.col("id") % 5).alias("n"))
    got = sorted((r.v, r.n, r.t, r.all_t) for r in ordering.running_totals(df, [F.col("v")], {"t": F.col("n")}).collect())
    total = 0
    for _, n, upto, every in got:
        total += n
        assert upto == total and every == 10_000


def test_audit(spark):
    text = "ok\nmail a.b@example.invalid and Known@Example.invalid\nsk-abcdefghijklmnop\n-----BEGIN RSA PRIVATE KEY-----"
    files = spark.createDataFrame([("tmp/x", 1, bytearray(b"")), ("private/README.md", 1, bytearray(b"")), ("private/people.csv", 60 << 20, bytearray(b"\xff\xfe")), ("docs/a.txt", 9, bytearray(text.encode()))], "path string, length long, content binary")
    found = audit.findings(files, exempt={"email address": ["known@example.invalid"]})
    assert {(r.path, r.rule, r.line) for r in found.collect()} == {
        ("tmp/x", "forbidden path", None), ("private/people.csv", "private path", None), ("private/people.csv", "too large", None), ("docs/a.txt", "email address", 2), ("docs/a.txt", "API token", 3), ("docs/a.txt", "private key", 4)
    }
    assert audit.exit_code(found) == 1 and audit.exit_code(found.limit(0)) == 0


def test_audit_from_a_configuration(spark):
    options = audit.from_config('{"forbidden": ["cache/", "sources/raw/"], "exempt": {"email address": ["known@example.invalid"]}, "patterns": {"email address": "[a-z.]+@[a-z.]+", "first word": "^todo\\\\b"}}')
    files = spark.createDataFrame([("cache/x", 1, bytearray(b"")), ("sources/raw/y", 1, bytearray(b"")), ("tmp/z", 1, bytearray(b"")), ("a.md", 1, bytearray(b"x\ntodo known@example.invalid\nnot todo a@b.c"))], "path string, length long, content binary")
    assert {(r.path, r.rule, r.line) for r in audit.findings(files, **options).collect()} == {("cache/x", "forbidden path", None), ("sources/raw/y", "forbidden path", None), ("a.md", "first word", 2), ("a.md", "email address", 3)}
    with pytest.raises(ValueError, match="unknown"):
        audit.from_config('{"other": 1}')


def test_patterns_that_look_around_are_not_used_on_whole_texts(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "b")], "k int, text string")
    found = audit.text_findings(df, "k", patterns={"b alone": r"(?<!\n)b", "ends": r"b\z"})
    assert sorted((r.k, r.rule, r.line) for r in found.collect()) == [(1, "b alone", 2), (1, "ends", 2), (2, "b alone", 1), (2, "ends", 1)]


def test_default_deny(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "ok boolean")
    assert [workflow.readable(df, role, {"owner": F.lit(True), "public": F.col("ok")}).count() for role in ("owner", "public", "nobody")] == [3, 1, 0]


def test_summaries_in_one_pass_equal_one_by_one(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, rng.randrange(9)]), rng.random() if i % 3 else None, None) for i in range(97)]
    df = spark.createDataFrame(rows, "a long, b double, c double").repartition(5)
    got = {r.metric: tuple(r)[1:] for r in stats.summaries(df, {"a": "a", "b": "b", "c": "c"}, digits=None, extremes=True).collect()}
    assert set(got) == {"a", "b"} and all(got[c] == pytest.approx(tuple(stats.summary(df, c, None, True).first())) for c in got)


def test_ranking_of_all_rows(spark):
    df = spark.range(3000).select(((F.col("id") * 7919) % 3001).alias("v"))
    assert [r["rank"] for r in stats.ranking(df, [F.desc("v")]).orderBy(F.desc("v")).collect()] == list(range(1, 3001))


def test_workflow_rules(spark):
    papers = spark.createDataFrame([("r1", "p1", "u", "CC0-1.0", "published", "license-cleared", True, "source-license"), ("r2", "p2", "u", None, "odd", "license-cleared", True, "manual-hold")], "record_id string, paper_id string, source_url string, source_license string, translation_status string, authorization_status string, publication_allowed boolean, publication_basis string")
    assert {r.rule for r in workflow.paper_breaches(papers).collect()} == {"source_license is required", "translation_status in its domain", "allowed has a basis"}
    contacts = spark.createDataFrame([("c1", "r1", "publisher", "paper", "verified", "a@x.invalid", None), ("c2", "r9", "publisher", "paper", "verified", "A@x.invalid", None)], "contact_id string, record_id string, role string, source_type string, verification_status string, email string, suppressed_at timestamp")
    assert [r.rule for r in workflow.contact_breaches(contacts, papers).collect()] == ["record_id exists"]
    requests = spark.createDataFrame(
        [("q1", "r1", "c1", S.REQUEST_TYPE, "sent", None, None, "unknown", None), ("q2", "r1", "c1", S.REQUEST_TYPE, "draft", None, None, "granted", None), ("q3", "r1", "c1", S.REQUEST_TYPE, "cancelled", None, None, "unknown", None)],
        "request_id string, record_id string, contact_id string, request_type string, status string, approved_by string, approved_at timestamp, permission_decision string, evidence_sha256 string",
    )
    assert sorted(r.rule for r in workflow.request_breaches(requests, papers, contacts).collect()) == ["approval before sending", "grant has evidence", "record_id, contact_id, request_type unique"]
    sent = spark.createDataFrame([], "contact_id string, first_sent_at timestamp")
    wanted = spark.createDataFrame([("q1", "c1"), ("q2", "c2")], "request_id string, contact_id string")
    assert [r.request_id for r in workflow.mailable(wanted, contacts, sent, "2026-01-01").collect()] == ["q1"]


def test_previous_states_of_a_hot_request(spark):
    events = spark.range(3000).select(F.concat(F.lit("e"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("event_id"), F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("q"), F.col("id") % 7)).alias("request_id"), (F.col("id") % 500).alias("occurred_at"), F.concat(F.lit("s"), F.col("id") % 11).alias("new_status"))
    plain, spread = (sorted((r.event_id, r.previous_status or "") for r in workflow.with_previous(events, spread=s).collect()) for s in (False, True))
    assert plain == spread


def test_states_over_the_log(spark):
    events = spark.createDataFrame([("e1", "q", "2026-01-01", "not-reviewed"), ("e2", "q", "2026-01-02", "needs-permission"), ("e3", "q", "2026-01-03", "permission-granted"), ("e4", "q", "2026-01-04", "withdrawn")], "event_id string, request_id string, occurred_at string, new_status string")
    changes = workflow.with_previous(events)
    assert [(r.previous_status, r.new_status) for r in workflow.forbidden_changes(changes, S.AUTHORIZATION_EDGES).collect()] == [("needs-permission", "permission-granted")]
    assert tuple(workflow.latest(events).first()) == ("q", "2026-01-04", "withdrawn")
    after = events.filter("event_id <> 'e1'").withColumn("new_status", F.when(F.col("event_id") == "e2", "x").otherwise(F.col("new_status")))
    assert {(r.key, r.rule) for r in workflow.rewritten(events, after).collect()} == {("e1", "deleted"), ("e2", "updated")}
