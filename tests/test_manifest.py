"""The manifest from files, its checks, and sources and sinks."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from loomcat import schemas as S
from loomcat.operators.keys import CheckError
from loomcat.plans import manifest
from loomcat.sources import readers, sinks


def fixture():
    rights = [
        {"record_id": "arxiv:B", "paper_id": "P-2", "title": "", "frontiers": [], "source_license": "CC-BY-4.0", "permits_adaptation": True, "license_decision": "eligible-after-attribution-check", "license_checked_at": "2026-08-09T01:00:00Z", "source_url": "", "source_version": "v1"},
        {"record_id": "arxiv:a", "title": "alpha", "frontiers": ["AF", "TF", "AF"], "source_license": "ARXIV", "permits_adaptation": None, "license_checked_at": "2026-08-08T01:00:00Z", "translation_status": "human-review"},
        {"record_id": "ext:c", "title": "Zeta", "frontiers": ["CF"], "source_license": None, "permits_adaptation": True, "license_decision": "", "license_checked_at": ""},
    ]
    return {
        "rights": rights,
        "catalog": [{"record_id": " ARXIV:b ", "title": "Beta from catalog", "authors_as_listed": "B. et al.", "frontiers": ["EF"], "topics": ["EF: x"], "external_url": "https://cds.cern.ch/record/1"}, {"record_id": "", "title": "blank"}],
        "analysis": [{"record_id": "arxiv:b", "publication_year": 2022, "citation_count": 7, "citations_per_year": "1.5", "impact_proxy_score_0_100": "", "frontier_labels": ["Energy"], "primary_arxiv_category": ""}],
        "lengths": [{"record_id": "arxiv:a", "page_count": 10, "unicode_token_count": "x"}, {"record_id": "arxiv:b", "page_count": True, "unicode_token_count": 5}],
        "titles": {"machine_model": " m1 ", "translations": [{"record_id": "arxiv:b", "title_zh": "乙"}, {"record_id": "ARXIV:A", "title_zh": "甲", "status": "reviewed"}, {"record_id": "ext:c", "title_zh": "丙"}]},
        "translations": [{"record_id": "arxiv:b", "translation_status": "published", "human_reviewers": ["R"], "publication_translation_url": "https://t.invalid", "publication_translation_size_bytes": 12}, {"record_id": "nobody", "translation_status": "published"}],
    }


def stored(tmp_path, data):
    paths = {}
    for name, value in data.items():
        paths[name] = str(tmp_path / f"{name}.json")
        (tmp_path / f"{name}.json").write_text(json.dumps(value), encoding="utf-8")
    return paths


def test_build_from_files(spark, tmp_path):
    line = manifest.run(spark, str(tmp_path / "out"), **stored(tmp_path, fixture()))
    assert line == {"records": 3, "source_snapshot_date": "2026-08-09", "publication_allowed": 1, "needs_permission": 2}
    text = (tmp_path / "out/papers.json").read_text(encoding="utf-8")
    papers = json.loads(text)
    assert text.endswith("]\n") and "乙" in text and text.startswith("[\n  {\n    \"paper_id\"")
    assert [p["title"] for p in papers] == ["alpha", "Beta from catalog", "Zeta"] and list(papers[0]) == S.PUBLIC
    a, b, c = papers
    assert (b["authors_as_listed"], b["frontiers"], b["source_url"], b["human_reviewers"]) == ("B. et al.", ["EF"], "https://cds.cern.ch/record/1", ["R"])
    assert (b["translation_status"], b["publication_allowed"], b["publication_conditions"]) == ("published", True, ["attribution", "indicate-changes"])
    assert (b["citation_count"], b["citations_per_year"], b["impact_proxy_score_0_100"], b["primary_arxiv_category"]) == (7, 1.5, None, None)
    assert (b["page_count"], a["page_count"], a["unicode_token_count"], a["paper_id"], a["title_zh_status"], b["title_zh_status"]) == (1, 10, None, "arxiv:a", "reviewed", "machine-draft")
    assert (a["translation_status"], c["translation_status"], c["publication_allowed"], c["publication_basis"]) == ("human-review", "not-started", False, "manual-hold")
    stats = json.loads((tmp_path / "out/stats.json").read_text())
    assert stats["frontier_counts"] == {"AF": 2, "CF": 1, "EF": 1, "TF": 1} and stats["license_counts"] == {"ARXIV": 1, "CC-BY-4.0": 1, "unknown": 1}
    assert stats["page_summary"] == {"count": 2, "total": 11, "mean": 5.5, "median": 5.5, "p25": 1, "p75": 10}
    assert '"mean": 5.5' in (tmp_path / "out/stats.json").read_text() and '"total": 11,' in (tmp_path / "out/stats.json").read_text() and '"citation_count": 7,' in text
    assert stats["data_notes"][0].startswith("Citation fields are an INSPIRE-derived snapshot")
    assert stats["year_counts"] == {"2022": 1} and stats["citation_summary"]["count"] == 1 and stats["publication_counts"] == {"allowed": 1, "blocked_or_pending": 2}


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda d: d["catalog"].append({"record_id": "Arxiv:B"}), "duplicate record_id in catalog"),
        (lambda d: d["titles"]["translations"].pop(), "missing=..ext:c"),
        (lambda d: d["titles"]["translations"].append({"record_id": "more", "title_zh": "x"}), "extra=..more"),
        (lambda d: d["titles"].update(machine_model=" "), "machine_model"),
        (lambda d: d["translations"].append({"record_id": "arxiv:a", "translation_status": "published"}), "not cleared"),
    ],
)
def test_checks_fail_closed(spark, tmp_path, change, message):
    data = fixture()
    change(data)
    with pytest.raises(CheckError, match=message):
        manifest.run(spark, str(tmp_path / "out"), **stored(tmp_path, data))
    assert not (tmp_path / "out").exists()


def test_rights_repeat_unless_strict(spark, tmp_path):
    data = fixture()
    data["rights"].append(dict(data["rights"][1]))
    paths = stored(tmp_path, data)
    assert manifest.build(manifest.load(spark, **paths)).count() == 4
    with pytest.raises(CheckError, match="rights"):
        manifest.build(manifest.load(spark, **paths), strict=True)


def test_missing_translations_are_none_and_orphans_are_told(spark, tmp_path):
    paths = stored(tmp_path, fixture())
    assert [r.record_id for r in manifest.unused_translations(manifest.load(spark, **paths)).collect()] == ["nobody"]
    paths["translations"] += ".absent"
    assert manifest.build(manifest.load(spark, **paths)).filter("publication_translation_url is not null").count() == 0


def test_files_and_tables(spark, tmp_path):
    (tmp_path / "tree/private").mkdir(parents=True)
    (tmp_path / "tree/private/x.txt").write_bytes(b"\xff")
    (tmp_path / "tree/a.md").write_text("| # | t |\n|---|---|\n| 1 | One \\| two | A. et al. | arXiv:1 | AF, CF | AF: x; CF: y | 2 |\nno row\n")
    got = {r.path: r.length for r in readers.files(spark, str(tmp_path / "tree")).collect()}
    assert got == {"private/x.txt": 1, "a.md": (tmp_path / "tree/a.md").stat().st_size}
    row = readers.white_papers(spark, str(tmp_path / "tree/a.md")).first()
    assert (row.number, row.title, row.frontiers, row.topics, row.placements) == (1, "One | two", ["AF", "CF"], ["AF: x", "CF: y"], 2)


def test_csv_and_json_round_trips(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", all', 1.5), ("two\nlines", None)], "t string, v double")
    sinks.csv_folder(df, str(tmp_path / "csv"))
    assert sorted(map(tuple, readers.csv_table(spark, str(tmp_path / "csv"), "t string, v double").collect())) == sorted(map(tuple, df.collect()))
    sinks.json_lines(df, str(tmp_path / "json"), [F.col("t")])
    assert readers.json_lines(spark, str(tmp_path / "json"), df.schema).count() == 2
    with pytest.raises(ValueError, match="more than 1"):
        sinks.json_file(df, str(tmp_path / "x.json"), most=1)
    sinks.appended(df, str(tmp_path / "log"))
    sinks.appended(df, str(tmp_path / "log"))
    assert readers.table(spark, str(tmp_path / "log"), df.schema).count() == 4


def test_json_keeps_doubles_and_whole_counts(spark, tmp_path):
    df = spark.createDataFrame([(2.0, 2.0, 0.5)], "score double, count double, share double")
    sinks.json_file(df, str(tmp_path / "x/y.json"), whole={"count"})
    assert (tmp_path / "x/y.json").read_text() == '[\n  {\n    "score": 2.0,\n    "count": 2,\n    "share": 0.5\n  }\n]\n'


class Answers(http.server.BaseHTTPRequestHandler):
    tries = 0

    def do_GET(self):
        Answers.tries += 1
        if self.path == "/flaky" and Answers.tries < 3 or self.path == "/down":
            self.send_error(503)
            return
        self.send_response(200)
        self.end_headers()
        self.wfile.write(b'{"a": 1}' if self.path == "/object" else b'[{"k": "a", "n": 7}, {"k": null}]')

    def log_message(self, *_):
        pass


def test_fetch_tries_again_and_wants_an_array(spark):
    server = http.server.HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at, schema = f"http://127.0.0.1:{server.server_port}", S.T.StructType([S.T.StructField("k", S.STRING), S.T.StructField("n", S.STRING)])
    try:
        assert [tuple(r) for r in readers.fetched(spark, f"{at}/flaky", schema, pause=0).collect()] == [("a", "7"), (None, None)] and Answers.tries == 3
        with pytest.raises(OSError):
            readers.fetched(spark, f"{at}/down", schema, tries=2, pause=0)
        with pytest.raises(TypeError, match="array"):
            readers.fetched(spark, f"{at}/object", schema)
    finally:
        server.shutdown()


def test_tables_of_a_database(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = spark.range(50).selectExpr("id as contact_id", "concat('r', id % 7) as record_id")
    rows.write.format("jdbc").options(url=url, dbtable="contacts", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    found = readers.jdbc_table(spark, url, "contacts", "contact_id", 0, 50, 4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert found.rdd.getNumPartitions() == 4 and sorted(tuple(r) for r in found.collect()) == [(i, f"r{i % 7}") for i in range(50)]


def test_options_have_defaults():
    given = manifest.paths_of(["--root", "/data/", "--titles-zh", "/t.json"])
    assert given["titles_zh"] == "/t.json" and given["rights"] == "/data/rights/rights.json" and set(given) == {"rights", "catalog", "analysis", "lengths", "titles_zh", "translations", "out_dir"}
