"""Registered queries over whole tables: rows that the given small tables don't have."""

import __spark_entry__ as entry


def test_positions_of_all_documents(spark, tmp_path):
    rows = [(i, f"text {i}", "en", "web", 7) for i in range(1100)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.record_id: r for r in entry.queries()["w02_w03_p31_positions"](spark, str(tmp_path)).collect()}
    assert len(found) == 1100 and {r.of for r in found.values()} == {1100}
    assert all((found[f"doc:{i}"].position, found[f"doc:{i}"].label) == (i + 1, f"{i + 1:03d}") for i in range(1100))


def test_rankings_have_all_records(spark, data):
    found = entry.queries()["w04_rankings"](spark, data).collect()
    for name in ("by_citations", "by_velocity", "by_proxy"):
        assert sorted(r[name] for r in found) == list(range(1, 201))
