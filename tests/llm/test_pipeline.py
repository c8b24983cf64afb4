"""The corpus pipeline: each stage, on what its predecessor kept, against brute force."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomcat.llm import language_id, mixing, toxicity
from loomcat.llm.common import table, written
from tests.llm.test_filters import brute_windows
from tests.llm.test_near_dedup import bag, classes


def test_stages(spark, data):
    docs = table(spark, data, "documents")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], data), name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept[-1].columns == columns
    ids = [sorted(r.doc_id for r in k.select("doc_id").collect()) for k in kept]
    texts = {r.doc_id: r.text for r in docs.collect()}

    model = toxicity.learn(docs, table(spark, data, "labels"))
    p = toxicity.scorer(model)(pa.array([texts[i] for i in ids[0]]))[:, -1]
    assert ids[1] == [i for i, x in zip(ids[0], p, strict=True) if x < toxicity.THRESHOLD] and len(ids[1]) < len(ids[0])

    best, score = language_id.scorer(language_id.learn(kept[1]))(pa.array([texts[i] for i in ids[1]]))
    assert ids[2] == [i for i, b, s in zip(ids[1], best, score, strict=True) if b >= 0 and s >= 0.5]

    least = dict(zip(ids[2], classes([(i, texts[i]) for i in ids[2]]), strict=True))
    assert ids[3] == [i for i in ids[2] if least[i] == i] and len(ids[3]) < len(ids[2])

    items = [(r.text, bag(r.text)) for r in table(spark, data, "benchmark").collect()]
    bags = {i: bag(texts[i]) for i in ids[3]}
    assert ids[4] == [i for i in ids[3] if not any(bags[i].keys() & b.keys() and brute_windows(texts[i], x) for x, b in items)] and len(ids[4]) < len(ids[3])

    last = kept[5].collect()
    assert set(ids[5]) <= set(ids[4]) and all(r.mix_copies >= 1 and abs(r.mix_copies - r.mix_rate) < 1 for r in last)
    rates = {r.id: (r.mix_tokens, r.mix_rate, r.mix_copies) for r in mixing.document_rates(kept[4], table(spark, data, "labels")).collect()}
    assert {r.doc_id: r.mix_rate for r in last} == pytest.approx({i: x[1] for i, x in rates.items() if x[2] > 0}) and all((r.mix_tokens, r.mix_copies) == rates[r.doc_id][::2] for r in last)
    ran = corpus_pipeline.run(spark, data)
    assert ran.columns == [*columns, "mix_tokens", "mix_rate", "mix_copies"] and sorted(r.doc_id for r in ran.select("doc_id").collect()) == ids[5]


def test_empty_documents(spark, data):
    docs = table(spark, data, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
        assert docs.count() == 0


def test_nulls_repeats_and_clashing_columns(spark, data, tmp_path):
    """Rows with nulls in every column, repeated rows, empty texts and columns with the names of helpers go through all five stages."""
    docs = table(spark, data, "documents")
    names = ["__told", "__none", "__row", "__text_key", "__key", "__tokens", "__cell", "__chars", "__rate", "__hot", "__salt", "label", "part", "id", "h"]
    some = docs.withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in names})
    kind = ", ".join(f"`{n}` {t}" for n, t in some.dtypes)
    first = [tuple(r) for r in some.orderBy("doc_id").limit(3).collect()]
    nothing = (None,) * len(some.columns)
    odd = spark.createDataFrame([nothing, nothing, (None, "", *nothing[2:]), (None, docs.first().text, *nothing[2:]), (9_000_001, "1 2 3", *nothing[2:]), *first, *first], kind)
    at = f"{tmp_path}/in"
    some.unionByName(odd).write.parquet(f"{at}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, data, name).write.parquet(f"{at}/{name}.parquet")
    ran = corpus_pipeline.run(spark, at)
    assert ran.columns == [*some.columns, "mix_tokens", "mix_rate", "mix_copies"]
    rows = ran.collect()
    plain = {r.doc_id for r in corpus_pipeline.run(spark, data).collect()}
    assert all(r.doc_id is not None and all(r[n] == f"{n} of {r.doc_id}" for n in names) for r in rows if r.doc_id is not None)
    assert len({r.doc_id for r in rows}) == len(rows) and len({r.doc_id for r in rows} ^ plain) <= 0.1 * len(plain)
