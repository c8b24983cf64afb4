"""Licence scans, chat formatting and vector search."""

import collections
import hashlib
import random
import re
import textwrap

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomcat.llm import chat_format, license_scan, vector_search
from loomcat.llm.common import written
from loomcat.llm.queries import TOKENIZER

# ---------------------------------------------------------------- licences


def licence_rows():
    return [
        (1, "MIT Licence\n\nCopyright (c) 2020 Somebody <a@b.invalid>\nAll rights reserved.\n\n" + license_scan._MIT_BODY.replace("sublicense", "sub-license").upper(), "x"),
        (2, "Released under the MIT Licence\nand more text", "x"),
        (3, "  * licensed UNDER cc by-nc 4.0 !", "x"),
        (4, None, "x"),
        (5, "", "x"),
        (6, "Copyright 2020", "x"),
        (7, "Released under the MIT License to all", "x"),
        (8, "Released under the MIT License.\nReleased under the MIT License.", "x"),
        (9, license_scan.LICENSES[10][1].replace("\n", " "), "x"),
        (11, "Re-leased under the MIT Li-c'ense", "x"),
        (10, "word " * 300_000 + "\nSPDX-License-Identifier: MIT", "x"),
        (None, "Licensed under CC0 1.0.", "x"),
    ]


def test_scan(spark):
    df = spark.createDataFrame(licence_rows(), "doc_id long, text string, license_id string")
    got = {(r.id, r.scope, r.license_id) for r in license_scan.scan(df).collect()}
    assert got == {
        (1, "document", "MIT"), (2, "line", "MIT"), (3, "document", "CC-BY-NC-4.0"), (3, "line", "CC-BY-NC-4.0"), (8, "line", "MIT"), (11, "document", "MIT"), (11, "line", "MIT"), (9, "document", "BSD-2-Clause"), (9, "line", "BSD-2-Clause"), (10, "line", "MIT"),
        (None, "document", "CC0-1.0"), (None, "line", "CC0-1.0"),
    }
    assert license_scan.scan(df.limit(0)).count() == 0


def same_as_sql(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, license_id string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    wanted = con.sql(license_scan.oracle()).fetchall()
    got = {(r.id, r.scope, r.license_id, r.digest) for r in license_scan.scan(df).collect()}
    assert got == {(None if x[0] is None or x[0] != x[0] else int(x[0]), x[1], x[2], x[3]) for x in wanted}
    return got


def test_scan_equals_sql(spark):
    same_as_sql(spark, licence_rows())


def test_licence_files_with_other_case_spelling_and_holders(spark):
    """Files as projects have them match by the digest of the whole text, in Spark and in SQL; a changed word does not."""
    rng, rows, names = random.Random(6), [], {}
    texts = [(n, t) for n, t in license_scan.LICENSES if len(t) > 200] + license_scan.full_texts()
    back = {v: k for k, v in license_scan.SPELLINGS.items() if v.isalpha()}
    for k, (name, text) in enumerate(texts * 3):
        short = len(text) < 4000 and name != "NCSA"
        text = "".join(x if rng.random() < 0.5 else back.get(x.lower(), x) for x in re.split(r"(\s+)", text))
        text = [text.upper, text.lower, text.title][k % 3]() if k % 4 else text
        head = rng.choice(["", "Copyright (c) 2021 Ann & Co.\n\n", "(C) Authors <a@b.invalid>\nAll rights reserved.\n", "© 1999-2024, Somebody\n"])
        rows.append((k, head + (wrapped(text, rng.choice([60, 72, 200])) if short else text), "x"))
        names[k] = name
    rows += [(1000 + k, f"Changed {t}", "x") for k, (_, t) in enumerate(texts)]
    got = same_as_sql(spark, rows)
    assert {(i, n) for i, scope, n, _ in got if scope == "document"} == set(names.items())


def wrapped(text, width):
    return "\n".join(textwrap.fill(line, width, break_long_words=False, break_on_hyphens=False) for line in text.split("\n"))


def test_hard_wrapped_and_full_texts(spark):
    """A body line that begins with copyright or (c) is no notice; notices go, also those of a holder alone."""
    files = {f.stem: f.read_text() for f in license_scan.TEXTS.glob("*.txt")}
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\n" + license_scan._ISC_AS_IS
    rows = [("ISC", "ISC License\n\nCopyright (c) 2004-2010 by Somebody, Inc.\nCopyright Somebody\n(c) Acme\n© Acme\n\n" + isc)]
    for width in range(30, 100, 7):
        rows += [(name, wrapped("Copyright (c) 2020 Somebody\n" + text, width)) for name, text in license_scan.LICENSES if len(text) > 200]
    rows += list(files.items()) + [(name, "Copyright 2020 Acme\n" + text[: text.index(license_scan.END)] + license_scan.END) for name, text in files.items() if license_scan.END in text]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {(r.id, r.license_id) for r in license_scan.scan(df).filter("scope = 'document'").collect()}
    assert got == {(i, name) for i, (name, _) in enumerate(rows)} and {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense"} <= set(files)


def test_every_known_text_has_a_stem():
    assert all(any(stem in license_scan.canonical(t) for stem in license_scan.STEMS) for _, t in [*license_scan.LICENSES, *license_scan.full_texts()])


def test_known_texts_are_told_apart():
    own = license_scan.known(license_scan.LICENSES)
    assert len({d for _, d, _ in own}) == len(own) == len(license_scan.LICENSES) and len(license_scan.known()) == len(own) + len({license_scan.canonical(t) for _, t in license_scan.full_texts()})


# ---------------------------------------------------------------- chats


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["\\", "<", "|", "[", "INST]", "</s>", "<s>", "[/INST]", "<|turn|>", "<|end|>", "a", "\n", "%0A", "%", "SYS>>", "é"]), max_size=12).map("".join))
def test_escapes_revert(text):
    assert chat_format.unescape(chat_format.escape(text)) == text and chat_format.unescape_role(chat_format.escape_role(text)) == text
    for control in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"):
        assert control not in chat_format.escape(text)
    assert chat_format.read_turns(chat_format.write_turn(text, text)[0]) == [(text, text)]


CHAT = "conv_id long, turn long, role string, text string, key string"


def chats():
    rng = random.Random(3)
    rows = []
    for c in range(12):
        for k in range(rng.randrange(1, 30) if c else 400):
            role = "system" if k == 0 and c % 3 == 0 else ["user", "assistant"][k % 2]
            rows.append((c, k, role, " ".join(rng.choice(["</s>", "word", "[INST]", "\n", "é", "<|end|>"]) for _ in range(rng.choice([0, 5, 40, 300]))), "k"))
    rows += [(None, 1, None, None, "k"), (None, None, "assistant", "first", "k"), (50, 0, "assistant", "same", "k"), (50, 0, "assistant", "same", "k"), (51, 0, "user", "long " * 60_000, "k"), (51, 1, "assistant", "ok", "k")]
    rng.shuffle(rows)
    return rows


def test_windows(spark):
    rows = chats()
    df = spark.createDataFrame(rows, CHAT)
    windows = written(chat_format.format_windows(df, TOKENIZER), "windows")
    found = {r.conv_id: r for r in chat_format.digests(windows).collect()}
    turns = collections.defaultdict(list)
    for c, k, role, text, _ in rows:
        turns[c].append((-1 if k is None else k, role or "", text or ""))
    assert set(found) == set(turns)
    for c, own in turns.items():
        own.sort(key=lambda t: t[0])
        loss = "".join(t for _, r, t in own if r == "assistant")
        r = found[c]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    by = collections.defaultdict(list)
    for w in windows.collect():
        by[w.conv_id].append(w)
    for c, ws in by.items():
        ws.sort(key=lambda w: w.window)
        system = turns[c][0][1] == "system"
        for i, w in enumerate(ws):
            got = chat_format.read_turns(w.formatted)
            assert w.n_context == 0 if i == 0 else w.n_context <= 2 + system
            if i and system:
                assert got[0] == (turns[c][0][1], turns[c][0][2])
            count = chat_format.counter(TOKENIZER)
            own = got[w.n_context :]
            assert len(own) == 1 or sum(count(chat_format.write_turn(*t)[0]) for t in own) <= chat_format.STRIDE + chat_format.LONGEST
    assert len(by[0]) > 10 and sum(w.formatted and len(w.formatted) for w in by[0]) == found[0].formatted_chars


def test_many_turns_without_numbers(spark):
    """They come first and in blocks; a piece's order is that of its hash, so nothing is lost or said twice."""
    rng = random.Random(5)
    rows = [(1, None, rng.choice(["user", "assistant"]), f"text {k} " * rng.randrange(1, 60), "k") for k in range(400)] + [(1, k, "assistant", f"later {k}", "k") for k in range(300)] + [(1, -5, "system", "early", "k")]
    rng.shuffle(rows)
    windows = written(chat_format.format_windows(spark.createDataFrame(rows, CHAT), TOKENIZER), "windows")
    own = [t for w in windows.orderBy("window").collect() for t in chat_format.read_turns(w.formatted)[w.n_context :]]
    assert collections.Counter(own) == collections.Counter((r, t) for _, _, r, t, _ in rows) and windows.count() > 5
    assert own[-300:] == [("assistant", f"later {k}") for k in range(300)] and own[400] == ("system", "early")


def test_chats_of_an_empty_table(spark):
    assert chat_format.digests(chat_format.format_windows(spark.createDataFrame([], CHAT), TOKENIZER)).count() == 0


# ---------------------------------------------------------------- vectors


def brute(rows, k, step=5):
    """Of rows (id, vector): every row but the query's own is a candidate; ids repeat and may be null."""
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows]
    out = []
    for n, (q, own) in enumerate(good):
        if q is None or q % step:
            continue
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i is None, i or 0) for m, (i, v) in enumerate(good) if m != n)
        out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(scores[:k])]
    return collections.Counter(out)


@pytest.mark.parametrize(("n", "spread"), [(400, 1.0), (400, 0.01), (4, 1.0)])
def test_top_k_equals_brute_force(spark, monkeypatch, n, spread):
    monkeypatch.setattr(vector_search, "SEGMENT_ROWS", 32)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 7)
    monkeypatch.setattr(vector_search, "MOST_ROWS", 9)
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(5, 8))
    vectors = {i: (centres[i % 5] + spread * rng.normal(size=8)).astype(np.float32).tolist() for i in range(n)}
    for i in range(0, n, 3):
        vectors[i] = vectors[0]
    vectors[n] = [0.0] * 8
    vectors[n + 1] = [1.5, -2.0]
    rows = list(vectors.items())
    rows += [rows[1], (0, vectors[2]), (0, vectors[0]), (None, [1.0] * 8), (None, vectors[0]), (None, vectors[0])]
    odd = [(n + 10, None), (n + 15, []), (n + 20, [float("nan")] * 8), (n + 25, [float("inf")] * 8), (n + 30, [None] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in [*rows, *odd]], "vec_id long, embedding array<float>, id string")
    seen = {}
    got = collections.Counter(tuple(r) for r in vector_search.top_k(df, F.col("id") % 5 == 0, seen=seen).collect())
    assert got == brute(rows, 5) and seen["vectors"] == len(rows) and seen["compared"] <= seen["queries"] * seen["vectors"]


def test_large_components_stay_exact(spark):
    vectors = {i: [float(3 + i) * 1e5, 1.0 + i, -2.0] for i in range(12)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    assert collections.Counter(tuple(r) for r in vector_search.top_k(df, F.col("id") % 5 == 0).collect()) == brute(vectors.items(), 5)


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert vector_search.top_k(df, F.col("id") % 5 == 0).count() == 0
    assert vector_search.top_k(df.limit(0), F.col("id") % 5 == 0).count() == 0
