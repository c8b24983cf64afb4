"""Toxicity, language ID, decontamination and mixing."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from loomcat.llm import decontamination, language_id, mixing, toxicity, words
from loomcat.llm.common import table
from tests.llm.test_near_dedup import bag
from tests.llm.test_words import plain

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, p string, `a.b` string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, "p", "dot") for i, t, lang in rows], DOCS)


# ---------------------------------------------------------------- toxicity


def toxic_rows(n=400):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = [f"w{rng.randrange(300)}" for _ in range(40)] + (["vile", "foul"][: 1 + i % 2] if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text), "en"))
        labels.append((i, int(not bad or i % 2), int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    df, marks = docs(spark, rows), spark.createDataFrame(labels[:200], "doc_id long, quality int, toxic int")
    found = {r.id: r.toxic for r in toxicity.classify(df, marks).collect()}
    held = labels[200:]
    assert sum(found[i] == bool(t) for i, _, t in held) >= 0.98 * len(held)
    assert not any(found[i] for i, _, t in held if not t)


def test_chain_feeds_earlier_categories():
    """A category that the features don't tell but the earlier one does."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600)
    lists = [np.array([1 + v, 10 + rng.integers(0, 50)]) for v in y]
    model = toxicity.fit_chain(lists, np.stack([y, y], axis=1)) | {"names": ["a", "b"]}
    assert len(model["weights"][1]) == len(model["weights"][0]) + 1 and model["weights"][1][len(model["ids"])] > 0


def brute_chain(model, text):
    """The chain by hand: a set of hashed words and prefixes, weights from a dict, one logistic after the other."""
    place = {int(x): k for k, x in enumerate(model["ids"])}
    hashed = lambda w: int(words.word_hashes(pa.array([w]))[0][0])
    ids = set()
    for w in plain(text or ""):
        ids |= {hashed(w) % toxicity.SPACE, int(words.word_hashes(pa.array([w]), toxicity.PREFIX)[2][0]) % toxicity.SPACE + toxicity.SPACE}
    out = []
    for w in model["weights"]:
        z = w[-1] + sum(w[place[i]] for i in ids if i in place)
        for k, p in enumerate(out):
            p = min(max(p, 1e-4), 1 - 1e-4)
            z += w[len(place) + k] * math.log(p / (1 - p))
        out.append(1 / (1 + math.exp(-z)))
    return out


def test_scores_equal_the_chain_by_hand(spark):
    rows, labels = toxic_rows()
    model = toxicity.learn(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    texts = [t for _, t, _ in rows[:40]] + ["", None, "vile", "unheard-of words", "foul " * 500, "Vile, FOUL!"]
    found = toxicity.scorer(model)(pa.array(texts))
    assert len(model["ids"]) and np.allclose(found, [brute_chain(model, t) for t in texts], atol=1e-9)


def test_out_of_fold_features_are_chosen_without_the_fold():
    """A feature of one row's own can't be chosen for that row's fold, and so not tell its label."""
    y = np.arange(120) % 2
    lists = [np.array([1000 + i]) for i in range(120)]
    rows, cols = np.arange(120), np.arange(120)
    assert not len(toxicity._chosen(rows, cols, 120, y[:, None].astype(float), np.ones(120, dtype=bool), 10))
    told = [np.array([7 if i % 3 == 0 and y[i] else 8]) for i in range(120)]
    use = np.arange(120) % 3 != 0
    r, c = np.arange(120), np.array([x[0] - 7 for x in told])
    assert 0 in toxicity._chosen(r, c, 2, y[:, None].astype(float), np.ones(120, dtype=bool), 10) and not len(toxicity._chosen(r, c, 2, y[:, None].astype(float), use, 10))
    assert len(toxicity.fit_chain(lists, np.stack([y, y], axis=1))["weights"]) == 2


def test_toxicity_ties_and_clashing_columns(spark):
    rows, labels = toxic_rows(100)
    model = toxicity.learn(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    df = spark.createDataFrame([(1, "vile foul", "a", "b"), (2, "fine words", "c", "d")], "doc_id long, text string, __told string, toxic string")
    assert [tuple(r) for r in toxicity.kept(df, model).collect()] == [(2, "fine words", "c", "d")]
    p = float(toxicity.scorer(model)(pa.array(["fine words"]))[0, -1])
    assert toxicity.kept(df, model, threshold=p).count() == 0


def test_toxicity_of_odd_tables(spark):
    rows, labels = toxic_rows(50)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    odd = docs(spark, [(None, None, None), (1, "", "en"), (1, "", "en"), (2, "vile foul " * 200_000, "en")])
    model = toxicity.learn(docs(spark, rows), marks)
    assert toxicity.kept(odd, model).count() <= 4 and toxicity.kept(odd, model).columns == odd.columns
    assert toxicity.classify(odd, marks.limit(0)).filter("toxic").count() == 0
    assert toxicity.classify(odd.limit(0), marks).count() == 0


# ---------------------------------------------------------------- language ID


def test_language_accuracy_on_held_out_documents(spark, data):
    df = table(spark, data.replace("0.001", "0.01"), "documents")
    found = language_id.identify(df).join(df.select(F.col("doc_id").alias("id"), "lang"), "id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.98


def test_unseen_words_back_off(spark):
    rows = [(i, "the thing then thatch thinning " * 3, "en") for i in range(20)] + [(100 + i, "der schön schluss schicht über " * 3, "de") for i in range(20)]
    model = language_id.learn(docs(spark, rows))
    assert not language_id.known(model["words"], ["schiene"])[0] and language_id.known(model["words"], ["thing"])[0]
    score = language_id.scorer(model)
    best, value = score(pa.array(["schlüssel schiene", "thinner thatcher", "", None, "123 !?", "Schön THE the the"]))
    assert [model["langs"][b] if b >= 0 else "und" for b in best] == ["de", "en", "und", "und", "und", "en"]
    assert ((value >= 0) & (value <= 1)).all() and value[2] == 0


def brute_language(rows, text):
    """The model counted with dicts, and a whole text scored word by word."""
    langs = sorted({x for _, _, x in rows})
    counts = {x: collections.Counter(w for _, t, lang in rows if lang == x for w in LETTERS.findall(t.lower())) for x in langs}
    grams = {k: {x: collections.Counter() for x in langs} for k in language_id.ORDERS}
    for x in langs:
        for w, n in counts[x].items():
            for k in language_id.ORDERS:
                for i in range(len(w) + 3 - k):
                    grams[k][x][f"^{w}$"[i : i + k]] += n

    def logs(table, least):
        kept = sorted(g for g in set().union(*table.values()) if sum(c[g] for c in table.values()) >= least)
        totals = {x: sum(table[x][g] for g in kept) + 0.5 * len(kept) for x in langs}
        return {g: np.array([math.log((table[x][g] + 0.5) / totals[x]) for x in langs]) for g in kept}

    by_word, by_gram = logs(counts, 2), {k: logs(v, 3) for k, v in grams.items()}
    found = LETTERS.findall((text or "").lower())
    total = np.zeros(len(langs))
    for w in found:
        if w in by_word:
            total += by_word[w]
            continue
        for k in language_id.ORDERS:
            parts = [f"^{w}$"[i : i + k] for i in range(len(w) + 3 - k)]
            seen = [by_gram[k][g] for g in parts if g in by_gram[k]]
            if seen and 2 * len(seen) >= len(parts):
                total += np.mean(seen, axis=0)
                break
    if not found:
        return "und", 0.0
    z = total * min(len(found), language_id.EVIDENCE) / len(found)
    odds = np.exp(z - z.max())
    return langs[int(odds.argmax())], float(odds.max() / odds.sum())


def test_scores_of_whole_texts_equal_brute_force(spark, data):
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, data, "documents").collect() if r.lang is not None and r.text is not None]
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2][:60]
    model = language_id.learn(docs(spark, train))
    texts = [t for _, t, _ in rows[::4]] + [None, "", "1 2 3", "ΟΔΟΣ ΟΔΟΣ", "xqzj", "Don't STOP", "a\u0301b", "word " * 5000, "ß", "日本語 テキスト"]
    best, score = language_id.scorer(model)(pa.array(texts, pa.string()))
    got = [("und" if b < 0 else model["langs"][b], x) for b, x in zip(best, score, strict=True)]
    for t, (lang, x) in zip(texts, got, strict=True):
        wanted = brute_language(train, t)
        assert lang == wanted[0] and x == pytest.approx(wanted[1], abs=1e-4), t


def test_learning_and_scoring_lower_alike(spark):
    """A final sigma is the same word in a text that is learned and in one that is scored; ties go to the first name."""
    model = language_id.learn(docs(spark, [(i, "ΟΔΟΣ ΜΕΡΟΣ", "el") for i in range(8)] + [(20 + i, "same same", "aa") for i in range(8)] + [(40 + i, "same same", "bb") for i in range(8)]))
    found, _ = language_id.known(model["words"], language_id.words_of(pa.array(["ΟΔΟΣ ΜΕΡΟΣ same"]))[0].to_pylist())
    assert found.all()
    best, _ = language_id.scorer(model)(pa.array(["same"]))
    assert model["langs"][best[0]] == "aa"


def test_sample_is_bounded_and_repeats_count_once(spark):
    rows = [(i, f"word{i} and more", "en") for i in range(3000)] + [(5001, "one text", "de")] * 500 + [(6000 + i, f"wort{i}", "de") for i in range(40)]
    got = collections.Counter(r["lang"] for r in language_id.sample(docs(spark, rows), "doc_id", "text", "lang", 100).collect())
    assert got["en"] == 100 and 20 <= got["de"] <= 41


def test_language_of_odd_tables(spark):
    odd = docs(spark, [(None, "the the", "en"), (1, None, None), (2, "", "en"), (4, "word " * 300_000, None), (4, "1", "xx")])
    found = {(r.id, r.lang_pred) for r in language_id.identify(odd).collect()}
    assert all(p == "und" for i, p in found if i in (1, 2)) and len(found) >= 4
    assert language_id.identify(odd.limit(0)).count() == 0
    model = language_id.learn(docs(spark, [(i, "the thing", "en") for i in range(8)]))
    kept = language_id.kept(odd, model)
    assert kept.columns == odd.columns and kept.count() == 2
    clash = spark.createDataFrame([(1, "the thing", "own", "p")], "doc_id long, text string, __told string, lang_pred string")
    assert [tuple(r) for r in language_id.kept(clash, model).collect()] == [(1, "the thing", "own", "p")]


# ---------------------------------------------------------------- decontamination


def brute_windows(text, item):
    n, words, target = len(plain(item)), plain(text), bag(item)
    best = None
    for i in range(len(words) - n + 1):
        b = bag(" ".join(words[i : i + n]))
        score = sum((b & target).values()) / sum((b | target).values())
        if score >= 0.8 and (best is None or score > best[0]):
            best = (score, i)
    return best


def test_contaminations_equal_brute_force(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([6, 12, 12, 40, 90])))) for i in range(25)] + [(90, "too few words"), (91, None), (92, "")]
    items += [(93, items[0][1].upper())]
    rows = []
    for i in range(60):
        words = [word() for _ in range(rng.randrange(150))]
        if i % 2:
            item = plain(rng.choice(items[:25])[1])
            if i % 4 == 1 and len(item) > 30:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = item
        rows.append((i, ", ".join(words).title(), "en"))
    rows += [(None, None, None), (61, "", None), (62, items[0][1], None)]
    found = {(r.id, r.item_id): (round(r.similarity, 9), r.first_word) for r in decontamination.contaminations(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    wanted = {}
    for i, t, _ in rows:
        for k, item in items:
            if t and item and len(plain(item)) >= 5 and (best := brute_windows(t, item)):
                wanted[(i, k)] = (round(best[0], 9), best[1])
    assert found == wanted and len(wanted) > 20
    kept = decontamination.kept(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _, _ in rows if i not in {k[0] for k in wanted})


def test_documents_shorter_than_an_item_equal_brute_force(spark):
    """Items less some words at an end, against longer items: the whole document is the window."""
    rng = random.Random(12)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(n))) for i, n in enumerate([9, 10, 14, 40, 40, 90])]
    items += [(6, items[3][1] + " more"), (7, " ".join(["again and"] * 20))]
    rows = []
    for _, item in items:
        words = item.split()
        for cut in range(len(words)):
            rows += [(len(rows), " ".join(words[: len(words) - cut])), (len(rows) + 1, " ".join(words[cut:]))]
        changed = words[:-2]
        changed[3] = "changed"
        rows.append((len(rows), " ".join(changed)))
    wanted = {}
    for i, text in rows:
        for k, item in items:
            n, a, b = len(text.split()), bag(text), bag(item)
            if n >= 5 and n < len(item.split()) and (score := sum((a & b).values()) / sum((a | b).values())) >= 0.8:
                wanted[(i, k)] = (0, n, round(score, 9), 1)
    df, frame = docs(spark, [(i, t, "en") for i, t in rows]), spark.createDataFrame(items, "item_id long, text string")
    size = {k: len(t.split()) for k, t in items}
    got = decontamination.contaminations(df, frame).collect()
    assert {(r.id, r.item_id): (r.first_word, r.n_words, round(r.similarity, 9), r.n_windows) for r in got if len(rows[r.id][1].split()) < size[r.item_id]} == wanted
    assert len(wanted) > 40 and any(len(items[3][1].split()) - 1 == w[1] for (_, k), w in wanted.items() if k == 3)
    left = {r.doc_id for r in decontamination.kept(df, frame).collect()}
    assert not left & {i for i, _ in wanted} and left == {i for i, _ in rows} - {r.id for r in got}


def test_fingerprints_within_the_radius_are_all_found():
    """Whether few buckets are gone through or all values within reach are looked up."""
    rng = np.random.default_rng(1)
    for n, near in ((40, None), (300, 3)):
        runs = [rng.integers(0, 2**63, 16, dtype=np.uint64) for _ in range(n)] + [rng.integers(0, 2**63, 9, dtype=np.uint64)]
        index = decontamination.Index(list(range(n + 1)), runs)
        if near:
            index.radius = near
            index.near = decontamination._BITS[np.bitwise_count(decontamination._BITS) <= near // 4]
        flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 25 if not near else 6), replace=False)) for _ in range(80)], dtype=np.uint64)
        prints = index.prints[np.arange(80) % n] ^ flips
        wanted = {(w, i) for w in range(80) for i in range(n) if int(prints[w] ^ index.prints[i]).bit_count() <= index.radius}
        assert set(zip(*map(list, index.within(prints, 16)), strict=True)) == wanted and len(wanted) > 20


def test_regions_hold_every_window_that_half_matches():
    rng = np.random.default_rng(2)
    for _ in range(200):
        hit = rng.random(rng.integers(1, 30)) < rng.random()
        wanted = {k for a in range(len(hit)) for b in range(a + 1, len(hit) + 1) if 2 * hit[a:b].sum() >= b - a for k in range(a, b)}
        assert {k for a, b in decontamination.spans(hit) for k in range(a, b)} == wanted


def test_fingerprints_lose_no_more_than_stated():
    """Recall of the candidate search against the exact overlap of all windows, without any other filter: items with changed words, at all similarities from 0.8 on."""
    rng = random.Random(4)
    found = lost = 0
    for k in range(150):
        item = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 60, 120]))]
        text = [f"o{rng.randrange(10**6)}" for _ in range(20)] + item + [f"o{rng.randrange(10**6)}" for _ in range(20)]
        for _ in range(k % 4):
            text[rng.randrange(20, 20 + len(item))] = "changed"
        a, b = (words.shingles(*words.word_hashes(pa.array([" ".join(x)]))[:2], short_texts=False)[0] for x in (item, text))
        index = decontamination.Index([0], [a])
        starts = np.arange(len(b) - len(a) + 1)
        close = {int(w) for w in index.within(decontamination.fingerprints(b, starts, len(a)), len(a))[0]}
        good = {i for i in starts.tolist() if words.weighted_overlap(a, b[i : i + len(a)]) >= 0.8}
        found, lost = found + len(good & close), lost + len(good - close)
    assert found > 500 and lost <= 0.002 * found


@pytest.mark.parametrize("shingles_in_a_part", [1 << 20, 400])
def test_benchmarks_in_parts_and_blocks(spark, monkeypatch, shingles_in_a_part):
    monkeypatch.setattr(decontamination, "PART_SHINGLES", shingles_in_a_part)
    monkeypatch.setattr(decontamination, "BLOCK_ROWS", 2)
    monkeypatch.setattr(decontamination, "BLOCK_SHARE", 10**6)
    items = [(i, " ".join(f"x{i}y{j}" for j in range(5 + i))) for i in range(60)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    text = " ".join(items[i][1] for i in (3, 40, 59))
    rows = [(1, text, "en"), (2, text, "en"), (2, text, "en"), (None, text, "en"), (3, "no item in here at all", "en"), (4, items[20][1], "en")]
    assert decontamination.benchmark_items(frame, "item_id", "text").select("part").distinct().count() == (1 if shingles_in_a_part > 400 else 6)
    found = collections.Counter((r.id, r.item_id) for r in decontamination.contaminations(docs(spark, rows), frame).collect())
    assert found == collections.Counter([(d, i) for d in (1, 2, None) for i in (3, 40, 59)] + [(4, 20)])
    assert decontamination.contaminations(docs(spark, rows), frame.limit(0)).count() == 0
    assert decontamination.contaminations(docs(spark, []), frame).count() == 0
    clash = docs(spark, [*rows, (None, None, None)]).withColumns({"__key": F.lit("mine"), "__none": F.lit("own"), "part": F.lit("p")})
    left = decontamination.kept(clash, frame)
    assert left.columns == clash.columns and [(r.doc_id, r["__key"], r["__none"], r.part) for r in left.orderBy("doc_id").collect()] == [(None, "mine", "own", "p"), (3, "mine", "own", "p")]


# ---------------------------------------------------------------- mixing


def brute_shares(cells, domains, targets, penalty, steps=20_000):
    """The optimum's expected shares, by plain projected gradient in numpy, over (w, p)."""
    w, p = np.array([c[0] for c in cells]), np.array([c[1] for c in cells])
    t = np.array([targets.get(d, 0.0) for d in domains])
    s = np.maximum(t, mixing.FLOOR)
    r, step = np.ones(len(w)), 1 / ((w[:, None] * p**2 / s).sum() + penalty)
    for _ in range(steps):
        r = np.maximum(0, r - step * (p @ ((p.T @ (w * r) - t) / s) + penalty * (r - 1)))
    return r, p.T @ (w * r)


def cells_of(spark, n, alpha, seed):
    rng = np.random.default_rng(seed)
    rows = [(str(i), float(x), [float(v) for v in q]) for i, (x, q) in enumerate(zip(rng.dirichlet(np.ones(n)), rng.dirichlet(alpha, n), strict=True))]
    return rows, spark.createDataFrame(rows, "cell string, w double, p array<double>").repartition(3)


@pytest.mark.parametrize(("alpha", "targets"), [((0.4, 0.4), {"a": 0.75, "b": 0.25}), ((3.0, 0.6, 0.05), {"a": 0.9, "b": 0.08, "c": 0.02}), ((0.3,) * 7, dict(zip("abcdefg", (0.4, 0.2, 0.1, 0.1, 0.1, 0.06, 0.04), strict=True)))])
def test_expected_shares_meet_targets(spark, alpha, targets):
    """Rare domains and more than five of them; every expected share is within two per cent of its target, as at the optimum."""
    domains = sorted(targets)
    rows, cells = cells_of(spark, 60, alpha, 4)
    rates = mixing.fitted_rates(cells, domains, targets)
    found = {r.cell: r.rate for r in rates.collect()}
    share = sum(r[1] * found[r[0]] * np.array(r[2]) for r in rows)
    goal = np.array([targets[d] for d in domains])
    assert np.allclose(brute_shares([r[1:] for r in rows], domains, targets, mixing.PENALTY)[1], goal, rtol=0.02)
    assert np.allclose(share, goal, rtol=0.02) and min(found.values()) >= 0
    totals = mixing.expected_totals(rates, domains, targets, 1.0)
    assert [t["domain"] for t in totals] == domains and np.allclose([t["expected"] for t in totals], share)


def test_rates_equal_numpy_where_targets_are_out_of_reach(spark):
    """No mix of these cells has a quarter of b; the steps end at the optimum of the objective."""
    rows = [("0", 0.5, [0.95, 0.05]), ("1", 0.3, [0.9, 0.1]), ("2", 0.2, [0.99, 0.01])]
    cells = spark.createDataFrame(rows, "cell string, w double, p array<double>")
    targets = {"a": 0.75, "b": 0.25}
    found = {r.cell: r.rate for r in mixing.fitted_rates(cells, ["a", "b"], targets, penalty=0.05).collect()}
    wanted, share = brute_shares([r[1:] for r in rows], ["a", "b"], targets, 0.05)
    got = sum(r[1] * found[r[0]] * np.array(r[2]) for r in rows)
    assert np.allclose(got, share, rtol=0.02) and np.allclose([found[r[0]] for r in rows], wanted, atol=0.1)


def test_posteriors_equal_naive_bayes(spark):
    rng = np.random.default_rng(8)
    levels = {"f": 3, "g": 2}
    marked = [(d, int(f), int(g), int(rng.integers(1, 9))) for d in ("a", "b") for f in range(3) for g in range(2) if rng.random() < 0.8]
    cells = [(f"{f}{g}", f, g) for f in range(3) for g in range(2)]
    got = mixing.posteriors(spark.createDataFrame(cells, "cell string, f int, g int"), spark.createDataFrame(marked, "domain string, f int, g int, n long"), ["a", "b", "c"], levels)
    n = {d: sum(m[3] for m in marked if m[0] == d) for d in "abc"}
    for r in got.collect():
        odds = [(n[d] + 1) / (sum(n.values()) + 3) * (sum(m[3] for m in marked if m[0] == d and m[1] == r.f) + 1) / (n[d] + 3) * (sum(m[3] for m in marked if m[0] == d and m[2] == r.g) + 1) / (n[d] + 2) for d in "abc"]
        assert r.p == pytest.approx([x / sum(odds) for x in odds])


def test_classifier_tells_domains(spark):
    loud = [(i, "BUY NOW!!! " * (5 + i % 3), "en") for i in range(60)]
    calm = [(100 + i, "a calm line of words that goes on and on\n" * (5 + i % 3), "en") for i in range(60)]
    marks = spark.createDataFrame([(i, 0, 0) for i in range(30)] + [(100 + i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    df = docs(spark, loud + calm)
    got = mixing.mixed(df, marks, targets={"good": 1.0, "poor": 0.0})
    assert got.columns == [*df.columns, "mix_tokens", "mix_rate", "mix_copies"]
    rate = collections.defaultdict(list)
    for r in got.collect():
        rate[r.doc_id < 100].append(r.mix_rate)
    assert max(rate[True]) < 0.2 and min(rate[False]) > 1
    same = {r.id: r.mix_rate for r in mixing.document_rates(df, marks, targets={"good": 1.0, "poor": 0.0}).collect()}
    assert all(same[r.doc_id] == pytest.approx(r.mix_rate) for r in got.collect())


def test_mixing_of_odd_tables(spark):
    odd = docs(spark, [(None, None, None), (1, "", "en"), (1, "", "en"), (2, "word " * 300_000, "zz")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.mix_rate for r in mixing.mixed(odd, none).collect()] == [1.0] * 4
    marks = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    assert mixing.mixed(odd, marks).count() == 4 and mixing.mixed(odd.limit(0), marks).count() == 0
    assert {r.mix_tokens for r in mixing.mixed(odd, marks).collect()} == {0, 300_001}


def test_terms_and_levels(spark):
    rows, labels = toxic_rows(300)
    marks = mixing.marked_domains(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "doc_id", mixing.DOMAIN)
    terms = mixing.domain_terms(docs(spark, rows).select(F.col("doc_id").alias("i"), "text"), marks, ["good", "poor", "toxic"])
    assert set(terms["toxic"]) == {"vile", "foul"} and terms["good"] == []
    levels = mixing.levels_by_name(terms)
    got = mixing.featured(docs(spark, [(1, "VILE and foul!", "en"), (2, "vile", "en"), (3, "evile", "en")]), "text", "lang", terms, "tokens", "cell")
    found = {r.doc_id: r.f_terms_2 for r in got.withColumns(mixing.levels_of(F.col("cell"), levels)).collect()}
    assert found == {1: 2, 2: 1, 3: 0}


def test_cells_are_numbered_apart(spark):
    assert mixing.CELLS == np.prod(list(mixing.LEVELS.values()))
    levels = mixing.levels_by_name({"a": [], "b": []})
    some = spark.createDataFrame([("0:00",), ("7679:21",), ("4:02",)], "cell string").withColumns(mixing.levels_of(F.col("cell"), levels))
    assert [[r[f] for f in levels] for r in some.collect()] == [[0] * 7, [15, 9, 3, 2, 3, 2, 1], [0, 0, 0, 1, 0, 0, 2]]


def test_targets_out_of_reach_go_to_the_others(spark):
    assert mixing.reachable({"a": 0.7, "b": 0.3}, {"a": 0.9, "b": 0.1}) == {"a": 0.9, "b": 0.1}
    goals = mixing.reachable({"good": 0.899, "poor": 0.1, "toxic": 0.001}, mixing.TARGETS)
    assert goals["toxic"] == pytest.approx(0.001) and sum(goals.values()) == pytest.approx(1) and goals["good"] / goals["poor"] == pytest.approx(0.9 / 0.08)
    assert mixing.reachable({"a": 0.0}, {"a": 1.0}) == {"a": 0.0} and mixing.reachable({"a": 0.9, "b": 0.1, "c": 0.0}, {"a": 0.2, "b": 0.8})["b"] == pytest.approx(0.5)
    loud = [(i, "BUY NOW!!! " * 5, "en") for i in range(300)] + [(1000 + i, "a calm line of words that goes on\n" * (5 + i % 9), "en") for i in range(700)]
    marks = spark.createDataFrame([(i, 0, 0) for i in range(60)] + [(1000 + i, 1, int(i == 3)) for i in range(140)], "doc_id long, quality int, toxic int")
    got = mixing.document_rates(docs(spark, loud), marks, targets={"good": 0.7, "poor": 0.1, "toxic": 0.2}).collect()
    kept = sum(r.mix_copies > 0 for r in got if r.id >= 1000)
    assert kept >= 0.9 * 700  # one toxic label among calm texts doesn't drop them


def test_calibrated_posteriors_have_the_labels_totals(spark):
    rng = np.random.default_rng(3)
    shares = spark.createDataFrame([(str(c), [float(x) for x in rng.dirichlet((1, 1, 1))]) for c in range(40)], "cell string, p array<double>")
    marked = [(str(c), d, int(rng.integers(0, 50))) for c in range(30) for d in "ab"]
    got = {r.cell: r.p for r in mixing.calibrated(shares, spark.createDataFrame(marked, "cell string, domain string, t long"), ["a", "b", "c"]).collect()}
    for i, d in enumerate("ab"):
        assert sum(t * got[c][i] for c, _, t in marked) == pytest.approx(sum(t for _, x, t in marked if x == d), rel=0.02)
    assert len(got) == 40 and all(sum(p) == pytest.approx(1) for p in got.values())


def test_seven_domains_and_clashing_columns(spark, monkeypatch):
    """Each domain has a word of its own; rates follow seven targets. Users' columns keep their values, also if rates aren't broadcast."""
    rows = [(i, f"topic{'abcdefg'[i % 7]} " * 3 + "and more words of any kind", "en") for i in range(700)]
    marks = spark.createDataFrame([(i, f"d{i % 7}") for i in range(0, 700, 2)] + [(1, "d1")], "doc_id long, kind string")
    targets = {f"d{k}": x for k, x in enumerate((0.4, 0.2, 0.1, 0.1, 0.1, 0.06, 0.04))}
    df = docs(spark, rows).withColumns({"__tokens": F.lit("mine"), "__cell": F.lit("own"), "__chars": F.lit(3), "rate": F.lit("r")})
    out = []
    for most in (mixing.BROADCAST_ROWS, 0):
        monkeypatch.setattr(mixing, "BROADCAST_ROWS", most)
        got = mixing.mixed(df, marks, domain="kind", targets=targets)
        assert got.columns == [*df.columns, "mix_tokens", "mix_rate", "mix_copies"]
        out.append(got.collect())
        assert {(r["__tokens"], r["__cell"], r["__chars"], r["rate"]) for r in out[-1]} == {("mine", "own", 3, "r")}
    shares = collections.Counter()
    for r in out[0]:
        shares[f"d{r.doc_id % 7}"] += r.mix_tokens * r.mix_rate / sum(x.mix_tokens for x in out[0])
    assert all(abs(shares[d] - t) < 0.05 * t + 0.01 for d, t in targets.items())
    assert {r.doc_id: r.mix_rate for r in out[0]} == pytest.approx({r.doc_id: r.mix_rate for r in out[1]})
