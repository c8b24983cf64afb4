"""Mixing by soft membership: a classifier's domain posteriors, and nonnegative document rates.

Native: DataFrame and SQL functions only. Every document falls into a cell of bucketed
features: language, length, share of capitals, share of exclamation marks, words per line, and how
often it has terms of each domain. A domain's terms are the at most `TERMS` words that
lean most to it in `SAMPLE` labelled documents (those with the least hash of their id). A naive Bayes
classifier counted on all labelled documents gives each cell its posterior over the labelled
domains, of which there may be any number; a factor for each domain makes the posteriors' token totals over the labelled
documents equal the labels' own. Documents of one cell have one posterior, hence one gradient and one
rate, so they are counted up to cells before anything is shuffled. The rates minimise

    1/2 sum over domains of (E(r) - T)^2 / max(T, FLOOR) + penalty/2 * mean((r - 1)^2),  r >= 0,

where E are the expected token shares of the domains and T the target shares of `budget` times
all tokens; the weights let rare domains count as much as common ones. Projected gradient steps with momentum, in
the metric of the cells' tokens, run as distributed aggregates over the cells until all expected shares are
within `TOLERANCE` of their targets or no longer move (STEPS at most). A document then gets
floor(rate) copies and one more with the fraction as probability, by the hash of its id.

A target of more than REACH times a domain's own expected share, or of more than that share if it is below RARE, is out of
reach: it is lowered to that, and what is missing goes to the other domains in proportion, so that a domain that is all but
absent, whose posteriors are little more than noise, does not bend the rates of all documents.

Defined results: a null text has no tokens and the cell of an empty one; null languages are
a language. Without labelled documents all rates are 1. Ids may repeat; null ids
hash like 0. Domains in the labels that have no target get the target 0. Very long texts are read whole. Columns
of the input keep their names and values, but for older mix_tokens, mix_rate and mix_copies.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcat.llm.common import fresh, own_columns, spread_join, written

LANGS, LENGTHS, CAPITALS, SHOUTS, LINES = 16, 10, 4, 3, 4
CELLS = LANGS * LENGTHS * CAPITALS * SHOUTS * LINES
FEATURES = ["f_lang", "f_length", "f_capitals", "f_shouts", "f_lines"]
TERMS, TERM_LEVELS, SAMPLE, LEAST_DEVIATION = 24, 3, 4000, 5.0
LEVELS = dict(zip(FEATURES, (LANGS, LENGTHS, CAPITALS, SHOUTS, LINES), strict=True))
#: Target shares of the tokens by domain.
TARGETS = {"good": 0.9, "poor": 0.08, "toxic": 0.02}
DOMAIN = "case when toxic = 1 then 'toxic' when quality = 1 then 'good' when quality = 0 then 'poor' end"
STEPS, TOLERANCE, FLOOR = 120, 0.005, 0.01
PENALTY = 0.0002
REACH, RARE = 5.0, 0.01  # times a domain's share that its target may be; a domain of a lesser share is not raised at all
CALIBRATIONS = 15  # rounds of fitting the factors at most
KEPT_STEPS = 8  # steps between two written states
BROADCAST_ROWS = 1 << 18  # rates, of some 60 bytes, are broadcast up to so many


def levels_by_name(terms: dict[str, list[str]]) -> dict[str, int]:
    return LEVELS | {f"f_terms_{i}": TERM_LEVELS for i in range(len(terms))}


def domain_terms(docs: DataFrame, marks: DataFrame, domains: list[str]) -> dict[str, list[str]]:
    """The terms of each domain, from docs (i, text) and marks (i, domain). Bounded by SAMPLE documents."""
    first = marks.withColumn("h", F.xxhash64("i")).orderBy("h", "i", "domain").limit(SAMPLE).select("i", "domain")
    texts = docs.filter("text is not null").join(F.broadcast(first), "i")
    # a document's words once, so that counts are of documents
    words = texts.select("domain", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"), *[F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(domains)]).filter("n >= 5")
    counts = written(counts, "terms")
    sizes = {r.domain: r.n for r in texts.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    every = sum(sizes.values())
    out = {}
    for i, d in enumerate(domains):
        rate = sizes.get(d, 0) / every if every else 0.0
        lean = (F.col(f"n{i}") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)) + 1)
        out[d] = [r.word for r in counts.select("word", lean.alias("z")).filter(F.col("z") >= LEAST_DEVIATION).orderBy(F.desc("z"), "word").limit(TERMS).collect()]
    return out


def featured(docs: DataFrame, text_col: str, lang_col: str, terms: dict[str, list[str]], tokens_to: str, cell_to: str) -> DataFrame:
    """docs with their tokens and cell, from counts over whole texts that are taken once each. A cell is a number and a digit for each domain's terms."""
    chars, spaces, lines, shouts, capitals, *hit_columns = fresh(["chars", "spaces", "lines", "shouts", "capitals", *[f"terms_{i}" for i in range(len(terms))]], docs)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    less = lambda c: F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    hits = lambda ws: F.regexp_count(F.lower(text), F.lit(r"(?<!\p{L})(?:" + "|".join(ws) + r")(?!\p{L})")) if ws else F.lit(0)
    counts = docs.withColumns({
        chars: F.octet_length(text), spaces: less(" "), lines: less("\n"), shouts: less("!"),
        capitals: F.octet_length(text) - F.octet_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")),
        **{c: hits(ws) for c, ws in zip(hit_columns, terms.values(), strict=True)},
    })
    words = F.when(F.col(chars) > 0, F.col(spaces) + F.col(lines) + 1).otherwise(0)
    size = F.greatest(chars, F.lit(1))
    bucket = lambda x, *cuts: sum((F.when(x >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    levels = {
        "f_lang": F.pmod(F.xxhash64(F.coalesce(F.col(lang_col).cast("string"), F.lit(""))), F.lit(LANGS)),
        "f_length": F.least(F.greatest(F.floor(F.log2(words + F.lit(1.0))) - 4, F.lit(0)), F.lit(LENGTHS - 1)),
        "f_capitals": bucket(F.col(capitals) / size, 0.02, 0.05, 0.2),
        "f_shouts": bucket(F.col(shouts) / size, 0.001, 0.02),
        "f_lines": bucket(words / (F.col(lines) + 1), 8, 16, 40),
    }
    number = F.lit(0)
    for f, n in LEVELS.items():
        number = number * n + levels[f]
    cell = F.concat(number.cast("int").cast("string"), F.lit(":"), *[bucket(F.col(c), 1, 2).cast("string") for c in hit_columns])
    return counts.select(*own_columns(docs), words.cast("long").alias(tokens_to), cell.alias(cell_to))


def levels_of(cell: Column, levels: dict[str, int]) -> dict[str, Column]:
    """The features' levels, read from a cell."""
    out, rest = {}, F.substring_index(cell, ":", 1).cast("int")
    for f, n in reversed(LEVELS.items()):
        out[f] = F.pmod(rest, F.lit(n)).cast("int")
        rest = F.floor(rest / n).cast("int")
    digits = F.substring_index(cell, ":", -1)
    return out | {f: F.substring(digits, i + 1, 1).cast("int") for i, f in enumerate(f for f in levels if f not in LEVELS)}


def posteriors(cells: DataFrame, marked: DataFrame, domains: list[str], levels: dict[str, int] = LEVELS) -> DataFrame:
    """cells with p, an array of probabilities in the order of domains: naive Bayes with add-one smoothing."""
    spark = cells.sparkSession
    totals = marked.groupBy("domain").agg(F.sum("n").alias("n"))
    counts = None
    for name in levels:
        own = marked.groupBy("domain", F.lit(name).alias("feature"), F.col(name).alias("level")).agg(F.sum("n").alias("n"))
        counts = own if counts is None else counts.unionByName(own)
    # a row for each domain and level
    known = {(r.domain, r.feature, r.level): r.n for r in counts.collect()}
    prior = {r.domain: r.n for r in totals.collect()}
    every = sum(prior.values())
    if not every:
        return cells.withColumn("p", F.array(*[F.lit(1.0 / len(domains)) for _ in domains]))
    rows = []
    for d in domains:
        n = prior.get(d, 0)
        for f, size in levels.items():
            rows += [(d, f, k, log((known.get((d, f, k), 0) + 1) / (n + size))) for k in range(size)]
        rows.append((d, "prior", 0, log((n + 1) / (every + len(domains)))))
    logs = spark.createDataFrame(rows, "domain string, feature string, level int, log double")
    wide = cells.select("cell", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("level")) for f in levels], F.struct(F.lit("prior").alias("feature"), F.lit(0).alias("level")))).alias("x"))
    scored = wide.select("cell", "x.*").join(F.broadcast(logs), ["feature", "level"]).groupBy("cell").pivot("domain", domains).agg(F.sum("log"))
    top = F.greatest(*[F.col(f"`{d}`") for d in domains]) if len(domains) > 1 else F.col(f"`{domains[0]}`")
    odds = scored.select("cell", F.array(*[F.exp(F.col(f"`{d}`") - top) for d in domains]).alias("o"))
    shares = odds.select("cell", F.transform("o", lambda v: v / F.aggregate("o", F.lit(0.0), lambda a, b: a + b)).alias("p"))
    return cells.join(shares, "cell")


def calibrated(shares: DataFrame, marked: DataFrame, domains: list[str]) -> DataFrame:
    """shares (cell, p) with p scaled by a factor for each domain, so that the expected tokens of the labelled documents equal the labels' tokens within a per cent."""
    own = marked.groupBy("cell").agg(F.sum("t").alias("t"), *[F.sum(F.when(F.col("domain") == d, F.col("t")).otherwise(0)).alias(f"t{i}") for i, d in enumerate(domains)])
    own = written(own.join(shares.select("cell", "p"), "cell"), "labelled")
    wanted = own.agg(*[F.sum(f"t{i}") for i in range(len(domains))]).first()
    factors = [1.0] * len(domains)

    def scaled() -> Column:
        odds = F.array(*[F.col("p")[i] * F.lit(f) for i, f in enumerate(factors)])
        return F.transform(odds, lambda v: v / F.aggregate(odds, F.lit(0.0), lambda a, b: a + b))

    if not sum(x or 0 for x in wanted):
        return shares
    for _ in range(CALIBRATIONS):
        got = own.withColumn("q", scaled()).agg(*[F.sum(F.col("t") * F.col("q")[i]) for i in range(len(domains))]).first()
        if max(abs(g - w) / max(w, 1e-3 * sum(wanted)) for g, w in zip(got, wanted, strict=True)) < 0.01:
            break
        factors = [max(1e-6, f * (w + 1e-6) / (g + 1e-6)) for f, g, w in zip(factors, got, wanted, strict=True)]
    return shares.withColumn("p", scaled())


def fitted_rates(cells: DataFrame, domains: list[str], targets: dict[str, float], budget: float = 1.0, steps: int = STEPS, penalty: float = PENALTY, tolerance: float = TOLERANCE) -> DataFrame:
    """cells (cell, w: share of all tokens, p) with their rate, by projected gradient steps."""
    goal = [budget * targets.get(d, 0.0) for d in domains]
    scale = [max(t, FLOOR) for t in goal]
    p = [F.col("p")[i] for i in range(len(domains))]
    # the sum of the curvatures along the domains bounds the greatest curvature
    curve = cells.agg(*[F.sum(F.col("w") * x * x / F.lit(s)).alias(f"c{i}") for i, (x, s) in enumerate(zip(p, scale, strict=True))]).first()
    step = 1.0 / (sum(c or 0.0 for c in curve) + penalty)
    now = cells.withColumns({"rate": F.lit(1.0), "ahead": F.lit(1.0)})
    best, before, still, turn = float("inf"), None, 0, 0
    for k in range(steps):
        found = now.agg(*[F.sum(F.col("w") * F.col("ahead") * x).alias(f"e{i}") for i, x in enumerate(p)], F.sum(F.col("w") * (F.col("ahead") - 1) * (F.col("ahead") - 1)).alias("far")).first()
        expected = [e or 0.0 for e in found[:-1]]
        off = [e - t for e, t in zip(expected, goal, strict=True)]
        loss = sum(x * x / s for x, s in zip(off, scale, strict=True)) / 2 + penalty / 2 * (found[-1] or 0.0)
        moved = max(abs(a - b) / s for a, b, s in zip(expected, before or expected, scale, strict=True)) if before else 1.0
        still = still + 1 if moved < tolerance / 20 else 0
        if max(abs(x) / s for x, s in zip(off, scale, strict=True)) <= tolerance or still >= 3:
            return now.select(*cells.columns, F.greatest(F.lit(0.0), F.col("ahead")).alias("rate"))
        turn = turn + 1 if loss <= best else 0  # momentum starts anew where the loss grew
        best, before = loss, expected
        slope = sum((x * F.lit(o / s) for x, o, s in zip(p, off, scale, strict=True)), F.lit(0.0)) + F.lit(penalty) * (F.col("ahead") - 1)
        now = now.withColumn("new", F.greatest(F.lit(0.0), F.col("ahead") - F.lit(step) * slope))
        now = now.select(*cells.columns, F.col("new").alias("rate"), (F.col("new") + F.lit(turn / (turn + 3.0)) * (F.col("new") - F.col("rate"))).alias("ahead"))
        if k % KEPT_STEPS == KEPT_STEPS - 1:
            now = written(now, "rates")
    return now.drop("ahead")


def reachable(before: dict[str, float], targets: dict[str, float], reach: float = REACH, rare: float = RARE) -> dict[str, float]:
    """The targets, none above reach times a domain's share, or that share if it is rare; what is missing goes to the others in proportion."""
    most = {d: x * (reach if x >= rare else 1.0) for d, x in before.items()}
    goals, lowered = dict.fromkeys(before, 0.0) | targets, set()
    total = sum(targets.values())
    while over := {d for d, t in goals.items() if d not in lowered and t > most.get(d, 0.0) + 1e-12}:
        lowered |= over
        goals |= {d: most.get(d, 0.0) for d in over}
        rest = sum(t for d, t in goals.items() if d not in lowered)
        if not rest:
            break
        more = (total - sum(goals[d] for d in lowered)) / rest
        goals |= {d: t * more for d, t in goals.items() if d not in lowered}
    return goals


def expected_totals(cells: DataFrame, domains: list[str], targets: dict[str, float], budget: float) -> list[dict]:
    """For each domain the target share of the tokens, the expected one without rates, and that with them."""
    p = [F.col("p")[i] for i in range(len(domains))]
    got = cells.agg(*[F.sum(F.col("w") * x).alias(f"b{i}") for i, x in enumerate(p)], *[F.sum(F.col("w") * F.col("rate") * x).alias(f"a{i}") for i, x in enumerate(p)]).first()
    n = len(domains)
    return [{"domain": d, "target": budget * targets.get(d, 0.0), "before": got[i] or 0.0, "expected": got[n + i] or 0.0} for i, d in enumerate(domains)]


def marked_domains(labels: DataFrame, id_col: str, domain: str) -> DataFrame:
    return labels.select(F.col(id_col).alias("i"), F.expr(domain).alias("domain")).filter("i is not null and domain is not null")


def domains_of(marks: DataFrame, targets: dict[str, float]) -> list[str]:
    return sorted({*targets, *(r.domain for r in marks.select("domain").distinct().collect())})


@dataclass(frozen=True)
class Mix:
    """docs with tokens and cell (columns of these names), stored so that texts are gone through once; (cell, rate); the totals by domain."""

    told: DataFrame
    tokens: str
    cell: str
    rates: DataFrame
    totals: list[dict]


def cell_rates(documents: DataFrame, marks: DataFrame, domains: list[str], levels: dict[str, int], targets: dict[str, float], budget: float, steps: int, penalty: float) -> tuple[DataFrame, list[dict]]:
    """(cell, rate) from documents (i, tokens, cell), and the totals by domain."""
    marked = documents.join(marks, "i").groupBy("domain", "cell").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
    marked = written(marked.withColumns(levels_of(F.col("cell"), levels)), "marked")
    cells = written(documents.groupBy("cell").agg(F.sum("tokens").alias("t")).withColumns(levels_of(F.col("cell"), levels)), "cells")
    every = cells.agg(F.sum("t")).first()[0] or 0
    if not every or marked.isEmpty():
        return cells.select("cell", F.lit(1.0).alias("rate")), []
    shares = written(posteriors(cells, marked, domains, levels).select("cell", (F.col("t") / F.lit(float(every))).alias("w"), "p"), "shares")
    shares = written(calibrated(shares, marked, domains), "shares")
    before = shares.agg(*[F.sum(F.col("w") * F.col("p")[i]) for i in range(len(domains))]).first()
    goals = reachable(dict(zip(domains, (x or 0.0 for x in before), strict=True)), {d: budget * t for d, t in targets.items()})
    rates = written(fitted_rates(shares, domains, goals, 1.0, steps, penalty), "rates")
    return rates.select("cell", "rate"), [t | {"goal": goals[t["domain"]]} for t in expected_totals(rates, domains, targets, budget)]


def with_copies(mix: Mix, id_col: str) -> DataFrame:
    """The documents of a mix with mix_tokens, mix_rate and mix_copies."""
    (mark,) = fresh(["rate"], mix.told)
    rates = mix.rates.select(F.col("cell").alias(mix.cell), F.col("rate").alias(mark))
    out = mix.told.join(F.broadcast(rates), mix.cell, "left") if rates.count() <= BROADCAST_ROWS else spread_join(mix.told, rates, mix.cell, "left")
    chance = F.pmod(F.xxhash64(F.coalesce(F.col(id_col), F.lit(0))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    own = [c for c, name in zip(own_columns(mix.told), mix.told.columns, strict=True) if name not in (mix.tokens, mix.cell)]
    return out.select(*own, F.col(mix.tokens).alias("mix_tokens"), F.col(mark).alias("mix_rate"), F.floor(F.col(mark) + chance).cast("long").alias("mix_copies"))


def fitted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", domain: str = DOMAIN, targets: dict[str, float] = TARGETS, budget: float = 1.0, steps: int = STEPS,
    penalty: float = PENALTY, keep: bool = False,
) -> Mix:
    """The mix of docs. keep: with all columns of docs, else with the id alone."""
    marks = marked_domains(labels, id_col, domain)
    domains = domains_of(marks, targets)
    terms = domain_terms(docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("text")), marks, domains)
    tokens, cell = fresh(["tokens", "cell"], docs)
    told = featured(docs, text_col, lang_col, terms, tokens, cell)
    told = written(told if keep else told.select(id_col, tokens, cell), "features")
    small = told.select(F.col(id_col).alias("i"), F.col(tokens).alias("tokens"), F.col(cell).alias("cell"))
    return Mix(told, tokens, cell, *cell_rates(small, marks, domains, levels_by_name(terms), targets, budget, steps, penalty))


def document_rates(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per row of docs: id, mix_tokens, mix_rate and mix_copies."""
    return with_copies(fitted(docs, labels, id_col, **options), id_col).select(F.col(id_col).alias("id"), "mix_tokens", "mix_rate", "mix_copies")


def mixed(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The columns of docs (but for older mix_ columns) with mix_tokens, mix_rate and mix_copies."""
    return with_copies(fitted(docs.drop("mix_tokens", "mix_rate", "mix_copies"), labels, id_col, keep=True, **options), id_col)
