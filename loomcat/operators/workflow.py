"""The authorization workflow: constraints as reports of breaches, states over the event log, and outreach rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcat import schemas as S
from loomcat.operators.keys import duplicate_keys, orphans
from loomcat.operators.ordering import previous


def outside(df: DataFrame, key: str, domains: dict[str, list[str]]) -> DataFrame:
    """(key, rule, value) of values outside their domain; nulls pass, as in a CHECK."""
    each = F.array(*[F.when(F.col(c).isNotNull() & ~F.col(c).isin(d), F.struct(F.lit(f"{c} in its domain").alias("rule"), F.col(c).cast("string").alias("value"))) for c, d in domains.items()])
    return df.select(F.col(key).alias("key"), F.explode(F.array_compact(each)).alias("x")).select("key", "x.*")


def missing(df: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """(key, rule, value) of null or blank values in required columns."""
    each = F.array(*[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.struct(F.lit(f"{c} is required").alias("rule"), F.col(c).cast("string").alias("value"))) for c in columns])
    return df.select(F.col(key).alias("key"), F.explode(F.array_compact(each)).alias("x")).select("key", "x.*")


def breaches(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule, value) of rows for which a rule is false; null passes, as in a CHECK."""
    each = F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()])
    return df.select(F.col(key).alias("key"), F.explode(F.array_compact(each)).alias("rule")).withColumn("value", F.lit(None).cast("string"))


def repeated(df: DataFrame, *columns: str) -> DataFrame:
    """(key, rule, value) of keys that are not unique."""
    key = F.array_join(F.array(*[F.col(c).cast("string") for c in columns]), "|")
    return duplicate_keys(df, *columns).select(key.alias("key"), F.lit(f"{', '.join(columns)} unique").alias("rule"), F.col("n").cast("string").alias("value"))


def _orphaned(child: DataFrame, key: str, parent: DataFrame, column: str) -> DataFrame:
    return orphans(child, parent, {column: column}).select(F.col(key).cast("string").alias("key"), F.lit(f"{column} exists").alias("rule"), F.col(column).alias("value"))


def with_defaults(df: DataFrame) -> DataFrame:
    """df with the store's defaults in place of nulls, for the columns that it has."""
    given = {c: F.uuid() for c in ("contact_id", "request_id", "event_id")} | {c: F.current_timestamp() for c in ("created_at", "updated_at", "occurred_at")}
    given |= {c: F.lit(v) for c, v in {
        "translation_status": "not-started", "authorization_status": "not-reviewed", "publication_allowed": False, "publication_basis": "manual-hold", "verification_status": "unverified",
        "request_type": S.REQUEST_TYPE, "status": "draft", "permission_decision": "unknown", "metadata": "{}",
    }.items()}
    return df.withColumns({c: F.coalesce(c, given[c]) for c in df.columns if c in given})


def readable(rows: DataFrame, role: str, grants: dict[str, Column]) -> DataFrame:
    """The rows that a role may read: those for which its grant is true. A role without a grant reads none."""
    return rows.filter(F.coalesce(grants.get(role, F.lit(False)), F.lit(False)))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def paper_breaches(papers: DataFrame) -> DataFrame:
    opened = F.col("publication_allowed") == F.lit(True)
    return _all([
        repeated(papers, "record_id"), repeated(papers, "paper_id"),
        missing(papers, "record_id", ["paper_id", "source_url", "source_license", "translation_status", "authorization_status", "publication_allowed", "publication_basis"]),
        outside(papers, "record_id", {"translation_status": S.TRANSLATION_STATES, "authorization_status": S.PRIVATE_AUTHORIZATION_STATES, "publication_basis": S.PRIVATE_BASES}),
        breaches(papers, "record_id", {"allowed has a basis": ~opened | F.col("publication_basis").isin(S.OPEN_BASES)}),
    ])


def contact_breaches(contacts: DataFrame, papers: DataFrame) -> DataFrame:
    return _all([
        repeated(contacts, "contact_id"), repeated(contacts, "record_id", "email"), _orphaned(contacts, "contact_id", papers, "record_id"),
        outside(contacts, "contact_id", {"role": S.CONTACT_ROLES, "source_type": S.SOURCE_TYPES, "verification_status": S.VERIFICATIONS}),
    ])


def request_breaches(requests: DataFrame, papers: DataFrame, contacts: DataFrame) -> DataFrame:
    approved = F.col("approved_by").isNotNull() & F.col("approved_at").isNotNull()
    granted = F.col("permission_decision").isin("granted", "granted-with-conditions")
    active = requests.filter(~F.col("status").isin(S.INACTIVE_STATES))
    return _all([
        repeated(requests, "request_id"), repeated(active, "record_id", "contact_id", "request_type"),
        _orphaned(requests, "request_id", papers, "record_id"), _orphaned(requests, "request_id", contacts, "contact_id"),
        outside(requests, "request_id", {"status": S.REQUEST_STATES, "permission_decision": S.DECISIONS, "request_type": [S.REQUEST_TYPE]}),
        breaches(requests, "request_id", {"approval before sending": ~F.col("status").isin(S.APPROVED_STATES) | approved, "grant has evidence": ~granted | F.col("evidence_sha256").isNotNull()}),
    ])


def event_breaches(events: DataFrame, requests: DataFrame) -> DataFrame:
    return _all([repeated(events, "event_id"), _orphaned(events, "event_id", requests, "request_id"), outside(events, "event_id", {"actor_type": S.ACTORS})])


def rewritten(before: DataFrame, after: DataFrame, key: str = "event_id") -> DataFrame:
    """(key, rule, value) of log rows that a later snapshot has lost or changed."""
    hashed = lambda d, to: d.select(key, F.xxhash64(*[F.col(c) for c in sorted(before.columns)]).alias(to))
    both = hashed(before, "was").join(hashed(after, "now"), key, "left").filter("now is null or now <> was")
    return both.select(F.col(key).cast("string").alias("key"), F.when(F.col("now").isNull(), "deleted").otherwise("updated").alias("rule"), F.lit(None).cast("string").alias("value"))


def with_previous(events: DataFrame, request: str = "request_id", time: str = "occurred_at", event: str = "event_id", status: str = "new_status", to: str = "previous_status", spread: bool = False) -> DataFrame:
    """events with the status before each; spread: in range partitions, for logs in which one request has very many events."""
    if spread:
        return previous(events, request, [F.col(time), F.col(event)], status, to)
    return events.withColumn(to, F.lag(status).over(Window.partitionBy(request).orderBy(time, event)))


def latest(events: DataFrame, request: str = "request_id", time: str = "occurred_at", event: str = "event_id", status: str = "new_status") -> DataFrame:
    """(request, last_event_at, status) of each request's last event, as an aggregate: a request with many events is combined before it is shuffled."""
    last = F.max_by(F.struct(F.col(status).alias("s"), F.col(time).alias("t")), F.struct(time, event))
    return events.groupBy(request).agg(last.alias("x")).select(request, F.col("x.t").alias("last_event_at"), F.col("x.s").alias("status"))


def forbidden_changes(changes: DataFrame, edges: list[tuple[str, str]], before: str = "previous_status", after: str = "new_status") -> DataFrame:
    """Changes of state that no edge allows; a first state and a repeated one are no change."""
    spark = changes.sparkSession
    known = spark.createDataFrame(edges, f"`{before}` string, `{after}` string")
    moved = changes.filter(F.col(before).isNotNull() & (F.col(before) != F.col(after)))
    return moved.join(F.broadcast(known), [before, after], "left_anti")


def public_status(private: Column) -> Column:
    """A status as it is shown: the verification of a grant's scope stays private."""
    return F.when(private == "license-scope-verified", "permission-granted").otherwise(private)


def mailable(wanted: DataFrame, contacts: DataFrame, sent: DataFrame, now: str, cooldown_days: int = 30, batch: int = 50) -> DataFrame:
    """Of wanted (contact_id, ...), what may be sent: known, unsuppressed contacts with nothing sent in the cooldown; one for each address; at most `batch` for each domain."""
    good = contacts.filter(F.col("suppressed_at").isNull() & ~F.col("verification_status").isin("bounced", "suppressed")).select("contact_id", F.lower("email").alias("email"))
    recent = sent.filter(F.col("first_sent_at") > F.to_timestamp(F.lit(now)) - F.expr(f"interval {cooldown_days} days")).select("contact_id").distinct()
    recent = recent.join(contacts.select("contact_id", F.lower("email").alias("email")), "contact_id").select("email").distinct()
    open_ = wanted.join(good, "contact_id").join(recent, "email", "left_anti")
    once = open_.withColumn("n", F.row_number().over(Window.partitionBy("email").orderBy("request_id"))).filter("n = 1").drop("n")
    domain = F.regexp_extract("email", "@(.*)$", 1)
    return once.withColumn("n", F.row_number().over(Window.partitionBy(domain).orderBy("request_id"))).filter(F.col("n") <= batch).drop("n")
