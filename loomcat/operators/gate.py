"""The rights gate: a licence and a decision give a publication state. It is closed unless proven open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcat.functions.values import null_on_blank, strictly_true
from loomcat.schemas import ADAPTABLE, COMPATIBLE, DEFAULT_HOLD, HOLD_CONDITIONS, LICENSE_DECISIONS, MANUAL_LICENSE, NO_DERIVATIVES


def license_decision(license_: Column) -> Column:
    """The decision that a licence leads to: known licences by table, no-derivatives ones by prefix, others by hand."""
    out = F.when(F.lit(False), "")
    for name, decision in LICENSE_DECISIONS.items():
        out = out.when(license_ == name, decision)
    return out.when(license_.rlike("^CC-BY-(NC-)?ND-"), NO_DERIVATIVES).otherwise(MANUAL_LICENSE)


def permits_adaptation(license_: Column) -> Column:
    """True, false, or null where the licence doesn't say."""
    return F.when(license_.isin(ADAPTABLE), True).when(license_.rlike("^CC-BY-(NC-)?ND-"), False)


def source_conditions(license_: Column) -> Column:
    share = license_.isin("CC-BY-SA-4.0", "CC-BY-NC-SA-4.0")
    named = F.coalesce(license_, F.lit("")) != ""
    keep = lambda when, what: F.when(when, F.lit(what))
    named = named & (license_ != "CC0-1.0")
    return F.array_compact(F.array(keep(named, "attribution"), keep(named, "indicate-changes"), keep(share, "share-alike"), keep(license_ == "CC-BY-NC-SA-4.0", "non-commercial")))


def is_open(permits: Column, license_: Column) -> Column:
    """True or false, never null."""
    return strictly_true(permits) & strictly_true(license_.isin(ADAPTABLE))


def hold_condition(decision: Column) -> Column:
    out = F.when(F.lit(False), "")
    for name, condition in HOLD_CONDITIONS.items():
        out = out.when(decision == name, condition)
    return out.otherwise(DEFAULT_HOLD)


def state(license_: Column, permits: Column, decision: Column) -> Column:
    """A struct of authorization_status, publication_allowed, publication_basis and publication_conditions."""
    decision = F.coalesce(null_on_blank(decision), F.lit("manual-review"))
    allowed = is_open(permits, license_)
    return F.struct(
        F.when(allowed, "license-cleared").otherwise("needs-permission").alias("authorization_status"),
        allowed.alias("publication_allowed"),
        F.when(allowed, "source-license").otherwise("manual-hold").alias("publication_basis"),
        F.when(allowed, source_conditions(license_)).otherwise(F.array(hold_condition(decision))).alias("publication_conditions"),
    )


def gate_breaches(records: DataFrame) -> DataFrame:
    """Records whose state doesn't follow from their licence, and permissions without a grant (V10)."""
    opened = is_open(F.col("permits_adaptation"), F.col("source_license"))
    by_grant = (F.col("publication_basis") == "permission-granted") & (F.col("authorization_status") == "permission-granted")
    by_source = opened & (F.col("publication_basis") == "source-license") & (F.col("authorization_status") == "license-cleared")
    allowed = strictly_true(F.col("publication_allowed"))
    closed = ~allowed & strictly_true(F.col("publication_basis") == "manual-hold")
    return records.filter(~F.coalesce(F.when(allowed, by_source | by_grant).otherwise(closed), F.lit(False)))


def incompatible_licenses(records: DataFrame) -> DataFrame:
    """Records whose translation has a licence that the source's licence doesn't allow (V16)."""
    spark = records.sparkSession
    pairs = spark.createDataFrame([(s, t) for s, ts in COMPATIBLE.items() for t in ts], "source_license string, translation_license string")
    return records.filter(F.coalesce(F.col("translation_license"), F.lit("")) != "").join(F.broadcast(pairs), ["source_license", "translation_license"], "left_anti")
