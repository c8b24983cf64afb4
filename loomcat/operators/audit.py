"""The audit of files and texts: forbidden paths, sizes and patterns."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcat.schemas import FORBIDDEN_PREFIXES, MAX_FILE_BYTES, PATTERNS, PRIVATE_ALLOWED, PRIVATE_PREFIX


def under(path: Column, prefixes: Iterable[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | path.startswith(p)
    return out


def from_config(text: str) -> dict:
    """The options of `findings` from a catalog's configuration: forbidden prefixes, the private prefix and its allowed files, the greatest size, patterns, and exempt matches by rule (JSON; what is missing has its default)."""
    given = json.loads(text)
    unknown = set(given) - {"forbidden", "private", "allowed", "most", "patterns", "exempt"}
    if unknown:
        raise ValueError(f"unknown settings of the audit: {sorted(unknown)}")
    return given


def path_findings(files: DataFrame, forbidden: Iterable[str] = FORBIDDEN_PREFIXES, private: str = PRIVATE_PREFIX, allowed: Iterable[str] = PRIVATE_ALLOWED, most: int = MAX_FILE_BYTES) -> DataFrame:
    """(path, rule) of files (path, length)."""
    path = F.col("path")
    rules = F.array(
        F.when(under(path, forbidden), "forbidden path"), F.when(path.startswith(private) & ~path.isin(list(allowed)), "private path"), F.when(F.col("length") > most, "too large")
    )
    return files.select("path", F.explode(F.array_compact(rules)).alias("rule"))


def decoded(files: DataFrame) -> DataFrame:
    """files with text from their content; those that aren't UTF-8 are skipped."""
    return files.withColumn("text", F.try_validate_utf8(F.col("content").cast("string"))).filter("text is not null")


def _matches(text: str, rule: str, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(F.lit(rule).alias("rule"), m.alias("found")))


def text_findings(texts: DataFrame, key: str, text: str = "text", patterns: Mapping[str, str] = PATTERNS, exempt: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """(key, rule, line, found) of every match of a pattern; exempt: matches to pass over by rule, in lower case."""
    if not any(x in p for p in patterns.values() for x in ("(?=", "(?!", "(?<", "\\A", "\\z", "\\Z", "\\G")):
        some = "|".join(f"(?:{p})" for p in patterns.values())
        texts = texts.filter(F.col(text).rlike(f"(?m){some}"))  # a match within a line is one within the text
    lines = texts.select(key, F.posexplode(F.split(text, "\n")).alias("line", "content"))
    matches = F.concat(*[_matches("content", name, p) for name, p in patterns.items()])
    out = lines.select(key, (F.col("line") + 1).alias("line"), F.explode(matches).alias("m")).select(key, "m.rule", "line", "m.found")
    for rule, known in (exempt or {}).items():
        out = out.filter(~((F.col("rule") == rule) & F.lower("found").isin([k.lower() for k in known])))
    return out


def clean_texts(texts: DataFrame, text: str = "text", patterns: Mapping[str, str] = PATTERNS) -> DataFrame:
    """The rows in which no pattern occurs."""
    for p in patterns.values():
        texts = texts.filter(~F.coalesce(F.col(text).rlike(p), F.lit(False)))
    return texts


def findings(files: DataFrame, **options) -> DataFrame:
    """(path, rule, line) of all that is wrong with files (path, length, content); none is a pass."""
    paths = path_findings(files, **{k: v for k, v in options.items() if k not in ("patterns", "exempt")})
    inside = text_findings(decoded(files), "path", **{k: v for k, v in options.items() if k in ("patterns", "exempt")})
    return paths.withColumn("line", F.lit(None).cast("int")).unionByName(inside.select("path", "rule", "line"))


def exit_code(found: DataFrame) -> int:
    return int(not found.isEmpty())
