"""Sinks: deterministic JSON for bounded results, and distributed tables for large ones."""

from __future__ import annotations

import json
from collections.abc import Collection
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession

from loomcat.sources.folders import put_text

MOST_ROWS = 1_000_000


def _plain(x: object, whole: Collection[str], name: str = "") -> object:
    if isinstance(x, dict):
        return {k: _plain(v, whole, k) for k, v in x.items()}
    if isinstance(x, list | tuple):
        return [_plain(v, whole, name) for v in x]
    if isinstance(x, date | datetime):
        return x.isoformat()
    if isinstance(x, Decimal):
        return float(x)
    return int(x) if name in whole and isinstance(x, float) and x.is_integer() else x


def dumped(value: object, whole: Collection[str] = ()) -> str:
    """JSON, two spaces deep; whole: names whose whole numbers have no decimals. Other doubles keep theirs."""
    return json.dumps(_plain(value, whole), ensure_ascii=False, indent=2) + "\n"


def json_file(rows: DataFrame, path: str, most: int = MOST_ROWS, whole: Collection[str] = ()) -> int:
    """One file with an array of all rows, in their order, two spaces deep, with a line feed at its end. For bounded results: more than `most` rows fail."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rows: use json_lines")
    put_text(rows.sparkSession, path, dumped([r.asDict(recursive=True) for r in found], whole))
    return len(found)


def json_object(spark: SparkSession, value: dict, path: str, whole: Collection[str] = ()) -> None:
    put_text(spark, path, dumped(value, whole))


def json_lines(rows: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """A folder with an object a line, in range partitions of an order, for large results."""
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def csv_folder(rows: DataFrame, path: str) -> None:
    rows.write.mode("errorifexists").csv(path, header=True, quote='"', escape='"')


def appended(rows: DataFrame, path: str) -> None:
    """Adds to an append-only log; there is no way to change or delete what it has."""
    rows.write.mode("append").parquet(path)
