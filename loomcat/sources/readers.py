"""Loaders. Every one reads by a Spark path with a schema of its own, so nothing is inferred."""

from __future__ import annotations

import json
import time
import urllib.request

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcat.operators.keys import CheckError
from loomcat.schemas import TITLES

WHITE_PAPER_COLUMNS = ["number", "title", "authors", "external_id", "frontiers", "topics", "placements"]


def json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file that holds one array of objects, a row for each object."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def fetched(spark: SparkSession, url: str, schema: T.StructType, tries: int = 3, pause: float = 1.0, timeout: float = 30.0) -> DataFrame:
    """The objects of an array at an address (http, https or file), asked for up to `tries` times. For bounded payloads: the driver reads it.

    An answer that is no success fails with its last error; one that is no array fails at once.
    """
    for left in range(tries - 1, -1, -1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"Cache-Control": "no-cache"}), timeout=timeout) as answer:
                payload = json.loads(answer.read())
            break
        except (OSError, ValueError):
            if not left:
                raise
            time.sleep(pause)
    if not isinstance(payload, list):
        raise TypeError(f"{url} has no array")
    rows = spark.createDataFrame([(json.dumps(x),) for x in payload], "value string")
    return rows.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("x")).select("x.*")


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Many files with an object a line: the form that splits, for large inputs."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def optional(spark: SparkSession, path: str, schema: T.StructType, load=json_records) -> DataFrame:
    """As load; without the file an empty relation."""
    try:
        return load(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def titles(spark: SparkSession, path: str) -> DataFrame:
    """The translations of a wrapped file, each with its machine_model; a blank model fails."""
    payload = json_records(spark, path, TITLES)
    if not payload.filter(F.coalesce(F.trim("machine_model"), F.lit("")) == "").isEmpty():
        raise CheckError("the title mapping has no machine_model")
    return payload.select(F.trim("machine_model").alias("machine_model"), F.inline("translations"))


def files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """(path relative to the folder, modified, length, content) of all files below a folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    found = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(folder)
    inside = F.regexp_replace(F.col("path"), r"^[a-z]+:/*", "/")
    root = "/" + folder.split("://")[-1].strip("/") + "/"
    return found.select(F.when(inside.startswith(root), F.substring(inside, len(root) + 1, 2**31 - 1)).otherwise(inside).alias("path"), F.coalesce("modificationTime", F.current_timestamp()).alias("modified"), "length", "content")


def markdown_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The rows of a table of so many columns whose first column is a number, as texts."""
    cells = r"^\|\s*(\d+)\s*\|" + r"((?:\\\||[^|])*)\|" * (len(columns) - 1) + r"\s*$"
    lines = spark.read.text(path).filter(F.col("value").rlike(cells))
    return lines.select(*[F.replace(F.trim(F.regexp_extract("value", cells, i + 1)), F.lit("\\|"), F.lit("|")).alias(c) for i, c in enumerate(columns)])


def white_papers(spark: SparkSession, path: str) -> DataFrame:
    """The catalog's table: number, title, authors, external_id, frontiers, topics and placements."""
    rows = markdown_table(spark, path, WHITE_PAPER_COLUMNS)
    split = lambda c, by: F.filter(F.split(c, by), lambda x: x != "")
    return rows.select(F.col("number").cast("int"), "title", "authors", "external_id", split("frontiers", r",\s*").alias("frontiers"), split("topics", r";\s*").alias("topics"), F.col("placements").cast("int"))


def csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape='"', multiLine=True)


def table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A parquet table; with a schema its columns in that order, cast."""
    found = spark.read.parquet(path)
    return found if schema is None else found.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def jdbc_table(spark: SparkSession, url: str, name: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A table of a database, read in ranges of a numeric key."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts), **options).load()


def first_source(sources: dict[str, str]) -> tuple:
    """(value, name) columns: of columns by source name the first non-null one, and which it is."""
    value = F.coalesce(*[F.col(c) for c in sources.values()])
    name = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(n)) for n, c in sources.items()])
    return value, name
