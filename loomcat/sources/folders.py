"""Folders and files that the driver and all executors share, through the store that Spark's paths name."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a session in one process gets a folder of our own if it names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='loomcat-')}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/loomcat/{name}-{uuid.uuid4().hex}"


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a file of UTF-8, with the folders above it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    store.setWriteChecksum(False)
    out = store.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
