"""Sinks: partitioned Parquet (S3/S4), CSV manifests."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.batches import small_batches


def write_manifest(df: DataFrame, out: str) -> None:
    """``path,label`` per split as header CSV, written by the executors."""
    (df.select("path", "label", "split").write.mode("overwrite")
       .partitionBy("split").option("header", True).csv(out))


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    schema = T.StructType([T.StructField("path", T.StringType()),
                           T.StructField("label", T.StringType()),
                           T.StructField("split", T.StringType())])
    return spark.read.schema(schema).option("header", True).csv(out)


def write_partitioned(df: DataFrame, out: str, *partition_cols: str) -> None:
    """One write of the whole frame; dynamic partition overwrite makes a
    re-run replace only the partitions it produces (idempotent, unlike append)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(out))


def write_files(df: DataFrame, out: str, name: str, content: str) -> None:
    """One file of raw bytes for each row, under ``out/<name>=<value>/``. The
    text sink writes a string's bytes as they are and a newline after them,
    which readers of sized chunks (RIFF) pass over.

    In a folder that all machines mount, the tasks write the same files
    themselves: Hadoop's local file system starts processes for each file to set its
    permissions, tens of milliseconds each. A row's file has the same name in
    every run of its task and appears whole, so a task that is repeated
    replaces its own files."""
    if urlsplit(out).scheme in ("", "file"):
        _write_mounted(df, unquote(urlsplit(out).path) if out.startswith("file:") else out, name, content)
        return
    (df.select(name, df[content].cast("string").alias("value")).write.partitionBy(name)
       .option("maxRecordsPerFile", 1).text(out))


#: Characters that Spark escapes in the name of a partition's folder.
_ESCAPED = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]")


def _folder(name: str, value: str | None) -> str:
    value = "__HIVE_DEFAULT_PARTITION__" if not value else _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value)
    return f"{name}={value}"


def _write_mounted(df: DataFrame, out: str, name: str, content: str) -> None:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, nth = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            for value, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Rows of equal names follow each other and are numbered.
                last, nth = value, nth + 1 if value == last else 0
                folder = f"{out}/{_folder(name, value)}"
                os.makedirs(folder, exist_ok=True)
                file = f"part-{part:05d}-{nth:05d}.txt"
                with open(f"{folder}/.{file}.{TaskContext.get().taskAttemptId()}", "wb") as f:
                    if data.is_valid:
                        f.write(data.as_buffer())
                    f.write(b"\n")
                os.replace(f.name, f"{folder}/{file}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(batch)], pa.int64())})

    small_batches(df.sparkSession)
    os.makedirs(out, exist_ok=True)  # there also when no row is
    rows = df.select(df[name].cast("string").alias("name"), df[content].cast("binary").alias("content"))
    rows.sortWithinPartitions("name", "content").mapInArrow(write, "n long").agg(F.sum("n")).first()


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage so a lost
    executor recomputes from this table, not from the raw blobs."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
