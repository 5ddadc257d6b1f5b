"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocalis.session import shared_dir, ship_package

#: A word is a run of characters other than the six ASCII space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of one given table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def private(df: DataFrame, *names: str) -> list[str]:
    """Names for an operator's own columns, none of them one of ``df``'s."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: later
    steps neither repeat the work nor depend on an executor's local files."""
    spark = df.sparkSession
    path = shared_dir(spark, uuid.uuid4().hex)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ready(df: DataFrame) -> SparkSession:
    """The frame's session, with this package importable on its executors."""
    ship_package(df.sparkSession)
    return df.sparkSession


#: Rows of one range partition, over which one running sum is taken.
ROWS_PER_RANGE = 200_000


def ordered(rows: DataFrame, order_by: list[str]) -> DataFrame:
    """``rows`` stored in a total order (nulls first): ``_part`` numbers the
    range partitions, ``_at`` ascends inside each. Rows that tie in every
    ordering column follow in any order and may lie in several partitions."""
    spark = ready(rows)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                math.ceil(rows.count() / ROWS_PER_RANGE))
    order = [F.col(c).asc_nulls_first() for c in order_by]
    ranged = (
        rows.withColumn("_tie", F.rand(7))
        .repartitionByRange(parts, *order, "_tie").sortWithinPartitions(*order, "_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return cut(ranged.drop("_tie").withColumn("_part", F.shiftright("_at", 33)))


def numbered(rows: DataFrame, order_by: list[str], name: str = "uid") -> DataFrame:
    """``rows`` with a gapless number from 0 in the given order, the same
    however the rows are dealt out (but for rows that tie)."""
    stored = ordered(rows, order_by)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored.groupBy("_part").count().select(  # one row per range partition
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_n0"))
    row = F.row_number().over(Window.partitionBy("_part").orderBy("_at"))
    return (
        stored.withColumn("_row", row).join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_n0") + F.col("_row") - 1)
        .drop("_part", "_at", "_row", "_n0")
    )


def words_of(text: Column) -> Column:
    """Array of the words of a text (null text: none)."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def n_words_of(text: Column) -> Column:
    """Number of words of a text (null text: 0)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def chunks(values: list, sizes: list[int], most: int):
    """(start, end) ranges of consecutive rows holding about ``most`` bytes."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(values):
        yield start, len(values)
