"""Small tables for the corpus operators' tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word%d tail. "


def prose(seed: int, n: int) -> str:
    """n different words, the same for a seed."""
    return " ".join(f"w{(seed * 7919 + i * 104729) % 1_000_003:x}q" for i in range(n))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text, source) rows as the documents table, with columns whose
    names clash with operators' own."""
    full = [(d, t, "en", s, None if t is None else len(t)) for d, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def with_clashes(df: DataFrame, *names: str) -> DataFrame:
    for n in names:
        df = df.withColumn(n, F.lit("clash"))
    return df


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = prose(5, 30_000)
    return [
        (1, prose(1, 60), "a"), (2, prose(2, 60), "a"), (3, prose(1, 60), "b"),
        (4, None, "a"), (5, "", None), (None, prose(3, 40), None), (None, None, None),
        (6, "  \n\t ", "b"), (7, long_text, "c"), (8, prose(4, 25), "c"), (8, prose(4, 25), "c"),
        (9, "ÀÉ é ñ 漢字 \U0001f600 " * 30, "b"), (10, "x" * 5000, "a"), (11, "one", "b"),
    ]
