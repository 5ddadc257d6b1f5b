"""Labelling operators: path -> corpus, code, label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import vocab


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_table(spark: SparkSession, rows: list[tuple], cols: list[str]) -> DataFrame:
    """A small fixed table as an inline VALUES relation (a LocalRelation, so
    Catalyst knows its exact size and the broadcast is bounded)."""
    body = ", ".join("(" + ", ".join(_sql_str(v) if isinstance(v, str) else repr(v) for v in r) + ")"
                     for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(cols)})")


def code_lookup(spark: SparkSession) -> DataFrame:
    """The fixed 29-row (code, label) table."""
    return values_table(spark, vocab.code_label_rows(), ["code", "label"])


def display_table(spark: SparkSession) -> DataFrame:
    return values_table(spark, vocab.DISPLAY, ["label", "label_fr", "emoji"])


def with_corpus_code(df: DataFrame, path_col: str = "path") -> DataFrame:
    """P2 + P3. ``code`` is made non-nullable ('' for no corpus): a null code and
    '' both find no lookup partner, and the join then infers no IS NOT NULL
    filter that Catalyst would push below the projections, re-expanding the
    path and regex expressions inside it."""
    tagged = df.selectExpr("*", f"{L.corpus_tag_sql(path_col)} AS dataset")
    return tagged.selectExpr("*", f"coalesce({L.emotion_code_sql(path_col, 'dataset')}, '') AS code")


def label_from_path(df: DataFrame, path_col: str = "path", keep_code: bool = False) -> DataFrame:
    """Corpus tag, emotion code, code -> label; unlabelled rows dropped.

    The code -> label map is an inner equi-join with the fixed 29-row lookup,
    broadcast (bounded size by construction). The inner join *is* the P5
    filter: '' codes, unknown codes and null codes (no corpus) find no partner.
    """
    spark = df.sparkSession
    tagged = with_corpus_code(df, path_col)
    out = tagged.join(F.broadcast(code_lookup(spark)), on="code", how="inner")
    return out if keep_code else out.drop("code")


def label_rejects(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Rows P5 drops, with the reason (no corpus / no code / unmapped code)."""
    spark = df.sparkSession
    tagged = with_corpus_code(df, path_col)
    rej = tagged.join(F.broadcast(code_lookup(spark)), on="code", how="left_anti")
    return rej.withColumn(
        "reason",
        F.when(F.col("dataset").isNull(), "no_corpus")
         .when(F.col("code") == "", "no_code")
         .otherwise("unmapped_code"))


def with_filename_label(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Serving-side filename parser (8 labels, 'unknown' on miss)."""
    return df.withColumn("fn_label", L.filename_label(F.col(path_col)))


def with_display(df: DataFrame, label_col: str = "label", prefix: str = "") -> DataFrame:
    """Label -> (French text, emoji), default (title case, '❓')."""
    spark = df.sparkSession
    d = display_table(spark).select(
        F.col("label").alias("_dlabel"), F.col("label_fr").alias("_dfr"), F.col("emoji").alias("_demoji"))
    out = df.join(F.broadcast(d), F.col(label_col) == F.col("_dlabel"), "left")
    return (out.withColumn(prefix + "label_fr", F.coalesce(F.col("_dfr"), L.title_case(F.col(label_col))))
               .withColumn(prefix + "emoji", F.coalesce(F.col("_demoji"), F.lit(vocab.DISPLAY_DEFAULT_EMOJI)))
               .drop("_dlabel", "_dfr", "_demoji"))
