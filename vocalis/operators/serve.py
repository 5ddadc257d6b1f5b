"""Scoring requests against a store of models (R1 R2 R4 R5 S6): table in,
records and rejects out.

A stored model is a folder with the class centres, their labels and, if it
was fitted on scaled vectors, the scaler. Every request comes out once: as a
record, or as a reject with its reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import labels as LB
from . import learn as LN
from . import score as SC


def save(spark: SparkSession, root: str, name: str, model: LN.NearestCentroid,
         scaler: LN.PopulationScaler | None = None) -> None:
    model.save(spark, f"{root}/{name}/centres")
    if scaler is not None:
        scaler.save(spark, f"{root}/{name}/scaler")
    row = [(name, len(model.classes), len(model.centres[0]), scaler is not None)]
    spark.createDataFrame(row, "name string, classes int, dims int, scaled boolean").coalesce(1) \
        .write.mode("overwrite").parquet(f"{root}/{name}/about")


def catalogue(spark: SparkSession, root: str) -> list:
    """One row per stored model (name, classes, dims, scaled)."""
    rows = LN.collect_bounded(spark.read.parquet(f"{root}/*/about"), LN.MAX_CLASSES, "stored models")
    return sorted(rows, key=lambda r: r["name"])


def request_status(models: list, vector: str = "features", name: str = "model_name") -> Column:
    """empty_input (no vector), unknown_model, error (wrong length or a null or
    non-finite value), no_features (all zero), else ok. Never null."""
    v = F.col(vector)
    dims = F.create_map(*[x for m in models for x in (F.lit(m["name"]), F.lit(m["dims"]))]) if models else None
    want = F.try_element_at(dims, F.coalesce(F.col(name), F.lit(""))) if models else F.lit(None).cast("int")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.when(v.isNull() | (F.size(v) == 0), "empty_input").when(want.isNull(), "unknown_model")
             .when((F.size(v) != want) | bad, "error").when(F.forall(v, lambda x: x == 0), "no_features")
             .otherwise("ok"))


def records(scored: DataFrame, key: str, name: str, n_classes: int) -> DataFrame:
    """The prediction record: model, main class with display text and
    confidence, all classes ranked and decorated (``ranked``), and the map of
    class to probability (4 places)."""
    names = F.array(*[SC.class_name(F.lit(i)) for i in range(n_classes)])
    show = LB.display_table(scored.sparkSession)
    text = {r["label"]: (r["label_fr"], r["emoji"]) for r in show.collect()}  # fixed rows
    fr = F.create_map(*[F.lit(x) for k, v in text.items() for x in (k, v[0])])
    emoji = F.create_map(*[F.lit(x) for k, v in text.items() for x in (k, v[1])])
    out = scored.withColumn("_names", names).selectExpr("*", f"{SC.ranked_sql('probs', '_names')} AS _ranked")
    ranked = F.transform("_ranked", lambda r: F.struct(
        r["emotion"].alias("emotion"),
        F.coalesce(F.try_element_at(fr, r["emotion"]), LB.L.title_case(r["emotion"])).alias("label_fr"),
        F.coalesce(F.try_element_at(emoji, r["emotion"]), F.lit(LB.vocab.DISPLAY_DEFAULT_EMOJI)).alias("emoji"),
        F.round(r["probability"], 4).alias("probability")))
    out = out.withColumn("ranked", ranked)
    main = F.col("ranked")[0]
    return out.select(
        key, name, main["emotion"].alias("main_emotion"), main["label_fr"].alias("main_label_fr"),
        main["emoji"].alias("main_emoji"), main["probability"].alias("confidence"), "ranked",
        F.map_from_entries(F.transform("ranked", lambda r: F.struct(r["emotion"], r["probability"]))).alias("probabilities"))


def score_requests(spark: SparkSession, requests: DataFrame, root: str, key: str,
                   vector: str = "features", name: str = "model_name") -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of ``requests``; rejects are key, model and status."""
    models = catalogue(spark, root)
    asked = requests.withColumn("status", request_status(models, vector, name))
    rejects = asked.filter("status <> 'ok'").select(key, name, "status")
    out = None
    for m in models:
        model = LN.NearestCentroid.load(spark, f"{root}/{m['name']}/centres")
        its = asked.filter((F.col("status") == "ok") & (F.col(name) == m["name"]))
        if m["scaled"]:
            its = LN.PopulationScaler.load(spark, f"{root}/{m['name']}/scaler").transform(its, vector, vector)
        part = records(model.transform(its, vector), key, name, m["classes"])
        out = part if out is None else out.unionByName(part)
    return out, rejects


def with_json(records_: DataFrame) -> DataFrame:
    """R2 as JSON text, without the map."""
    body = [c for c in records_.columns if c != "probabilities"]
    return records_.withColumn("json", F.to_json(F.struct(*body)))


def record_schema(records_: DataFrame) -> str:
    """The record's own schema as text, to read its JSON form back by."""
    return records_.select(*[c for c in records_.columns if c not in ("probabilities", "json")]).schema.simpleString()


def from_json(rows: DataFrame, schema: str, key: str, text: str = "json") -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of JSON texts: a text that isn't a record of
    ``schema``, or is null, is rejected with ``reason`` and kept as it is."""
    fields = schema[len("struct<"):-1]
    got = F.from_json(F.col(text), f"struct<{fields},_malformed:string>",
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})
    read = rows.select(key, text).withColumn("r", got)
    bad = F.col(text).isNull() | F.col("r").isNull() | F.col("r._malformed").isNotNull() | F.col(f"r.{key}").isNull()
    rejects = read.filter(bad).select(key, text, F.when(F.col(text).isNull(), "no record").otherwise("malformed").alias("reason"))
    return read.filter(~bad).select("r.*").drop("_malformed"), rejects


HISTORY = ("key string, time timestamp, file string, main_emotion string, confidence double, model string")


def append_history(spark: SparkSession, records_: DataFrame, path: str, clock: str) -> None:
    """Records ``key, file, main_emotion, confidence, model`` of one batch,
    all written at the batch's one ``clock``. A key and model that the history
    already holds, from a batch that is replayed, stay as they were."""
    rows = records_.select(F.col("key").cast("string").alias("key"), F.lit(clock).cast("timestamp").alias("time"),
                           "file", "main_emotion", F.col("confidence").cast("double").alias("confidence"), "model")
    spark.createDataFrame([], HISTORY).write.mode("append").parquet(path)  # the table, should it be the first batch
    known = spark.read.schema(HISTORY).parquet(path).select("key", "model")
    rows.dropDuplicates(["key", "model"]).join(known, ["key", "model"], "left_anti").write.mode("append").parquet(path)


def newest(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """The newest ``k`` of the history (ties: the greater key, by text), with the
    time as text, the display label and the confidence in whole percent."""
    rows = spark.read.schema(HISTORY).parquet(path).orderBy(F.desc("time"), F.desc("key"), "model").limit(k)
    shown = LB.with_display(rows, "main_emotion", prefix="main_")
    return shown.select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "file", F.col("main_label_fr").alias("main"),
                        F.col("main_emoji").alias("emoji"), F.floor(F.col("confidence") * 100).cast("long").alias("confidence"), "model")
