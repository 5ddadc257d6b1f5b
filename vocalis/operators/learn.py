"""Learning operators.

Fitted parameters are small by construction (one mean/std per feature
dimension, one centroid per class x dimension, one index per class) and are
held like a Spark ML model's parameters: computed by a distributed
aggregate, then applied row-wise with native array functions, so scoring
never shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import split as SP

EPS = 1e-15
MAX_CLASSES = 100_000          # bound on labels / centres brought to the driver
#: Numbers of one distance block inside a task.
BLOCK_VALUES = 2_000_000
MAX_DIMS = 1_000_000           # bound on feature dimensions


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect at most ``max_rows`` rows; more is an error, never a silent cap.
    ``limit(max_rows + 1)`` keeps the driver's intake bounded either way."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows; refusing to collect")
    return rows


def _dbl(v: float) -> str:
    v = float(v)
    if v != v:
        return "double('NaN')"
    if v in (float("inf"), float("-inf")):
        return f"double('{'-' if v < 0 else ''}Infinity')"
    return "%.17ED" % v


def double_array(values) -> Column:
    """Exact array<double> literal built in one call (a SQL literal list),
    instead of one driver round trip per element."""
    return F.expr("array(" + ", ".join(_dbl(v) for v in values) + ")")


def train_test(df: DataFrame, key: str = "vec_id") -> DataFrame:
    """Split keyed by the clip id (md5 bucket), as for paths."""
    return SP.with_split(df, key)


# ---------------------------------------------------------------- vocabulary

def label_vocabulary(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Sorted distinct labels -> 0..k-1, plus k. The distinct runs first, so
    the rank window only sees k rows."""
    d = df.select(label_col).distinct()
    w = Window.orderBy(label_col)
    return (d.withColumn("idx", (F.dense_rank().over(w) - 1).cast("long"))
             .withColumn("k", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))))


def with_index(df: DataFrame, vocab: DataFrame, label_col: str = "label", unseen: str = "raise") -> DataFrame:
    """M4: encode labels by a vocabulary fitted on train rows. A label outside
    it raises or, with ``unseen="status"``, keeps its row with a null index
    and ``status`` 'unseen_label' (else 'ok'). The vocabulary is broadcast
    only after its size is checked (at most MAX_CLASSES rows)."""
    rows = collect_bounded(vocab.select(label_col, "idx", "k"), MAX_CLASSES, "label vocabulary")
    small = df.sparkSession.createDataFrame(rows, vocab.select(label_col, "idx", "k").schema)
    out = df.join(F.broadcast(small), label_col, "left")
    if unseen == "status":
        return out.withColumn("status", F.when(F.col("idx").isNull(), "unseen_label").otherwise("ok"))
    return out.withColumn("idx", F.when(F.col("idx").isNull(),
                                        F.raise_error(F.concat(F.lit("unseen label: "),
                                                               F.col(label_col).cast("string"))))
                          .otherwise(F.col("idx")))


def one_hot(idx: Column, k: Column) -> Column:
    """M5: 0/1 array of length k."""
    return F.transform(F.sequence(F.lit(0), (k - 1).cast("int")), lambda i: F.when(i == idx, 1).otherwise(0))


# ---------------------------------------------------------------- standardiser (A10, M2, M3)

def dim_stats(df: DataFrame, vec_col: str = "features") -> DataFrame:
    """Per-dimension mean and population std; zero std -> divisor 1. One
    vector aggregate: a task adds up its rows' vectors before the shuffle."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    m = df.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("v")).agg(
        Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("m")).filter("m.count > 0")
    n = F.col("m.count").cast("double")
    pop = F.sqrt(F.when(n > 1, F.col("x.variance") * (n - 1) / n).otherwise(F.lit(0.0)))
    both = F.arrays_zip(vector_to_array("m.mean").alias("mean"), vector_to_array("m.variance").alias("variance"))
    st = m.select("m", F.posexplode(both).alias("dim", "x")).select(
        F.col("dim").cast("long").alias("dim"), F.col("x.mean").alias("mean"), pop.alias("std"))
    return st.withColumn("scale", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


@dataclass
class PopulationScaler:
    """(x - mean) / std_pop, std 0 -> 1; fit on the rows given (train only)."""
    mean: list[float]
    scale: list[float]

    @classmethod
    def fit(cls, df: DataFrame, vec_col: str = "features") -> "PopulationScaler":
        rows = collect_bounded(dim_stats(df, vec_col).orderBy("dim"), MAX_DIMS, "scaler dimensions")
        return cls([r["mean"] for r in rows], [r["scale"] for r in rows])

    def transform_col(self, vec: Column) -> Column:
        m = double_array(self.mean)
        s = double_array(self.scale)
        centred = F.zip_with(vec, m, lambda x, mu: x.cast("double") - mu)
        return F.zip_with(centred, s, lambda c, sd: c / sd)

    def transform(self, df: DataFrame, vec_col: str = "features", out_col: str = "scaled") -> DataFrame:
        return df.withColumn(out_col, self.transform_col(F.col(vec_col)))

    def save(self, spark, path: str) -> None:
        """Parameters as a (dim, mean, scale) Parquet table."""
        rows = [(i, float(m), float(s)) for i, (m, s) in enumerate(zip(self.mean, self.scale))]
        spark.createDataFrame(rows, "dim long, mean double, scale double").coalesce(1) \
            .write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "PopulationScaler":
        rows = spark.read.parquet(path).orderBy("dim").collect()       # one row per dimension
        return cls([r["mean"] for r in rows], [r["scale"] for r in rows])


def has_nan_inf(vec: Column) -> Column:
    """M3: the vector holds NaN or +-Inf."""
    return F.exists(vec, lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


# ---------------------------------------------------------------- nearest centroid

def centroids(df: DataFrame, vec_col: str = "features", label_col: str = "label") -> DataFrame:
    """(label, dim, c) class means; partial aggregation per (label, dim)."""
    long = df.select(label_col, F.posexplode(vec_col).alias("dim", "x"))
    return (long.groupBy(label_col, "dim").agg(F.avg(F.col("x").cast("double")).alias("c"))
                .withColumn("dim", F.col("dim").cast("long")))


@dataclass
class NearestCentroid:
    """Distance-to-class-mean classifier with softmax(-d) probabilities.

    The fitted state is k x d numbers (classes x dimensions); prediction is a
    row-wise native expression: no join, no shuffle.
    """
    classes: list
    centres: list[list[float]]

    @classmethod
    def fit(cls, df: DataFrame, vec_col: str = "features", label_col: str = "label") -> "NearestCentroid":
        from pyspark.ml.functions import array_to_vector
        from pyspark.ml.stat import Summarizer
        # one aggregation, partial per task: k rows of d means reach the driver
        rows = collect_bounded(
            df.groupBy(label_col).agg(Summarizer.mean(array_to_vector(F.col(vec_col).cast("array<double>"))).alias("m")),
            MAX_CLASSES, "class centres")
        rows = sorted(rows, key=lambda r: r[label_col])
        return cls([r[label_col] for r in rows], [[float(v) for v in r["m"]] for r in rows])

    def save(self, spark, path: str) -> None:
        """(label, centre array<double>) Parquet table."""
        rows = [(c, [float(v) for v in cs]) for c, cs in zip(self.classes, self.centres)]
        spark.createDataFrame(rows, ["label", "centre"]).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "NearestCentroid":
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["label"])   # k rows
        return cls([r["label"] for r in rows], [list(r["centre"]) for r in rows])

    def transform(self, df: DataFrame, vec_col: str = "features") -> DataFrame:
        """Adds pred, dist, probs (softmax of -distance, in class order), classes.

        Rows meet the centres in Arrow batches as matrices, in blocks of at
        most BLOCK_VALUES numbers; the centres (k x d, bounded by MAX_CLASSES
        and MAX_DIMS) are broadcast once."""
        held = df.sparkSession.sparkContext.broadcast(np.array(self.centres, dtype=np.float64))

        @F.pandas_udf("best int, d double, probs array<double>")
        def score(rows: pd.Series) -> pd.DataFrame:
            centres = held.value
            step = max(1, BLOCK_VALUES // max(1, centres.size))
            best, low, probs = [], [], []
            for a in range(0, len(rows), step):
                x = np.array([np.asarray(r, dtype=np.float64) for r in rows.iloc[a:a + step]])
                gap = x[:, None, :] - centres[None, :, :]
                d = np.einsum("nkd,nkd->nk", gap, gap)
                # argmin on distance rounded to 9 places, ties -> smallest class
                best += np.argmin(np.round(d, 9), axis=1).tolist()
                low += np.round(d.min(axis=1), 9).tolist()
                e = np.exp(d.min(axis=1, keepdims=True) - d)
                probs += list(e / e.sum(axis=1, keepdims=True))
            return pd.DataFrame({"best": best, "d": low, "probs": probs})

        classes = F.array(*[F.lit(c) for c in self.classes])
        out = df.withColumn("classes", classes).withColumn("_s", score(F.col(vec_col)))
        return (out.withColumn("pred", F.get("classes", F.col("_s.best"))).withColumn("dist", F.col("_s.d"))
                   .withColumn("probs", F.col("_s.probs")).drop("_s"))


def log_loss(probs: Column, classes: Column, label: Column) -> Column:
    """-ln p(true), p clipped to [1e-15, 1 - 1e-15]."""
    p_true = F.element_at(probs, F.array_position(classes, label).cast("int"))
    return -F.log(F.least(F.greatest(p_true, F.lit(EPS)), F.lit(1 - EPS)))


def confusion(pred: DataFrame, classes: list, true_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """rows = true class, columns pred_<c>, zero-filled, fixed class list."""
    out = pred.groupBy(true_col).pivot(pred_col, classes).agg(F.count(F.lit(1)))
    for c in classes:
        out = out.withColumnRenamed(str(c), f"pred_{c}")
    return out.fillna(0, subset=[f"pred_{c}" for c in classes])


def classification_report(pred: DataFrame, true_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """Precision, recall, F1, support per class, then accuracy, macro and
    weighted averages (0 where a denominator is 0). All aggregates are over
    per-class counts (k rows)."""
    # one pass over the scored rows -> at most k*k (true, pred) counts; each
    # pair then counts once for its true class and once for its predicted
    # class, so per-class support / predictions / hits come from one
    # aggregation of k*k rows, no join
    pairs = pred.groupBy(F.col(true_col).alias("t"), F.col(pred_col).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    roles = pairs.select(F.explode(F.array(
        F.struct(F.col("t").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("n_pred"),
                 F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("p").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("n_pred"),
                 F.lit(0).cast("long").alias("tp")))).alias("r")).select("r.*")
    per = roles.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                                   F.sum("n_pred").alias("n_pred"))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") /
                                      (F.col("precision") + F.col("recall"))).otherwise(0.0))
    classes = per.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1",
                         F.col("support").cast("long").alias("support"))
    tot = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                 F.col("n").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                 F.col("wf").alias("f1"), F.col("n").cast("long").alias("support")),
    )).alias("s")).select("s.*")
    return classes.unionByName(summary)
