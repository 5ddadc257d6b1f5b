"""Distributed classifier training and selection.

The reference trains a single-machine Conv1D network; here the classifier is
Spark ML's multilayer perceptron with the same dense widths (256, 128) and a
softmax output, trained on the standardised vectors, seed 42, block 64. It
is not weight-compatible with the reference network and makes no claim of
equal accuracy. Model choice uses folds of the *train* rows only, keyed by
clip (the reference validated on its test set).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import title_case
from . import learn as LN


def design(df: DataFrame, scaler: LN.PopulationScaler, vec_col: str = "features") -> DataFrame:
    """M1 + M2: standardised vector as an ML vector column ``x``."""
    return df.withColumn("x", array_to_vector(scaler.transform_col(F.col(vec_col))))


def mlp(n_in: int, n_classes: int, max_iter: int = 100, seed: int = 42) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(featuresCol="x", labelCol="y", layers=[n_in, 256, 128, n_classes],
                                          blockSize=64, seed=seed, maxIter=max_iter)


def fit_mlp(train: DataFrame, n_in: int, n_classes: int, max_iter: int = 100):
    return mlp(n_in, n_classes, max_iter).fit(train)


HISTORY = ("model string, run long, iterations long, step long, loss double, accuracy double, "
           "val_loss double, val_accuracy double")


def measure(model, data: DataFrame) -> tuple[float, float]:
    """Log loss and accuracy of a fitted classifier, in one pass."""
    p = F.element_at(vector_to_array("probability"), F.col("y").cast("int") + 1)
    r = model.transform(data).agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("loss"),
                                  F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("accuracy")).first()
    return (float("nan"), float("nan")) if r["loss"] is None else (float(r["loss"]), float(r["accuracy"]))


class Fitted(NamedTuple):
    """A candidate at its best: after how many iterations, and its scores."""
    model: object
    iterations: int
    val_loss: float
    val_accuracy: float


def append_history(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """One row for each run (at most some dozens of a candidate)."""
    spark.createDataFrame(rows, HISTORY).coalesce(1).write.mode("append").parquet(f"{root}/_history")


def read_history(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(f"{root}/_history")


def fit_in_runs(est: MultilayerPerceptronClassifier, train: DataFrame, val: DataFrame, name: str, root: str,
                step: int = 16, max_iterations: int = 100, patience: int = 4) -> Fitted:
    """The network's weights at the least validation loss of its runs."""
    weights, best, rows, done, missed = None, None, [], 0, 0
    while step and done < max_iterations and missed < patience:
        est = est.copy().setMaxIter(min(step, max_iterations - done))
        if weights is not None:
            est = est.setInitialWeights(weights)
        model = est.fit(train)
        done += est.getMaxIter()
        (loss, accuracy), (val_loss, val_accuracy) = measure(model, train), measure(model, val)
        rows.append((name, len(rows) + 1, done, step, loss, accuracy, val_loss, val_accuracy))
        if best is None or val_loss < best.val_loss:
            best, weights, missed = Fitted(model, done, val_loss, val_accuracy), model.weights, 0
        else:
            missed, step, weights = missed + 1, step // 2, best.model.weights
    append_history(train.sparkSession, root, rows)
    return best


def fit_once(est, train: DataFrame, val: DataFrame, name: str, root: str) -> Fitted:
    """A convex candidate needs a single run to its end."""
    model = est.fit(train)
    (loss, accuracy), (val_loss, val_accuracy) = measure(model, train), measure(model, val)
    done = int(model.summary.totalIterations)
    append_history(train.sparkSession, root, [(name, 1, done, done, loss, accuracy, val_loss, val_accuracy)])
    return Fitted(model, done, val_loss, val_accuracy)


def candidates(n_in: int, n_classes: int) -> dict:
    """Estimators by name: the network and logistic regressions."""
    out = {"mlp": mlp(n_in, n_classes)}
    for reg in (0.0, 0.01, 0.1):
        out[f"logistic_{reg:g}"] = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", maxIter=50, regParam=reg)
    return out


def held_out(train: DataFrame, key: str = "vec_id", folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Train rows without one fold, and the fold: by the md5 bucket of the
    clip key, so variants of a clip never lie on both sides."""
    from . import split as SP
    fold = SP.split_bucket(F.concat(F.lit("fold-"), F.col(key).cast("string"))) % folds
    return train.filter(fold != 0), train.filter(fold == 0)


def select_model(train: DataFrame, found: dict, root: str, key: str = "vec_id", folds: int = 5) -> DataFrame:
    """M8: fit every candidate without one fold of the train rows, choose by
    the validation loss on that fold (ties: the first name), fit the choice
    again on all train rows, and save it as ``selected``.

    Returns a row per candidate: ``model, iterations, val_loss, val_accuracy,
    chosen``, and for the chosen one ``train_loss`` of the refitted model and
    ``stored_loss``, that of the model read back."""
    spark = train.sparkSession
    inner, val = held_out(train, key, folds)
    best = {}
    for name, est in found.items():
        run = fit_in_runs if isinstance(est, MultilayerPerceptronClassifier) else fit_once
        best[name] = run(est, inner, val, name, root)
        save_model(best[name].model, f"{root}/{name}")
    chosen = min(best, key=lambda n: (best[n].val_loss, n))
    est = found[chosen].copy().setMaxIter(max(1, best[chosen].iterations))
    if isinstance(est, MultilayerPerceptronClassifier):
        est = est.setInitialWeights(best[chosen].model.weights)
    final = est.fit(train)
    save_model(final, f"{root}/selected")
    stored = ModelStore(spark, root).load("selected")
    losses = measure(final, train)[0], measure(stored, train)[0]
    rows = [(n, b.iterations, b.val_loss, b.val_accuracy, n == chosen, *(losses if n == chosen else (None, None)))
            for n, b in best.items()]
    return spark.createDataFrame(rows, "model string, iterations int, val_loss double, val_accuracy double, "
                                       "chosen boolean, train_loss double, stored_loss double")


def history_best(hist: DataFrame) -> DataFrame:
    """A11 over the stored history: per model the iterations run, the least
    validation loss with its run, and the greatest validation accuracy."""
    return hist.sparkSession.sql("""
        SELECT model, max(run) AS runs, max(iterations) AS iterations, min(val_loss) AS best_val_loss,
               min_by(run, struct(val_loss, run)) AS best_run, max(val_accuracy) AS best_val_accuracy
        FROM {hist} GROUP BY model""", hist=hist)


def evaluate(pred: DataFrame) -> DataFrame:
    """M9: accuracy and log loss with Spark's evaluator definitions."""
    acc = MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy").evaluate(pred)
    ll = MulticlassClassificationEvaluator(labelCol="y", metricName="logLoss",
                                           probabilityCol="probability").evaluate(pred)
    return pred.sparkSession.createDataFrame([(float(acc), float(ll))], "accuracy double, logloss double")


def probabilities(pred: DataFrame) -> DataFrame:
    """Probability vector as array<double> ``probs``."""
    return pred.withColumn("probs", vector_to_array("probability"))


CATALOGUE = "file_name string, model_class string, num_classes int, saved timestamp"


def save_model(model, path: str) -> None:
    """Fitted model to the shared store; its name, class and number of
    classes are appended to the store's catalogue."""
    root, _, name = path.rstrip("/").rpartition("/")
    model.write().overwrite().save(path)
    spark = SparkSession.active()
    about = spark.createDataFrame([(name, f"{type(model).__module__}.{type(model).__name__}", int(model.numClasses))],
                                  "file_name string, model_class string, num_classes int")
    about.withColumn("saved", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/_catalogue")


def load_model(path: str, model_class: str):
    """A saved model by the class that the catalogue names."""
    import importlib
    mod, cls = model_class.rsplit(".", 1)
    return getattr(importlib.import_module(mod.replace("org.apache.spark.ml", "pyspark.ml")), cls).load(path)


def model_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """One row per saved model under ``root``, sorted by folder name:
    folder name, model class, output class count and readable name (extension
    stripped, '_' -> ' ', title case), as of its last save. Only the catalogue
    table is read; no model is opened."""
    rows = spark.read.schema(CATALOGUE).parquet(f"{root.rstrip('/')}/_catalogue")
    newest = rows.groupBy("file_name").agg(F.max_by(F.struct("model_class", "num_classes"), "saved").alias("m"))
    stem = F.regexp_replace(F.col("file_name"), r"\.[^.]*$", "")          # drop a file extension
    name = title_case(F.replace(stem, F.lit("_"), F.lit(" ")))
    return newest.select("file_name", "m.*").withColumn("name", name).orderBy("file_name")


class ModelStore:
    """Saved models under ``root``; each is read once per process."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.loaded = spark, root.rstrip("/"), {}

    def load(self, name: str):
        if name not in self.loaded:
            row = model_catalogue(self.spark, self.root).filter(F.col("file_name") == name).first()
            if row is None:
                raise KeyError(f"no model {name!r} under {self.root}")
            self.loaded[name] = load_model(f"{self.root}/{name}", row["model_class"])
        return self.loaded[name]

    def catalogue(self) -> DataFrame:
        """The catalogue with ``is_loaded``, and on each row the totals
        ``n_loaded`` and ``n_available``."""
        names = F.array(*[F.lit(n) for n in self.loaded]).cast("array<string>")
        rows = model_catalogue(self.spark, self.root).withColumn("is_loaded", F.array_contains(names, F.col("file_name")))
        totals = rows.agg(F.count_if("is_loaded").alias("n_loaded"), F.count(F.lit(1)).alias("n_available"))
        return rows.crossJoin(F.broadcast(totals))  # one row
