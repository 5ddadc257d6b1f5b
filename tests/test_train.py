"""Model selection, history, store, scoring history and JSON records."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from vocalis.operators import serve, train as TR
from vocalis.operators import split as SP


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(3, 6)) * 2
    data = [(i, float(i % 3), Vectors.dense(centres[i % 3] + rng.normal(size=6))) for i in range(300)]
    path = str(tmp_path_factory.mktemp("design"))
    spark.createDataFrame(data, ["vec_id", "y", "x"]).repartition(4).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _network(n_in=6, k=3):
    return TR.mlp(n_in, k).setLayers([n_in, 8, k])


def test_runs_start_from_the_best_weights(spark, rows, tmp_path):
    inner, val = TR.held_out(rows)
    assert inner.count() + val.count() == 300 and 0 < val.count() < 120
    assert inner.join(val, "vec_id").count() == 0
    best = TR.fit_in_runs(_network(), inner, val, "m", str(tmp_path), step=4, max_iterations=24)
    hist = TR.read_history(spark, str(tmp_path)).orderBy("run").collect()
    assert [r["run"] for r in hist] == list(range(1, len(hist) + 1)) and hist[-1]["iterations"] <= 24
    low = min(r["val_loss"] for r in hist)
    assert best.val_loss == low and TR.measure(best.model, val)[0] == pytest.approx(low, abs=1e-9)
    for before, now in zip(hist, hist[1:]):  # a run that didn't help halves the next
        helped = before["val_loss"] <= min(r["val_loss"] for r in hist[:before["run"]])
        assert now["step"] == (before["step"] if helped else before["step"] // 2)
    found = TR.history_best(TR.read_history(spark, str(tmp_path))).first()
    assert found["best_val_loss"] == low and found["runs"] == len(hist)
    assert found["best_run"] == min((r["val_loss"], r["run"]) for r in hist)[1]
    assert found["best_val_accuracy"] == max(r["val_accuracy"] for r in hist)


def test_the_choice_is_saved_and_reads_back(spark, rows, tmp_path):
    root = str(tmp_path)
    found = {"net": _network(), "flat": TR.candidates(6, 3)["logistic_0.1"]}
    got = {r["model"]: r for r in TR.select_model(rows, found, root).collect()}
    chosen = min(got.values(), key=lambda r: (r["val_loss"], r["model"]))
    assert [m for m, r in got.items() if r["chosen"]] == [chosen["model"]]
    store = TR.ModelStore(spark, root)
    assert TR.measure(store.load("selected"), rows)[0] == pytest.approx(chosen["train_loss"], abs=1e-9)
    assert chosen["train_loss"] == pytest.approx(chosen["stored_loss"], abs=1e-9)
    _, val = TR.held_out(rows)
    for m, r in got.items():  # each candidate is there as it was judged
        assert TR.measure(store.load(m), val) == pytest.approx((r["val_loss"], r["val_accuracy"]), abs=1e-9)
    listed = store.catalogue().collect()
    assert [r["file_name"] for r in listed] == ["flat", "net", "selected"]
    assert {(r["n_loaded"], r["n_available"], r["num_classes"]) for r in listed} == {(3, 3, 3)}
    with pytest.raises(KeyError):
        store.load("missing")


def test_history_ignores_replays(spark, tmp_path):
    path = str(tmp_path / "h")

    def batch(keys, model="m"):
        return spark.createDataFrame([(k, f"{k}.wav", "happy", 0.5 + k / 100, model) for k in keys],
                                     "key long, file string, main_emotion string, confidence double, model string")

    serve.append_history(spark, batch(range(8)), path, "2024-01-01 00:00:00")
    serve.append_history(spark, batch([5, 6, 7, 8, 8]), path, "2024-01-02 00:00:00")
    serve.append_history(spark, batch([]), path, "2024-01-03 00:00:00")
    serve.append_history(spark, batch([1], "n"), path, "2024-01-03 00:00:00")
    assert spark.read.parquet(path).count() == 10
    top = serve.newest(spark, path, 4).collect()
    assert [(r["time"], r["file"], r["model"]) for r in top] == [
        ("2024-01-03 00:00:00", "1.wav", "n"), ("2024-01-02 00:00:00", "8.wav", "m"),
        ("2024-01-01 00:00:00", "7.wav", "m"), ("2024-01-01 00:00:00", "6.wav", "m")]
    assert top[1]["confidence"] == 57 or top[1]["confidence"] == 58


def test_json_records_come_back(spark):
    rec = spark.createDataFrame([(1, "a", [("x", 0.5), ("y", 0.25)]), (2, None, [])],
                                "id long, name string, ranked array<struct<emotion:string,probability:double>>")
    text = rec.withColumn("json", F.to_json(F.struct("id", "name", "ranked")))
    bad = spark.createDataFrame([(3, None), (4, "{"), (5, "[]"), (6, '{"id": "q"}'), (7, "{}"), (8, "")], "id long, json string")
    good, rejects = serve.from_json(text.select("id", "json").unionByName(bad), serve.record_schema(text), "id")
    assert sorted(map(tuple, good.collect())) == sorted(map(tuple, rec.collect()))
    assert {r["id"]: r["reason"] for r in rejects.collect()} == {
        3: "no record", 4: "malformed", 5: "malformed", 6: "malformed", 7: "malformed", 8: "malformed"}


def test_byte_ranges(spark):
    rng = np.random.default_rng(1)
    sizes = [0, 0, 5000, None] + rng.integers(0, 900, 500).tolist() + [0]
    files = [(f"f{i:05d}", s) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(files, "path string, length long")
    got = SP.byte_ranges(df, 1000).collect()
    want, before = {}, 0
    for path, size in files:
        want[path] = before // 1000
        before += size or 0
    assert {r["path"]: r["part"] for r in got} == want
    per = {}
    for r in got:
        per[r["part"]] = per.get(r["part"], 0) + (r["length"] or 0)
    assert max(per.values()) <= 1000 + 5000
    tasks = SP.in_parts(SP.byte_ranges(df, 1000), before // 1000 + 1)
    held = tasks.select("part", F.spark_partition_id().alias("task")).distinct().collect()
    assert all(r["part"] == r["task"] for r in held)
    assert SP.byte_ranges(df.limit(0), 1000).count() == 0
