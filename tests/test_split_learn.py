"""Split / fan-out invariants and learning operators against brute force."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vocalis.operators import fanout as FO
from vocalis.operators import labels as LB
from vocalis.operators import learn as LN
from vocalis.operators import split as SP
from vocalis.plans import views as V


def test_split_stable_under_repartition(spark):
    lab = LB.label_from_path(V.clip_paths(spark, SF_SMALL))
    a = {r["event_id"]: r["split"] for r in SP.with_split(lab).collect()}
    b = {r["event_id"]: r["split"] for r in SP.with_split(lab.repartition(7)).collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.7 < share < 0.9


def test_no_overlap_and_fanout(spark):
    s = SP.with_split(LB.label_from_path(V.clip_paths(spark, SF_SMALL)))
    assert SP.split_overlap(s).first()["n_overlap"] == 0
    SP.assert_disjoint(s)
    fan = FO.fan_out(s)
    chk = FO.fanout_check(fan, "event_id").first()
    assert chk["n_bad"] == 0 and chk["n_clips"] == s.count()
    n_train = s.filter("split = 'train'").count()
    assert fan.filter("split = 'train'").count() == 4 * n_train


def test_overlap_detected(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "train")], "path string, split string")
    assert SP.split_overlap(df).first()["n_overlap"] == 1


def test_population_scaler(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],), ([5.0, 5.0],)], "features array<double>")
    sc = LN.PopulationScaler.fit(df)
    assert np.allclose(sc.mean, [3.0, 5.0])
    assert np.allclose(sc.scale, [np.std([1, 3, 5]), 1.0])     # population std; constant -> 1
    unseen = spark.createDataFrame([([7.0, 7.0],)], "features array<double>")
    z = sc.transform(unseen).first()["scaled"]
    assert np.allclose(z, [4.0 / np.std([1, 3, 5]), 2.0])


def test_nearest_centroid_vs_numpy(spark):
    f = V.feature_vectors(spark, SF_SMALL)
    pdf = f.toPandas()
    X = np.stack(pdf["features"].map(np.asarray)).astype(np.float64)
    y = pdf["label"].to_numpy()
    model = LN.NearestCentroid.fit(f)
    classes = sorted(set(y))
    C = np.stack([X[y == c].mean(axis=0) for c in classes])
    d = ((X[:, None, :] - C[None, :, :]) ** 2).sum(axis=2)
    want = np.array(classes)[np.argmin(np.round(d, 9), axis=1)]
    got = model.transform(f).select("vec_id", "pred", "probs").toPandas().set_index("vec_id").loc[pdf["vec_id"]]
    assert (got["pred"].to_numpy() == want).all()
    p = np.exp(-d - (-d).max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    assert np.allclose(np.stack(got["probs"].map(np.asarray)), p, atol=1e-12)


def test_report_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 1)], "label int, pred int")
    rows = {r["class"]: r for r in LN.classification_report(df).collect()}
    assert rows["2"]["precision"] == 0 and rows["2"]["recall"] == 0 and rows["2"]["f1"] == 0
    assert rows["1"]["support"] == 0 and rows["1"]["precision"] == 0
    assert abs(rows["accuracy"]["f1"] - 1 / 3) < 1e-12
    assert rows["0"]["precision"] == 1.0 and rows["0"]["recall"] == 0.5


def test_one_hot_and_unseen(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c")], "id long, label string")
    voc = LN.label_vocabulary(df)
    enc = LN.with_index(df, voc).select("id", "idx", LN.one_hot(F.col("idx"), F.col("k")).alias("h"))
    got = {r["id"]: (r["idx"], list(r["h"])) for r in enc.collect()}
    assert got == {0: (1, [0, 1, 0]), 1: (0, [1, 0, 0]), 2: (2, [0, 0, 1])}


def test_param_store_round_trip(spark, tmp_path):
    f = V.feature_vectors(spark, SF_SMALL)
    sc = LN.PopulationScaler.fit(f)
    sc.save(spark, str(tmp_path / "scaler"))
    sc2 = LN.PopulationScaler.load(spark, str(tmp_path / "scaler"))
    assert sc2.mean == sc.mean and sc2.scale == sc.scale
    nc = LN.NearestCentroid.fit(f)
    nc.save(spark, str(tmp_path / "centroids"))
    nc2 = LN.NearestCentroid.load(spark, str(tmp_path / "centroids"))
    a = nc.transform(f).select("vec_id", "pred").collect()
    b = nc2.transform(f).select("vec_id", "pred").collect()
    assert sorted(a) == sorted(b)
