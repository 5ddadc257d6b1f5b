"""Every registered query vs its DuckDB oracle at sf0.001: exact row multiset
(both sides round floats to 6 decimals inside the query; no extra tolerance)."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
from vocalis.plans.queries import REGISTRY
from vocalis.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return float(v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql))
def test_oracle(spark, con, name):
    q = REGISTRY[name]
    sdf = q.run(spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    rel = con.sql(q.sql)
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert srows == drows


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if not q.sql))
def test_rows_only(spark, name):
    rows = REGISTRY[name].run(spark, SF_SMALL).collect()
    n = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    values = {
        "wav_features": lambda r: len(r) == n and {x["n_features"] for x in r} == {185},
        "train_classifier": lambda r: [x["run"] for x in sorted(r, key=lambda x: x["run"])] == list(range(1, len(r) + 1))
        and min(x["loss"] for x in r) < min(r, key=lambda x: x["run"])["loss"] and all(0 <= x["val_accuracy"] <= 1 for x in r),
        "history_best": lambda r: len(r) == 1 and r[0]["best_val_loss"] > 0 and r[0]["best_run"] <= r[0]["runs"],
        "select_model": lambda r: {x["model"] for x in r} == {"mlp", "logistic_0", "logistic_0.01", "logistic_0.1"}
        and sum(x["chosen"] for x in r) == 1 and all(0 <= x["val_accuracy"] <= 1 for x in r)
        and [x["model"] for x in r if x["chosen"]] == [min(r, key=lambda x: (x["val_loss"], x["model"]))["model"]]
        and all(abs(x["train_loss"] - x["stored_loss"]) < 1e-9 for x in r if x["chosen"]),
        "batch_score": lambda r: {x["status"] for x in r} >= {"ok", "unknown_model"}
        and len({x["vec_id"] for x in r}) == len(r),
        "mlp_evaluation": lambda r: len(r) == 1 and 0 <= r[0]["accuracy"] <= 1 and r[0]["logloss"] > 0,
    }
    assert values[name](rows)
