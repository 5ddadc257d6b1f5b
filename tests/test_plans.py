"""Physical-plan properties the scale design relies on (explain-driven)."""

import pytest

from conftest import SF_SMALL
from vocalis.operators import spectral as SPC
from vocalis.plans.queries import REGISTRY


def _plan(spark, name):
    df = REGISTRY[name].run(spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_label_lookup_is_broadcast_and_scan_pruned(spark):
    p = _plan(spark, "label_from_path")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    assert "props" not in scan and "event_type" not in scan      # only the columns used are read


@pytest.mark.parametrize("name", ["split_overlap", "variant_pairs", "class_distribution", "standardize_fit",
                                  "classification_report"])
def test_hash_aggregates(spark, name):
    p = _plan(spark, name)
    assert "SortAggregate" not in p and "SortMergeJoin" not in p and "CartesianProduct" not in p


def test_top_k_is_limited_before_the_shuffle(spark):
    p = _plan(spark, "history_top10")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_feature_extraction_is_narrow(spark):
    p = _plan(spark, "wav_features")
    assert "Exchange" not in p and "SortMergeJoin" not in p


@pytest.mark.parametrize("name,kernels", [("power_spectrum", 1), ("mel_bands", 1), ("chroma_mean", 1), ("mfcc_mean", 2)])
def test_spectral_kernel_runs_once(spark, name, kernels):
    assert _plan(spark, name).count("ArrowEvalPython") == kernels


def test_clips_without_a_vector_explode_to_no_rows(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25]), (2, []), (3, None)], "clip_id long, v array<double>")
    got = SPC.exploded(df, df["v"], "i", "x").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0.5), (1, 1, 0.25)]


def test_scoring_does_not_shuffle(spark):
    for name in ("nearest_centroid_pred", "standardize_apply"):
        assert "Exchange" not in _plan(spark, name)


def test_store_read_prunes_partitions(spark):
    p = _plan(spark, "augmented_store")
    assert "PartitionFilters: [isnotnull(augmentation" in p and "white_noise" in p
