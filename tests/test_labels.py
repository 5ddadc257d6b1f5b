"""Path labeller (P2-P5) and filename parser (P8) on hand-written paths."""

import pytest

from vocalis.operators import labels as LB

# (path, dataset, code, label or None when dropped)
PATHS = [
    ("Dataset/Ravdess/Actor_01/03-01-05-01-02-01-24.wav", "RAVDESS", "05", "angry"),
    ("Dataset/Ravdess/Actor_01/03-01-02-01-02-01-24.wav", "RAVDESS", "02", "neutral"),
    ("Dataset/Crema/1001_DFA_ANG_XX.wav", "CREMA", "ANG", "angry"),
    ("Dataset/Crema/1001_DFA_ANG_X2.wav", "CREMA", "", None),
    ("Dataset/Tess/OAF_back_ps.wav", "TESS", "ps", "surprise"),
    ("Dataset/Tess/OAF_Fear/OAF_back_fear.wav", "TESS", "fear", "fear"),
    ("Dataset/Tess/OAF_back_Angry.wav", "TESS", "", None),
    ("Dataset/Tess/OAF_back_pleasant_surprised.wav", "TESS", "surprised", None),
    ("Dataset/Savee/DC_sa01.wav", "SAVEE", "sa", "sad"),
    ("Dataset/Savee/DC_su13.wav", "SAVEE", "su", "surprise"),
    ("Dataset/Savee/dc-a01.wav", "SAVEE", "a", "angry"),
    ("Dataset/Other/x.wav", None, "", None),
]


@pytest.fixture(scope="module")
def paths(spark):
    return spark.createDataFrame([(i, p[0]) for i, p in enumerate(PATHS)], "id long, path string")


def test_corpus_and_code(paths):
    rows = {r["id"]: r for r in LB.with_corpus_code(paths).collect()}
    for i, (_, ds, code, _) in enumerate(PATHS):
        assert rows[i]["dataset"] == ds, PATHS[i]
        assert rows[i]["code"] == code, PATHS[i]


def test_label_and_drop(paths):
    got = {r["id"]: r["label"] for r in LB.label_from_path(paths).collect()}
    want = {i: p[3] for i, p in enumerate(PATHS) if p[3] is not None}
    assert got == want


def test_rejects_reasons(paths):
    rej = {r["id"]: r["reason"] for r in LB.label_rejects(paths).collect()}
    assert rej[11] == "no_corpus"
    assert rej[3] == "no_code"
    assert rej[7] == "unmapped_code"
    assert len(rej) == sum(1 for p in PATHS if p[3] is None)


FILENAMES = [
    ("a/b/03-01-05-01-02-01-24.wav", "angry"),
    ("a/b/03-01-09-01-02-01-24.wav", "unknown"),
    ("x-y-z-q-r-s.wav", "unknown"),
    ("1-2-08-4-5-6.wav", "surprise"),
    ("OAF_back_angry.wav", "angry"),
    ("OAF_back_ps.wav", "ps"),
    ("OAF_back_calm.wav", "unknown"),
    ("1001_DFA_ANG_XX.wav", "angry"),
    ("1001_DFA_xyz_XX.wav", "unknown"),
    ("DC_sa01.wav", "sad"),
    ("DC_n12.wav", "neutral"),
    ("DC_q01.wav", "unknown"),
    ("plain.wav", "unknown"),
    ("03-01.wav", "unknown"),
]


def test_filename_parser(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(FILENAMES)], "id long, path string")
    got = {r["id"]: r["fn_label"] for r in LB.with_filename_label(df).collect()}
    assert got == {i: lab for i, (_, lab) in enumerate(FILENAMES)}


def test_display_default(spark):
    df = spark.createDataFrame([("angry",), ("ps",), ("boredom",)], "label string")
    got = {r["label"]: (r["label_fr"], r["emoji"]) for r in LB.with_display(df).collect()}
    assert got["angry"] == ("Colère", "😡")
    assert got["ps"] == ("Surprise+", "😮")
    assert got["boredom"] == ("Boredom", "❓")
