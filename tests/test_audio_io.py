"""binaryFile scan (S1), audio stream (R6) and augmentation invariants."""

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from test_signal import tone, wav_bytes
from vocalis.functions import dsp, vocab
from vocalis.operators import augment as AU
from vocalis.operators import features as FT
from vocalis.operators import labels as LB
from vocalis.sources import audio
from vocalis.streaming import score_stream as ST


def _write_corpus(root):
    files = {
        "Ravdess/Actor_01/03-01-05-01-02-01-01.wav": tone(330.0, 0.5),
        "Crema/1001_DFA_SAD_XX.wav": tone(220.0, 0.4),
        "Tess/OAF_back_ps.wav": tone(660.0, 0.3),
        "Savee/DC_h03.wav": tone(440.0, 0.2),
    }
    for rel, y in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(wav_bytes(y))
    with open(os.path.join(root, "notes.txt"), "w") as fh:
        fh.write("not audio")
    return files


def test_scan_label_decode_features(spark):
    root = tempfile.mkdtemp(prefix="vocalis-wav-")
    files = _write_corpus(root)
    raw = audio.scan_audio(spark, root)
    assert raw.count() == len(files)                     # glob keeps only *.wav
    lab = {r["path"].split("/")[-1]: r["label"] for r in LB.label_from_path(raw.select("path")).collect()}
    assert lab == {"03-01-05-01-02-01-01.wav": "angry", "1001_DFA_SAD_XX.wav": "sad",
                   "OAF_back_ps.wav": "surprise", "DC_h03.wav": "happy"}
    clips = FT.with_status(audio.decode(raw.select(F.col("path").alias("clip_id"), "content")))
    feats = FT.extract_features(clips).collect()
    assert len(feats) == 4 and all(r["status"] == "ok" and len(r["features"]) == 185 for r in feats)


def test_audio_stream(spark):
    root = tempfile.mkdtemp(prefix="vocalis-wav-stream-")
    _write_corpus(root)
    out = tempfile.mkdtemp(prefix="vocalis-stream-out-")
    src = audio.read_stream_audio(spark, root, max_files=2)

    def transform(batch):
        clips = FT.with_status(audio.decode(batch.withColumn("clip_id", F.col("path"))))
        f = FT.extract_features(clips, long_clip_samples=None, carry=ST.KEYS)
        return f.select(*ST.KEYS, "clip_id", "status", F.size("features").alias("n"))

    assert ST.run_to_table(src, transform, out + "/pred", out + "/ckpt", "m") == 2
    rows = spark.read.parquet(out + "/pred").collect()
    assert len(rows) == 4 and {r["n"] for r in rows} == {185}
    assert len({r["epoch"] for r in rows}) == 2            # two files per micro-batch
    # a restart finds nothing new: output unchanged
    ST.run_to_table(audio.read_stream_audio(spark, root, max_files=2), transform, out + "/pred", out + "/ckpt", "m")
    assert spark.read.parquet(out + "/pred").count() == 4


def test_augment_invariants(spark):
    x = tone(440.0, 1.0)
    rows = [(1, t, x.tolist()) for t in vocab.AUGMENTATIONS] + [(2, "time_stretch", x[:1000].tolist()),
                                                                      (3, "pitch_shift", None)]
    df = spark.createDataFrame(rows, "clip_id long, augmentation string, samples array<float>")
    a = {(r["clip_id"], r["augmentation"]): r for r in AU.augment(df, "clip_id").collect()}
    n = len(x)
    assert len(a[(1, "original")]["samples"]) == n
    assert len(a[(1, "pitch_shift")]["samples"]) == n
    assert abs(len(a[(1, "time_stretch")]["samples"]) - n / 1.2) <= 1
    noise = np.array(a[(1, "white_noise")]["samples"]) - x
    assert abs(noise.std() - 0.005) < 5e-4
    again = {(r["clip_id"], r["augmentation"]): r for r in AU.augment(df, "clip_id").collect()}
    assert again[(1, "white_noise")]["samples"] == a[(1, "white_noise")]["samples"]   # repeatable
    assert a[(2, "time_stretch")]["augment_status"] == "ok"              # shorter than a frame
    assert abs(len(a[(2, "time_stretch")]["samples"]) - 1000 / 1.2) <= 1
    assert a[(3, "pitch_shift")]["augment_status"] == "fallback"                       # G5
    assert not a[(3, "pitch_shift")]["samples"]


def test_pitch_shift_moves_frequency():
    y = dsp.pitch_shift(tone(440.0, 1.0).astype(np.float64), 4)
    spec = np.abs(np.fft.rfft(y))
    f = np.argmax(spec) * vocab.SAMPLE_RATE / len(y)
    assert abs(f - 440 * 2 ** (4 / 12)) < 5
    z = dsp.time_stretch(tone(440.0, 1.0).astype(np.float64), 1.2)
    f2 = np.argmax(np.abs(np.fft.rfft(z))) * vocab.SAMPLE_RATE / len(z)
    assert abs(f2 - 440) < 5


def test_model_catalogue(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    from vocalis.operators import train as TR
    df = spark.createDataFrame([(Vectors.dense([0.0, 1.0]), 0.0), (Vectors.dense([1.0, 0.0]), 1.0),
                                (Vectors.dense([1.0, 1.0]), 2.0)], ["x", "y"])
    TR.save_model(LogisticRegression(featuresCol="x", labelCol="y", maxIter=5).fit(df), str(tmp_path / "b_model"))
    TR.save_model(TR.mlp(2, 3, max_iter=5).fit(df), str(tmp_path / "voice_conv1d_model"))
    rows = TR.model_catalogue(spark, str(tmp_path)).collect()
    assert [r["file_name"] for r in rows] == ["b_model", "voice_conv1d_model"]
    assert [r["num_classes"] for r in rows] == [3, 3]
    assert rows[1]["name"] == "Voice Conv1D Model"


def test_label_plan_does_not_read_content(spark):
    root = tempfile.mkdtemp(prefix="vocalis-wav-prune-")
    _write_corpus(root)
    lab = LB.label_from_path(audio.scan_audio(spark, root).select("path", "length"))
    plan = lab._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan" in ln or "Scan binaryFile" in ln or "ReadSchema" in ln]
    assert scan and not any("content" in ln for ln in scan), scan
    assert lab.count() == 4


def test_streamed_time_stretch_equals_whole_clip():
    x = tone(440.0, 1.3).astype(np.float64) + np.random.default_rng(2).normal(0, 0.01, int(22050 * 1.3))
    for rate in (1.2, 2 ** (-4 / 12)):
        a = dsp.time_stretch_whole(x, rate)
        b = dsp.time_stretch(x, rate, block=5)
        assert len(a) == len(b) and np.allclose(a, b, atol=1e-10)


def test_build_corpus_end_to_end(spark, tmp_path):
    from vocalis.plans.corpus import build_corpus
    root = tempfile.mkdtemp(prefix="vocalis-corpus-")
    _write_corpus(root)
    t = build_corpus(spark, root, str(tmp_path / "out"))
    rows = t.collect()
    per_path = {}
    for r in rows:
        per_path.setdefault(r["path"], []).append(r)
    assert len(per_path) == 4
    for path, rs in per_path.items():
        split = {r["split"] for r in rs}
        assert len(split) == 1
        want = 4 if split == {"train"} else 1
        assert len(rs) == want and all(len(r["features"]) == 185 for r in rs)
    man = spark.read.option("header", True).csv(str(tmp_path / "out" / "manifest"))
    assert man.count() == 4
    assert t.filter("augmentation = 'white_noise'").count() == sum(1 for rs in per_path.values() if len(rs) == 4)


def test_long_files_take_the_chunked_path(spark, tmp_path):
    """Files above the byte bound, long and short clips among them, give the
    same table as all files at once."""
    from vocalis.plans.corpus import build_corpus
    root = tempfile.mkdtemp(prefix="vocalis-wav-long-")
    _write_corpus(root)
    with open(os.path.join(root, "Savee", "DC_a07.wav"), "wb") as fh:
        fh.write(b"no sound, but many bytes" * 2000)
    key = lambda r: (r["path"], r["augmentation"])
    whole = sorted(build_corpus(spark, root, str(tmp_path / "a")).collect(), key=key)
    # 0.2 s and 0.3 s stay below the bound, 0.4 s is stored but short, 0.5 s is long
    split = sorted(build_corpus(spark, root, str(tmp_path / "b"), long_file_bytes=15_000, long_clip_samples=9_500).collect(), key=key)
    assert [key(r) for r in whole] == [key(r) for r in split] and len(whole) >= 5
    for a, b in zip(whole, split):
        assert (a["status"], a["label"], a["split"], a["augment_status"]) == (b["status"], b["label"], b["split"], b["augment_status"])
        assert np.allclose(a["features"], b["features"], rtol=1e-4, atol=1e-4)


def test_stream_picks_up_only_new_files(spark):
    root = tempfile.mkdtemp(prefix="vocalis-wav-incr-")
    _write_corpus(root)
    out = tempfile.mkdtemp(prefix="vocalis-incr-out-")

    def transform(batch):
        return batch.select(*ST.KEYS, "length")

    ST.run_to_table(audio.read_stream_audio(spark, root), transform, out + "/t", out + "/ckpt", "m")
    assert spark.read.parquet(out + "/t").count() == 4
    with open(os.path.join(root, "Savee", "DC_n05.wav"), "wb") as fh:
        fh.write(wav_bytes(tone(550.0, 0.1)))
    ST.run_to_table(audio.read_stream_audio(spark, root), transform, out + "/t", out + "/ckpt", "m")
    rows = spark.read.parquet(out + "/t").collect()
    assert len(rows) == 5 and len({r["epoch"] for r in rows}) == 2


def test_build_corpus_elsewhere_loses_nothing(tmp_path):
    """From another folder, without the package on the workers' path: every
    scanned clip, also one that is no WAV file, has a row for each version."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = tmp_path / "in"
    root.mkdir()
    _write_corpus(str(root))
    next(root.rglob("1001_DFA_SAD_XX.wav")).with_name("1002_DFA_ANG_XX.wav").write_bytes(b"no sound at all")
    code = f"""
import sys
sys.path.insert(0, {repo!r})
from vocalis.session import build_session
from vocalis.plans.corpus import build_corpus
spark = build_session("local[2]", shuffle_partitions=2)
for store in (False, True):
    rows = build_corpus(spark, {str(root)!r}, {str(tmp_path)!r} + "/out" + str(store), store_audio=store).collect()
    by = {{}}
    for r in rows:
        by.setdefault(r["path"].split("/")[-1], []).append(r)
    assert len(by) == 5, sorted(by)
    for name, its in by.items():
        assert len(its) == (4 if its[0]["split"] == "train" else 1), name
        assert all(len(r["features"]) == 185 for r in its)
    assert all(r["status"] == "decode_error" and not any(r["features"]) for r in by["1002_DFA_ANG_XX.wav"])
print("kept all")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=300)
    assert "kept all" in out.stdout, out.stderr[-2000:]


def test_title_case(spark):
    from vocalis.functions.labels import title_case
    words = ["voice conv1d model", "o'brien's", "x-ray 3d", "ÉTÉ à", "", None, "a1b2 c"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", title_case(F.col("w")).alias("t")).collect()
    for r in got:
        assert r["t"] == (None if r["w"] is None else r["w"].title())
