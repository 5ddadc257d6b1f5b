"""Signal fixtures (22050 Hz mono): tone, silence, short, empty, corrupt, stereo."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocalis.functions import dsp, vocab
from vocalis.operators import features as FT
from vocalis.operators import signal as SG
from vocalis.operators import spectral as SPC
from vocalis.sources import audio

SR = vocab.SAMPLE_RATE


def tone(freq=440.0, dur=1.0, amp=0.5):
    n = int(SR * dur)
    t = np.arange(n) * (dur / n)
    return (amp * np.sin(2 * np.pi * freq * t)).astype(np.float32)


def wav_bytes(y, rate=SR, channels=1):
    data = np.clip(np.rint(np.asarray(y, dtype=np.float64) * 32767), -32768, 32767).astype("<i2")
    if channels > 1:
        data = np.repeat(data[:, None], channels, axis=1)
    raw = data.tobytes()
    hdr = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(raw), b"WAVE", b"fmt ", 16, 1, channels, rate,
                      rate * 2 * channels, 2 * channels, 16, b"data", len(raw))
    return hdr + raw


@pytest.fixture(scope="module")
def clips(spark):
    rows = [
        (1, wav_bytes(tone())),
        (2, wav_bytes(np.zeros(SR, dtype=np.float32))),
        (3, wav_bytes(tone(dur=1000 / SR))),
        (4, b""),
        (5, bytes(np.random.default_rng(0).integers(0, 256, 500, dtype=np.uint8))),
        (6, wav_bytes(tone(dur=1.0, freq=440.0).repeat(2)[: 2 * SR], rate=2 * SR, channels=2)),
        (7, wav_bytes(tone(amp=0.25))),
    ]
    df = spark.createDataFrame(rows, "clip_id long, content binary")
    dec = audio.decode(df)
    return FT.with_status(dec).cache()


def test_decode_status(clips):
    st = {r["clip_id"]: (r["status"], len(r["samples"])) for r in clips.collect()}
    assert st[1] == ("ok", SR)
    assert st[3] == ("too_short", 1000)
    assert st[4][0] == "empty"
    assert st[5][0] == "decode_error"
    assert st[6][0] == "ok" and abs(st[6][1] - 2 * SR // 2) <= 1  # stereo 44.1k -> mono 22.05k


def test_frame_counts(spark):
    df = spark.createDataFrame([(1, tone().tolist(), SR)], "clip_id long, samples array<float>, sample_rate int")
    r = SG.clip_duration(df, vocab.N_FFT, vocab.HOP).first()
    assert r["n_frames"] == 40 and r["n_frames_centred"] == 44
    assert SG.frames(df, vocab.N_FFT, vocab.HOP).count() == 40


def test_time_features_tone_and_silence(clips):
    ok = clips.filter("status = 'ok'").select("clip_id", "samples")
    tf = {r["clip_id"]: r for r in SG.time_features(ok).collect()}
    # centred, edge-padded frames (44): the 4 edge frames hold fewer crossings,
    # so the mean sits below the interior value 2*440/22050 = 0.0399 that the
    # 40 uncentred frames give
    z, _, _ = brute_time(tone())
    assert abs(tf[1]["zcr"] - z) < 1e-12
    assert abs(tf[1]["zcr"] - 0.03853) < 1e-4
    x = tone().astype(np.float64)
    unc = np.mean([np.sum((x[j * 512 + 1:j * 512 + 2048] < -1e-10) != (x[j * 512:j * 512 + 2047] < -1e-10)) / 2048
                   for j in range(40)])
    assert abs(unc - 0.0399) < 1e-4
    assert tf[2]["zcr"] == 0 and tf[2]["rms"] == 0 and tf[2]["entropy"] == 0
    # amplitude scaling leaves zcr and entropy alone, scales rms
    assert abs(tf[7]["zcr"] - tf[1]["zcr"]) < 1e-9
    assert abs(tf[7]["entropy"] - tf[1]["entropy"]) < 1e-3
    assert abs(tf[7]["rms"] / tf[1]["rms"] - 0.5) < 1e-3


def brute_time(x, n_fft=vocab.N_FFT, hop=vocab.HOP):
    x = np.asarray(x, dtype=np.float64)
    half = n_fft // 2
    xe = np.pad(x, half, mode="edge")
    xz = np.pad(x, half)
    nf = 1 + len(x) // hop
    neg = lambda v: v < -1e-10
    zc = [np.sum(neg(xe[i * hop + 1:i * hop + n_fft]) != neg(xe[i * hop:i * hop + n_fft - 1])) / n_fft
          for i in range(nf)]
    rms = [np.sqrt(np.mean(xz[i * hop:i * hop + n_fft] ** 2)) for i in range(nf)]
    nu = 1 + (len(x) - n_fft) // hop
    e = np.array([np.sum(x[j * hop:j * hop + n_fft] ** 2) for j in range(nu)])
    p = e / e.sum()
    p = p[p > 0]
    return np.mean(zc), np.mean(rms), float(-(p * np.log2(p)).sum())


def test_time_features_vs_brute_force(spark):
    rng = np.random.default_rng(7)
    sigs = [rng.normal(0, 0.1, n).astype(np.float32) for n in (2048, 3000, 5111)]
    df = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sigs)], "clip_id long, samples array<float>")
    got = {r["clip_id"]: r for r in SG.time_features(df).collect()}
    for i, s in enumerate(sigs):
        z, r, h = brute_time(s)
        assert abs(got[i]["zcr"] - z) < 1e-12
        assert abs(got[i]["rms"] - r) < 1e-9
        assert abs(got[i]["entropy"] - h) < 1e-9


def test_feature_vector(clips):
    f = {r["clip_id"]: r for r in FT.extract_features(clips).collect()}
    assert all(len(r["features"]) == 185 for r in f.values())
    for k in (3, 4, 5):
        assert f[k]["status"] != "ok" and all(v == 0 for v in f[k]["features"])
    sil = f[2]["features"]
    assert abs(sil[0] - (-100 * np.sqrt(128))) < 0.1          # MFCC[0] of silence
    assert any(v != 0 for v in sil)                             # so not rejected as empty
    t = f[1]["features"]
    assert abs(t[42] - 440) < 60                                # centroid near 440 Hz
    assert int(np.argmax(t[44:56])) == 9                        # chroma peak at A


def test_kernel_fft_matches_dft():
    rng = np.random.default_rng(1)
    x = rng.normal(size=64)
    n_fft, hop = 16, 4
    p = dsp.stft_power(x, n_fft, hop)
    xp = np.pad(x, n_fft // 2)
    w = dsp.hann(n_fft)
    m = np.arange(n_fft)
    for i in range(p.shape[0]):
        fr = xp[i * hop:i * hop + n_fft] * w
        for k in range(n_fft // 2 + 1):
            re = np.sum(fr * np.cos(2 * np.pi * m * k / n_fft))
            im = np.sum(fr * np.sin(2 * np.pi * m * k / n_fft))
            assert abs(p[i, k] - (re * re + im * im)) < 1e-10


def test_mel_filterbank_shape_and_area():
    w = dsp.mel_filterbank(SR, 2048, 128)
    assert w.shape == (128, 1025)
    assert (w >= 0).all() and (w.sum(axis=1) > 0).all()


def test_tone_column_matches_numpy(spark):
    df = spark.createDataFrame([(440.0,), (0.0,)], "f double")
    rows = df.select(SG.tone(F.col("f"), 1.0).alias("y")).collect()
    assert np.allclose(np.array(rows[0]["y"]), tone(), atol=1e-7)
    assert not any(rows[1]["y"])


def test_mfcc_dct_native_matches_numpy(spark):
    v = np.random.default_rng(3).normal(size=128)
    df = spark.createDataFrame([(v.tolist(),)], "v array<double>")
    got = np.array(df.select(SPC.dct_ortho(F.col("v"), 128, 40).alias("c")).first()["c"])
    k = np.arange(40)[:, None]
    n = np.arange(128)[None, :]
    basis = np.cos(np.pi * k * (2 * n + 1) / 256) * np.where(k == 0, np.sqrt(1 / 128), np.sqrt(2 / 128))
    assert np.allclose(got, basis @ v, atol=1e-9)


def test_spectral_kernel_chunking_and_two_pass():
    x = np.random.default_rng(5).normal(size=60000) * np.linspace(0, 1, 60000)
    args = (SR, 2048, 512, 128, 12, 0.85, 80.0, 1e-10)
    a = dsp.clip_spectral(x, *args, chunk_frames=100000)
    b = dsp.clip_spectral(x, *args, chunk_frames=7)
    c = dsp.clip_spectral(x, *args, chunk_frames=7, keep_db_values=0)   # forces the second pass
    for k in a:
        assert np.allclose(a[k], b[k], rtol=1e-9, atol=1e-9)
        assert np.allclose(a[k], c[k], rtol=1e-9, atol=1e-9)


def test_kernel_and_native_time_domain_agree(spark):
    rng = np.random.default_rng(11)
    sigs = [rng.normal(0, 0.1, n).astype(np.float32) for n in (1500, 2048, 4099, 9000)]
    df = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sigs)], "clip_id long, samples array<float>")
    nat = {r["clip_id"]: r for r in SG.time_features(df).collect()}
    for i, s in enumerate(sigs):
        z, r, h = dsp.time_domain(s, vocab.N_FFT, vocab.HOP, vocab.ZCR_THRESHOLD)
        assert abs(nat[i]["zcr"] - z) < 1e-12 and abs(nat[i]["rms"] - r) < 1e-9
        assert (h is None and nat[i]["entropy"] is None) or abs(nat[i]["entropy"] - h) < 1e-9
    clips = FT.with_status(df.withColumn("decode_status", F.lit("ok")))     # 1500 samples -> too_short
    a = {r["clip_id"]: r["features"] for r in FT.extract_features(clips, time_domain="kernel").collect()}
    b = {r["clip_id"]: r["features"] for r in FT.extract_features(clips, time_domain="native").collect()}
    for k in a:
        assert np.allclose(a[k], b[k], rtol=1e-6, atol=1e-6)


def test_long_clip_path_matches_clip_at_once(spark):
    rng = np.random.default_rng(21)
    sigs = [(rng.normal(0, 0.1, n) * np.linspace(0.2, 1, n)).astype(np.float32) for n in (2100, 5000, 9999, 12288)]
    sigs.append(tone(330.0, 0.6))
    df = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sigs)], "clip_id long, samples array<float>")
    clips = FT.with_status(df.withColumn("decode_status", F.lit("ok")))
    a = {r["clip_id"]: r["features"] for r in FT.extract_features(clips, long_clip_samples=None).collect()}
    b = {r["clip_id"]: r["features"] for r in
         FT.extract_features(clips, long_clip_samples=2048, frames_per_chunk=3).collect()}   # all clips chunked
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose(a[k], b[k], rtol=1e-5, atol=1e-4), k


def test_tuning_of_detuned_tones():
    """A tone's deviation from the nearest semitone is found to some hundredths
    (a parabola through three bins of power is that far off at this pitch)."""
    for cents in (-40, -20, -3, 0, 12, 30, 40):
        t = np.arange(22050) / 22050
        x = 0.5 * np.sin(2 * np.pi * 440 * 2 ** (3 / 12 + cents / 1200) * t)
        got = dsp.clip_spectral(x, 22050, 2048, 512, 128, 12, 0.85, 80.0, 1e-10)["tuning"]
        assert abs(got - cents / 100) <= 0.08, (cents, got)
    assert dsp.clip_spectral(np.zeros(4096), 22050, 2048, 512, 128, 12, 0.85, 80.0, 1e-10)["tuning"] == 0.0


def test_long_clip_tuning_is_exact(spark):
    """Medians from counted parts equal those of all peaks."""
    from vocalis.operators import longclips
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for clip, n in (("a", 1001), ("b", 400), ("c", 1), ("d", 2)):
        step, height = rng.integers(0, 100, n), np.round(rng.lognormal(0, 3, n), 2) + 0.01
        rows += [(clip, int(s), float(h)) for s, h in zip(step, height)]
        want[clip] = dsp.tuning_of(step, height)
    got = longclips.tunings(spark.createDataFrame(rows, "clip_id string, step long, height double")).collect()
    assert {r["clip_id"]: round(r["tuning"], 6) for r in got} == {k: round(v, 6) for k, v in want.items()}


def test_noise_is_normal_and_a_function_of_key_and_place(spark):
    from vocalis.operators.augment import noise_sql
    df = spark.createDataFrame([("k1", 40001), ("k1", 7), ("k2", 7), ("k3", 0), ("k4", 1)], "k string, n int")
    got = [np.array(r["e"]) for r in df.selectExpr(f"{noise_sql('k', 'n')} AS e").collect()]
    assert [len(x) for x in got] == [40001, 7, 7, 0, 1]
    assert (got[0][:7] == got[1]).all() and not (got[1] == got[2]).any()
    x = got[0]
    assert abs(x.mean()) < 0.02 and abs(x.std() - 1) < 0.02 and abs((x ** 3).mean()) < 0.06 and abs((x ** 4).mean() - 3) < 0.2
    assert abs(np.corrcoef(x[:-1], x[1:])[0, 1]) < 0.02
