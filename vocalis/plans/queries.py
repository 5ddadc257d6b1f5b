"""Named queries over the shared test tables, each with its DuckDB oracle.

Every query reads whole tables (or views Spark derives from them); the
oracle SQL is written independently against the same tables. Floating
results are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import fanout as FO
from ..functions import labels as LBF
from ..operators import labels as LB
from ..operators import learn as LN
from ..operators import score as SC
from ..operators import profile as PR
from ..operators import signal as SG
from ..operators import spectral as SPC
from ..operators import split as SP
from ..session import ship_package, shared_dir
from ..sources.tables import table
from . import views as V


@dataclass
class Query:
    name: str
    ids: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    notes: str = ""
    tags: list[str] = field(default_factory=list)


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None = None, notes: str = ""):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, ids, run, sql, notes)
        return fn
    return deco


# --------------------------------------------------------------------------
# 1-2. label_from_path, class_distribution
# --------------------------------------------------------------------------

@register("label_from_path", "P1 P2 P3 P4 P5 J1", sql=V.LABELLED_SQL + """
SELECT event_id, path, dataset, label FROM labelled WHERE label <> 'unknown'
""")
def q_label_from_path(spark, sf):
    return LB.label_from_path(V.clip_paths(spark, sf)).select("event_id", "path", "dataset", "label")


@register("class_distribution", "A1 A2 T1", sql=V.LABELLED_SQL + """
SELECT label, count(*) AS n FROM labelled WHERE label <> 'unknown' GROUP BY label ORDER BY n DESC, label
""")
def q_class_distribution(spark, sf):
    return PR.class_distribution(LB.label_from_path(V.clip_paths(spark, sf)))


# --------------------------------------------------------------------------
# 3. corpus x label (A3 A4), rejects (P5 report)
# --------------------------------------------------------------------------

def _labelled(spark, sf):
    return LB.label_from_path(V.clip_paths(spark, sf))


@register("corpus_label_counts", "A3", sql=V.LABELLED_SQL + """
SELECT dataset, label, count(*) AS n FROM labelled WHERE label <> 'unknown' GROUP BY dataset, label
""")
def q_corpus_label_counts(spark, sf):
    return PR.group_counts(_labelled(spark, sf), "dataset", "label")


@register("corpus_label_matrix", "A4", sql=V.LABELLED_SQL + """
SELECT dataset, """ + ", ".join(f"count(*) FILTER (WHERE label = '{e}') AS {e}" for e in vocab.EMOTIONS_7) + """
FROM labelled WHERE label <> 'unknown' GROUP BY dataset
""")
def q_corpus_label_matrix(spark, sf):
    return PR.cross_tab(_labelled(spark, sf), "dataset", "label", vocab.EMOTIONS_7)


@register("label_rejects", "P5", sql=V.LABELLED_SQL.replace("labelled AS (", "labelled_unused AS (") + """
SELECT CASE WHEN dataset IS NULL THEN 'no_corpus' WHEN code = '' THEN 'no_code' ELSE 'unmapped_code' END AS reason,
       count(*) AS n
FROM coded
WHERE dataset IS NULL OR code NOT IN ('03','HAP','happy','h','04','SAD','sad','sa','05','ANG','angry','a',
      '06','FEA','fear','f','07','DIS','disgust','d','08','ps','su','surprise','01','02','NEU','neutral','n')
GROUP BY 1
""")
def q_label_rejects(spark, sf):
    return PR.group_counts(LB.label_rejects(V.clip_paths(spark, sf)), "reason")


# --------------------------------------------------------------------------
# 4. filename-only parser
# --------------------------------------------------------------------------

_FN_SQL = V.CLIP_PATHS_SQL + """,
fn AS (
  SELECT event_id, path, lower(string_split(path, '/')[-1]) AS f FROM clip_paths
),
parts AS (
  SELECT event_id, path, f,
         string_split(replace(f, '.wav', ''), '-') AS dash,
         string_split(replace(f, '.wav', ''), '_') AS us,
         length(f) - length(replace(f, '-', '')) AS n_dash
  FROM fn
)
SELECT event_id, path,
  CASE
    WHEN (starts_with(f, '03-01') OR n_dash >= 5) AND len(dash) >= 3 THEN
      CASE dash[3] WHEN '01' THEN 'neutral' WHEN '02' THEN 'neutral' WHEN '03' THEN 'happy'
                   WHEN '04' THEN 'sad' WHEN '05' THEN 'angry' WHEN '06' THEN 'fear'
                   WHEN '07' THEN 'disgust' WHEN '08' THEN 'surprise' ELSE 'unknown' END
    WHEN contains(f, '_') AND len(us) = 3
         AND us[3] IN ('angry','disgust','fear','happy','neutral','sad','surprise','ps') THEN us[3]
    WHEN contains(f, '_') AND len(us) >= 3 THEN
      CASE upper(us[3]) WHEN 'ANG' THEN 'angry' WHEN 'DIS' THEN 'disgust' WHEN 'FEA' THEN 'fear'
                        WHEN 'HAP' THEN 'happy' WHEN 'NEU' THEN 'neutral' WHEN 'SAD' THEN 'sad'
                        ELSE 'unknown' END
    WHEN contains(f, '_') THEN
      CASE regexp_replace(us[-1], '[^\\p{L}]', '', 'g')
        WHEN 'a' THEN 'angry' WHEN 'd' THEN 'disgust' WHEN 'f' THEN 'fear' WHEN 'h' THEN 'happy'
        WHEN 'n' THEN 'neutral' WHEN 'sa' THEN 'sad' WHEN 'su' THEN 'surprise' ELSE 'unknown' END
    ELSE 'unknown'
  END AS fn_label
FROM parts
"""


@register("filename_label", "P8", sql=_FN_SQL)
def q_filename_label(spark, sf):
    return LB.with_filename_label(V.clip_paths(spark, sf)).select("event_id", "path", "fn_label")


# --------------------------------------------------------------------------
# 5. split (X1 X2 U2 S5)
# --------------------------------------------------------------------------

_SPLIT_CTE = V.LABELLED_CTE + """,
split AS (
  SELECT *, CASE WHEN ('0x' || substr(md5(path), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS split
  FROM labelled WHERE label <> 'unknown'
)"""
_SPLIT_SQL = "WITH " + _SPLIT_CTE


def _split(spark, sf):
    return SP.with_split(_labelled(spark, sf), "path")


@register("hash_split", "X1", sql=_SPLIT_SQL + """
SELECT event_id, path, label, split FROM split
""")
def q_hash_split(spark, sf):
    return _split(spark, sf).select("event_id", "path", "label", "split")


@register("split_counts", "X1 A2", sql=_SPLIT_SQL + """
SELECT split, label, count(*) AS n FROM split GROUP BY split, label
""")
def q_split_counts(spark, sf):
    return PR.group_counts(_split(spark, sf), "split", "label")


@register("split_overlap", "X2 U2", sql=_SPLIT_SQL + """
SELECT count(*) AS n_overlap FROM (
  SELECT DISTINCT path FROM split WHERE split = 'train'
  INTERSECT SELECT DISTINCT path FROM split WHERE split = 'test')
""")
def q_split_overlap(spark, sf):
    return SP.split_overlap(_split(spark, sf), "path")


@register("split_manifest", "S5 P1", sql=_SPLIT_SQL + """
SELECT path, label, split FROM split
""")
def q_split_manifest(spark, sf):
    """Writes the manifest as header CSV partitioned by split (distributed, no
    driver collect), then reads it back."""
    from ..sources import sinks
    out = shared_dir(spark, "manifest-" + uuid.uuid4().hex)
    sinks.write_manifest(_split(spark, sf), out)
    return sinks.read_manifest(spark, out)


# --------------------------------------------------------------------------
# 6. augmentation fan-out
# --------------------------------------------------------------------------

_FAN_SQL = _SPLIT_SQL + """,
fanned AS (
  SELECT s.*, t.augmentation FROM split s,
    unnest(CASE WHEN s.split = 'train' THEN ['original','pitch_shift','white_noise','time_stretch']
                ELSE ['original'] END) AS t(augmentation)
)"""


def _fanned(spark, sf):
    return FO.fan_out(_split(spark, sf))


@register("augment_fanout_counts", "G4 U1 A5", sql=_FAN_SQL + """
SELECT split, augmentation, count(*) AS n FROM fanned GROUP BY split, augmentation
""")
def q_augment_fanout_counts(spark, sf):
    return PR.group_counts(_fanned(spark, sf), "split", "augmentation")


@register("fanout_check", "A12", sql=_FAN_SQL + """
SELECT count(*) AS n_clips,
       count(*) FILTER (WHERE n <> CASE WHEN split = 'train' THEN 4 ELSE 1 END) AS n_bad
FROM (SELECT event_id, split, count(*) AS n FROM fanned GROUP BY event_id, split)
""")
def q_fanout_check(spark, sf):
    return FO.fanout_check(_fanned(spark, sf), "event_id")


@register("variant_pairs", "J2", sql=_FAN_SQL + """
SELECT event_id, count(*) AS n_versions,
  max(label) FILTER (WHERE augmentation = 'original') AS label_original,
  max(label) FILTER (WHERE augmentation = 'pitch_shift') AS label_pitch_shift,
  max(label) FILTER (WHERE augmentation = 'white_noise') AS label_white_noise,
  max(label) FILTER (WHERE augmentation = 'time_stretch') AS label_time_stretch
FROM fanned GROUP BY event_id
""")
def q_variant_pairs(spark, sf):
    return FO.variant_pairs(_fanned(spark, sf), "event_id", "label", vocab.EMOTIONS_7)


@register("variant_sample", "P7", sql=_FAN_SQL + """
SELECT augmentation, path, event_id, label FROM fanned
WHERE split = 'train' AND event_id = (SELECT event_id FROM fanned WHERE split = 'train' ORDER BY path, event_id LIMIT 1)
""")
def q_variant_sample(spark, sf):
    return FO.variant_sample(_fanned(spark, sf), ["path", "event_id"], ["label"], "event_id")


# --------------------------------------------------------------------------
# 7-9. framing, duration, time-domain features, tones
# --------------------------------------------------------------------------

_NF, _HOP = V.SIGNAL_N_FFT, V.SIGNAL_HOP
_SIG_CTE = f"""
sig AS (SELECT vec_id AS clip_id, CAST(embedding AS DOUBLE[]) AS x, len(embedding) AS n FROM embeddings)"""


def _r(c: str, d: int = 6):
    return F.round(F.col(c), d).alias(c)


@register("frame_signal", "D2", sql="WITH " + _SIG_CTE + f""",
fr AS (SELECT clip_id, x, n, unnest(range(0, (n - {_NF}) // {_HOP} + 1)) AS frame_no FROM sig WHERE n >= {_NF})
SELECT clip_id, frame_no, round(sum(x[frame_no * {_HOP} + m + 1] * x[frame_no * {_HOP} + m + 1]), 6) AS energy
FROM fr, range(0, {_NF}) t(m) GROUP BY clip_id, frame_no
""")
def q_frame_signal(spark, sf):
    return SG.frame_energy(V.signals(spark, sf), _NF, _HOP).select(
        "clip_id", F.col("frame_no").cast("long").alias("frame_no"), _r("energy"))


@register("clip_duration", "D14 D2 D2c", sql="WITH " + _SIG_CTE + f"""
SELECT clip_id, n AS n_samples, round(n / {V.SIGNAL_RATE}, 6) AS duration_s,
       CASE WHEN n >= {_NF} THEN (n - {_NF}) // {_HOP} + 1 ELSE 0 END AS n_frames,
       n // {_HOP} + 1 AS n_frames_centred
FROM sig
""")
def q_clip_duration(spark, sf):
    return (SG.clip_duration(V.signals(spark, sf), _NF, _HOP)
            .withColumn("duration_s", F.round("duration_s", 6))
            .withColumn("n_samples", F.col("n_samples").cast("long")))


_TIME_SQL = "WITH " + _SIG_CTE + f""",
fr AS (SELECT clip_id, x, n, unnest(range(0, n // {_HOP} + 1)) AS i FROM sig WHERE n > 0),
pos AS (
  SELECT clip_id, n, i, m,
         x[least(greatest(i * {_HOP} - {_NF // 2} + m, 0), n - 1) + 1] AS ve,
         CASE WHEN i * {_HOP} - {_NF // 2} + m BETWEEN 0 AND n - 1
              THEN x[i * {_HOP} - {_NF // 2} + m + 1] ELSE 0 END AS vz
  FROM fr, range(0, {_NF}) t(m)
),
lagged AS (
  SELECT *, lag(ve) OVER (PARTITION BY clip_id, i ORDER BY m) AS ve_prev FROM pos
),
per AS (
  SELECT clip_id, n, i,
         count(*) FILTER (WHERE ve_prev IS NOT NULL AND (ve < -1e-10) <> (ve_prev < -1e-10)) / {float(_NF)} AS zcr_t,
         sum(vz * vz) AS ss_t
  FROM lagged GROUP BY clip_id, n, i
),
w AS (
  SELECT *, (i * {_HOP} - {_NF // 2} >= 0 AND i * {_HOP} - {_NF // 2} + {_NF} <= n) AS whole FROM per
),
agg AS (
  SELECT clip_id, avg(zcr_t) AS zcr, avg(sqrt(ss_t / {float(_NF)})) AS rms,
         sum(ss_t) FILTER (WHERE whole) AS e_tot,
         sum(ss_t * log2(ss_t)) FILTER (WHERE whole AND ss_t > 0) AS s_tot,
         count(*) FILTER (WHERE whole) AS nf
  FROM w GROUP BY clip_id
)
SELECT clip_id, round(zcr, 6) AS zcr, round(rms, 6) AS rms,
       round(CASE WHEN nf = 0 THEN NULL WHEN e_tot > 0 THEN log2(e_tot) - coalesce(s_tot, 0) / e_tot ELSE 0 END, 6)
         AS entropy
FROM agg
"""


@register("frame_time_features", "D3 D4 D5 A8 A9", sql=_TIME_SQL)
def q_frame_time_features(spark, sf):
    out = SG.time_features(V.signals(spark, sf), _NF, _HOP)
    return out.select("clip_id", _r("zcr"), _r("rms"), _r("entropy"))


_TONE_DUR = 0.01
_TONE_N = int(vocab.SAMPLE_RATE * _TONE_DUR)


@register("tone_signal", "S9", sql=f"""
WITH tones AS (
  SELECT event_id, value * 20 AS freq, i,
         CASE WHEN value * 20 > 0
              THEN CAST(0.5 * sin(2.0 * pi() * (value * 20) * (i * {_TONE_DUR / _TONE_N!r})) AS FLOAT)
              ELSE CAST(0 AS FLOAT) END AS y
  FROM events, range(0, {_TONE_N}) t(i)
)
SELECT event_id, round(any_value(freq), 6) AS freq, count(*) AS n_samples,
       round(sum(CAST(y AS DOUBLE) * CAST(y AS DOUBLE)), 6) AS energy,
       count(*) FILTER (WHERE y < 0) AS n_negative
FROM tones GROUP BY event_id
""")
def q_tone_signal(spark, sf):
    """One 10 ms tone per event at 20*value Hz, summarised natively."""
    ev = table(spark, sf, "events", "event_id", "value").withColumn("freq", F.col("value") * 20)
    t = SG.tone_summary(ev, "event_id", "freq", _TONE_DUR)
    return t.select("event_id", F.round("freq", 6).alias("freq"), "n_samples", F.round("energy", 6).alias("energy"),
                    "n_negative")


# --------------------------------------------------------------------------
# 10-11. spectral
# --------------------------------------------------------------------------

_SR, _NMELS, _NMFCC = V.SIGNAL_RATE, vocab.N_MELS, vocab.N_MFCC
_FFT, _STEP = vocab.N_FFT, vocab.HOP
_NB = _FFT // 2 + 1

#: Centred frames of full size as lists, times the windowed Fourier basis.
_POWER_CTE = "WITH " + V.SUNG_CTE + f""",
pad AS (SELECT clip_id, n, list_concat(list_concat([0.0::DOUBLE for z in range({_FFT // 2})], x), [0.0::DOUBLE for z in range({_FFT // 2})]) AS x FROM sung),
fr AS MATERIALIZED (SELECT clip_id, i, x[i * {_STEP} + 1 : i * {_STEP} + {_FFT}] AS v
  FROM (SELECT clip_id, x, unnest(range(0, n // {_STEP} + 1)) AS i FROM pad)),
basis AS MATERIALIZED (
  SELECT k, list((0.5 - 0.5 * cos(2 * pi() * m / {_FFT})) * cos(2 * pi() * ((m * k) % {_FFT}) / {_FFT}) ORDER BY m) AS c,
            list((0.5 - 0.5 * cos(2 * pi() * m / {_FFT})) * sin(2 * pi() * ((m * k) % {_FFT}) / {_FFT}) ORDER BY m) AS s
  FROM range(0, {_FFT}) a(m) CROSS JOIN range(0, {_NB}) b(k) GROUP BY k
),
spec AS (SELECT clip_id, i, k, list_dot_product(v, c) AS re, list_dot_product(v, s) AS im FROM fr CROSS JOIN basis),
pw AS MATERIALIZED (SELECT clip_id, i, k, re * re + im * im AS p, sqrt(re * re + im * im) AS mag,
  k * ({_SR}::DOUBLE / {_FFT}) AS f FROM spec)"""

_SPEC_CTE = _POWER_CTE + f""",
mp AS (
  SELECT j, CASE WHEN mm >= 15 THEN 1000 * exp(ln(6.4) / 27 * (mm - 15)) ELSE mm * 200 / 3 END AS f
  FROM (SELECT j, j * ((15 + ln({_SR} / 2 / 1000) / (ln(6.4) / 27)) / {_NMELS + 1}) AS mm FROM range(0, {_NMELS + 2}) t(j))
),
mel_fb AS (
  SELECT a.j AS band, t.k,
         greatest(0, least((t.k * ({_SR}::DOUBLE / {_FFT}) - a.f) / (b.f - a.f), (c.f - t.k * ({_SR}::DOUBLE / {_FFT})) / (c.f - b.f)))
           * 2 / (c.f - a.f) AS w
  FROM mp a JOIN mp b ON b.j = a.j + 1 JOIN mp c ON c.j = a.j + 2 CROSS JOIN range(0, {_NB}) t(k)
  WHERE a.j < {_NMELS}
),
mf AS (SELECT clip_id, i, band, sum(p * w) AS mel FROM pw JOIN mel_fb USING (k) GROUP BY clip_id, i, band)"""


def _spec(spark, sf):
    return SPC.with_spectral(V.sung_clips(spark, sf))


@register("power_spectrum", "D6", sql=_POWER_CTE + """
SELECT clip_id, k AS bin, round(avg(p), 3) AS power FROM pw GROUP BY clip_id, k
""")
def q_power_spectrum(spark, sf):
    return SPC.exploded(_spec(spark, sf), F.col("spec.power_mean"), "bin", "power", 3)


@register("spectral_centroid", "D7", sql=_POWER_CTE + """,
cf AS (SELECT clip_id, i, CASE WHEN sum(mag) > 0 THEN sum(mag * f) / sum(mag) ELSE 0 END AS c
       FROM pw GROUP BY clip_id, i)
SELECT clip_id, round(avg(c), 4) AS centroid FROM cf GROUP BY clip_id
""")
def q_spectral_centroid(spark, sf):
    return _spec(spark, sf).select("clip_id", F.round("spec.centroid", 4).alias("centroid"))


@register("spectral_rolloff", "D8", sql=_POWER_CTE + """,
cs AS (SELECT clip_id, i, k, f,
              sum(mag) OVER (PARTITION BY clip_id, i ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
              sum(mag) OVER (PARTITION BY clip_id, i) AS tot FROM pw),
rf AS (SELECT clip_id, i, min(f) FILTER (WHERE cum >= 0.85 * tot) AS r FROM cs GROUP BY clip_id, i)
SELECT clip_id, round(avg(r), 6) AS rolloff FROM rf GROUP BY clip_id
""")
def q_spectral_rolloff(spark, sf):
    return _spec(spark, sf).select("clip_id", F.round("spec.rolloff", 6).alias("rolloff"))


@register("mel_bands", "D9", sql=_SPEC_CTE + """
SELECT clip_id, band, round(avg(mel), 4) AS mel FROM mf GROUP BY clip_id, band
""")
def q_mel_bands(spark, sf):
    return SPC.exploded(_spec(spark, sf), F.col("spec.mel_mean"), "band", "mel", 4)


@register("mfcc_mean", "D10", sql=_SPEC_CTE + f""",
db AS (SELECT clip_id, i, band, 10 * log10(greatest(1e-10, mel)) AS d FROM mf),
dbm AS (SELECT *, max(d) OVER (PARTITION BY clip_id) AS dmax FROM db),
dbmean AS (SELECT clip_id, band, avg(greatest(d, dmax - 80)) AS d FROM dbm GROUP BY clip_id, band),
dct AS (SELECT band, c, cos(pi() * c * (2 * band + 1) / {2 * _NMELS})
                        * CASE WHEN c = 0 THEN sqrt(1.0 / {_NMELS}) ELSE sqrt(2.0 / {_NMELS}) END AS w
        FROM range(0, {_NMELS}) a(band) CROSS JOIN range(0, {_NMFCC}) b(c))
SELECT clip_id, c AS coef, round(sum(d * w), 3) AS mfcc FROM dbmean JOIN dct USING (band) GROUP BY clip_id, c
""")
def q_mfcc_mean(spark, sf):
    s = _spec(spark, sf)
    return SPC.exploded(s, SPC.mfcc(F.col("spec")), "coef", "mfcc", 3)


#: Peaks by a parabola through three bins, their deviation from the nearest
#: semitone in hundredths, and the commonest one among the taller half.
_TUNING_CTE = _POWER_CTE + f""",
nb AS (SELECT clip_id, i, k, f, p, lag(p) OVER w AS l, lead(p) OVER w AS r, 0.1 * max(p) OVER (PARTITION BY clip_id, i) AS a
       FROM pw WINDOW w AS (PARTITION BY clip_id, i ORDER BY k)),
top AS (SELECT *, r + l - 2 * p AS aa, (r - l) / 2 AS bb FROM nb
        WHERE k BETWEEN 1 AND {_NB - 2} AND f >= 150 AND f < 4000 AND p > a
          AND p > CASE WHEN l > a THEN l ELSE 0 END AND p >= CASE WHEN r > a THEN r ELSE 0 END),
sh AS (SELECT *, CASE WHEN abs(bb) < abs(aa) THEN -bb / aa ELSE 0 END AS shift FROM top),
oc AS (SELECT clip_id, p + 0.5 * bb * shift AS h, 12 * log2((k + shift) * ({_SR}::DOUBLE / {_FFT}) / 27.5) AS o FROM sh),
dv AS (SELECT clip_id, h, o - floor(o) - CASE WHEN o - floor(o) >= 0.5 THEN 1 ELSE 0 END AS d FROM oc),
pk AS MATERIALIZED (SELECT clip_id, h, least(99, CAST(floor((d + 0.5) * 100) AS BIGINT)) AS step FROM dv),
md AS (SELECT clip_id, median(h) AS m FROM pk GROUP BY clip_id),
ct AS (SELECT clip_id, step, count(*) AS n FROM pk JOIN md USING (clip_id) WHERE h >= m * (1 - 1e-9) GROUP BY clip_id, step),
tun AS MATERIALIZED (SELECT clip_id, coalesce(step, 50) AS step FROM sung LEFT JOIN
  (SELECT * FROM ct QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY n DESC, step) = 1) USING (clip_id))"""


@register("clip_tuning", "D11", sql=_TUNING_CTE + """
SELECT clip_id, round(step / 100.0 - 0.5, 6) AS tuning FROM tun
""")
def q_clip_tuning(spark, sf):
    """Each clip's deviation from concert pitch, in parts of a semitone."""
    return _spec(spark, sf).select("clip_id", F.round("spec.tuning", 6).alias("tuning"))


@register("chroma_mean", "D11", sql=_TUNING_CTE + f""",
st AS (SELECT DISTINCT step FROM tun),
cq AS (SELECT step, j, 12 * log2((j * ({_SR}::DOUBLE / {_FFT})) / (440 * pow(2, (step / 100.0 - 0.5) / 12) / 16)) AS q
       FROM st, range(1, {_FFT}) t(j)),
cq0 AS (SELECT step, 0 AS j, q - 18 AS q FROM cq WHERE j = 1 UNION ALL SELECT step, j, q FROM cq),
cw AS (SELECT step, j, q, greatest(lead(q) OVER (PARTITION BY step ORDER BY j) - q, 1.0) AS width FROM cq0),
cd AS (SELECT step, j, c, q, width, ((q - c + 6 + 120) % 12) - 6 AS d FROM cw CROSS JOIN range(0, 12) t(c) WHERE j < {_NB}),
ce AS (SELECT step, j, c, q, exp(-0.5 * pow(2 * d / width, 2)) AS e FROM cd),
cn AS (SELECT step, j, c, e / sqrt(sum(e * e) OVER (PARTITION BY step, j)) * exp(-0.5 * pow((q / 12 - 5) / 2, 2)) AS w FROM ce),
chroma_fb AS MATERIALIZED (SELECT step, (c + 9) % 12 AS cbin, j AS k, w FROM cn),
cv AS (SELECT clip_id, i, cbin, sum(p * w) AS v FROM pw JOIN tun USING (clip_id) JOIN chroma_fb USING (step, k) GROUP BY clip_id, i, cbin),
cm AS (SELECT *, max(v) OVER (PARTITION BY clip_id, i) AS mx FROM cv)
SELECT clip_id, cbin AS chroma_bin, round(avg(v / CASE WHEN mx > 0 THEN mx ELSE 1 END), 6) AS chroma
FROM cm GROUP BY clip_id, cbin
""")
def q_chroma_mean(spark, sf):
    return SPC.exploded(_spec(spark, sf), F.col("spec.chroma_mean"), "chroma_bin", "chroma")


# --------------------------------------------------------------------------
# 12-15. feature checks, vocabulary, one-hot, standardiser, nearest centroid,
#        confusion matrix, report, accuracy/log-loss
# --------------------------------------------------------------------------

_FEAT_CTE = """
base AS (
  SELECT vec_id, label, embedding,
         CASE WHEN ('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80
              THEN 'train' ELSE 'test' END AS split
  FROM embeddings
),
lng AS (
  SELECT vec_id, label, split, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(0, len(embedding))) AS dim
  FROM base
)"""


def _features(spark, sf):
    return LN.train_test(V.feature_vectors(spark, sf), "vec_id")


@register("feature_checks", "A1 A7 M1 M3 M6 S8 P9", sql="""
SELECT count(*) AS n_rows, min(len(embedding)) AS min_len, max(len(embedding)) AS max_len,
       count(*) FILTER (WHERE label IS NULL) AS n_null_label,
       count(*) FILTER (WHERE len(list_filter(embedding, lambda x: x <> 0)) = 0) AS n_all_zero,
       count(*) FILTER (WHERE len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) > 0) AS n_nan_inf,
       min(len(embedding)) = max(len(embedding)) AS equal_len
FROM embeddings
""")
def q_feature_checks(spark, sf):
    return (PR.vector_profile(V.feature_vectors(spark, sf), "features", "label")
            .withColumn("min_len", F.col("min_len").cast("long"))
            .withColumn("max_len", F.col("max_len").cast("long")))


@register("label_vocabulary", "A6 M4", sql="""
SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS idx, count(*) OVER () AS k
FROM (SELECT DISTINCT label FROM embeddings)
""")
def q_label_vocabulary(spark, sf):
    return LN.label_vocabulary(V.feature_vectors(spark, sf))


_TRAIN = "('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80"


@register("unseen_labels", "M4", sql=f"""
WITH v AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS idx
           FROM (SELECT DISTINCT label FROM embeddings WHERE {_TRAIN} AND label < 7))
SELECT e.vec_id, e.label, v.idx, CASE WHEN v.idx IS NULL THEN 'unseen_label' ELSE 'ok' END AS status
FROM embeddings e LEFT JOIN v USING (label)
""")
def q_unseen_labels(spark, sf):
    """A vocabulary fitted on the train rows of seven labels, applied to all:
    the others come out with a status, not an error or a lost row."""
    f = _features(spark, sf)
    voc = LN.label_vocabulary(f.filter((F.col("split") == "train") & (F.col("label") < 7)))
    return LN.with_index(f, voc, unseen="status").select("vec_id", "label", "idx", "status")


@register("one_hot", "M4 M5", sql=f"""
WITH v AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS idx, count(*) OVER () AS k
           FROM (SELECT DISTINCT label FROM embeddings WHERE {_TRAIN}))
SELECT e.vec_id, e.label, v.idx,
       array_to_string(list_transform(range(0, v.k), lambda i: CASE WHEN i = v.idx THEN 1 ELSE 0 END), ',') AS one_hot
FROM embeddings e JOIN v USING (label)
""")
def q_one_hot(spark, sf):
    f = _features(spark, sf)
    voc = LN.label_vocabulary(f.filter(F.col("split") == "train"))
    enc = LN.with_index(f, voc)
    return enc.select("vec_id", "label", "idx",
                      F.array_join(LN.one_hot(F.col("idx"), F.col("k")).cast("array<string>"), ",").alias("one_hot"))


@register("standardize_fit", "A10 M2 S6", sql="WITH " + _FEAT_CTE + """
SELECT dim, round(avg(x), 6) AS mean,
       round(CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END, 6) AS std
FROM lng WHERE split = 'train' GROUP BY dim
""")
def q_standardize_fit(spark, sf):
    st = LN.dim_stats(_features(spark, sf).filter(F.col("split") == "train"))
    return st.select("dim", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("std"))


@register("standardize_apply", "M2 M3", sql="WITH " + _FEAT_CTE + """,
st AS (SELECT dim, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS sd
       FROM lng WHERE split = 'train' GROUP BY dim)
SELECT vec_id, dim, round((x - mean) / sd, 6) AS z FROM lng JOIN st USING (dim)
""")
def q_standardize_apply(spark, sf):
    f = _features(spark, sf)
    scaler = LN.PopulationScaler.fit(f.filter(F.col("split") == "train"))
    out = scaler.transform(f)
    return (out.select("vec_id", F.posexplode("scaled").alias("dim", "z"))
               .select("vec_id", F.col("dim").cast("long").alias("dim"), F.round("z", 6).alias("z")))


@register("scaled_checks", "M3 M2 M6", sql="WITH " + _FEAT_CTE + """,
st AS (SELECT dim, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS sd
       FROM lng WHERE split = 'train' GROUP BY dim),
z AS (SELECT vec_id, split, (x - mean) / sd AS z FROM lng JOIN st USING (dim)),
bad AS (SELECT vec_id, split, bool_or(isnan(z) OR isinf(z)) AS b FROM z GROUP BY vec_id, split)
SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE b) AS n_nan_inf FROM bad GROUP BY split
""")
def q_scaled_checks(spark, sf):
    """M3: rows holding NaN/Inf after scaling, per split (both must be 0)."""
    f = _features(spark, sf)
    scaled = LN.PopulationScaler.fit(f.filter(F.col("split") == "train")).transform(f)
    return scaled.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_if(LN.has_nan_inf(F.col("scaled"))).alias("n_nan_inf"))


_NC_CTE = "WITH " + _FEAT_CTE + """,
cent AS (SELECT label AS cls, dim, avg(x) AS c FROM lng WHERE split = 'train' GROUP BY label, dim),
dist AS (SELECT l.vec_id, l.label, c.cls, sum((l.x - c.c) * (l.x - c.c)) AS d
         FROM lng l JOIN cent c USING (dim) WHERE l.split = 'test' GROUP BY l.vec_id, l.label, c.cls),
mx AS (SELECT *, exp(-d - max(-d) OVER (PARTITION BY vec_id)) AS ex FROM dist),
soft AS (SELECT vec_id, label, cls, d, ex / sum(ex) OVER (PARTITION BY vec_id) AS p FROM mx),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(d, 9), cls) AS rn FROM soft),
pred AS (SELECT vec_id, label, cls AS pred, round(d, 9) AS dist FROM ranked WHERE rn = 1)"""


def _nc_scored(spark, sf):
    f = _features(spark, sf)
    model = LN.NearestCentroid.fit(f.filter(F.col("split") == "train"))
    return model, model.transform(f.filter(F.col("split") == "test"))


@register("nearest_centroid_pred", "T3 M9", sql=_NC_CTE + """
SELECT vec_id, label, pred, round(dist, 6) AS dist FROM pred
""")
def q_nearest_centroid_pred(spark, sf):
    _, s = _nc_scored(spark, sf)
    return s.select("vec_id", "label", "pred", F.round("dist", 6).alias("dist"))


@register("confusion_matrix", "M11", sql=_NC_CTE + """
SELECT label, """ + ", ".join(f"count(*) FILTER (WHERE pred = {c}) AS pred_{c}" for c in range(10)) + """
FROM pred GROUP BY label
""", notes="oracle lists the 10 classes of the test tables; Spark takes them from the fitted model")
def q_confusion_matrix(spark, sf):
    model, s = _nc_scored(spark, sf)
    return LN.confusion(s, model.classes)


_REPORT_TAIL = """t AS (SELECT label AS cls, count(*) AS support, count(*) FILTER (WHERE label = pred) AS tp FROM pred GROUP BY label),
p AS (SELECT pred AS cls, count(*) AS n_pred FROM pred GROUP BY pred),
per AS (SELECT coalesce(t.cls, p.cls) AS cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
               coalesce(n_pred, 0) AS n_pred FROM t FULL OUTER JOIN p ON t.cls = p.cls),
pr AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END AS precision,
                 CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
      FROM pr)
SELECT CAST(cls AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                 CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                 CAST(sum(support) AS BIGINT) FROM f
"""


@register("classification_report", "M10", sql=_NC_CTE + """,
""" + _REPORT_TAIL + """""")
def q_classification_report(spark, sf):
    _, s = _nc_scored(spark, sf)
    r = LN.classification_report(s)
    return r.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("accuracy_logloss", "M9", sql=_NC_CTE + """,
pt AS (SELECT vec_id, p FROM soft WHERE cls = label)
SELECT count(*) AS n, round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(-ln(least(greatest(p, 1e-15), 1 - 1e-15))), 6) AS logloss
FROM pred JOIN pt USING (vec_id)
""")
def q_accuracy_logloss(spark, sf):
    _, s = _nc_scored(spark, sf)
    return s.agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.avg(F.when(F.col("label") == F.col("pred"), 1.0).otherwise(0.0)), 6).alias("accuracy"),
                 F.round(F.avg(LN.log_loss(F.col("probs"), F.col("classes"), F.col("label"))), 6).alias("logloss"))


# --------------------------------------------------------------------------
# 16. prediction records, display lookup, history
# --------------------------------------------------------------------------

_NAMES_SQL = "[" + ",".join(f"'{n}'" for n in vocab.EMOTIONS_8) + "]"
_DISPLAY_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in vocab.DISPLAY) + ") AS d(dlabel, dfr, demoji)"


def _names(model) -> F.Column:
    return F.array(*[SC.class_name(F.lit(i)) for i in range(len(model.classes))])


@register("prediction_record", "R2 J1 J3 T3", sql=_NC_CTE + f""",
named AS (SELECT vec_id, cls, p, dense_rank() OVER (ORDER BY cls) - 1 AS idx FROM soft),
nm AS (SELECT *, CASE WHEN idx < 8 THEN ({_NAMES_SQL})[idx + 1] ELSE 'class_' || CAST(idx AS VARCHAR) END AS emotion
       FROM named),
best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, idx) AS rn FROM nm)
SELECT vec_id, emotion AS main_emotion, round(p, 4) AS confidence,
       coalesce(dfr, upper(emotion[1]) || lower(emotion[2:])) AS main_label_fr, coalesce(demoji, '❓') AS main_emoji
FROM best LEFT JOIN {_DISPLAY_SQL} ON emotion = dlabel WHERE rn = 1
""")
def q_prediction_record(spark, sf):
    model, s = _nc_scored(spark, sf)
    return SC.prediction_records(s, "vec_id", _names(model))


@register("ranked_probabilities", "R3 T2 T5 J1", sql=_NC_CTE + f""",
named AS (SELECT vec_id, cls, p, dense_rank() OVER (ORDER BY cls) - 1 AS idx FROM soft),
nm AS (SELECT *, CASE WHEN idx < 8 THEN ({_NAMES_SQL})[idx + 1] ELSE 'class_' || CAST(idx AS VARCHAR) END AS emotion
       FROM named),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, idx) AS rank FROM nm)
SELECT vec_id, rank, emotion, round(p, 4) AS probability,
       coalesce(dfr, upper(emotion[1]) || lower(emotion[2:])) AS label_fr, coalesce(demoji, '❓') AS emoji,
       rank = 1 AS is_main
FROM rk LEFT JOIN {_DISPLAY_SQL} ON emotion = dlabel
""")
def q_ranked_probabilities(spark, sf):
    model, s = _nc_scored(spark, sf)
    return SC.ranked_probabilities(s, "vec_id", _names(model))


@register("record_json", "R2 R3", sql=_NC_CTE + f""",
named AS (SELECT vec_id, cls, p, dense_rank() OVER (ORDER BY cls) - 1 AS idx FROM soft),
nm AS (SELECT *, CASE WHEN idx < 8 THEN ({_NAMES_SQL})[idx + 1] ELSE 'class_' || CAST(idx AS VARCHAR) END AS emotion FROM named),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, idx) AS rn FROM nm),
rec AS (SELECT vec_id, max(emotion) FILTER (WHERE rn = 1) AS main_emotion, round(max(p) FILTER (WHERE rn = 1), 4) AS confidence,
    string_agg(emotion, ' ' ORDER BY rn) AS ranked FROM rk GROUP BY vec_id)
SELECT vec_id, CASE vec_id % 11 WHEN 3 THEN 'malformed' WHEN 5 THEN 'no record' ELSE 'ok' END AS status,
  CASE WHEN vec_id % 11 NOT IN (3, 5) THEN main_emotion END AS main_emotion,
  CASE WHEN vec_id % 11 NOT IN (3, 5) THEN confidence END AS confidence,
  CASE WHEN vec_id % 11 NOT IN (3, 5) THEN ranked END AS ranked
FROM rec
""")
def q_record_json(spark, sf):
    """Records as JSON texts, some cut short and some lost, read back by the
    record's schema: fields of the good ones, reasons of the others."""
    from ..operators import serve
    model, s = _nc_scored(spark, sf)
    rec = serve.with_json(serve.records(s.withColumn("model_name", F.lit("centroid")), "vec_id", "model_name", len(model.classes)))
    kind = F.col("vec_id") % 11
    texts = rec.select("vec_id", F.when(kind == 3, F.expr("left(json, 40)")).when(kind != 5, F.col("json")).alias("json"))
    good, rejects = serve.from_json(texts, serve.record_schema(rec), "vec_id")
    good = good.select("vec_id", F.lit("ok").alias("status"), "main_emotion", "confidence",
                       F.array_join(F.transform("ranked", lambda r: r["emotion"]), " ").alias("ranked"))
    return good.unionByName(rejects.select("vec_id", F.col("reason").alias("status")), allowMissingColumns=True)


@register("history_newest", "R5 T4", sql=_NC_CTE + f""",
named AS (SELECT vec_id, cls, p, dense_rank() OVER (ORDER BY cls) - 1 AS idx FROM soft),
nm AS (SELECT *, CASE WHEN idx < 8 THEN ({_NAMES_SQL})[idx + 1] ELSE 'class_' || CAST(idx AS VARCHAR) END AS emotion FROM named),
best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, idx) AS rn FROM nm),
h AS (SELECT CAST(vec_id AS VARCHAR) AS key, '2024-05-0' || (vec_id % 3 + 1) || ' 10:30:0' || (vec_id % 3) AS time,
  vec_id || '.wav' AS file, emotion, round(p, 4) AS c FROM best WHERE rn = 1)
SELECT time, file, coalesce(dfr, upper(emotion[1]) || lower(emotion[2:])) AS main, coalesce(demoji, '❓') AS emoji,
  CAST(floor(c * 100) AS BIGINT) AS confidence, 'centroid' AS model
FROM (SELECT * FROM h ORDER BY time DESC, key DESC LIMIT 10) LEFT JOIN {_DISPLAY_SQL} ON emotion = dlabel
""")
def q_history_newest(spark, sf):
    """Three batches of records written to the history, each at its clock; the
    second comes again later and changes nothing. The newest ten."""
    from ..operators import serve
    model, s = _nc_scored(spark, sf)
    rec = serve.records(s.withColumn("model_name", F.lit("centroid")), "vec_id", "model_name", len(model.classes))
    rec = rec.select(F.col("vec_id").alias("key"), F.concat("vec_id", F.lit(".wav")).alias("file"), "main_emotion", "confidence",
                     F.col("model_name").alias("model"))
    path = shared_dir(spark, "history-" + uuid.uuid4().hex)
    for batch, clock in ((0, "2024-05-01 10:30:00"), (1, "2024-05-02 10:30:01"), (2, "2024-05-03 10:30:02"), (1, "2024-05-04 10:30:03")):
        serve.append_history(spark, rec.filter(F.col("key") % 3 == batch), path, clock)
    return serve.newest(spark, path)


@register("display_lookup", "J1", sql=f"""
WITH v AS (SELECT DISTINCT label FROM embeddings),
nm AS (SELECT dense_rank() OVER (ORDER BY label) - 1 AS idx FROM v),
e AS (SELECT CASE WHEN idx < 8 THEN ({_NAMES_SQL})[idx + 1] ELSE 'class_' || CAST(idx AS VARCHAR) END AS label FROM nm)
SELECT label, coalesce(dfr, upper(label[1]) || lower(label[2:])) AS label_fr, coalesce(demoji, '❓') AS emoji
FROM e LEFT JOIN {_DISPLAY_SQL} ON label = dlabel
""")
def q_display_lookup(spark, sf):
    voc = LN.label_vocabulary(V.feature_vectors(spark, sf))
    return LB.with_display(voc.select(SC.class_name(F.col("idx")).alias("label")), "label")


@register("history_top10", "T4 R5", sql=V.LABELLED_SQL + f""",
lab AS (SELECT * FROM labelled WHERE label <> 'unknown'),
h AS (SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
             string_split(path, '/')[-1] AS file, label,
             CAST(trunc(value / 500.0 * 100) AS BIGINT) AS confidence,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank
      FROM lab)
SELECT user_id, rank, event_id, time, file, coalesce(dfr, label) AS main, coalesce(demoji, '❓') AS emoji, confidence
FROM h LEFT JOIN {_DISPLAY_SQL} ON label = dlabel WHERE rank <= 10
""")
def q_history_top10(spark, sf):
    """Events as a prediction log: newest 10 per user (partial top-k before the shuffle)."""
    lab = _labelled(spark, sf)
    h = lab.select("user_id", "event_id", "ts", "path", "label", "value")
    top = SC.top_k_per_key(h, "user_id", [F.col("ts").desc(), F.col("event_id").desc()], 10)
    top = LB.with_display(top, "label")
    return top.select("user_id", F.col("rank").cast("long").alias("rank"), "event_id",
                      F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
                      LBF.basename(F.col("path")).alias("file"),
                      F.col("label_fr").alias("main"), "emoji",
                      (F.col("value") / 500.0 * 100).cast("long").alias("confidence"))


# --------------------------------------------------------------------------
# 18. WAV pipeline: encode -> decode -> 185 features (S1-like D1 D12 D13 G6)
# --------------------------------------------------------------------------

def decoded_clips(spark, sf):
    """Decode once, store in the shared folder, read back (lineage cut)."""
    from ..sources import audio, sinks
    raw = V.wav_clips(spark, sf)
    dec = audio.decode(raw).select("clip_id", "label", "samples", "sample_rate", "decode_status",
                                   F.size("samples").cast("long").alias("n_samples"))
    return sinks.materialize(dec, shared_dir(spark, "clips-" + uuid.uuid4().hex))


@register("wav_features", "D1 D12 D13 G6 P10", notes="rows-only: WAV codec has no SQL form")
def q_wav_features(spark, sf):
    from ..operators import features as FT
    clips = FT.with_status(decoded_clips(spark, sf))
    f = FT.extract_features(clips, keep_parts=True)
    return f.select("clip_id", "status", F.size("features").alias("n_features"),
                    *[F.round(c, 6).alias(c) for c in ("zcr", "rms", "centroid", "rolloff", "entropy")],
                    F.round(F.element_at("features", 1), 4).alias("mfcc0"))


@register("table_files", "S1", sql="""
SELECT name || '.parquet' AS file, hex('PAR1') AS head, hex('PAR1') AS tail
FROM (VALUES ('region'), ('nation'), ('customer'), ('supplier'), ('part'), ('orders'), ('lineitem'), ('events'),
  ('documents'), ('embeddings'), ('pages'), ('benchmark'), ('labels'), ('conversations')) AS t(name)
""")
def q_table_files(spark, sf):
    """The given tables' own files through the binary source: base name, first
    and last four bytes (the format's magic number) of each. Of long files only
    those bytes are read."""
    from ..sources import audio
    head, tail = audio.file_ends()
    return audio.ends_of_long(audio.scan_audio(spark, sf, "*.parquet")).select(
        audio.file_name().alias("file"), head.alias("head"), tail.alias("tail"))


@register("byte_ranges", "X3 S1", sql="WITH " + V.WAV_FILES_CTE + """
SELECT clip, 45 + 2 * n AS length,
  CAST(coalesce(sum(45 + 2 * n) OVER (ORDER BY clip ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 200000 AS part
FROM wavs
""")
def q_byte_ranges(spark, sf):
    """Scanned files dealt to tasks by their lengths: 200,000 bytes a task."""
    from ..sources import audio
    files = audio.scan_audio(spark, V.wav_files(spark, sf), "*.txt").select(audio.file_name(folder="clip").alias("clip"), "length")
    return SP.byte_ranges(files, 200_000, "clip")


_PCM_SQL = "round_even(greatest(least(emb[({i}) % 64 + 1], 1.0), -1.0) * 32767, 0)"
_BYTE_SQL = "right('0' || upper(to_hex((CAST({q} AS BIGINT) + 65536) % 65536 {part})), 2)"


@register("audio_scan", "S1 P1 P2 P3 P4 X1 D1", sql="WITH " + V.WAV_FILES_CTE + f"""
SELECT clip, label, CASE WHEN ('0x' || substr(md5(clip), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS split,
  45 + 2 * n AS length, hex('RIFF') AS head,
  {_BYTE_SQL.format(q=_PCM_SQL.format(i="n - 2"), part="// 256")}
    || {_BYTE_SQL.format(q=_PCM_SQL.format(i="n - 1"), part="% 256")}
    || {_BYTE_SQL.format(q=_PCM_SQL.format(i="n - 1"), part="// 256")} || '0A' AS tail,
  'ok' AS status, n AS n_samples
FROM wavs WHERE label <> 'unknown'
""")
def q_audio_scan(spark, sf):
    """Real WAV files scanned as binary rows, labelled and split by their
    names, then decoded: name, file length, first and last four bytes, decode
    status and decoded length. Unlabelled files go before content is decoded."""
    from ..sources import audio
    files = audio.scan_audio(spark, V.wav_files(spark, sf), "*.txt")
    head, tail = audio.file_ends()
    clips = files.withColumns({"clip": audio.file_name(folder="clip"), "head": head, "tail": tail})
    clips = LB.label_from_path(clips.withColumn("path", F.concat(F.lit("Crema/"), "clip")))
    clips = SP.with_split(clips, "clip")
    return audio.decode(clips).select("clip", "label", "split", "length", "head", "tail",
                                      F.col("decode_status").alias("status"), F.size("samples").cast("long").alias("n_samples"))


_WAV_CTE = """WITH base AS (
  SELECT vec_id AS clip_id, CAST(floor((0.08::DOUBLE + label * 0.06::DOUBLE) * 22050) AS BIGINT) AS n,
         CASE WHEN ('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80
              THEN 'train' ELSE 'test' END AS split
  FROM embeddings
)"""


@register("audio_augment", "G1 G2 G3 G4 G5 D14 J2", sql=_WAV_CTE + """,
fan AS (SELECT b.*, t.augmentation FROM base b,
          unnest(CASE WHEN split = 'train' THEN ['original','pitch_shift','white_noise','time_stretch']
                      ELSE ['original'] END) AS t(augmentation)),
out AS (
  SELECT clip_id, split, augmentation, n AS n_original, 'ok' AS augment_status,
         CASE WHEN augmentation = 'time_stretch' THEN CAST(round_even(n / 1.2, 0) AS BIGINT) ELSE n END AS n_samples
  FROM fan
)
SELECT clip_id, split, augmentation, augment_status, n_samples, round(n_samples / 22050, 6) AS duration_s, n_original
FROM out
""", notes="oracle checks lengths, statuses and durations; sample values are covered by tests")
def q_audio_augment(spark, sf):
    """Decoded clips -> md5 split -> fan-out -> augmentation kernels; per
    version: length, duration and status, beside the original's length."""
    from ..operators import augment as AU
    clips = decoded_clips(spark, sf).withColumnRenamed("n_samples", "n_original")
    aug = AU.augment(FO.fan_out(SP.with_split(clips, "clip_id")), "clip_id")
    return aug.select("clip_id", "split", "augmentation", "augment_status",
                      F.size("samples").cast("long").alias("n_samples"),
                      F.round(F.size("samples") / F.lit(V.SIGNAL_RATE), 6).alias("duration_s"), "n_original")


@register("noise_samples", "G1 G4 G6 D1", sql=_WAV_CTE.replace("SELECT vec_id AS clip_id,", "SELECT vec_id AS clip_id, CAST(embedding AS DOUBLE[]) AS emb,") + f""",
four AS (SELECT clip_id, b, md5(clip_id || '|white_noise|' || b) AS h
  FROM (SELECT clip_id, unnest(range(0, (n - 1) // 4 + 1)) AS b FROM base WHERE split = 'train')),
pair AS (SELECT clip_id, 4 * b + 2 * j AS i, sqrt(-2 * ln((('0x' || h[16*j+1:16*j+8])::BIGINT + 1) / 4294967296.0::DOUBLE)) AS r,
    2 * pi() * ('0x' || h[16*j+9:16*j+16])::BIGINT / 4294967296.0::DOUBLE AS t FROM four, range(0, 2) x(j)),
noise AS (SELECT clip_id, i, r * cos(t) AS e FROM pair UNION ALL SELECT clip_id, i + 1, r * sin(t) FROM pair),
y AS (SELECT clip_id, i, CAST(round_even(greatest(least(emb[i % 64 + 1], 1.0), -1.0) * 32767, 0) / 32768 AS FLOAT) AS x, e
  FROM base JOIN noise USING (clip_id) WHERE i < n),
q AS (SELECT clip_id, i, CAST(round_even(greatest(least(CAST(CAST(x + {vocab.NOISE_FACTOR}::DOUBLE * e AS FLOAT) AS DOUBLE), 1.0), -1.0) * 32767, 0) AS BIGINT) AS q FROM y)
SELECT clip_id, i // 256 AS block, count(*) AS n, CAST(sum(q) AS BIGINT) AS total, CAST(sum(q * q) AS BIGINT) AS energy,
  CAST(sum(q * (i % 256 + 1)) AS BIGINT) AS in_order FROM q GROUP BY clip_id, i // 256
""")
def q_noise_samples(spark, sf):
    """The noisy version of every train clip, on the 16-bit grid: per block of
    256 samples their sum, sum of squares and sum weighted by place, in units
    of the grid, so that no sample can differ unseen."""
    from ..operators import augment as AU
    from ..sources import audio
    clips = SP.with_split(audio.decode(V.wav_clips(spark, sf)).select("clip_id", "samples"), "clip_id")
    fan = FO.fan_out(clips.filter("split = 'train'")).filter("augmentation = 'white_noise'")
    y = AU.augment(fan, "clip_id").select("clip_id", F.posexplode("samples").alias("i", "x"))
    q = y.select("clip_id", "i", F.rint(F.col("x") * 32768.0).cast("long").alias("q"))
    return q.groupBy("clip_id", F.expr("CAST(i div 256 AS BIGINT)").alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("q").alias("total"), F.sum(F.col("q") * F.col("q")).alias("energy"),
        F.sum(F.col("q") * (F.col("i") % 256 + 1)).alias("in_order"))


@register("wav_status", "D1 D13 D14 P10", sql=_WAV_CTE + """
SELECT clip_id, CASE WHEN n < 2048 THEN 'too_short' ELSE 'ok' END AS status, n AS n_samples,
       CAST(185 AS BIGINT) AS n_features
FROM base
""")
def q_wav_status(spark, sf):
    """Per clip: decode/feature status, decoded length and vector length."""
    from ..operators import features as FT
    clips = FT.with_status(decoded_clips(spark, sf))
    f = FT.extract_features(clips, carry=["n_samples"])
    return f.select("clip_id", "status", F.size("features").cast("long").alias("n_features"), "n_samples")


@register("failed_clips", "D1 D12 D13 P10 G4 G5", sql=_WAV_CTE + """,
bad AS (SELECT clip_id, split, CASE clip_id % 10 WHEN 3 THEN 'decode_error' WHEN 4 THEN 'empty' WHEN 5 THEN 'empty'
          ELSE 'ok' END AS decode_status, n FROM base),
fan AS (SELECT b.*, t.augmentation FROM bad b,
          unnest(CASE WHEN split = 'train' THEN ['original','pitch_shift','white_noise','time_stretch']
                      ELSE ['original'] END) AS t(augmentation)),
len AS (SELECT *, CASE WHEN decode_status <> 'ok' THEN 0 WHEN augmentation = 'time_stretch'
          THEN CAST(round_even(n / 1.2, 0) AS BIGINT) ELSE n END AS n_samples FROM fan)
SELECT clip_id, augmentation, decode_status,
       CASE WHEN decode_status <> 'ok' AND augmentation <> 'original' THEN 'fallback' ELSE 'ok' END AS augment_status,
       CASE WHEN decode_status <> 'ok' THEN decode_status WHEN n_samples < 2048 THEN 'too_short' ELSE 'ok' END AS status,
       n_samples, CAST(185 AS BIGINT) AS n_features,
       decode_status <> 'ok' OR n_samples < 2048 AS all_zero
FROM len
""")
def q_failed_clips(spark, sf):
    """Every tenth clip's bytes are garbage, null or of length 0: each version
    of each clip comes out with its statuses and a vector of full length."""
    from ..operators import augment as AU
    from ..operators import features as FT
    from ..sources import audio
    raw = V.wav_clips(spark, sf)
    kind = F.col("clip_id") % 10
    raw = raw.withColumn("content", F.when(kind == 3, F.lit("no sound").cast("binary")).when(kind == 5, F.lit("").cast("binary"))
                         .when(kind != 4, F.col("content")))
    clips = audio.decode(raw).select("clip_id", "samples", "decode_status")
    fan = AU.augment(FO.fan_out(SP.with_split(clips, "clip_id")), "clip_id")
    fan = fan.withColumn("vid", F.concat_ws("|", "clip_id", "augmentation")).withColumn(
        "n_samples", F.size("samples").cast("long"))
    f = FT.extract_features(FT.with_status(fan), key="vid", long_clip_samples=None,
                            carry=["augmentation", "decode_status", "augment_status", "n_samples"])
    return f.select(F.split("vid", "[|]")[0].cast("long").alias("clip_id"), "augmentation", "decode_status",
                    "augment_status", "status", "n_samples", F.size("features").cast("long").alias("n_features"),
                    F.forall("features", lambda v: v == 0).alias("all_zero"))


# --------------------------------------------------------------------------
# 17/19. training, selection, history, scoring, model store
# --------------------------------------------------------------------------

def _design(spark, sf):
    """The standardised rows, stored once for all fits, folds and scorings."""
    from ..operators import train as TR
    from ..sources import sinks
    f = _features(spark, sf)
    voc = LN.label_vocabulary(f.filter(F.col("split") == "train"))
    f = LN.with_index(f, voc).withColumn("y", F.col("idx").cast("double"))
    scaler = LN.PopulationScaler.fit(f.filter(F.col("split") == "train"))
    d = SP.spread(TR.design(f, scaler), "vec_id")
    n_in = len(scaler.mean)
    k = voc.count()
    return sinks.materialize(d, shared_dir(spark, "design-" + uuid.uuid4().hex)), n_in, k


def _mlp_history(spark, sf):
    from ..operators import train as TR
    d, n_in, k = _design(spark, sf)
    root = shared_dir(spark, "models-" + uuid.uuid4().hex)
    TR.fit_in_runs(TR.mlp(n_in, k), *TR.held_out(d.filter(F.col("split") == "train")), "mlp", root)
    return TR.read_history(spark, root)


@register("train_classifier", "M7 M12", notes="rows-only: iterative optimiser history")
def q_train_classifier(spark, sf):
    """Losses and accuracies on both sides after each short run."""
    return _mlp_history(spark, sf)


@register("history_best", "A11 M12", notes="rows-only: over the stored history")
def q_history_best(spark, sf):
    """The best of the stored history; nothing is trained again for it."""
    from ..operators import train as TR
    return TR.history_best(_mlp_history(spark, sf))


@register("select_model", "M8 M7", notes="rows-only: clip-keyed fold inside train rows")
def q_select_model(spark, sf):
    """The network against three logistic regressions; the choice is fitted
    again, saved and read back."""
    from ..operators import train as TR
    d, n_in, k = _design(spark, sf)
    root = shared_dir(spark, "models-" + uuid.uuid4().hex)
    return TR.select_model(d.filter(F.col("split") == "train"), TR.candidates(n_in, k), root)


@register("model_store", "S7 S6", sql="""
SELECT file_name, name, (SELECT count(DISTINCT label) FROM embeddings) AS num_classes, is_loaded,
  CAST(1 AS BIGINT) AS n_loaded, CAST(2 AS BIGINT) AS n_available
FROM (VALUES ('voice_logreg_model', 'Voice Logreg Model', true), ('voice_logreg_model_2', 'Voice Logreg Model 2', false))
  AS t(file_name, name, is_loaded)
""")
def q_model_store(spark, sf):
    """Two fitted models saved, one of them twice and loaded: the catalogue
    with its totals, from the table that the saves appended to."""
    from pyspark.ml.classification import LogisticRegression
    from ..operators import train as TR
    d, _, _ = _design(spark, sf)
    root = shared_dir(spark, "models-" + uuid.uuid4().hex)
    model = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", maxIter=3).fit(d)
    for name in ("voice_logreg_model", "voice_logreg_model_2", "voice_logreg_model"):
        TR.save_model(model, f"{root}/{name}")
    store = TR.ModelStore(spark, root)
    store.load("voice_logreg_model")
    return store.catalogue().select("file_name", "name", F.col("num_classes").cast("long").alias("num_classes"),
                                    "is_loaded", "n_loaded", "n_available")


@register("batch_score", "R1 R2 R4 M9 S6 S7", notes="rows-only: trained models")
def q_batch_score(spark, sf):
    """Train two models, save them to the shared store, list the catalogue
    (S7), then score requests table-in/table-out: each test row asks for a
    model by file name; unknown names and all-zero vectors become statuses
    (R4) instead of errors, and are kept as rows."""
    from pyspark.ml.classification import LogisticRegression
    from ..operators import train as TR
    d, n_in, k = _design(spark, sf)
    train = d.filter(F.col("split") == "train")
    root = shared_dir(spark, "models-" + uuid.uuid4().hex)
    TR.save_model(TR.fit_mlp(train, n_in, k, max_iter=50), f"{root}/emotion_mlp_model")
    TR.save_model(LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", maxIter=50).fit(train),
                  f"{root}/emotion_logreg_model")
    cat = TR.model_catalogue(spark, root)
    asked = F.element_at(F.array(F.lit("emotion_mlp_model"), F.lit("emotion_logreg_model"), F.lit("emotion_cnn_model")),
                         (F.col("vec_id") % 3 + 1).cast("int"))
    req = d.filter(F.col("split") == "test").withColumn("model_name", asked)
    known = {r["file_name"]: r["model_class"] for r in cat.collect()}       # catalogue: a few rows
    # null-safe: a vector with a null or only zeros, or a null model name, is rejected
    zero = F.coalesce(F.forall("features", lambda v: v == 0) | F.exists("features", lambda v: v.isNull()), F.lit(True))
    names = F.array(*[SC.class_name(F.lit(i)) for i in range(k)])
    parts = []
    for m in known:
        model = TR.load_model(f"{root}/{m}", known[m])
        sub = req.filter((F.col("model_name") == m) & ~zero)
        scored = TR.probabilities(model.transform(sub))
        parts.append(SC.prediction_records(scored, "vec_id", names)
                     .withColumn("model_name", F.lit(m)).withColumn("status", F.lit("ok")))
    rejected = req.filter(zero | ~F.coalesce(F.col("model_name").isin(list(known)), F.lit(False))).select(
        "vec_id", "model_name",
        F.when(zero, F.lit("no_features")).otherwise(F.lit("unknown_model")).alias("status"))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out.unionByName(rejected, allowMissingColumns=True)


@register("stream_score", "R6", sql=_NC_CTE + """
SELECT vec_id, label, pred, round(dist, 6) AS dist FROM pred
""")
def q_stream_score(spark, sf):
    """The embeddings as twelve arriving files, scored in several micro-batches
    with the centroid model fitted on the train rows; then all files again from
    a new checkpoint. The table must equal batch scoring, every row once."""
    from ..streaming import score_stream as ST
    f = _features(spark, sf)
    model = LN.NearestCentroid.fit(f.filter(F.col("split") == "train"))
    root = shared_dir(spark, "stream-" + uuid.uuid4().hex)
    rows = table(spark, sf, "embeddings")
    rows.repartition(12, "vec_id").write.parquet(f"{root}/arriving")
    src = ST.parquet_stream(spark, f"{root}/arriving", rows.schema, max_files=5)

    def transform(batch):
        b = LN.train_test(batch.select(*ST.KEYS, "vec_id", "label", F.col("embedding").alias("features")), "vec_id")
        return (model.transform(b.filter(F.col("split") == "test"))
                .select(*ST.KEYS, "vec_id", "label", "pred", F.round("dist", 6).alias("dist")))

    for run in ("first", "again"):
        ST.run_to_table(src, transform, f"{root}/predictions", f"{root}/checkpoint-{run}", "centroid")
    return ST.latest(ST.read_table(spark, f"{root}/predictions")).drop(*ST.KEYS)


@register("augmented_store", "S3 S4 G4 A2", sql=_FAN_SQL + """
SELECT label, count(*) AS n FROM fanned WHERE augmentation = 'white_noise' GROUP BY label
""")
def q_augmented_store(spark, sf):
    """The fanned-out table written once, partitioned by (split, augmentation)
    with dynamic overwrite (a re-run replaces only its partitions), then read
    back for one augmentation: the filter prunes partitions at the scan."""
    from ..sources import sinks
    out = shared_dir(spark, "augmented-" + uuid.uuid4().hex)
    fan = _fanned(spark, sf).select("event_id", "path", "label", "dataset", "split", "augmentation")
    sinks.write_partitioned(fan, out, "split", "augmentation")
    back = spark.read.parquet(out).filter(F.col("augmentation") == "white_noise")
    return PR.group_counts(back, "label")


@register("mlp_evaluation", "M7 M9", notes="rows-only: trained model")
def q_mlp_evaluation(spark, sf):
    """Accuracy and log loss of the MLP on the test rows (Spark's evaluator)."""
    from ..operators import train as TR
    d, n_in, k = _design(spark, sf)
    model = TR.fit_mlp(d.filter(F.col("split") == "train"), n_in, k, max_iter=50)
    return TR.evaluate(model.transform(d.filter(F.col("split") == "test")))



# --------------------------------------------------------------------------
# the other given tables: labels (binary true/pred pair), pages (parser on
# real-world strings), documents (keyed split)
# --------------------------------------------------------------------------

@register("binary_report", "M10 M11", sql="""WITH pred AS (SELECT doc_id AS vec_id, quality AS label, toxic AS pred
                                             FROM labels),
""" + _REPORT_TAIL)
def q_binary_report(spark, sf):
    """The report on a second, binary (true, pred) pair: labels.quality vs labels.toxic."""
    p = table(spark, sf, "labels", "quality", "toxic").select(F.col("quality").alias("label"),
                                                             F.col("toxic").alias("pred"))
    r = LN.classification_report(p)
    return r.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("binary_confusion", "M11", sql="""
SELECT quality AS label, count(*) FILTER (WHERE toxic = 0) AS pred_0, count(*) FILTER (WHERE toxic = 1) AS pred_1
FROM labels GROUP BY quality
""")
def q_binary_confusion(spark, sf):
    p = table(spark, sf, "labels", "quality", "toxic").select(F.col("quality").alias("label"),
                                                             F.col("toxic").alias("pred"))
    return LN.confusion(p, [0, 1])


_URL_FILES = ("03-01-05-01-02-01-24.wav", "oaf_back_fear.wav", "1001_dfa_ang_xx.wav", "dc_a01.wav", "x.wav",
              "03-01-99-01.wav", "yaf_dog_ps.wav", "1001_dfa_zzz_xx.wav", "jk_su07.wav")


@register("url_filename_label", "P8", sql=_FN_SQL.replace(
    V.CLIP_PATHS_SQL, "WITH clip_paths AS (SELECT page_id AS event_id, url || '/' || "
    f"{list(_URL_FILES)}[page_id % {len(_URL_FILES)} + 1] AS path FROM pages)").replace(
    "SELECT event_id, path,\n  CASE", "SELECT event_id AS page_id, path AS url,\n  CASE"))
def q_url_filename_label(spark, sf):
    """The filename-only parser on recordings under page URLs: a file of each
    rule and of each miss."""
    files = F.array(*[F.lit(x) for x in _URL_FILES])
    pg = table(spark, sf, "pages", "page_id", "url")
    pg = pg.withColumn("url", F.concat_ws("/", "url", F.get(files, (F.col("page_id") % len(_URL_FILES)).cast("int"))))
    return LB.with_filename_label(pg, "url").select("page_id", "url", "fn_label")


@register("document_split", "X1 A2", sql="""
WITH s AS (
  SELECT lang, n_chars,
         CASE WHEN ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80
              THEN 'train' ELSE 'test' END AS split
  FROM documents)
SELECT split, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM s GROUP BY split, lang
""")
def q_document_split(spark, sf):
    """The keyed md5 split on another table (documents by doc_id), per language."""
    d = SP.with_split(table(spark, sf, "documents", "doc_id", "lang", "n_chars"), "doc_id")
    return d.groupBy("split", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@register("wav_time_features", "D1 D3 D4 D5 D12 D13 G6", sql="""
WITH e AS (
  SELECT vec_id AS clip_id, CAST(embedding AS DOUBLE[]) AS emb,
         CAST(floor((0.08::DOUBLE + label * 0.06::DOUBLE) * 22050) AS BIGINT) AS n
  FROM embeddings
),
fr AS (SELECT clip_id, n, emb, unnest(range(0, n // 512 + 1)) AS i FROM e WHERE n >= 2048),
val AS (
  SELECT clip_id, n, i, m,
         CASE WHEN i * 512 - 1024 + m BETWEEN 0 AND n - 1
              THEN round_even(greatest(least(emb[((i * 512 - 1024 + m) % 64) + 1], 1.0), -1.0) * 32767, 0) / 32768
         END AS v
  FROM fr CROSS JOIN range(0, 2048) t(m)
),
lagged AS (SELECT *, lag(v) OVER (PARTITION BY clip_id, i ORDER BY m) AS vp FROM val),
per AS (
  SELECT clip_id, n, i,
         count(*) FILTER (WHERE v IS NOT NULL AND vp IS NOT NULL AND (v < -1e-10) <> (vp < -1e-10)) / 2048.0 AS zc,
         coalesce(sum(v * v), 0) AS ss,
         (i * 512 - 1024 >= 0 AND i * 512 - 1024 + 2048 <= n) AS whole
  FROM lagged GROUP BY clip_id, n, i
),
agg AS (
  SELECT clip_id, avg(zc) AS zcr, avg(sqrt(ss / 2048.0)) AS rms,
         sum(ss) FILTER (WHERE whole) AS e_tot, sum(ss * log2(ss)) FILTER (WHERE whole AND ss > 0) AS s_tot,
         count(*) FILTER (WHERE whole) AS nf
  FROM per GROUP BY clip_id
)
SELECT e.clip_id, CASE WHEN e.n < 2048 THEN 'too_short' ELSE 'ok' END AS status,
       round(zcr, 6) AS zcr, round(rms, 6) AS rms,
       round(CASE WHEN nf IS NULL OR nf = 0 THEN NULL
                  WHEN e_tot > 0 THEN log2(e_tot) - coalesce(s_tot, 0) / e_tot ELSE 0 END, 6) AS entropy
FROM e LEFT JOIN agg USING (clip_id)
""", notes="SQL rebuilds the decoded 16-bit samples from embeddings; checks codec + kernel time features")
def q_wav_time_features(spark, sf):
    """ZCR, RMS and energy entropy of the encoded -> decoded WAV clips, as the
    185-vector extraction computes them (kernel pass)."""
    from ..operators import features as FT
    clips = FT.with_status(decoded_clips(spark, sf))
    f = FT.extract_features(clips, keep_parts=True)
    return f.select("clip_id", "status", *[F.round(c, 6).alias(c) for c in ("zcr", "rms", "entropy")])


@register("audio_stream", "R6 S1 D1 D3 D4", sql=REGISTRY["wav_time_features"].sql.replace("WITH e AS", "WITH " + V.WAV_FILES_CTE + ",\ne AS").replace(
    "SELECT e.clip_id, CASE WHEN e.n < 2048 THEN 'too_short' ELSE 'ok' END AS status,\n       round(zcr, 6) AS zcr, round(rms, 6) AS rms,",
    "SELECT wavs.clip, wavs.label, 'time-features' AS model, CAST(1 AS BIGINT) AS n_versions, "
    "CASE WHEN e.n < 2048 THEN 'too_short' ELSE 'ok' END AS status, round(zcr, 6) AS zcr, round(rms, 6) AS rms,").replace(
    "FROM e LEFT JOIN agg USING (clip_id)", "FROM e LEFT JOIN agg USING (clip_id) JOIN wavs ON wavs.vec_id = e.clip_id WHERE wavs.label <> 'unknown'"))
def q_audio_stream(spark, sf):
    """WAV files arriving as a stream: labelled by name, decoded and measured
    micro-batch by micro-batch, merged by (path, modification time, model);
    then restarted from its checkpoint and fed again from a new one. Every
    file is there once, with its features."""
    from ..operators import features as FT
    from ..sources import audio
    from ..streaming import score_stream as ST
    root = V.wav_files(spark, sf)
    sink = shared_dir(spark, "audio-stream-" + uuid.uuid4().hex)
    # Batches of 200 files; of a twentieth where that is more, as each batch
    # has its fixed cost and the table to merge into has a folder for each.
    n_files = table(spark, sf, "embeddings", "vec_id").count()
    src = audio.read_stream_audio(spark, f"{root}/Crema/*", "*.txt", max_files=max(200, n_files // 20))
    # Labelled in the stream: files without a label, which the table never
    # holds, go by their names before the merge looks at what is new.
    src = src.withColumn("clip", audio.file_name(folder="clip")).withColumn("file", F.col("path"))
    src = LB.label_from_path(src.withColumn("path", F.concat(F.lit("Crema/"), "clip")))
    src = src.withColumn("path", F.col("file")).drop("file", "dataset")

    def transform(batch):
        b = FT.with_status(audio.decode(batch).withColumn("clip_id", F.col("path")))
        f = FT.extract_features(b, keep_parts=True, long_clip_samples=None,
                                carry=["path", "modificationTime", "model", "clip", "label"])
        return f.select(*ST.KEYS, "clip", "label", "status", *[F.round(c, 6).alias(c) for c in ("zcr", "rms", "entropy")])

    for checkpoint in ("one", "one", "two"):
        ST.run_to_table(src, transform, f"{sink}/clips", f"{sink}/{checkpoint}", "time-features")
    versions = ST.read_table(spark, f"{sink}/clips")
    n = versions.groupBy("path", "model").agg(F.count(F.lit(1)).alias("n_versions"))
    return ST.latest(versions).join(n, ["path", "model"]).drop("path", "modificationTime")


_NAME_SQL = ("CASE WHEN cls < 8 THEN ["
             + ", ".join(f"'{n}'" for n in vocab.EMOTIONS_8) + "][cls + 1] ELSE 'class_' || cls END")


@register("score_requests", "R1 R2 R4 R5 S6 T2 T5", sql="WITH " + _FEAT_CTE + """,
st AS (SELECT dim, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS sd
       FROM lng WHERE split = 'train' GROUP BY dim),
z AS (SELECT vec_id, label, split, dim, x, (x - mean) / sd AS z FROM lng JOIN st USING (dim)),
req AS (SELECT DISTINCT vec_id, CASE vec_id % 8 WHEN 0 THEN 'centroid_plain' WHEN 6 THEN 'centroid_plain'
          WHEN 4 THEN 'emotion_cnn_model' WHEN 7 THEN NULL ELSE 'centroid_scaled' END AS model_name,
        CASE vec_id % 8 WHEN 2 THEN 'empty_input' WHEN 3 THEN 'no_features' WHEN 4 THEN 'unknown_model'
          WHEN 5 THEN 'error' WHEN 7 THEN 'unknown_model' ELSE 'ok' END AS status FROM base),
cent AS (SELECT 'centroid_plain' AS model_name, label AS cls, dim, avg(x) AS c FROM z WHERE split = 'train' GROUP BY ALL
         UNION ALL SELECT 'centroid_scaled', label, dim, avg(z) FROM z WHERE split = 'train' GROUP BY ALL),
dist AS (SELECT vec_id, model_name, cls, sum((v - c) * (v - c)) AS d FROM (
           SELECT z.vec_id, req.model_name, dim, CASE WHEN req.model_name = 'centroid_plain' THEN x ELSE z END AS v
           FROM z JOIN req USING (vec_id) WHERE status = 'ok') JOIN cent USING (model_name, dim) GROUP BY ALL),
mx AS (SELECT *, exp(-d - max(-d) OVER (PARTITION BY vec_id)) AS ex FROM dist),
soft AS (SELECT vec_id, cls, """ + _NAME_SQL + """ AS name, ex / sum(ex) OVER (PARTITION BY vec_id) AS p FROM mx),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, cls) AS rn FROM soft),
rec AS (SELECT vec_id, max(name) FILTER (WHERE rn = 1) AS main_emotion,
    round(max(p) FILTER (WHERE rn = 1), 4) AS confidence,
    string_agg(name || '=' || CAST(CAST(round(p, 4) AS DECIMAL(6, 4)) AS VARCHAR), ' ' ORDER BY rn) FILTER (WHERE rn > 1) AS others,
    count(*) AS n_probabilities
  FROM ranked GROUP BY vec_id)
SELECT req.vec_id, req.model_name, status, main_emotion, confidence, others, n_probabilities
FROM req LEFT JOIN rec ON req.vec_id = rec.vec_id
""")
def q_score_requests(spark, sf):
    """Requests of every outcome against two stored models, one with a stored
    scaler; records go to the history, the rest to the rejects, both by append
    sinks and read back. ``others`` lists the ranks after the main class."""
    from ..operators import serve
    f = _features(spark, sf)
    train = f.filter(F.col("split") == "train")
    root = shared_dir(spark, "serve-" + uuid.uuid4().hex)
    scaler = LN.PopulationScaler.fit(train)
    serve.save(spark, f"{root}/models", "centroid_plain", LN.NearestCentroid.fit(train))
    serve.save(spark, f"{root}/models", "centroid_scaled",
               LN.NearestCentroid.fit(scaler.transform(train, "features", "features")), scaler)
    kind = F.col("vec_id") % 8
    v = F.col("features").cast("array<double>")
    zero = F.transform(v, lambda x: F.lit(0.0))
    req = f.select(
        "vec_id",
        F.when(kind.isin(0, 6), "centroid_plain").when(kind == 4, "emotion_cnn_model")
         .when(kind != 7, "centroid_scaled").alias("model_name"),
        F.when(kind == 3, zero).when(kind == 5, F.slice(v, 1, 10)).when(kind != 2, v).alias("features"))
    rec, rejects = serve.score_requests(spark, req, f"{root}/models", "vec_id")
    serve.with_json(rec).write.mode("append").parquet(f"{root}/history")
    rejects.write.mode("append").parquet(f"{root}/rejects")
    rec, rejects = spark.read.parquet(f"{root}/history"), spark.read.parquet(f"{root}/rejects")
    others = F.array_join(F.transform(F.slice("ranked", 2, 1000), lambda r: F.concat(
        r["emotion"], F.lit("="), r["probability"].cast("decimal(6,4)").cast("string"))), " ")
    rec = rec.select("vec_id", "model_name", F.lit("ok").alias("status"), "main_emotion", "confidence",
                     others.alias("others"), F.size(F.map_keys("probabilities")).cast("long").alias("n_probabilities"))
    return rec.unionByName(rejects, allowMissingColumns=True)
