"""Derived inputs over the shared test tables.

The test tables carry no audio, so each operator family gets a view Spark
derives from a given table (work grows with the table):

* ``clip_paths``: corpus-like file paths built from ``events`` (event_id, user_id);
  every rule of the path labeller is hit, including misses.
* ``signals``: ``embeddings.embedding`` read as a short mono waveform.
* ``feature_vectors``: the same vectors as feature rows with ``label`` as class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

# Word lists the synthetic paths draw from, by k = (event_id div 6) % 9.
CREMA_CODES = ["ANG", "DIS", "FEA", "HAP", "NEU", "SAD", "ZZZ", "ZZZ", "ZZZ"]
TESS_WORDS = ["angry", "disgust", "fear", "happy", "neutral", "ps", "sad", "Angry", "calm"]
SAVEE_CODES = ["a", "d", "f", "h", "n", "sa", "su", "zz", "zz"]

# Parameters for reading 64-float embeddings as waveforms (scaled-down frames).
SIGNAL_RATE = 22050
SIGNAL_N_FFT = 16
SIGNAL_HOP = 4


def _arr(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def clip_paths_from_events(events: DataFrame) -> DataFrame:
    """(event_id, user_id, ts, value, path) with corpus = event_id % 6 and
    code index k = (event_id div 6) % 9. One SQL expression (one call to the
    JVM to build, one projection in the plan)."""
    k = "((event_id div 6) % 9)"
    nn24 = "lpad(cast(user_id % 24 + 1 AS STRING), 2, '0')"
    nn15 = "lpad(cast(user_id % 15 + 1 AS STRING), 2, '0')"
    path = f"""CASE event_id % 6
      WHEN 0 THEN concat('Dataset/Ravdess/Actor_', {nn24}, '/03-01-0', cast({k} AS STRING), '-01-02-01-', {nn24}, '.wav')
      WHEN 1 THEN concat('Dataset/Crema/', cast(user_id + 1000 AS STRING), '_DFA_',
                         element_at({_arr(CREMA_CODES)}, cast({k} + 1 AS INT)),
                         CASE WHEN {k} = 7 THEN '_X2.wav' ELSE '_XX.wav' END)
      WHEN 2 THEN concat('Dataset/Tess/OAF_back_', element_at({_arr(TESS_WORDS)}, cast({k} + 1 AS INT)), '.wav')
      WHEN 3 THEN concat('Dataset/Savee/DC_', element_at({_arr(SAVEE_CODES)}, cast({k} + 1 AS INT)), {nn15}, '.wav')
      WHEN 4 THEN concat('Dataset/Savee/x', cast({k} AS STRING), '.wav')
      ELSE concat('Dataset/Other/', cast(event_id AS STRING), '.wav') END AS path"""
    return events.selectExpr("event_id", "user_id", "ts", "value", path)


def clip_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clip_paths_from_events(table(spark, sf_dir, "events", "event_id", "user_id", "ts", "value"))


CLIP_PATHS_CTE = """
clip_paths AS (
  SELECT event_id, user_id, ts, value,
    CASE event_id % 6
      WHEN 0 THEN 'Dataset/Ravdess/Actor_' || lpad(CAST(user_id % 24 + 1 AS VARCHAR), 2, '0')
                  || '/03-01-0' || CAST((event_id // 6) % 9 AS VARCHAR) || '-01-02-01-'
                  || lpad(CAST(user_id % 24 + 1 AS VARCHAR), 2, '0') || '.wav'
      WHEN 1 THEN 'Dataset/Crema/' || CAST(user_id + 1000 AS VARCHAR) || '_DFA_'
                  || (['ANG','DIS','FEA','HAP','NEU','SAD','ZZZ','ZZZ','ZZZ'])[(event_id // 6) % 9 + 1]
                  || CASE WHEN (event_id // 6) % 9 = 7 THEN '_X2.wav' ELSE '_XX.wav' END
      WHEN 2 THEN 'Dataset/Tess/OAF_back_'
                  || (['angry','disgust','fear','happy','neutral','ps','sad','Angry','calm'])[(event_id // 6) % 9 + 1]
                  || '.wav'
      WHEN 3 THEN 'Dataset/Savee/DC_'
                  || (['a','d','f','h','n','sa','su','zz','zz'])[(event_id // 6) % 9 + 1]
                  || lpad(CAST(user_id % 15 + 1 AS VARCHAR), 2, '0') || '.wav'
      WHEN 4 THEN 'Dataset/Savee/x' || CAST((event_id // 6) % 9 AS VARCHAR) || '.wav'
      ELSE 'Dataset/Other/' || CAST(event_id AS VARCHAR) || '.wav'
    END AS path
  FROM events
)"""

# DuckDB mirror of the labeller (P2-P5) on top of clip_paths.
LABELLED_CTE = CLIP_PATHS_CTE + """,
tagged AS (
  SELECT *, CASE WHEN contains(path, 'Ravdess') THEN 'RAVDESS'
                 WHEN contains(path, 'Crema') THEN 'CREMA'
                 WHEN contains(path, 'Tess') THEN 'TESS'
                 WHEN contains(path, 'Savee') THEN 'SAVEE' END AS dataset
  FROM clip_paths
),
coded AS (
  SELECT *, CASE dataset
      WHEN 'RAVDESS' THEN regexp_extract(path, '([0-9]{2})-([0-9]{2})-([0-9]{2})-', 3)
      WHEN 'CREMA' THEN regexp_extract(path, '_([A-Z]{3})_([A-Z]+)[.]wav', 1)
      WHEN 'TESS' THEN regexp_extract(path, '_([a-z]+)[.]wav', 1)
      WHEN 'SAVEE' THEN regexp_extract(path, '([a-z]+)[0-9]{2}[.]wav', 1) END AS code
  FROM tagged
),
labelled AS (
  SELECT event_id, user_id, ts, value, path, dataset,
    CASE WHEN code IN ('03','HAP','happy','h') THEN 'happy'
         WHEN code IN ('04','SAD','sad','sa') THEN 'sad'
         WHEN code IN ('05','ANG','angry','a') THEN 'angry'
         WHEN code IN ('06','FEA','fear','f') THEN 'fear'
         WHEN code IN ('07','DIS','disgust','d') THEN 'disgust'
         WHEN code IN ('08','ps','su','surprise') THEN 'surprise'
         WHEN code IN ('01','02','NEU','neutral','n') THEN 'neutral'
         ELSE 'unknown' END AS label
  FROM coded
)"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip_id, samples array<float>, sample_rate)."""
    from ..operators.split import spread
    return (spread(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id")
            .select(F.col("vec_id").alias("clip_id"), F.col("embedding").alias("samples"),
                    F.lit(SIGNAL_RATE).alias("sample_rate")))


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label int, features array<float>)."""
    return (table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
            .select("vec_id", "label", F.col("embedding").alias("features")))


CLIP_PATHS_SQL = "WITH " + CLIP_PATHS_CTE
LABELLED_SQL = "WITH " + LABELLED_CTE


def wav_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip_id, label, content) 16-bit PCM WAV bytes at 22050 Hz built from
    ``embeddings``: the 64-sample waveform tiled to 0.08 + 0.06 * label
    seconds (label 0 gives clips shorter than one 2048-sample frame)."""
    from ..functions.batches import small_batches
    from ..operators.split import spread
    from ..sources import audio
    small_batches(spark)
    e = spread(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), "vec_id")
    n = ((F.lit(0.08) + F.col("label") * F.lit(0.06)) * F.lit(SIGNAL_RATE)).cast("int")
    reps = (n / F.lit(64)).cast("int") + 1
    samples = F.slice(F.flatten(F.array_repeat(F.col("embedding"), reps)), F.lit(1), n)
    return e.select(F.col("vec_id").alias("clip_id"), "label",
                    audio.encode_udf(samples, F.lit(SIGNAL_RATE)).alias("content"))


def wav_files(spark: SparkSession, sf_dir: str) -> str:
    """The WAV clips as files: a folder with one file per clip, under
    ``Crema/clip=<vec_id>_DFA_<code>_XX.wav/``; returns the folder. The code
    is that of ``vec_id % 9``, unknown ones included."""
    from ..session import shared_dir
    from ..sources import sinks
    code = f"element_at({_arr(CREMA_CODES)}, cast(clip_id % 9 + 1 AS INT))"
    root = shared_dir(spark)
    clips = wav_clips(spark, sf_dir).selectExpr(
        f"concat(cast(clip_id AS STRING), '_DFA_', {code}, '_XX.wav') AS clip", "content")
    sinks.write_files(clips, f"{root}/Crema", "clip", "content")
    return root


#: The same in SQL: name, label and the encoded 16-bit samples' count.
WAV_FILES_CTE = f"""
wavs AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS emb,
    vec_id || '_DFA_' || ({CREMA_CODES})[vec_id % 9 + 1] || '_XX.wav' AS clip,
    CAST(floor((0.08::DOUBLE + label * 0.06::DOUBLE) * {SIGNAL_RATE}) AS BIGINT) AS n,
    CASE ({CREMA_CODES})[vec_id % 9 + 1] WHEN 'ANG' THEN 'angry' WHEN 'DIS' THEN 'disgust' WHEN 'FEA' THEN 'fear'
      WHEN 'HAP' THEN 'happy' WHEN 'NEU' THEN 'neutral' WHEN 'SAD' THEN 'sad' ELSE 'unknown' END AS label
  FROM embeddings
)"""


#: Sung clips: 0.1 s of the tiled vector under a tone that is off concert pitch
#: by up to 1/4 of a semitone, on the 16-bit grid. Frames have full size.
SUNG_N = 2205
_SUNG_HZ = "220 * pow(2D, (vec_id % 37) / 12D + (vec_id % 50 - 25) / 1200D)"


def sung_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip_id, samples)."""
    from ..operators.split import spread
    wave = (f"transform(sequence(0, {SUNG_N - 1}), i -> CAST(rint((0.25D * element_at(embedding, i % 64 + 1) + "
            f"0.5D * sin(2 * pi() * hz * i / {SIGNAL_RATE})) * 32768) / 32768 AS FLOAT))")
    e = spread(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id")
    return e.selectExpr("vec_id AS clip_id", "embedding", f"{_SUNG_HZ} AS hz").selectExpr("clip_id", f"{wave} AS samples")


SUNG_CTE = f"""
sung AS MATERIALIZED (
  SELECT clip_id, count(*) AS n, list(x ORDER BY i) AS x
  FROM (SELECT vec_id AS clip_id, i, CAST(CAST(round_even((0.25 * CAST(embedding[i % 64 + 1] AS DOUBLE)
          + 0.5 * sin(2 * pi() * {_SUNG_HZ.replace("D", "::DOUBLE")} * i / {SIGNAL_RATE})) * 32768, 0) / 32768 AS FLOAT) AS DOUBLE) AS x
        FROM embeddings, range(0, {SUNG_N}) t(i))
  GROUP BY clip_id
)"""
