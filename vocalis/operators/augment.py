"""Audio augmentation over the fanned-out clip table.

Pitch and tempo go through one Arrow-batched kernel ('original' comes back as
it is). Noise is made by built-in functions: its sample is a function of the
clip's key and the sample's number alone, so a re-run (or a recomputed
partition after a lost executor) yields the same samples, and so does any
other engine. A kernel failure returns the original samples under the
variant's tag (the fallback) and says so in ``augment_status``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dsp, vocab
from ..functions.batches import slices, small_batches
from ..session import ship_package

AUG_TYPE = T.StructType([
    T.StructField("samples", T.ArrayType(T.FloatType(), False)),
    T.StructField("status", T.StringType()),
])


def noise_sql(key: str, n: str) -> str:
    """SQL text of an array of ``n`` independent standard normal values. The
    MD5 of ``key`` and a counter gives four 32-bit numbers, two pairs (u, v);
    a pair gives r cos t and r sin t with r = sqrt(-2 ln((u + 1) / 2^32)) and
    t = 2 pi v / 2^32 (Box-Muller)."""
    word = "CAST(conv(substr(h, {at}, 8), 16, 10) AS DOUBLE)"
    pair = (f"named_struct('r', sqrt(-2 * ln(({word.format(at='at')} + 1) / 4294967296D)), "
            f"'t', 2 * pi() * {word.format(at='at + 8')} / 4294967296D)")
    pairs = (f"flatten(flatten(transform(sequence(0L, ({n} - 1) div 4), b -> "
             f"transform(array(md5(concat({key}, '|', b))), h -> transform(array(1, 17), at -> {pair})))))")
    return f"slice(flatten(transform({pairs}, p -> array(p.r * cos(p.t), p.r * sin(p.t)))), 1, {n})"


def _one(x, tag: str):
    x = np.asarray(x if x is not None else [], dtype=np.float64)
    try:
        if tag == "original":
            return x.astype(np.float32), "ok"
        if not len(x):
            raise ValueError("no samples")  # undecoded: kept as it is under the tag
        if tag == "white_noise":
            y = x  # the noise is added outside, by built-in functions
        elif tag == "pitch_shift":
            y = dsp.pitch_shift(x, vocab.PITCH_STEPS, vocab.N_FFT, vocab.HOP)
        elif tag == "time_stretch":
            y = dsp.time_stretch(x, vocab.STRETCH_RATE, vocab.N_FFT, vocab.HOP)
        else:
            raise ValueError(f"unknown augmentation {tag}")
        return y.astype(np.float32), "ok"
    except Exception:  # noqa: BLE001 - fallback is part of the contract
        return x.astype(np.float32), "fallback"


@F.pandas_udf(AUG_TYPE)
def augment_udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for samples, tag in slices(*batch):
            out = [_one(x, t) for x, t in zip(samples, tag)]
            yield pd.DataFrame({"samples": [o[0] for o in out], "status": [o[1] for o in out]})


def augment(fanned: DataFrame, key: str, samples: str = "samples", quantize: bool = True) -> DataFrame:
    """fanned(key, augmentation, samples, ...) -> same rows, samples replaced
    for variants, plus ``augment_status``. Every row stays: a clip without
    samples keeps its tag and says ``fallback``. One pass over the audio.

    ``quantize`` puts the variants on the 16-bit grid that re-encoded PCM
    holds (G6); the original is as it was decoded."""
    ship_package(fanned.sparkSession)
    small_batches(fanned.sparkSession)
    a = "_augmented"
    out = fanned.withColumn(a, augment_udf(F.col(samples), F.col("augmentation")))
    noise = noise_sql(f"concat(CAST(`{key}` AS STRING), '|', augmentation)", f"size({a}.samples)")
    noisy = F.expr(f"zip_with({a}.samples, {noise}, (x, e) -> CAST(x + {vocab.NOISE_FACTOR}D * e AS FLOAT))")
    new = F.when((F.col("augmentation") == "white_noise") & (F.col(f"{a}.status") == "ok"), noisy).otherwise(F.col(f"{a}.samples"))
    if quantize:
        grid = F.transform(new, lambda v: (F.rint(F.greatest(F.least(v, F.lit(1.0)), F.lit(-1.0)) * 32767) / 32768).cast("float"))
        new = F.when(F.col("augmentation") == "original", new).otherwise(grid)
    # A generator of one row: filters and sizes taken of the new samples stay
    # above it, instead of computing the samples again below.
    made = F.struct(new.alias(samples), F.col(f"{a}.status").alias("augment_status"))
    return out.select(*[c for c in fanned.columns if c not in (samples, "augment_status")], F.inline(F.array(made)))
