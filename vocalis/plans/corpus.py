"""The corpus build as one Spark job graph: audio folder -> feature tables.

Same stages as the reference's batch notebook, expressed as DataFrame
operators: scan WAV files, label from paths, split by md5 of the path, write
the split manifests, fan the training clips out into four versions, augment,
compute the 185-value vectors, and store one feature table partitioned by
(split, augmentation). Labelling and splitting read only file metadata;
audio is decoded once into a stored clip table that every later stage reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import augment as AU
from ..operators import fanout as FO
from ..operators import features as FT
from ..operators import labels as LB
from ..operators import split as SP
from ..session import shared_dir, ship_package
from ..sources import audio, sinks


#: Every recording above LONG_CLIP_SAMPLES has more bytes than this, at a byte
#: a sample and 8,000 samples a second: those files are looked at one by one.
LONG_FILE_BYTES = FT.LONG_CLIP_SAMPLES // vocab.SAMPLE_RATE * 8_000


def build_corpus(spark: SparkSession, root: str, out: str, glob: str = "*.wav", store_audio: bool = False,
                 long_file_bytes: int = LONG_FILE_BYTES, long_clip_samples: int = FT.LONG_CLIP_SAMPLES) -> DataFrame:
    """Build ``out/features`` (and ``out/manifest``) from the audio under
    ``root``; returns the stored feature table.

    Columns: path, label, dataset, split, augmentation, augment_status,
    status, features array<float>[185]. Its rows are the sum of all clips'
    versions, failed clips included. Files above ``long_file_bytes``, told by
    their metadata, go to a stored table first, from which the features of
    versions above ``long_clip_samples`` are computed chunk by chunk in many
    tasks; the others never leave their scan's task. ``store_audio`` writes the
    samples of all versions (``out/augmented``) and treats all files so."""
    ship_package(spark)
    meta = audio.scan_audio(spark, root, glob).select("path", "length", "modificationTime")
    labelled = SP.with_split(LB.label_from_path(meta), "path")                 # metadata only
    sinks.write_manifest(labelled, f"{out}/manifest")
    # decode once: the content column is read here and nowhere else. Labels
    # and split are functions of the path, so the content rows are labelled
    # in place (broadcast 29-row lookup) and never shuffled.
    raw = audio.scan_audio(spark, root, glob).select("path", "length", "content")
    carry = ["path", "label", "dataset", "split", "augmentation", "augment_status"]

    def versions(files: DataFrame) -> DataFrame:
        # Every clip stays: one that can't be decoded keeps its tags, a status
        # and the zero vector.
        clips = audio.decode(SP.with_split(LB.label_from_path(files), "path"))
        return AU.augment(FO.fan_out(clips.select("path", "label", "dataset", "split", "samples", "decode_status")), "path")

    def features(of: DataFrame, long_samples: int | None) -> DataFrame:
        of = of.withColumn("vid", F.concat_ws("|", "path", "augmentation"))
        return FT.extract_features(FT.with_status(of), key="vid", carry=carry, long_clip_samples=long_samples).drop("vid")

    def with_length(of: DataFrame) -> DataFrame:
        # Stored beside the audio, which the search for long ones then leaves.
        return of.withColumn("n_samples", F.size("samples").cast("long"))

    if store_audio:
        sinks.write_partitioned(with_length(versions(raw)), f"{out}/augmented", "split", "augmentation")
        table = features(spark.read.parquet(f"{out}/augmented"), long_clip_samples)
    else:
        is_long = F.col("length") > long_file_bytes
        # Decode, fan-out, augmentation and features are one narrow stage;
        # only the features are stored.
        table = features(versions(raw.filter(~is_long)), None)
        if not labelled.filter(is_long).isEmpty():
            stored = sinks.materialize(with_length(versions(raw.filter(is_long))), shared_dir(spark, "long-" + uuid.uuid4().hex))
            table = table.unionByName(features(stored, long_clip_samples))
    sinks.write_partitioned(table, f"{out}/features", "split", "augmentation")
    return spark.read.parquet(f"{out}/features")
