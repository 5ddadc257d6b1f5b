"""vocalis: voice-corpus analytics as Spark DataFrame operators.

Layout:
  sources/    scans and sinks (audio files, Parquet tables, manifests, model store)
  functions/  column-level building blocks (label rules, vector predicates, DSP kernels)
  operators/  DataFrame -> DataFrame operators (labels, split, profile, signal,
              spectral, augment, learn, score)
  plans/      derived views over the shared test tables and the named query registry
  streaming/  incremental scoring of arriving clips
"""

__all__ = ["session"]
