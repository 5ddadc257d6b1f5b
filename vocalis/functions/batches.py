"""Bounded memory for kernels over audio columns.

Spark hands a pandas UDF up to 10,000 rows or 64 MB at once and takes as many
back, which for clips is hundreds of MB in each Python worker and again in the
JVM's Arrow buffers. The audio kernels are iterator UDFs instead: batches come
in small (:func:`small_batches`), and results leave slice by slice
(:func:`slices`), so memory depends on neither the table's nor the batch's rows.

Kernels that return long arrays are Arrow UDFs: for a pandas UDF Spark makes a
Python object of each value of an array, which took longer than the kernels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of one Arrow batch on its way to Python; a longer row goes alone.
BATCH_BYTES = 4_000_000
#: Rows, and bytes of input, between two outputs of a kernel.
ROWS, BYTES = 128, 2_000_000


def small_batches(spark: SparkSession) -> None:
    """Limit this session's Arrow batches to BATCH_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def _size(x) -> int:
    return x.nbytes if isinstance(x, np.ndarray) else len(x) if isinstance(x, (bytes, bytearray, list)) else 0


def slices(*columns: pd.Series) -> Iterator[tuple[pd.Series, ...]]:
    """The columns of one batch in slices of at most ROWS rows and, above one
    row, about BYTES bytes of the first column."""
    start = held = 0
    for i, x in enumerate(columns[0]):
        n = _size(x)
        if i > start and (i - start >= ROWS or held + n > BYTES):
            yield tuple(c.iloc[start:i] for c in columns)
            start, held = i, 0
        held += n
    if start < len(columns[0]):
        yield tuple(c.iloc[start:] for c in columns)


def as_series(column: pa.Array | pd.Series) -> pd.Series:
    """An Arrow column's values as a series; arrays of numbers are not copied."""
    return column.to_pandas() if isinstance(column, pa.Array) else column


def _floats(values: list) -> pa.Array:
    """None and NaN are null, as from pandas."""
    return pa.array(np.array([np.nan if x is None else x for x in values], dtype=np.float64), from_pandas=True)


def _lists(values: list, kind: pa.ListType) -> pa.Array:
    """Arrays of numbers end to end; None is null."""
    ends = np.cumsum([0] + [0 if x is None else len(x) for x in values], dtype=np.int32)
    flat = np.concatenate([[], *(x for x in values if x is not None)], dtype=kind.value_type.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), type=kind, mask=pa.array([x is None for x in values], pa.bool_()))


def struct_array(columns: dict[str, list], schema: T.StructType) -> pa.StructArray:
    """Rows of an Arrow UDF from one list for each field of ``schema``."""
    fields = list(to_arrow_type(schema))
    return pa.StructArray.from_arrays(
        [_lists(columns[f.name], f.type) if pa.types.is_list(f.type) else _floats(columns[f.name]) if pa.types.is_floating(f.type)
         else pa.array(columns[f.name], f.type) for f in fields], fields=fields)
