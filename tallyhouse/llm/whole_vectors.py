"""Vectors of whole numbers: the input of vector codes and hard negatives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Whole components are held between the negative and the positive of this.
MOST = 1 << 62


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) as 64-bit integers, held within MOST."""
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(values * float(scale))
    return np.clip(np.where(np.isnan(whole), 0.0, whole), -float(MOST), float(MOST)).astype("<i8")


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, vector) of the rows whose vector is neither null nor
    holds a null, NaN or infinite component. A vector is packed as
    little-endian 64-bit integers; the label is text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b["vector"]
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False)  # nulls become NaN
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            kept = pa.array((odd[offsets[1:]] == odd[offsets[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False))
            packed = pa.Array.from_buffers(pa.large_binary(), len(lists), [
                None, pa.py_buffer(offsets * 8), pa.py_buffer(scaled(values, scale).tobytes())])
            yield pa.RecordBatch.from_arrays([b["vec_id"].filter(kept), b["label"].filter(kept),
                                              packed.cast(pa.binary()).filter(kept)], names=["vec_id", "label", "vector"])

    source = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                            F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    return source.mapInArrow(run, "vec_id long, label string, vector binary")


def matrix(packed: list[bytes], width: int) -> np.ndarray:
    """Packed vectors as rows; shorter ones end in zeros."""
    if packed and all(len(x) == 8 * width for x in packed):
        return np.frombuffer(b"".join(packed), "<i8").reshape(len(packed), width)
    out = np.zeros((len(packed), width), np.int64)
    for i, x in enumerate(packed):
        out[i, :len(x) // 8] = np.frombuffer(x, "<i8")
    return out
