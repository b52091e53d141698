"""Helpers shared by the operators: word rule, Arrow views, worker path."""

from __future__ import annotations

import ctypes
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# fixed value: a word is a run of anything but space and the characters 9 to 13
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = b" \t\n\x0b\x0c\r"
M64 = (1 << 64) - 1


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session import this package.

    On a cluster the package is shipped with ``--py-files``; the extra path
    entry does nothing there.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH", "")]))
    return spark


def whole_text(name: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A second key beside the id, so that rows that share an id but not a
    text stay apart. Rows equal in both may be treated as one."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array and their len + 1 offsets; null: empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat, at


def slices(column: pa.Array):
    """Each text as bytes; null: empty."""
    flat, at = utf8(column)
    view = memoryview(flat)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield bytes(view[a:b])


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def tidy() -> None:
    """Give memory that earlier work of a reused worker left unused back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner"
                ) -> DataFrame:
    """Equi-join on keys of which null equals null; a hot key of ``left`` can
    be split by the skew rule, because neither side keeps an older layout."""
    from rosterlake.operators.joins import join_group_stats
    return join_group_stats(left, right, keys, how)
