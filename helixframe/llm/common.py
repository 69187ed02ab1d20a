"""Helpers shared by the operators on texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.plans.session import cut_lineage

#: A word: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a table is broadcast; the tables in question have rows of at most 100 bytes.
BROADCAST_ROWS = 100_000
#: Row identity: two 64-bit hashes of id and text. Rows equal in both are interchangeable.
ROW_KEY = ["row_a", "row_b"]

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder, so that nothing is computed twice or lost."""
    return cut_lineage(df)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster; where it names none, as in tests, a local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        checkpointed(spark.range(0))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Ask for a broadcast of a materialised table if it has at most so many narrow rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def filled(name: str) -> Column:
    """A text column where null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def with_row_key(docs: DataFrame, *columns: str) -> DataFrame:
    """The row key and the named columns of ``docs``, null texts being empty."""
    text = filled("text")
    return docs.select(
        F.xxhash64("doc_id", text).alias("row_a"),
        F.xxhash64(text, "doc_id").alias("row_b"),
        *(text.alias("text") if name == "text" else F.col(name) for name in columns),
    )


def _power(kind: str, size: int) -> np.ndarray:
    """Powers of the multiplier (up) or its inverse (down), at least ``size`` of them."""
    if len(_powers[kind]) < size:
        steps = np.full(max(size, 1 << 16), _MULTIPLIER if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:size]


def prefix_hashes(data: np.ndarray, codes: np.ndarray = _BYTE_CODES) -> np.ndarray:
    """Running polynomial hash of the bytes, from which ``span_hashes`` reads any span's hash."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * _power("up", len(data)), out=sums[1:], dtype=np.uint64)
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans ``[start, end)``; equal bytes have equal hashes."""
    down = _power("down", len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    values = values ^ (values >> np.uint64(31))
    values *= np.uint64(0x7FB5D329728EA185)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x81DADEF4BC2DD44D)
    values ^= values >> np.uint64(33)
    return values


def byte_array(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
