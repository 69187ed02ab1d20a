"""Equi-joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes up to which the small side of a join is broadcast; beyond it the join is salted.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
#: A key is hot if it holds at least 1/HOT_SHARE of the rows, so at most HOT_SHARE keys are hot.
HOT_SHARE = 1000


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row has: its texts, and everything nested as the text it makes."""
    sizes = [F.lit(16 * len(df.columns))]
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.octet_length(F.to_json(F.struct(column))))
    return reduce(lambda a, b: a + b, sizes).cast("long")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Check the size of ``df``, reading no more than ``max_rows + 1`` rows of it."""
    found = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(_row_bytes(df)).alias("bytes")).first()
    return found["n"] <= max_rows and (found["bytes"] or 0) <= BROADCAST_BYTES


def hot_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hot keys with the number of salts that splits each into parts of 1/HOT_SHARE of all rows."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * HOT_SHARE >= total).select(
        *keys, F.ceil(F.col("_n") * HOT_SHARE / total).cast("int").alias("_salts")
    )


def _salt_columns(big: DataFrame) -> list[Column]:
    """All that tells rows apart; maps have no hash, and count as their entries."""
    columns = []
    for field in big.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.MapType):
            column = F.map_entries(column)
        elif "map<" in field.dataType.simpleString():
            column = F.to_json(F.struct(column))
        columns.append(column)
    return columns


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    salt_by: Sequence[str] | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join on ``keys`` where ``big`` may be skewed; ``how`` is inner, left, left_semi or left_anti.

    A small side of a checked size is broadcast, which needs no shuffle of the big side.
    Otherwise the rows of the hot keys are salted: ``big`` gets a hashed salt, and the matching
    rows of ``small`` are repeated once per salt. ``condition`` may use the columns of both sides.
    """
    keys = list(keys)
    if fits_broadcast(small, max_rows):
        return _join(big, F.broadcast(small), keys, how, condition)

    hot = hot_keys(big, keys)
    hashed = F.xxhash64(*(salt_by or _salt_columns(big)))
    # Rows with a null key match nothing, and are spread over all salts
    no_key = F.greatest(*(F.col(key).isNull() for key in keys), F.lit(False))
    salts = F.when(no_key, F.lit(HOT_SHARE)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_big = (
        big.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.pmod(hashed, salts.cast("long")).cast("int"))
        .drop("_salts")
    )
    salted_small = (
        small.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return _join(salted_big, salted_small, [*keys, "_salt"], how, condition).drop("_salt")


def _join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, condition: Column | None
) -> DataFrame:
    if condition is None:
        return left.join(right, keys, how)

    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    match = condition
    for key in keys:
        match = match & (F.col(key) == F.col(f"_r_{key}"))
    joined = left.join(renamed, match, how)
    return joined.drop(*(f"_r_{key}" for key in keys))
