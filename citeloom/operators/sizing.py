"""Joins against a dictionary whose size is checked before it is broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NULL_SPREAD = 256


@dataclass(frozen=True)
class BroadcastLimit:
    """Most a table may measure to be broadcast.

    A broadcast table is built by the driver and held whole by every executor.
    Beyond the limit the join shuffles and adaptive execution splits skewed
    partitions.
    """

    rows: int = 1_000_000
    text_bytes: int = 64 * 1024 * 1024

    def fits(self, rows: int | None, text_bytes: int | None) -> bool:
        return (rows or 0) <= self.rows and (text_bytes or 0) <= self.text_bytes

    def apply(self, table: DataFrame, rows: int | None, text_bytes: int | None) -> DataFrame:
        """Mark a table of the given measured size for broadcast, if it fits."""
        return F.broadcast(table) if self.fits(rows, text_bytes) else table


DEFAULT_LIMIT = BroadcastLimit()


def measured(table: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """The table, marked for broadcast if it fits."""
    width = F.lit(16)
    for name in table.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    size = table.agg(F.count("*").alias("n"), F.sum(width).alias("b")).first()
    return limit.apply(table, size["n"], size["b"])


def left_lookup(
    df: DataFrame,
    key: str,
    table: DataFrame,
    table_key: str,
    limit: BroadcastLimit | None = DEFAULT_LIMIT,
) -> DataFrame:
    """Left equi-join of ``df[key]`` to a table with one row per key.

    The table's other columns are added. With a limit the table is measured and
    broadcast if it fits; give None for a table that is dear to compute, where
    measuring would compute it twice and adaptive execution should choose.

    Rows without a key match nothing. They are spread over the shuffle by a
    second key, so that a large share of null keys does not end in one task.
    """
    values = [c for c in table.columns if c != table_key]
    lookup = table.select(F.col(table_key).alias("_key"), *values)
    checked = lookup if limit is None else measured(lookup, limit)
    if checked is not lookup:
        return df.join(checked, F.col(key) == F.col("_key"), "left").drop("_key")
    plain = [c for c, t in df.dtypes if "map<" not in t]
    spread = F.when(
        F.col(key).isNull(), F.pmod(F.xxhash64(*plain), F.lit(_NULL_SPREAD))
    ).otherwise(F.lit(0))
    return (
        df.withColumn("_spread", spread)
        .join(
            lookup.withColumn("_zero", F.lit(0).cast("bigint")),
            (F.col(key) == F.col("_key")) & (F.col("_spread") == F.col("_zero")),
            "left",
        )
        .drop("_key", "_zero", "_spread")
    )
