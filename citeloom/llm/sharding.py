"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.sources.staged import new_stage_path, write_stage

LAW = "bytes"


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Assign every row to one of ``shards`` contiguous ranges of ``id_col``.

    Rows are range-partitioned by id, each partition reports its byte and row
    totals, and the prefix sums of those totals turn the running sums inside a
    partition into global offsets. A row belongs to the shard in which its
    first byte lies, so shards differ from the equal target by less than one
    row. Only (id, size, checksum) is shuffled, never a text.

    Result: id, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``law``,
    ``shard``, ``slot`` (gapless from 0 in each shard), ``grown_shard`` (null:
    this law moves rows when the number of shards changes). A null text has
    size 1 and checksum 0; null ids come first; repeated ids are ordered by
    size and checksum and may be parted by a shard border; an empty table
    gives no rows; other columns are ignored.
    """
    sized = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("text_crc32"),
    )
    order = ["id", "size", "text_crc32"]
    # Written once: a partition's number must not depend on a second sampling.
    blocks = write_stage(
        sized.repartitionByRange(*order).withColumn("block", F.spark_partition_id()),
        new_stage_path(docs.sparkSession, "shard-blocks"),
    )
    totals = blocks.groupBy("block").agg(
        F.sum("size").alias("block_bytes"), F.count("*").alias("block_rows")
    )
    # One row per partition of the sort.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "block",
        F.coalesce(F.sum("block_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("block_bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("block").orderBy(*order)
    numbered = (
        blocks.withColumns(
            {
                "first_byte": F.sum("size").over(
                    inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
                )
                - F.col("size"),
                "row": F.row_number().over(inside) - 1,
            }
        )
        .join(offsets, "block")
        .withColumns(
            {
                "shard": F.floor(
                    (F.col("bytes_before") + F.col("first_byte")).cast("decimal(38,0)")
                    * shards
                    / F.col("all_bytes").cast("decimal(20,0)")
                ).cast("int"),
                "row": F.col("rows_before") + F.col("row"),
            }
        )
    )
    # At most ``shards`` rows, hence safe to broadcast.
    starts = numbered.groupBy("shard").agg(F.min("row").alias("shard_start"))
    return numbered.join(F.broadcast(starts), "shard").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("row") - F.col("shard_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
