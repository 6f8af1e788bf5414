"""Contiguous shards of nearly equal bytes from global prefix sums.

The rows are range-partitioned by document id. One total per partition gives every
partition's offset, a running sum inside the partition does the rest, and the shard is the
equal target that a document's first byte falls under. Texts are read once and never move: only ids,
sizes and checksums do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callmill.llm.common import saved, text_of

ORDER = ("doc_id", "text_crc32", "size")


def measured(docs: DataFrame) -> DataFrame:
    text = F.encode(text_of(), "UTF-8")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def shard_by_bytes(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Shard and place of every document: doc_id, size, text_crc32, shard, slot, start_byte.

    Shards are contiguous in doc_id; the largest and smallest differ by less than twice the largest document.
    Null texts count as empty (size 1, checksum 0). Null ids sort first. Repeated rows and repeated ids
    are kept, each with a slot of its own, in the order of checksum and size. Texts are measured whole, whatever their
    length. An empty table gives no rows. Other columns are ignored.
    """
    # Written narrow first: choosing range bounds reads the input a second time. Its row numbers part rows that are
    # equal in all of ORDER, should one row be repeated a million times.
    narrow = saved(measured(docs).withColumn("_row", F.monotonically_increasing_id()), "sizes")
    by = (*ORDER, "_row")
    ranged = saved(narrow.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "ranges")

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, not per document.
    offsets = (
        ranged.groupBy("part")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        ranged.withColumn("_up_to", F.sum("size").over(inside))
        .withColumn("_number", F.count("*").over(inside))
        .join(offsets, "part")
        .select(
            *ORDER,
            (F.col("bytes_before") + F.col("_up_to") - F.col("size")).alias("start_byte"),
            (F.col("rows_before") + F.col("_number") - 1).alias("row"),
            "all_bytes",
        )
        .withColumn("shard", F.expr(f"CAST(start_byte * {n_shards} DIV all_bytes AS INT)"))
    )
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(firsts), "shard").select(  # n_shards rows
        *ORDER, "shard", (F.col("row") - F.col("first_row")).alias("slot"), "start_byte"
    )
