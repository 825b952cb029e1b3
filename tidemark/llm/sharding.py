"""Contiguous shards of near equal size in bytes.

Rows are dealt out by ranges of the id; the totals of the ranges, summed up, give each row
the bytes before it in the whole table, and that prefix sum is cut at equal targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import discard, stored

SHARDS = 8
RANGE_ROWS = 4_000_000  # of a range at most, by expectation; a row takes some 40 bytes there


def utf8_size(text: Column) -> Column:
    """The bytes of a text, none for null, and one that ends it."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_crc32(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null).

    Rows lie in the order of their ids, nulls first; rows of one id go by their texts'
    crc32 and size, and equal ones by their place in the input.  A shard is a stretch of
    that order: the one in which the middle of the row falls when the bytes of the whole
    table are cut into ``shards`` equal parts.  So a shard's size differs from the equal
    part by less than the two documents at its ends; a document larger than a part leaves shards
    empty.  ``slot`` counts the rows of a shard from 0.  Null texts have size 1 and the
    crc32 of the empty text.  Equal texts, repeated rows and null ids are rows like others
    and spread over ranges however many they are.  An empty table gives an empty result;
    further columns are not read, so they may have any names.
    """
    spark, text = docs.sparkSession, F.col(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), utf8_size(text).alias("size"), text_crc32(text).alias("text_crc32"))
    rows = stored(rows.withColumn("_n", F.monotonically_increasing_id()), "shard-sizes")  # texts are read once
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    order = ["_id", "text_crc32", "size", "_n"]  # _n tells all rows apart, so no range has to take in a hot id
    ranges = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    ranges = stored(ranges, "shard-ranges")  # later steps must see the same ranges
    discard(rows)
    totals = ranges.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))  # one row for each range
    earlier, whole = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1), W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    starts = totals.select(
        "_part", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"), F.sum("_bytes").over(whole).alias("_total"))
    here = W.partitionBy("_part").orderBy(*order)
    before = F.col("_bytes_before") + F.coalesce(F.sum("size").over(here.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = ranges.join(F.broadcast(starts), "_part").select(
        "_id", "size", "text_crc32", "_total", before.alias("_before"), (F.col("_rows_before") + F.row_number().over(here) - 1).alias("_rank"))
    shard = F.expr(f"(2 * _before + size) * {shards} DIV (2 * _total)").cast("int")
    placed = stored(placed.withColumn("shard", shard), "shard-places")
    discard(ranges)
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))  # one row for each shard
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_rank") - F.col("_first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
