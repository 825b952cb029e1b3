"""Histories that arrive as a stream: features of the customers each micro-batch touches."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import Prep
from ..plans.scoring import scoring_features
from ..sources.raw import ingest
from ..sources.shared import remove


SHARDS = 256  # folders of a batch's history, by a hash of the id
FAN = 32  # folders of a level that are merged into one of the next


def covering(number: int) -> Iterator[tuple[int, int]]:
    """(level, first batch) of the folders that hold the batches before ``number``; one of a level holds FAN ** level batches."""
    level = 0
    while FAN ** (level + 1) <= number:
        level += 1
    start = 0
    while start < number:
        while start + FAN**level > number:
            level -= 1
        yield level, start
        start += FAN**level


def merges(number: int) -> Iterator[tuple[int, int]]:
    """(level, first batch) of the folders that can be written once the batches before ``number`` are there, lower levels first."""
    level = 1
    while number and number % FAN**level == 0:
        yield level, number - FAN**level
        level += 1


def refresh_features(arriving: DataFrame, history_path: str, grid: DataFrame, cfg: Prep, out_path: str, checkpoint: str) -> StreamingQuery:
    """Appends each micro-batch to the history and writes new feature rows of the customers in it.

    A batch's folder is named by its number and overwritten on a rerun, so a batch that is
    repeated after a failure neither doubles the history nor the output.  The history lies
    in SHARDS folders by a hash of the id; of it, a batch reads those its customers are in.
    Finished batches are merged by FAN at a time, level by level, so the folders to read grow with the
    logarithm of the batches and a row is rewritten as often.  What has been merged is
    deleted one merge of its level later, when no rerun can need it.
    """
    shard = F.pmod(F.xxhash64(cfg.columns.id), F.lit(SHARDS))

    def folder(level: int, start: int) -> str:
        return f"{history_path}/level={level}/from={start}"

    def parts(level: int, start: int) -> list[str]:
        return [folder(level - 1, start + i * FAN ** (level - 1)) for i in range(FAN)]

    def write(rows: DataFrame, path: str) -> None:
        rows.repartition("_shard").write.mode("overwrite").partitionBy("_shard").parquet(path)

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        rows = rows.withColumn("_shard", shard)
        places = [T.StructField(c, T.LongType()) for c in ("level", "from", "_shard")]
        schema = T.StructType([*rows.drop("_shard").schema, *places])

        def read(paths: list[str]) -> DataFrame:
            return spark.read.schema(schema).option("basePath", history_path).parquet(*paths).drop("level", "from")

        for level, start in merges(number):
            write(read(parts(level, start)), folder(level, start))
            for old in parts(level, start - FAN**level) if start else ():
                remove(spark, old)
        write(rows, folder(0, number))
        touched = rows.select("_shard", cfg.columns.id).distinct()
        shards = [r[0] for r in touched.select("_shard").distinct().collect()]
        history = read([folder(*x) for x in (*covering(number), (0, number))]).where(F.col("_shard").isin(shards))
        own = history.join(touched.select(cfg.columns.id), cfg.columns.id, "left_semi").drop("_shard")
        scoring_features(ingest(own, cfg), grid, cfg).write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    return arriving.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
