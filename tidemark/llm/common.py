"""What the operators share: table access, shared-folder tables, word splitting, hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import shared
from ..sources.shared import discard, stored, sweep

__all__ = ["Memo", "SPACE", "WORD", "crc_fold", "discard", "mix64", "ship", "stored", "sweep", "table", "text_or_empty", "words_col"]

#: The white space that separates words, as a character class body: U+0020 and U+0009..U+000D.
SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers.

    Every operator with Python in its tasks calls it.  They see texts in Arrow batches; a
    batch of 10,000 very long texts would not fit a worker, so the session's
    spark.sql.execution.arrow.maxRecordsPerBatch is lowered to 1,000 where it has its default.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    shared.ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(id_col: str, folds: int = 5):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(folds)


def text_or_empty(col: str):
    return F.coalesce(F.col(col), F.lit(""))


def words_col(text: Column) -> Column:
    """The words of a text column: runs of other characters than the six of white space."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), element by element."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Memo(dict):
    """A dict that computes missing values and empties itself at ``limit`` entries, so memory stays bounded."""

    def __init__(self, fn, limit: int):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.fn(key)
        return value
