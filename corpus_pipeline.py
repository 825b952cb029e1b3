"""The training-data pipeline: language ID, near-dedup, substring dedup, PII, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on
all its predecessor kept.  ``run`` writes every stage to the shared folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import crc_fold, ship, stored, table
from tidemark.llm.language_id import keep_identified
from tidemark.llm.near_dedup import drop_near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.personal_data import redact
from tidemark.llm.substring_dedup import cut_repeats

BATCH_ROWS = "250"  # documents that a Python worker sees at once: stages follow each other in workers that keep what they once took


def prepare(spark: SparkSession) -> None:
    """Ships the package and lowers the session's Arrow batches from where ``ship`` leaves them; a setting of one's own stays."""
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found, with that language as ``lang``; texts without a letter go.

    Null and empty texts go with them; repeated rows and null ids are judged row by row, by
    their texts alone; further columns stay.  An empty table, or one without any known language to learn
    from, gives an empty one.
    """
    prepare(spark)
    return keep_identified(docs, crc_fold("doc_id") != 0)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates.

    Documents with a null id or without words stay; rows that share the id of a document
    that stays do so too.  An empty table gives an empty one; further columns stay.
    """
    prepare(spark)
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that a document with a smaller id has.

    A document of which no word is left goes; one that had none, null texts among them,
    stays as it is, and so do documents with a null id, which repeat nothing.  Rows that share an id
    repeat nothing of each other.  Further columns stay; an empty table gives an empty one.
    """
    prepare(spark)
    return cut_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; null texts stay null, repeated rows and null ids are masked row by row.

    An empty table gives an empty one; all columns stay, and n_chars is counted anew.
    """
    prepare(spark)
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's length bucket, batch and place in it, by its number of words.

    Null texts count as length 0; repeated rows and null ids are packed each; an empty
    table gives an empty result.
    """
    prepare(spark)
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: A trained classifier and an alignment search are beyond SQL; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
