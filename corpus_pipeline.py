"""The corpus pipeline: quality rules, SimHash near-dedup, substring dedup, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from opsledger.llm import chaining, packing, quality, simhash
from opsledger.llm.common import apart, dropped, shared_dir, table

ORACLE_SQL = None  # hashed n-grams, fingerprints, chains and bitsets have no SQL form


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, null, empty and wordless texts among them.

    Rows are judged one by one, so rows that repeat an id or a text share its verdict. All columns
    are kept, whatever their names; an empty table gives an empty result.
    """
    back, held = apart(docs, ["doc_id", "text"], [])
    return quality.judged(held, table(spark, sf_dir, "labels")).where("quality_rules.kept").select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Wordless texts are one group. Of rows that repeat the id, the first as stored stays; a row
    without an id stays only where its group has none with one. All columns are kept; an empty
    table gives an empty result.
    """
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go; what is left of a document stays.

    Null and empty texts stay as they are; a document of which no word is left goes. Rows that
    repeat an id or have none count as documents of their own, by their places. All columns are
    kept, n_chars brought up to date; an empty table gives an empty result.
    """
    return chaining.without_passages(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document in a sequence.

    A null or empty text is its end id alone. Rows that repeat an id, or have none, are packed as
    any other; columns besides id and text play no part; an empty table gives an empty result.
    """
    import public_tokenizers

    return packing.packed(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("substring dedup", substring_dedup), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what a stage read goes once it is written."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            dropped(spark, [f"{folder}/{k - 1}"])
    return docs
