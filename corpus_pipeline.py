"""Corpus pipeline: language ID, line dedup, near-duplicate removal, packing.

Each stage takes all rows its predecessor kept and calls one operator of
``stockcast.llm``. ``run`` writes every stage's result as Parquet under the
shared folder named by spark.checkpoint.dir and reads it again, so a lost
executor costs at most the running stage. All stages but the last return the
columns of ``documents``.

1. language_id: trained on the stage's own labelled rows; rows without a
   letter or with a language score under ``MIN_SCORE`` are rejected. Where no
   row can be learned from, every row with a letter stays.
2. line_dedup: later documents lose the blocks of lines they share with an
   earlier one; a document that loses all its text goes.
3. simhash: shingles of 3 words, 2 differing bits at most; the document with
   the smallest doc_id of each group stays.
4. packing: sequences of at most 1024 tokens; one row per piece.

Null and empty texts have no letter and go in the first stage; rows without a
doc_id pass the line stage unchanged, count as the largest id of their group in
the third one and are packed; rows that repeat a doc_id and text are copies of
each other; texts of any length are read whole; an empty table gives no rows.
Columns beyond those of ``documents`` are carried through to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.llm import langid, linededup, packing, simhash
from stockcast.llm.common import shared_dir, table
from stockcast.llm.queries import tokenizer_file

MIN_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.model_of(docs), MIN_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = linededup.without_repeats(docs)
    if "n_chars" in kept.columns:  # it describes the text, which may be shorter now
        kept = kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, 3, 2)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), 1024, 2)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash", near_dedup), ("packing", pack)]

#: No stage but the last two's bookkeeping can be said in SQL (a trained network, an alignment, XXH64, a tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the packed pieces."""
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
