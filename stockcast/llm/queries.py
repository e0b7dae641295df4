"""The opN_ queries over the testdata tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockcast.llm import balltree, bpe, chat, langid, lexical, linededup, lsh, packing, piece, resample, simhash, tokencount, warc
from stockcast.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), 1024, 2)


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.identify(documents, langid.model_of(documents))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), 3, 2)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op7(spark, table(spark, sf_dir, "conversations"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048)


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark), 0))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                             longest=1, buckets=10_000, seed=2024, least_words=20, percent=10)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_exact_topk": op2_exact_topk,
    "op3_language_id": op3_language_id,
    "op4_simhash": op4_simhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_token_counts": op8_token_counts,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_warc": op10_warc,
    "op11_ranked_search": op11_ranked_search,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE: dict[str, str] = {
    "op2_exact_topk": balltree.OP2_SQL,
    "op7_chat_formatting": chat.OP7_SQL,
    "op10_warc": warc.OP10_SQL,
    "op11_ranked_search": lexical.OP11_SQL,
    "op12_importance_resampling": resample.OP12_SQL,
}
