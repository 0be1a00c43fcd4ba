"""Encoding of a whole corpus with a public tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.pieces import TOKENIZERS, coded_blocks, distinct_words, encoded_words, ids_by_position, ranks


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``key, ids``: token ids of every text, without special tokens.

    One row for each input row. Null and empty texts have an empty list; strings that look like
    special tokens are ordinary text; repeated rows are encoded alike. Other columns are ignored, so
    their names can't clash.
    """
    documents, dictionary = coded_blocks(df, [key], text)
    words = encoded_words(distinct_words(dictionary), tokenizer, folder)
    return ids_by_position(documents, dictionary, words, [key])


def vocabulary(spark: SparkSession, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``id, piece``: one row for each entry of the vocabulary (a fixed number, about 50,000)."""
    return spark.createDataFrame([(i, piece.hex()) for piece, i in ranks(tokenizer, folder).items()], "id int, piece string")


def decode_corpus(encoded: DataFrame, key: str = "doc_id", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``key, text``: texts put together again through a join of ids with the vocabulary's pieces.

    ``key`` must be unique. The vocabulary has a fixed number of rows, which bounds the broadcast. An
    empty or null list gives an empty text.
    """
    pieces = F.broadcast(vocabulary(encoded.sparkSession, tokenizer, folder))
    placed = encoded.select(key, F.posexplode_outer("ids").alias("_at", "id")).join(pieces, "id", "left")
    spelled = placed.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_at", "piece"))).alias("_pieces"))
    joined = F.array_join(F.transform("_pieces", lambda p: p["piece"]), "")
    return spelled.select(key, F.decode(F.unhex(joined), "UTF-8").alias("text"))
