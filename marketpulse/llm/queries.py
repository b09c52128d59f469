"""One checked query per operator, over the whole given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketpulse.llm.chat import format_chats
from marketpulse.llm.common import sha256_hex, table
from marketpulse.llm.decontaminate import contamination
from marketpulse.llm.nearest import nearest_neighbours
from marketpulse.llm.oracle import BYTES, CHATS, CONTAMINATION, SUBSTRINGS, VECTOR_CODES
from marketpulse.llm.pieces import default_model, encode_column, read_pieces
from marketpulse.llm.pii import personal_data
from marketpulse.llm.quality import quality
from marketpulse.llm.relative_lz import remove_repeats
from marketpulse.llm.repair import repair_damaged
from marketpulse.llm.run_index import remove_repeated_bytes
from marketpulse.llm.sharding import shard_rows
from marketpulse.llm.simhash import near_duplicates
from marketpulse.llm.toxicity import toxicity
from marketpulse.llm.vector_codes import vector_codes


def op1_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", sha256_hex(F.col("kept")).alias("kept_sha256"))


def op3_sentencepiece(spark, sf_dir):
    return encode_column(table(spark, sf_dir, "documents"), read_pieces(default_model()))


def op4_pii(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_array_dedup(spark, sf_dir):
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        sha256_hex(F.col("kept")).alias("kept_sha256"))


def op7_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_chat_formatting(spark, sf_dir):
    return format_chats(table(spark, sf_dir, "conversations"))


def op9_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sharding(spark, sf_dir):
    return shard_rows(table(spark, sf_dir, "documents"))


def op11_nearest_neighbours(spark, sf_dir):
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark, sf_dir):
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark, sf_dir):
    return repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_pii": op4_pii,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_toxicity": op9_toxicity,
    "op10_sharding": op10_sharding,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_repair": op13_conversation_repair,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op2_substring_dedup": SUBSTRINGS,
    "op6_suffix_array_dedup": BYTES,
    "op7_decontamination": CONTAMINATION,
    "op8_chat_formatting": CHATS,
    "op12_vector_codes": VECTOR_CODES,
}
