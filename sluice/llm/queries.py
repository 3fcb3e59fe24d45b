"""The registered training-data queries: each runs its operator over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import piece_codec
from .align import align_texts
from .ann import nearest
from .cotrain import classify
from .decontam import find_contamination
from .html_wrap import extract_pages
from .jaccard import jaccard_components
from .line_dedup import dedup_lines
from .pyp_lm import score_texts
from .shards import shard_rows
from .suffix_dedup import remove_repeats
from .token_count import count_tokens
from .trie import build_trie, ends_digest, share_openings, turn_paths


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; the package is installed on every node."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_docs(spark, sf_dir), "doc_id", "text", tokenizer_path("byte_bpe_50k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = jaccard_components(_docs(spark, sf_dir), "doc_id", "text", width=3, percent=90)
    return out.withColumnRenamed("id", "doc_id")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding them gives the text back."""
    path = tokenizer_path("piece_bpe_32k.model")
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    both = piece_codec.decode(piece_codec.encode(docs, "text", path), "piece_ids", path)
    return both.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids",
                       (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_docs(spark, sf_dir).select("doc_id", "text"), "doc_id", "text").select(
        "doc_id", "n_lines", "n_removed", "text")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = _docs(spark, sf_dir).select(
        "doc_id", (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"))
    return shard_rows(docs, shards=16, seed=7).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(_docs(spark, sf_dir).select("doc_id", "text"), "text", bench,
                               "item_id", "text", window=10)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    ids = F.array_sort(F.transform("hit_items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"),
                        F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_docs(spark, sf_dir), "doc_id", "text")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return ends_digest(*build_trie(share_openings(turn_paths(turns, near=5), near=5, most=9))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_texts(_docs(spark, sf_dir), "doc_id", "text", tokenizer_path("byte_bpe_50k.json"),
                       tokenizer_path("piece_bpe_32k.model"))[0]


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_docs(spark, sf_dir), "doc_id", "text").select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_html_wrapper, op2_token_counts, op3_quality, op4_ngram_jaccard, op5_sentencepiece, op6_line_dedup,
    op7_sharding, op8_nearest, op9_decontamination, op10_pitman_yor, op11_conversation_trie,
    op12_token_alignment, op13_suffix_dedup)}
ORACLE: dict[str, str] = {}
