"""A training-data pipeline: quality, line dedup, near duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet and hands the written table to the next.  All but the last return the columns
of documents.  No stage can be put as SQL in full, so ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm import piece_codec
from sluice.llm.cotrain import classify
from sluice.llm.decontam import cut_spans, find_contamination
from sluice.llm.jaccard import jaccard_components
from sluice.llm.line_dedup import dedup_lines
from sluice.llm.queries import tokenizer_path
from sluice.llm.work import Work

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def _sized(df: DataFrame) -> DataFrame:
    """The columns of documents, n_chars of the text as it is now."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    gone = classify(docs, labels).filter("not keep").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone"]), "left_anti").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines leave; a document that this empties leaves with them."""
    out = dedup_lines(docs.select(*COLUMNS), "doc_id", "text", bands=2)
    return _sized(out.filter("n_removed = 0 or trim(text) <> ''"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each component of five-word shingles at 0.8."""
    groups, _ = jaccard_components(docs, "doc_id", "text", width=5, percent=80)
    first = groups.filter("id is null or component_id = id").select(F.col("id").alias("first")).distinct()
    return docs.join(first, docs["doc_id"].eqNullSafe(first["first"]), "left_semi").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; wordless remains leave."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = cut_spans(find_contamination(docs.select(*COLUMNS), "text", bench, "item_id", "text"), "text")
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return _sized(found.filter((n_hit == 0) | (n_hit < F.col("n_words"))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' piece ids and their number."""
    out = piece_codec.encode(docs.select("doc_id", "text"), "text", tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids")


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontaminate), ("encoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
