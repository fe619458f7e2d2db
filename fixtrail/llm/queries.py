"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtrail.llm.chunk_dedup import dedup_passages
from fixtrail.llm.html_trees import extract_text
from fixtrail.llm.jaccard_join import similar_groups
from fixtrail.llm.jacobi_davidson import whiten
from fixtrail.llm.lattice_lm import score_documents
from fixtrail.llm.line_crf import fit_line_field, judge_documents
from fixtrail.llm.mixing import mix
from fixtrail.llm.packing import pack_documents
from fixtrail.llm.permutation_index import search
from fixtrail.llm.string_kernel import label_languages
from fixtrail.llm.table_kmeans import cluster_vectors
from fixtrail.llm.toxicity import score_toxicity
from fixtrail.llm.warc import read_archives, write_archives

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document a mix by source weights takes."""
    return mix(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    manifest = write_archives(_table(spark, folder, "pages"))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return read_archives(manifest, with_payload=False).select(*columns)


def op3_line_field_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = _table(spark, folder, "documents")
    field = fit_line_field(docs, _table(spark, folder, "labels"))
    return judge_documents(docs, field)


def op4_jaccard_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that are linked by shared four-word shingles."""
    return similar_groups(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_html_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    texts = extract_text(_table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op6_pack_sum_of_squares(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    return pack_documents(_table(spark, folder, "documents"), with_ids=False)


def op7_permutation_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20."""
    table = _table(spark, folder, "embeddings")
    return search(table, table.where(F.col("vec_id") % 20 == 0).select("vec_id"))


def op8_string_kernel_languages(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    return label_languages(_table(spark, folder, "documents"))


def op9_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text without passages of over 50 words that an earlier document has, and what was cut."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    words = F.aggregate("removed", F.lit(0).cast("long"), lambda total, x: total + x["words"])
    return dedup_passages(docs).select("doc_id", "text", words.alias("removed_words"), "removed")


def op10_lattice_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document."""
    return score_documents(_table(spark, folder, "documents"))


def op11_table_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    """Eight clusters of all vectors with 64 components."""
    return cluster_vectors(_table(spark, folder, "embeddings"))


def op12_jacobi_davidson_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector whitened along the 32 largest principal components."""
    return whiten(_table(spark, folder, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_boosted_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """How likely each document is toxic."""
    return score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def registered() -> dict[str, Query]:
    found = (
        op1_mix_sources,
        op2_warc_round_trip,
        op3_line_field_quality,
        op4_jaccard_groups,
        op5_html_trees,
        op6_pack_sum_of_squares,
        op7_permutation_neighbours,
        op8_string_kernel_languages,
        op9_chunk_dedup,
        op10_lattice_scores,
        op11_table_kmeans,
        op12_jacobi_davidson_whitening,
        op13_boosted_toxicity,
    )
    return {f.__name__: f for f in found}
