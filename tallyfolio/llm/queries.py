"""The operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfolio.llm.alignment import align, link_counts, with_scores
from tallyfolio.llm.common import scratch, written
from tallyfolio.llm.exact_dedup import exact_groups
from tallyfolio.llm.graph_index import build, search
from tallyfolio.llm.jaccard import jaccard_components
from tallyfolio.llm.language import fit, held_out, with_language
from tallyfolio.llm.lexical import ranked_search
from tallyfolio.llm.licenses import scan_licenses
from tallyfolio.llm.mixing import PRODUCTION_MIX, mix_documents
from tallyfolio.llm.packing import pack, pieces
from tallyfolio.llm.quality import quality
from tallyfolio.llm.token_files import ids_crc32, read_tokens, write_tokens
from tallyfolio.llm.warc import list_records, read_records, write_packages
from tallyfolio.llm.wrappers import main_text


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(_documents(spark, folder))


def op2_html_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(_pages(spark, folder)).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "token-files")
    write_tokens(_documents(spark, folder), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", ids_crc32(F.col("ids")).alias("ids_crc32"))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_documents(spark, folder))


def packed(docs: DataFrame) -> DataFrame:
    """Every piece of the documents with its place in the packed sequences."""
    cuts = pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return pack(written(cuts, "pack-pieces"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(_documents(spark, folder))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    net = fit(docs.select("doc_id", "text", "lang"))
    seen = with_language(docs.select("doc_id", "text"), net)
    return seen.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality(_documents(spark, folder))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(_documents(spark, folder))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_documents(_documents(spark, folder), PRODUCTION_MIX)


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = read_records(list_records(write_packages(_pages(spark, folder))))
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )


def op11_graph_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return search(build(vectors), vectors.filter(F.col("vec_id") % 100 == 0))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer, model = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    aligned = written(align(_documents(spark, folder), tokenizer, model).select("doc_id", *numbers, "pairs", "weights", digest), "align-rows")
    counts = written(link_counts(aligned, model), "align-counts")
    return with_scores(aligned, counts).select("doc_id", *numbers, "n_best", "count_sum", "groups_sha256")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
