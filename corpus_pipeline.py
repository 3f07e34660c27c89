"""A training corpus from the documents: language, exact copies, near copies, mix, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``, with the columns of
documents; the last one returns the pieces of the packed sequences. ``run`` writes every stage's result
as Parquet in the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfolio.llm.common import without, written
from tallyfolio.llm.exact_dedup import exact_dedup
from tallyfolio.llm.jaccard import jaccard_components
from tallyfolio.llm.language import UNKNOWN, fit, with_language
from tallyfolio.llm.mixing import Mix, mixed
from tallyfolio.llm.queries import packed

LEAST_SCORE = 0.5
CORPUS_MIX = Mix(
    domains={"web": 4, "books": 3, "news": 3, "forums": 2},
    langs={(d, "en"): 4 for d in ("web", "books", "news", "forums")},
    budget_percent=90,
)
"""Nine tenths of the tokens there are, each document once at most."""


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: not those without text or letters, nor those where no language
    has half of the probability. Where there is nothing to learn from, letters are enough."""
    net = fit(docs.select("doc_id", "text", "lang"))
    if net is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    seen = with_language(docs, net, lang_pred="__lang", score="__score")
    return seen.filter((F.col("__lang") != UNKNOWN) & (F.col("__score") >= LEAST_SCORE)).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join, the one with the smallest id."""
    found = jaccard_components(docs.select("doc_id", "text"))
    return without(docs, "doc_id", written(found.filter("component_id <> doc_id").select("doc_id"), "near-copies"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix has room for."""
    return mixed(docs, CORPUS_MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packed(docs)


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mix", mix),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL = None
"""Neither a trained network nor a tokenizer can be written in SQL; tests hold stages against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
