"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, SentencePiece ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of the documents.  ``run`` writes each stage's result as
Parquet into the shared folder and reads it again for the next one, so a lost
executor repeats a stage's tasks only, never an earlier stage.

Defined results of every stage: null and empty texts are empty documents (the
quality rules drop them); repeated rows stay rows of their own until near-dedup
keeps one of each group; an empty table gives an empty table; a text of any
length is taken whole; a column that has the name of an operator's result keeps
the document's values, and extra columns go along until the last stage, which
returns ids, sources and pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm import linededup, mixing, pieces, quality, simhash
from tillpoint.llm.common import fresh, table
from tillpoint.session import scratch_path


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns that an operator would take for its own (``names``, without case) under other names, and the way back."""
    own = {n.lower() for n in names}
    moved = dict(zip((c for c in docs.columns if c.lower() in own), fresh(docs, *[f"aside_{c}" for c in docs.columns if c.lower() in own])))
    return docs.withColumnsRenamed(moved), {new: old for old, new in moved.items()}


def _same_columns(done: DataFrame, docs: DataFrame, back: dict[str, str], text_length: bool = False) -> DataFrame:
    """``done`` with the columns of ``docs``, in order and under their own names; n_chars follows the text where it changed."""
    there = {old: new for new, old in back.items()}
    length = F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    return done.select(*[length.alias(c) if text_length and c == "n_chars" else F.col(f"`{there.get(c, c)}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more documents share; n_chars follows the text."""
    given, back = _aside(docs, "n_lines", "n_dropped")
    return _same_columns(linededup.dedup_lines(given), docs, back, text_length=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson draws towards the sources' target weights, in shuffled order."""
    given, back = _aside(docs, "copy", "n_copies", "rate", "shuffle_key")
    return _same_columns(mixing.mix(given), docs, back)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the piece ids of every document; ``decodes`` tells that the ids give the text back."""
    coder = pieces.SentencePiece(spark)
    coded = docs.select("doc_id", "source", coder.encode_verified(F.col("text")).alias("c"))
    return coded.select("doc_id", "source", F.size("c.token_ids").cast("long").alias("n_tokens"), "c.token_ids", "c.decodes")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

#: SimHash components and piece ids aren't SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
