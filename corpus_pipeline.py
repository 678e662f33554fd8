"""From raw documents to packed training sequences: five stages, each an operator of ``martforge.llm``.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's docs; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import language_id, line_dedup, minhash, mixing, packing
from martforge.llm.catalog import held_out, tokenizer_path
from martforge.llm.shared import table, written

MIN_LANGUAGE_SCORE = 0.1  # a text that resembles no language less than this goes


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or whose best language scores too low, go."""
    model = language_id.train(docs.filter(~held_out(4, 2)))
    found = docs.withColumn("stage_found", language_id.language_of(spark, model, F.col("text")))
    kept = (F.col("stage_found.lang_pred") != language_id.UNKNOWN) & (F.col("stage_found.score") >= MIN_LANGUAGE_SCORE)
    return found.filter(kept).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later occurrences of a line are cut; a document that loses all its words goes."""
    cut = line_dedup.dedup_lines(docs)
    left = cut.filter((F.col("removed_count") == 0) | F.col("text").rlike(mixing.WORD))
    return _counted(left, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays; of rows that repeat its id, one. Rows without an id stay."""
    kept = minhash.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    # combined before the shuffle, so that an id of very many rows is not gathered
    single = docs.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("first_row"))
    found = single.join(kept, "doc_id", "left_semi").select("first_row.*")
    return found.union(docs.filter("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a row for each time that a document, or part of it, is taken."""
    return _counted(mixing.mixed_documents(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all sequences, with their token ids."""
    return packing.pack_documents(docs, tokenizer_path())


def _counted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(*docs.columns)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack),
]

ORACLE_SQL = None  # line groups, MinHash and tokenisation are beyond SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
