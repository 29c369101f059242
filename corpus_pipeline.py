"""The corpus pipeline: raw documents to packed training sequences.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame`` over all that its
predecessor kept; all but the last return the columns of ``documents``.

Cases, in any stage: a null or empty text is a document without words, which
the classifier scores, lines and near copies leave alone, the benchmark can't
occur in, and packing gives its end token; null ids and ids that other rows
have, too, follow ``common.keyed`` (rows that repeat id and text are one
document: the near-copy stage keeps one of them); of lines or documents that
tie, the first by key stays; texts of any length are read whole; further
columns, whatever their names, are carried along up to packing; an empty table
gives no rows.  A stage that takes away lines takes away documents of which
only white space and marks would be left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import common, decontaminate, lines, minhash, packing, quality


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier scores below its
    threshold; it is fitted on the labels of rows that aren't held out."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each group of like lines; ``n_chars`` follows the text.
    A document that loses all its lines goes."""
    return lines.drop_repeated(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each near-duplicate group."""
    return minhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which a span of the benchmark occurs."""
    return decontaminate.remove_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences: one row a piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", reject_poor),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: The stages learn, hash and tokenize: SQL can't express them.  They are
#: tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    folder and read again by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
