"""A training corpus from raw documents: quality, line dedup, near dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
returns a DataFrame that is written as Parquet and read again for the next one. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sousflow.llm.common import Staging, staged, table
from sousflow.llm.op2_line_dedup import line_dedup
from sousflow.llm.op5_quality_fm import THRESHOLD, score_quality, train
from sousflow.llm.op7_minhash_near_dedup import near_duplicates
from sousflow.llm.op8_best_fit_packing import pack
from sousflow.llm.op9_pii import redact

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the threshold, unchanged; a null text is scored as empty."""
    docs = docs.select(*COLUMNS)
    machine = train(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, machine).where(F.col("quality_score") >= THRESHOLD).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a document that loses its last word with them goes, one that had none stays."""
    out = line_dedup(docs.select(*COLUMNS))
    return _with_length(out.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates on runs of five words; of rows that repeat id and text one stays, too."""
    docs = docs.select(*COLUMNS)
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id IS NULL")).select(*COLUMNS)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind in square brackets."""
    return _with_length(redact(docs.select(*COLUMNS)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: The learned stages have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next.

    What a stage staged and what it read goes once it is written; only what the result reads stays.
    """
    docs, left = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with Staging(spark, left) as own:
            docs = own.keep(staged(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        left = own.left
    with Staging(spark, left) as own:
        return own.keep(STAGES[-1][1](spark, docs, sf_dir))
