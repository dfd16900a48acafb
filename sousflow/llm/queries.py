"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .op1_exact_dedup import exact_dedup
from .op2_line_dedup import line_dedup
from .op3_fingerprints import fingerprint_groups, fingerprints
from .op4_html_text import extract_text
from .op5_quality_fm import quality
from .op6_ppm import score
from .op7_minhash_near_dedup import near_duplicates
from .op8_best_fit_packing import pack
from .op9_pii import find_pii
from .op10_sentencepiece import model_bytes, round_trip
from .op11_vantage_points import nearest_vectors
from .op12_fill_in_middle import fill_in_middle, restore
from .op13_importance_resampling import resample


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact deduplication of all documents."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that have a similar earlier line."""
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with the groups of near copies that share a band."""
    docs = table(spark, sf_dir, "documents")
    return fingerprints(docs, groups=fingerprint_groups(docs))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_text(table(spark, sf_dir, "pages"))


def op5_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from labels outside fold 0 of 5."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents, learned outside fold 0 of 10."""
    return score(table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents on word pairs, Jaccard 0.8 and more."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 words."""
    return pack(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find_pii(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded, with parity to the sentencepiece library."""
    return round_trip(table(spark, sf_dir, "documents"), model_bytes())


def op11_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest neighbours of every hundredth embedding among all."""
    return nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in fill-in-the-middle form, with the digests of output and rebuilt text."""
    both = restore(fill_in_middle(table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by their likeness to the benchmark's words."""
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_html_text": op4_html_text,
    "op5_quality_fm": op5_quality_fm,
    "op6_ppm": op6_ppm,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_pii": op9_pii,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_vantage_points": op11_vantage_points,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_importance_resampling": op13_importance_resampling,
}
