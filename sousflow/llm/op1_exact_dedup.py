"""Exact deduplication by two passes over a Bloom filter.

Pass one adds every text's 64-bit hash to a Bloom filter whose slots count 0, 1 or "2 and
more". A hash that occurs twice has counted every slot of its own twice, so pass two,
which probes the slots, finds each repeated hash and few others. Only rows that pass it
are shuffled, grouped by SHA-256 of the whole text and settled; all others are single
and go straight through.

The filter is sized from the number of rows. One filter takes ``KEYS_PER_FILTER`` keys at
most, which bounds the bitmap that goes to every task; more rows are dealt by hash into
as many classes as needed, each with a filter of its own and read from its own files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import MAX_SLOTS, SLOTS_PER_KEY, bitmap_of, passes
from .common import staged, text_of

KEYS_PER_FILTER = MAX_SLOTS // SLOTS_PER_KEY


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                keys_per_filter: int = KEYS_PER_FILTER) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after no change; a null text counts as empty, and
    empty texts equal each other. Of equal texts the row with the largest id stays.
    Rows that repeat id and text are copies with one id: they share ``keep_id`` and are
    both marked kept. A null id is smaller than all others, so it stays only when every
    row of its group has none. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    text = text_of(docs, text_column)
    rows = docs.select(docs[id_column].alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("text_sha256"), F.xxhash64(text).alias("h"))
    total = docs.count()
    classes = max(1, -(-total // keys_per_filter))
    rows = staged(rows.withColumn("part", F.pmod(F.hash("h"), F.lit(classes))), "exact-rows", ("part",))
    flagged = None
    for i in range(classes):
        part = rows.where(F.col("part") == i)
        bits, slots = bitmap_of(part.select("h"), -(-total // classes), least=2)
        marked = part.withColumn("maybe", passes(spark, part["h"], bits, slots))
        flagged = marked if flagged is None else flagged.unionByName(marked)
    flagged = staged(flagged.select("doc_id", "text_sha256", "maybe"), "exact-flagged", ("maybe",))

    single = flagged.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    again = flagged.where("maybe").select("doc_id", "text_sha256")
    groups = staged(again.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "exact-groups")
    # both sides are plain scans, so a group with a large share of the rows is split among tasks
    settled = again.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return single.unionByName(settled)
