"""Exact dedup: 128-bit content hash, bytes compared, the row with the largest id stays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbgrid.llm.common import ascii_lower


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  Rows are grouped by MD5 *and* the text itself, with partial
    aggregation first: a text that makes up a third of the table leaves each
    task once.  So a group holds equal bytes only, whatever the hash does.
    Rows find their group by MD5, SHA-256 and length; the job stops if two
    different texts ever share all three.

    Ids that repeat with the same text stay or go together; null ids lose to
    any other, and stay only in a group that has no other id.
    """
    norm = docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.col(text_col)).alias("_norm"))
    hashed = norm.withColumn("_h", F.unhex(F.md5("_norm")))
    groups = hashed.groupBy("_h", "_norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    digest, length = F.sha2("_norm", 256).alias("text_sha256"), F.octet_length("_norm").alias("_len")
    known = (
        groups.select("_h", digest, length, "keep_id", "group_size")
        .groupBy("_h", "text_sha256", "_len")
        .agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("_k"))
    )
    # One key made after the aggregation: both sides are then shuffled for the join alone, and
    # adaptive execution may split the rows of a hot text.
    key = F.concat_ws("-", F.hex("_h"), "text_sha256", "_len").alias("_key")
    known = known.select(key, "keep_id", "group_size", "_k")
    rows = hashed.select("doc_id", "_h", digest, length).select("doc_id", "text_sha256", key)
    alone = F.when(F.col("_k") == 1, F.col("group_size")).otherwise(
        F.raise_error(F.lit("different texts share MD5, SHA-256 and length")).cast("long")
    )
    return rows.join(known, "_key").select(
        "doc_id",
        "keep_id",
        alone.alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
