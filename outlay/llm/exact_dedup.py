"""Exact duplicates by progressive refinement: length, then a prefix hash, then the full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import LOWER, UPPER, measured, same_row, staged, text_of, without

PREFIX_CHARS = 256


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hash_all: bool = False
) -> DataFrame:
    """One row per document: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; a null text is the empty text.
    Of equal texts the row with the largest key stays; a null key is smaller than any other, and of
    rows that repeat key and text exactly one stays. An empty table gives no rows, other columns
    are ignored, whatever their names.

    Three refinements, each over what the one before left: rows that share their length, of these
    the rows that share the hash of their first ``PREFIX_CHARS`` characters, and only of these the
    whole text is hashed. ``text_sha256`` is therefore null for rows settled earlier, unless
    ``hash_all`` asks for it as a column. Lengths, prefixes and hashes are counted with map-side
    combine, and the counts are written out before rows are joined with them, so that a hot group
    can be split.
    """
    content = text_of(text)
    lowered = F.translate(content, UPPER, LOWER)
    length = F.octet_length(content).cast("bigint").alias("_length")
    prefix = F.xxhash64(F.translate(F.substring(content, 1, PREFIX_CHARS), UPPER, LOWER))
    sizes = staged(docs.select(length, prefix.alias("_prefix")), "lengths")
    lengths = staged(sizes.groupBy("_length").count().where("count > 1").select("_length"), "same")
    alike = staged(
        sizes.join(measured(lengths), "_length", "left_semi")
        .groupBy("_length", "_prefix")
        .count()
        .where("count > 1")
        .select("_length", "_prefix", F.lit(True).alias("_alike")),
        "prefixes",
    )

    full = F.sha2(lowered.cast("binary"), 256)
    base = docs.select(
        F.col(key).alias("_key"), length, prefix.alias("_prefix"),
        (full if hash_all else lowered.cast("binary")).alias("_content"), *same_row(key, text),
    )
    hashed = base.join(measured(alike), ["_length", "_prefix"], "left").select(
        "_key",
        "_id",
        "_text",
        F.coalesce("_alike", F.lit(False)).alias("_alike"),
        (F.col("_content") if hash_all else F.when(F.col("_alike"), F.sha2("_content", 256))).alias(
            "text_sha256"
        ),
    )
    hashed = staged(hashed.withColumn("_row", F.monotonically_increasing_id()), "hashed")
    open_rows = hashed.where("_alike")
    groups = staged(
        open_rows.groupBy("text_sha256").agg(
            F.count(F.lit(1)).alias("group_size"), F.max(F.struct("_key", "_row", "_text")).alias("_keep")
        ),
        "groups",
    )
    joined = open_rows.join(groups, "text_sha256").select(
        "_key", "_id", "_text", F.col("_keep._key").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_keep._row")).alias("kept"), "text_sha256",
        (F.col("_key").eqNullSafe(F.col("_keep._key")) & (F.col("_text") == F.col("_keep._text")))
        .alias("_again"),
    )
    settled = hashed.where("not _alike").select(
        "_key", "_id", "_text", F.col("_key").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256",
        F.lit(True).alias("_again"),
    )
    return joined.unionByName(settled).withColumnRenamed("_key", key)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are."""
    gone = exact_groups(docs).where("not kept").select("_id", "_text", "_again").distinct()
    gone = staged(gone, "dropped")
    # A dropped row that equals the row that stays in key and text is a repeat of it.
    repeats = gone.where("_again").select("_id", "_text")
    return without(docs, gone.where("not _again").select("_id", "_text"), repeats)
