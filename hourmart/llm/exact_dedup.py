"""Exact deduplication by content sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import SPACES, Scratch, packed, partitions, tuned, unpacked

#: Leading characters of a text that range-partition it, before its hash.
HEAD_CHARS = 32
#: Texts with fewer copies than this are never split over partitions.
LEAST_HOT = 64


def normalised(text: Column) -> Column:
    """Runs of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find equal texts by sorting content; of equals the smallest identifier stays.

    Adds ``keep_id`` (identifier of the row that stays), ``group_size``, ``kept``
    and ``text_sha256`` (of the normalised text) to all rows of ``docs``.

    Spark samples splitters and range-partitions rows by the leading characters and
    a hash of their normalised text; an external sort puts equal texts side by
    side, and the window's group boundaries are full comparisons of neighbouring
    texts.  A sampled key is a few dozen bytes however long the text is.  Texts with
    many copies are split over several ranges by identifier; their partial results
    are aggregated before the shuffle and merged, so no task gets a whole hot group.

    A null text counts as empty.  Null identifiers come last: one stays only in a
    group without others, where ``keep_id`` is null.  Of repeated rows with the same
    identifier and text one stays.  An empty table gives no rows.  Input columns named
    like result columns are replaced.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "exact-dedup")
    names = docs.columns
    text = normalised(F.col(f"row.`{text_col}`"))
    key = F.col(f"row.`{id_col}`")
    rows = packed(docs).select("row", F.xxhash64(text).alias("hash"))

    # At most 4 hashes a partition can have more rows than this: the table is small by design.
    limit = max(LEAST_HOT, docs.count() // (4 * partitions(spark)))
    counts = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    hot = scratch.store(
        counts.select("hash", F.ceil(F.col("n") / limit).cast("int").alias("parts")), "hot"
    )
    marked = rows.join(F.broadcast(hot), "hash", "left")
    whole = (
        rows.join(F.broadcast(hot), "hash", "left_semi")
        .groupBy("hash", text.alias("content"))
        .agg(F.min(key).alias("least"), F.count(F.lit(1)).alias("size"))
        .select("hash", F.sha2("content", 256).alias("sha"), "least", "size")
    )

    placed = marked.select(
        "row",
        "hash",
        F.substring(text, 1, HEAD_CHARS).alias("head"),
        F.coalesce(F.pmod(F.xxhash64(key), F.col("parts")), F.lit(0)).alias("salt"),
    ).repartitionByRange("head", "hash", "salt")
    group = Window.partitionBy("head", "hash", "content", "salt").orderBy(key.asc_nulls_last())
    everyone = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sorted_rows = placed.withColumn("content", text).select(
        "row",
        "hash",
        F.sha2("content", 256).alias("sha"),
        F.row_number().over(group).alias("place"),
        F.min(key).over(everyone).alias("part_least"),
        F.count(F.lit(1)).over(everyone).alias("part_size"),
    )
    merged = sorted_rows.join(F.broadcast(whole), ["hash", "sha"], "left")
    split = F.col("size").isNotNull()
    keep = F.when(split, F.col("least")).otherwise(F.col("part_least"))
    return unpacked(
        merged,
        names,
        keep.alias("keep_id"),
        F.coalesce("size", "part_size").alias("group_size"),
        ((F.col("place") == 1) & F.col("part_least").eqNullSafe(keep)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
