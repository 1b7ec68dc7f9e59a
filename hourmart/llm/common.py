"""Helpers of the training-data operators: settings, stored tables, text, ranks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourmart.session import prepare, remove_folder, work_folder

#: Characters that separate words, for Spark's and DuckDB's regular expressions.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

#: Bits that mark keys: of each key, about, and at most, as a power of two.
KEY_BITS, MOST_BITS = 16, 27

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: Arrow batches bounded in rows and bytes."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """Tables of one run below the shared folder of the cluster.

    A stored table cuts the lineage and survives lost executors.  What is no
    longer read is dropped; tables under the returned frame stay with it.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.base = work_folder(spark, purpose)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(self.path(name))
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            remove_folder(self.spark, self.path(name))


def packed(frame: DataFrame, **columns: Column) -> DataFrame:
    """The input's columns as one struct ``row`` beside own columns: no name can clash."""
    return frame.select(F.struct(*[frame[f"`{c}`"] for c in frame.columns]).alias("row")).select(
        "row", *[column.alias(name) for name, column in columns.items()]
    )


def with_texts(
    docs: DataFrame, text_col: str, keep: list[str] | None
) -> tuple[DataFrame, Callable[[pa.RecordBatch], list[str | None]], list[str]]:
    """The columns ``keep`` (all, if None) as ``row``, a reader of a batch's texts, and their names.

    The text goes to the tasks once, and comes back only if it is kept.
    """
    names = list(docs.columns if keep is None else keep)
    if text_col in names:
        return packed(docs.select(*[f"`{n}`" for n in names])), lambda b: b.column("row").field(text_col).to_pylist(), names
    row = F.struct(*[docs[f"`{n}`"] for n in names]).alias("row")
    return docs.select(row, docs[f"`{text_col}`"].alias("text")), lambda b: b.column("text").to_pylist(), names


def unpacked(frame: DataFrame, names: Iterable[str], *columns: Column | str) -> DataFrame:
    """The input's columns ``names`` of ``row`` again, followed by result columns.

    A result column replaces an input column of the same name.
    """
    results = [F.col(c) if isinstance(c, str) else c for c in columns]
    taken = {c.lower() for c in frame.select(*results).columns}
    return frame.select(
        *[F.col(f"row.`{name}`").alias(name) for name in names if name.lower() not in taken],
        *results,
    )


def hash_remainder(column: str | Column, divisor: int) -> Column:
    """crc32 of an identifier written as text, modulo ``divisor``."""
    column = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(column.cast("string")), F.lit(divisor))


def map_arrow(
    frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[Any]], schema: str
) -> DataFrame:
    """``mapInArrow`` of a function that yields record batches."""
    return frame.mapInArrow(function, schema)


def word_blocks(data: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, as lists from bounded blocks of bytes."""
    start, size = 0, len(data)
    while start < size:
        end = size
        if size - start > step and (gap := _SPACE.search(data, start + step)):
            end = gap.start()
        yield data[start:end].split()
        start = end


def marked_keys(frame: DataFrame, keys: dict[str, str], wanted: DataFrame) -> DataFrame:
    """Add ``likely`` to all rows: false only where ``wanted``, which is stored, lacks the row's key.

    ``keys`` names the key's columns in ``frame`` and ``wanted``.  One bit for each hash of
    a key, of bounded size in all, goes to the tasks, so wide rows can be told before
    they are shuffled; an exact join has to follow.
    """
    size = 1 << min(MOST_BITS, max(15, (KEY_BITS * wanted.count()).bit_length()))

    def slot(names: Iterable[str]) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(size)) + 1

    slots = wanted.select(slot(keys.values()).alias("slot"))
    bits = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    joined = frame.withColumn("slot", slot(keys)).join(
        F.broadcast(bits), F.bitmap_bucket_number("slot") == F.col("bucket"), "left"
    )
    place = F.bitmap_bit_position("slot")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1)
    return joined.withColumn("likely", F.coalesce(bit == 1, F.lit(False))).drop("slot", "bucket", "bits")


def global_rank(frame: DataFrame, order: list[Column], scratch: Scratch, name: str) -> DataFrame:
    """Add ``rank`` (from 0) in a total order, without a window over all rows.

    Rows are range-partitioned and sorted; ranks inside a partition get the number
    of rows in earlier partitions added.
    """
    placed = scratch.store(
        frame.repartitionByRange(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("inner", F.monotonically_increasing_id()),
        f"{name}-placed",
    )
    inside = placed.withColumn(
        "inner", F.row_number().over(Window.partitionBy("part").orderBy(*order, "inner")) - 1
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranked = inside.join(starts, "part").withColumn("rank", F.col("start") + F.col("inner"))
    return ranked.drop("part", "inner", "start")
