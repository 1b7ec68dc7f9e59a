"""Parsed documents: one row per document, broken ones marked.

Parsing is the expensive step, so the functions that read a parsed document use
outer generators: a filter on the payload, or one that Spark infers for an inner
generator, would be pushed below the projection and parse every document again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_payload(docs: DataFrame, parsed: Column, keys: Sequence[str]) -> DataFrame:
    """Add ``payload``, NULL for a broken document, and ``corrupt``, its text."""
    corrupt = F.col("parsed._corrupt_record")
    return docs.select(*keys, parsed.alias("parsed")).select(
        *keys,
        F.when(corrupt.isNull(), F.col("parsed")).alias("payload"),
        corrupt.alias("corrupt"),
    )


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (good, broken).  A broken document gives no rows in either case;
    the split is for storing it."""
    good = parsed.where(F.col("corrupt").isNull())
    return good, parsed.where(F.col("corrupt").isNotNull()).drop("payload")
