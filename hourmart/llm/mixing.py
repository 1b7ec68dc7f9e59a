"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import WORDS, Scratch, global_rank, packed, tuned, unpacked

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source is read more often than this.
MOST_EPOCHS = 3
#: Rows of a source that one block of the key range is expected to hold.
BLOCK_ROWS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame,
    scratch: Scratch,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
) -> DataFrame:
    """(source, source_size, rows, weight, target) from (source, source_size, rows).

    Every source gets ``level * weight`` words, at most ``most`` times its own.  The
    level rises until the words of capped sources are shared out among the others;
    each round aggregates the sources to one row.
    """
    order = [F.col("source").asc_nulls_last()]
    ranked = global_rank(sources, order, scratch, "sources")
    weight = F.array(*[F.lit(w) for w in weights])[(F.col("rank") % len(weights)).cast("int")]
    known = scratch.store(ranked.withColumn("weight", weight).drop("rank"), "weights")

    cap = F.col("source_size") * most
    total = known.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) > cap
        held, share = known.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        raised = (total - held) / share if share else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("weight") * F.lit(level), cap.cast("double"))
    return known.withColumn("target", target)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: int = 7,
) -> DataFrame:
    """Take words of each source up to its target.

    Adds ``size`` (words), ``source_size``, ``target`` (both of the row's source) and
    ``taken`` (words that the mix takes from the row, repeats counted).

    Rows get hash-random keys.  Within a source the keys' range is cut into blocks of
    about a thousand rows; the blocks' word counts and their prefix sums say in which
    block the budget ends, and a running sum inside each block where.  A source is
    taken whole as often as its budget allows, then in key order up to the remaining
    words; the row at the cut gives the words that are still missing, so each source
    meets its rounded target exactly.  Keys depend on identifier and text alone:
    reruns agree.  A hot source has as many more blocks as it has more rows.

    A null text has size 0; a null source is a source of its own, the last; null
    identifiers are ordinary values.  Repeated rows each count, in any order, as they
    are alike.  A source without words, or an empty table, takes nothing.  Input columns
    named like result columns are replaced.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "mixing")
    names = docs.columns
    text, key = F.col(f"row.`{text_col}`"), F.col(f"row.`{id_col}`")
    sized = packed(docs).select(
        "row",
        key.alias("id"),
        F.col(f"row.`{source_col}`").alias("source"),
        word_count(text).alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), text)).alias("key"),
    )
    narrow = scratch.store(sized.select("source", "size", "key"), "narrow")
    sources = narrow.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    plan = scratch.store(
        source_targets(sources, scratch, weights, most).select(
            F.col("source").alias("plan_source"),
            "source_size",
            "target",
            F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks"),
            F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * most).alias("budget"),
        ),
        "plan",
    )

    def blocked(rows: DataFrame) -> DataFrame:
        """The key's place in [0, 1), from its first eight digits, times the number of blocks."""
        place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
        block = F.floor(place * F.col("blocks"))
        joined = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
        return joined.withColumn("block", block)

    by_source = Window.partitionBy("source").orderBy("block")
    before = by_source.rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked(narrow).groupBy("source", "block").agg(F.sum("size").alias("n"))
    starts = sums.select(
        F.col("source").alias("start_source"),
        F.col("block").alias("start_block"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
    )

    inside = Window.partitionBy("source", "block").orderBy("key", F.col("id").asc_nulls_last(), "size")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    ordered = blocked(sized).withColumn("inner", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    placed = ordered.join(
        starts,
        F.col("source").eqNullSafe(F.col("start_source")) & (F.col("block") == F.col("start_block")),
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    rest = F.col("budget") - epochs * F.col("source_size") - F.col("start") - F.col("inner")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return unpacked(
        placed, names, "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_rows(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of a mix as often as they are taken.

    Whole copies keep their text; the row at a source's cut also gives its first
    words, joined by one space.
    """
    part = F.col("taken") % F.col("size")
    copies = F.floor(F.col("taken") / F.col("size")).cast("int")
    whole = mixed.where("taken >= size and size > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), copies))
    )
    words = F.slice(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(WORDS), F.lit(0)), 1, part.cast("int"))
    cut = mixed.where((F.col("size") > 0) & (part > 0)).withColumn(text_col, F.array_join(words, " "))
    return whole.drop("copy").unionByName(cut)
