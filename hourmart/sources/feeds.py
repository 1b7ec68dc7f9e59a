"""RSS and Atom documents to headlines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.functions.text import clean_text, parse_feed_date
from hourmart.operators.revisions import keep_first
from hourmart.sources.documents import with_payload

# Element names of the two feed formats.
_RSS_ITEM = (
    "ARRAY<STRUCT<title: STRING, link: STRING, pubDate: STRING, "
    "`atom:link`: ARRAY<STRUCT<_href: STRING>>>>"
)
_ATOM_ENTRY = (
    "ARRAY<STRUCT<title: STRING, link: ARRAY<STRUCT<_href: STRING>>, "
    "updated: STRING, published: STRING>>"
)
FEED_XML = (
    f"channel STRUCT<item: {_RSS_ITEM}>, item {_RSS_ITEM}, entry {_ATOM_ENTRY}, "
    "_corrupt_record STRING"
)


def parse_feeds(docs: DataFrame, content: str, keys: Sequence[str]) -> DataFrame:
    """Add the parsed feed; a broken document keeps its text in ``corrupt``."""
    return with_payload(docs, F.from_xml(F.col(content), FEED_XML, {"mode": "PERMISSIVE"}), keys)


def _items() -> Column:
    """RSS items and Atom entries in one shape, in document order."""

    def rss(item: Column) -> Column:
        return F.struct(
            item.getField("title").alias("title"),
            F.get(item.getField("atom:link"), F.lit(0)).getField("_href").alias("href"),
            item.getField("link").alias("link"),
            item.getField("pubDate").alias("published"),
        )

    def atom(entry: Column) -> Column:
        return F.struct(
            entry.getField("title").alias("title"),
            F.get(entry.getField("link"), F.lit(0)).getField("_href").alias("href"),
            F.lit(None).cast("string").alias("link"),
            F.coalesce(entry.getField("updated"), entry.getField("published")).alias("published"),
        )

    rss_items = F.coalesce(F.col("payload.channel.item"), F.col("payload.item"))
    return F.coalesce(F.transform(rss_items, rss), F.transform(F.col("payload.entry"), atom))


def headlines(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per item with a title and a link; the first of equal links in a
    document stays."""
    items = parsed.select(*keys, F.posexplode_outer(_items()).alias("position", "item"))
    href = F.trim(F.coalesce(F.col("item.href"), F.lit("")))
    rows = items.select(
        *keys,
        "position",
        href.alias("href"),
        clean_text("item.link").alias("plain"),
        clean_text("item.title").alias("title"),
        parse_feed_date("item.published").alias("published_ts"),
    ).select(
        *keys,
        "position",
        F.when(F.col("href") != "", F.col("href")).otherwise(F.col("plain")).alias("link"),
        "title",
        "published_ts",
    )
    named = rows.where((F.col("title") != "") & (F.col("link") != ""))
    return keep_first(named, [*keys, "link"], ["position"]).drop("position")
