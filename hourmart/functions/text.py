"""Text cleanup, feed dates and hosts."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TAG = "<[^>]+>"
SPACE = r"(?U)[\s\x1c-\x1f]+"

# Zone names allowed in mail-style dates.
MAIL_ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "AST": "-0400", "ADT": "-0300", "EST": "-0500", "EDT": "-0400",
    "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600",
    "PST": "-0800", "PDT": "-0700",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unescape_entities(text: Column | str) -> Column:
    """Character references to characters.

    Spark has no built-in for the full entity list, so batches of text cross to
    Python as Arrow; texts without an ampersand stay behind.
    """
    text = _col(text)
    @F.pandas_udf("string")
    def unescape(batch: pd.Series) -> pd.Series:
        import html

        return batch.map(html.unescape, na_action="ignore")

    return F.coalesce(unescape(F.when(text.contains("&"), text)), text)


def clean_text(text: Column | str) -> Column:
    """Drop tags, resolve entities, collapse whitespace; NULL becomes ''."""
    bare = F.regexp_replace(F.coalesce(_col(text), F.lit("")), TAG, "")
    return F.trim(F.regexp_replace(unescape_entities(bare), SPACE, " "))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often it is named."""
    return F.transform(F.array(value), use)[0]


def parse_feed_date(text: Column | str) -> Column:
    """Mail-style date, then ISO 8601; offsets become naive UTC, junk becomes NULL."""
    raw = F.trim(_col(text))
    zones = F.create_map(*[F.lit(v) for pair in MAIL_ZONES.items() for v in pair])
    # Spark's parser raises and catches an error for every text that a pattern does not fit,
    # so each sees only texts of its own shape; a text has the shape of one pattern at most.
    day = r"[+-]?\d+ \p{L}+"
    start = rf"^{day}\.? [+-]?\d+ \d\d:\d\d"
    patterns = {
        "d MMM yyyy HH:mm:ss Z": start + r":\d\d \S+$", "d MMM yyyy HH:mm Z": start + r" \S+$",
        "d MMM yyyy HH:mm:ss": start + r":\d\d$", "d MMM yyyy HH:mm": start + "$",
    }

    def zoned(bare: Column) -> Column:
        offset = F.try_element_at(zones, F.upper(F.regexp_extract(bare, r"\s([A-Za-z]{1,4})$", 1)))
        return F.when(offset.isNull(), bare).otherwise(F.concat(F.regexp_replace(bare, r"[A-Za-z]+$", ""), offset))

    def parsed(mail: Column) -> Column:
        return F.coalesce(*[F.when(mail.rlike(shape), F.try_to_timestamp(mail, F.lit(p))) for p, shape in patterns.items()])

    # The weekday carries no information and Spark's parser rejects it.
    weekday = r"^[A-Za-z]{3,9},?\s+"
    mail = F.when(raw.rlike(rf"^({weekday[1:]})?{day}"), _once(_once(F.regexp_replace(raw, weekday, ""), zoned), parsed))
    iso = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(raw))
    return F.coalesce(mail, iso).cast("timestamp_ntz")


def source_name(url: Column | str) -> Column:
    """Host part of a URL, or the text itself when it has none."""
    url = _col(url)
    host = F.try_parse_url(url, F.lit("AUTHORITY"))
    return F.coalesce(F.nullif(host, F.lit("")), url)
