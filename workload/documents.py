"""Document sources: payloads are built from the driver tables by Spark and parsed back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions.text import clean_text, parse_feed_date, source_name
from hourmart.functions.zones import hour_floor
from hourmart.operators.revisions import latest_revision
from hourmart.plans import headlines as news
from hourmart.session import work_folder
from hourmart.sources import feeds, price_documents, ranges, weather_documents
from hourmart.sources.documents import quarantine
from workload import bindings as b
from workload import sql

KEYS = ["doc_id"]
ITEMS_PER_FEED = 20
CLIP_FROM, CLIP_TO = dt.datetime(1997, 3, 1), dt.datetime(1998, 3, 1)
# Codes of the translation example; the rest pass through.
SEGMENTS = {"BUILDING": "B", "MACHINERY": "M"}


# -- prices -----------------------------------------------------------------


def price_xml(spark, d) -> DataFrame:
    """One quarter-hour document per day: at most 96 points each."""
    day = F.date_trunc("day", "slot").cast("timestamp_ntz")
    position = F.timestamp_diff("MINUTE", F.col("day"), F.col("slot")) / 15 + 1
    point = F.concat(
        F.lit("<Point><position>"), position.cast("int").cast("string"),
        F.lit("</position><price.amount>"), F.col("price").cast("string"),
        F.lit("</price.amount></Point>"),
    )
    return (
        b.slots(spark, d)
        .withColumn("day", day)
        .groupBy("day")
        .agg(F.array_join(F.sort_array(F.collect_list(point)), "").alias("points"))
        .select(
            F.date_format("day", "yyyy-MM-dd").alias("doc_id"),
            F.concat(
                F.lit('<Document xmlns="urn:example:prices"><TimeSeries><Period><timeInterval><start>'),
                F.date_format("day", price_documents.START_FORMAT),
                F.lit("</start></timeInterval><resolution>PT15M</resolution>"),
                F.col("points"),
                F.lit("</Period></TimeSeries></Document>"),
            ).alias("content"),
        )
    )


def price_json(spark, d) -> DataFrame:
    """The same days as parallel arrays."""
    at = F.unix_seconds(F.col("slot").cast("timestamp"))
    rows = b.slots(spark, d).select(
        F.date_format("slot", "yyyy-MM-dd").alias("doc_id"), F.struct(at.alias("at"), "price").alias("row")
    )
    listed = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    payload = F.struct(F.col("rows.at").alias("unix_seconds"), F.col("rows.price").alias("price"))
    return listed.select("doc_id", F.to_json(payload).alias("content"))


def xml_points(spark, d):
    parsed = price_documents.parse_xml(price_xml(spark, d), "content", KEYS)
    return price_documents.xml_points(parsed, KEYS)


def json_points(spark, d):
    parsed = price_documents.parse_json(price_json(spark, d), "content", KEYS)
    return price_documents.json_points(parsed, KEYS)


def series_hours(spark, d):
    """The completeness rule on the raw points, one series per event type."""
    points = b.table(spark, d, "events").select(
        "event_type",
        hour_floor("ts").alias("hour_utc"),
        (F.floor(F.minute("ts") / 15) * 15).cast("int").alias("minute"),
        F.col("value").alias("price_eur_mwh"),
    )
    return price_documents.hours_from_points(points, ["event_type"])


# -- weather ----------------------------------------------------------------


def station_hours(spark, d) -> DataFrame:
    """Newest click per hour as tenths and integers, as a station file holds them."""
    events = b.table(spark, d, "events").where(F.col("event_type") == "click")
    rows = events.select(
        hour_floor("ts").alias("hour"),
        F.floor("value").cast("int").alias("t"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "ts",
        "event_id",
    )
    return latest_revision(rows, ["hour"], "ts", b.TIES)


def station_texts(spark, d) -> DataFrame:
    """One text per day with a commented header; k < 5 leaves the wind blank and
    radiation starts below zero."""
    line = F.concat_ws(
        ",",
        F.lit("  260"),
        F.date_format("hour", "yyyyMMdd"),
        F.lpad((F.hour("hour") + 1).cast("string"), 5, " "),
        F.lpad(F.col("t").cast("string"), 5, " "),
        F.when(F.col("k") < 5, "     ").otherwise(F.lpad(F.col("k").cast("string"), 5, " ")),
        F.lpad((F.col("k") - 10).cast("string"), 5, " "),
    )
    header = F.lit("# SOURCE: station text\n# STN = station, H = hour\n# STN,YYYYMMDD,    H,    T,   FH,    Q\n")
    return (
        station_hours(spark, d)
        .groupBy(F.date_format("hour", "yyyy-MM-dd").alias("doc_id"))
        .agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
        .select("doc_id", F.concat(header, "lines", F.lit("\n")).alias("content"))
    )


def station_rows(spark, d):
    lines = weather_documents.lines_of_documents(station_texts(spark, d), "content", KEYS)
    return weather_documents.station_rows(lines, KEYS)


def decade_files(spark, d):
    """Order days as station files, one per decade with an overlap of days that
    both files hold; the later file's row stays."""
    date = F.col("o_orderdate")
    per_day = b.table(spark, d, "orders").groupBy(date.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    decade = F.concat((F.year("day") - F.year("day") % 10).cast("string"), F.lit("-"),
                      (F.year("day") - F.year("day") % 10 + 9).cast("string"))
    rows = per_day.select(decade.alias("decade"), "day", "n").unionByName(
        per_day.where(F.year("day") == 1999).select(
            F.lit("2000-2009").alias("decade"), "day", (F.col("n") + 1000).alias("n")
        )
    )
    line = F.concat_ws(",", F.lit("260"), F.date_format("day", "yyyyMMdd"), F.lit("24"), F.col("n").cast("string"))
    data = rows.select("decade", F.lit(1).alias("part"), line.alias("value"))
    header = rows.select("decade").distinct().select(
        "decade", F.lit(0).alias("part"), F.lit("# STN,YYYYMMDD,H,T").alias("value")
    )
    path = work_folder(spark, "station-files")
    (
        header.unionByName(data)
        .repartition("decade")
        .sortWithinPartitions("decade", "part", "value")
        .drop("part")
        .write.partitionBy("decade")
        .text(path)
    )
    paths = weather_documents.decade_paths(path + "/decade={decade}", 1995, 2001)
    return weather_documents.station_files(spark, paths)


def grid_json(spark, d) -> DataFrame:
    """Parallel arrays per day; a row with k < 3 is empty and has to vanish."""
    events = b.table(spark, d, "events").where(F.col("event_type") == "signup")
    k = F.get_json_object("props", "$.k").cast("int")
    rows = latest_revision(
        events.select(hour_floor("ts").alias("hour"), F.col("value").alias("v"), k.alias("k"), "ts", "event_id"),
        ["hour"], "ts", b.TIES,
    )
    filled = F.col("k") >= 3
    row = F.struct(
        F.date_format("hour", weather_documents.TIME_FORMAT).alias("time"),
        F.when(filled, F.col("v") / 10.0).alias("temp"),
        F.when(filled, F.col("k") * 0.9).alias("wind"),
        F.when(filled, F.col("k") * 10.0).alias("rad"),
    )
    listed = rows.groupBy(F.date_format("hour", "yyyy-MM-dd").alias("doc_id")).agg(
        F.sort_array(F.collect_list(row)).alias("rows")
    )
    hourly = F.struct(
        F.col("rows.time").alias("time"),
        F.col("rows.temp").alias("temperature_2m"),
        F.col("rows.wind").alias("wind_speed_10m"),
        F.col("rows.rad").alias("shortwave_radiation"),
    )
    payload = F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"})
    return listed.select("doc_id", payload.alias("content"))


def grid_rows(spark, d):
    parsed = weather_documents.parse_json(grid_json(spark, d), "content", KEYS)
    return weather_documents.grid_rows(parsed, KEYS)


def clipped_labels(spark, d):
    rows = weather_documents.clip(b.dst_labels(spark, d), CLIP_FROM, CLIP_TO)
    return rows.groupBy("station").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("interval_end_local").alias("first_label"),
        F.max("interval_end_local").alias("last_label"),
    )


# -- feeds and headlines ----------------------------------------------------


def rss_documents(spark, d) -> DataFrame:
    """Feeds of up to twenty whole documents; odd feeds are Atom, the others RSS.
    Texts are escaped as XML requires."""
    text = F.col("text")
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    link = F.concat(F.lit("https://"), "source", F.lit(".example/"), F.md5("text"))
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id"))
    feed = F.floor(F.col("doc_id") / ITEMS_PER_FEED)
    atom = feed % 2 == 1
    rss_item = F.concat(
        F.lit("<item><title>"), text, F.lit("</title><link>"), link, F.lit("</link><pubDate>"),
        F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0200</pubDate></item>"),
    )
    atom_item = F.concat(
        F.lit("<entry><title>"), text, F.lit('</title><link href="'), link, F.lit('"/><updated>'),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</updated></entry>"),
    )
    items = b.table(spark, d, "documents").select(
        feed.alias("feed_id"),
        F.struct("doc_id", F.when(atom, atom_item).otherwise(rss_item).alias("xml")).alias("item"),
    )
    body = F.array_join(F.col("items.xml"), "")
    return (
        items.groupBy("feed_id")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .select(
            "feed_id",
            F.when(F.col("feed_id") % 2 == 1,
                   F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), body, F.lit("</feed>")))
            .otherwise(F.concat(F.lit('<rss version="2.0"><channel>'), body, F.lit("</channel></rss>")))
            .alias("content"),
        )
    )


def feed_headlines(spark, d):
    parsed = feeds.parse_feeds(rss_documents(spark, d), "content", ["feed_id"])
    return feeds.headlines(parsed, ["feed_id"])


def broken_feeds(spark, d):
    """Feeds whose closing tag is lost are set aside; the others load."""
    content = F.when(
        F.col("feed_id") % 5 == 0, F.regexp_replace("content", "</(rss|feed)>$", "")
    ).otherwise(F.col("content"))
    docs = rss_documents(spark, d).withColumn("content", content)
    parsed = feeds.parse_feeds(docs, "content", ["feed_id"])
    _, broken = quarantine(parsed)
    loaded = feeds.headlines(parsed, ["feed_id"]).groupBy("feed_id").agg(F.count(F.lit(1)).alias("headlines"))
    return loaded.withColumn("is_broken", F.lit(False)).unionByName(
        broken.select("feed_id", F.lit(0).cast("bigint").alias("headlines"), F.lit(True).alias("is_broken"))
    )


def classified(spark, d):
    raw = b.headline_revisions(spark, d)
    return news.apply_labels(raw, b.label_results(spark, d), ["doc_id"])


def keyword_topics(spark, d):
    docs = b.table(spark, d, "documents").select("doc_id", "text")
    return news.classify_by_keywords(docs, "text").select("doc_id", *news.category_columns())


def batch_topics(spark, d):
    """A Python classifier in Arrow batches: long texts are off topic."""

    def by_length(titles):
        import pandas as pd

        size = titles.str.len()
        return pd.DataFrame(
            {
                "label": size.map(lambda n: "none of these" if n > 1000 else "gas"),
                "confidence": 0.5,
                "model": "length",
            }
        )

    docs = b.table(spark, d, "documents").select("doc_id", F.col("text").alias("title"))
    out = news.classify_batches(docs, by_length)
    return out.select("doc_id", *news.category_columns())


def page_titles(spark, d):
    pages = b.table(spark, d, "pages")
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return pages.select("page_id", clean_text(title).alias("title"))


def page_texts(spark, d):
    """Whole pages without tags, entities resolved."""
    return b.table(spark, d, "pages").select("page_id", F.md5(clean_text("html")).alias("digest"))


def mail_dates(spark, d):
    """Order dates written in two styles, parsed back."""
    date = F.col("o_orderdate")
    mail = F.concat(F.date_format(date, "EEE, d MMM yyyy"), F.lit(" 08:30:00 EST"))
    iso = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("T08:30:00+02:00"))
    return b.table(spark, d, "orders").select(
        "o_orderkey",
        parse_feed_date(mail).alias("mail"),
        parse_feed_date(iso).alias("iso"),
        parse_feed_date(F.col("o_orderpriority")).alias("junk"),
    )


POINT_COLUMNS = "doc_id, hour_utc, price_eur_mwh"
# The entities of the pages; HTML accepts these names without a semicolon, too.
ENTITIES = {"quot": '"', "copy": "©", "middot": "·", "nbsp": " ", "amp": "&"}


def _clean(x: str) -> str:
    text = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for name, character in ENTITIES.items():
        text = f"regexp_replace({text}, '&{name};?', '{character}', 'g')"
    space = r"[\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]+"
    return f"trim(regexp_replace({text}, '{space}', ' ', 'g'))"


FEED_ROWS = f"""
    select cast(floor(doc_id / 20) as bigint) as feed_id, doc_id,
           'https://' || source || '.example/' || md5(text) as link, {_clean("text")} as title,
           timestamp '2024-01-01' + to_seconds(doc_id)
             - to_hours(if(floor(doc_id / 20) % 2 = 1, 0, 2)) as published_ts
    from documents
    qualify row_number() over (partition by feed_id, link order by doc_id) = 1"""

KEYWORD_HITS = ", ".join(
    f"regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}])({'|'.join(words)})([^\\p{{L}}\\p{{N}}]|$)') as h{i}"
    for i, words in enumerate(news.KEYWORDS.values())
)
KEYWORD_N = " + ".join(f"h{i}::int" for i in range(len(news.KEYWORDS)))
KEYWORD_CASE = "case " + " ".join(f"when h{i} then '{t}'" for i, t in enumerate(news.KEYWORDS)) + " end"

ENTRIES = {
    "src01_xml_points": (
        xml_points,
        "select doc_id, hour_utc, cast(15 as int) as mtu_minutes, price_eur_mwh from points",
    ),
    "src02_hours_from_units": (
        lambda s, d: price_documents.hours_from_units(xml_points(s, d), KEYS),
        f"""select doc_id, hour_utc, {sql.mean("price_eur_mwh")} as price_eur_mwh from points
            group by 1, 2 having count(*) = 4""",
    ),
    "src03_json_points": (json_points, "select doc_id, hour_utc, minute, price_eur_mwh from points"),
    "src04_hours_from_points": (
        lambda s, d: price_documents.hours_from_points(json_points(s, d), KEYS),
        f"""select {POINT_COLUMNS} from (
              select doc_id, hour_utc, count(*) as n, {sql.mean("price_eur_mwh")} as price_eur_mwh,
                     lag(count(*)) over w as before, lead(count(*)) over w as after
              from points group by 1, 2 window w as (partition by doc_id order by hour_utc))
            where n = 4 or (n = 1 and coalesce(before, 1) < 2 and coalesce(after, 1) < 2)""",
    ),
    "src04_hours_of_series": (
        series_hours,
        f"""select event_type, hour_utc, price_eur_mwh from (
              select event_type, date_trunc('hour', ts) as hour_utc, count(*) as n,
                     count(distinct floor(extract(minute from ts) / 15)) as marks,
                     {sql.mean("value")} as price_eur_mwh,
                     lag(count(*)) over w as before, lead(count(*)) over w as after
              from events group by 1, 2 window w as (partition by event_type order by date_trunc('hour', ts)))
            where (n = 4 and marks = 4) or (n = 1 and coalesce(before, 1) < 2 and coalesce(after, 1) < 2)""",
    ),
    "src05_station_rows": (
        station_rows,
        """select strftime(hour, '%Y-%m-%d') as doc_id, cast(260 as int) as station,
                  hour + interval 1 hour as interval_end_local, t / 10e0 as temp_c,
                  if(k < 5, null, k / 10e0) as wind_ms, greatest((k - 10) * 10000e0, 0) as radiation_jm2
           from (select date_trunc('hour', ts) as hour, floor(value) as t,
                        cast(json_extract(props, '$.k') as int) as k from events where event_type = 'click'
                 qualify row_number() over (partition by hour order by ts desc, event_id desc) = 1)""",
    ),
    "src06_grid_rows": (
        grid_rows,
        f"""select strftime(hour, '%Y-%m-%d') as doc_id, cast(0 as int) as station,
                   {sql.loc("hour + interval 1 hour")} as interval_end_local, v / 10e0 as temp_c,
                   {sql.even("k * 0.9e0 * (1e0 / 3.6e0)")} as wind_ms, k * 10e0 * 3600e0 as radiation_jm2
            from (select date_trunc('hour', ts) as hour, value as v,
                         cast(json_extract(props, '$.k') as int) as k from events where event_type = 'signup'
                  qualify row_number() over (partition by hour order by ts desc, event_id desc) = 1)
            where k >= 3""",
    ),
    "src07_decade_files": (
        decade_files,
        """select cast(260 as int) as station, o_orderdate + interval 24 hour as interval_end_local,
                  (count(*) + if(year(o_orderdate) = 1999, 1000, 0)) / 10e0 as temp_c,
                  null::double as wind_ms, null::double as radiation_jm2
           from orders group by o_orderdate""",
    ),
    "src08_feed_headlines": (
        feed_headlines,
        f"select feed_id, link, title, published_ts from ({FEED_ROWS})",
    ),
    "src09_broken_feeds": (
        broken_feeds,
        f"""select feed_id, if(feed_id % 5 = 0, 0, count(*)) as headlines, feed_id % 5 = 0 as is_broken
            from ({FEED_ROWS}) group by feed_id""",
    ),
    "src10_translated_codes": (
        lambda s, d: b.table(s, d, "customer")
        .groupBy(price_documents.translate_zone(F.col("c_mktsegment"), SEGMENTS).alias("code"))
        .agg(F.count(F.lit(1)).alias("n")),
        """select case c_mktsegment when 'BUILDING' then 'B' when 'MACHINERY' then 'M'
                  else c_mktsegment end as code, count(*) as n from customer group by 1""",
    ),
    "src11_day_chunks": (
        lambda s, d: ranges.chunk_counts(b.table(s, d, "orders"), "o_orderdate", 30),
        """select chunk_start, least(chunk_start + interval 30 day, hi) as chunk_end, n_rows from
             (select lo + to_days(cast(floor(date_diff('day', lo, o_orderdate) / 30) as int) * 30) as chunk_start,
                     any_value(hi) as hi, count(*) as n_rows
              from orders, (select min(o_orderdate) as lo, max(o_orderdate) + interval 1 day as hi from orders)
              group by 1)""",
    ),
    "src11_year_chunks": (
        lambda s, d: ranges.year_chunks(
            b.table(s, d, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")),
            "lo",
            "hi",
        ),
        """select lo, hi, greatest(make_timestamp(y, 1, 1, 0, 0, 0), lo) as chunk_start,
                  least(make_timestamp(y, 12, 31, 23, 0, 0), hi) as chunk_end
           from (select lo, hi, unnest(range(year(lo), year(hi) + 1)) as y
                 from (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders))""",
    ),
    "src12_clipped_labels": (
        clipped_labels,
        f"""select station, count(*) as n, min(interval_end_local) as first_label,
                   max(interval_end_local) as last_label from labels_raw
            where interval_end_local between timestamp '{CLIP_FROM}' - interval 1 day
              and timestamp '{CLIP_TO}' + interval 1 day group by 1""",
    ),
    "md04_staged_headlines": (
        lambda s, d: news.staged_headlines(classified(s, d), ["doc_id"]),
        """select doc_id, source, link, source || '|' || link as headline_key, title, category, confidence,
                  model, fetched_at as source_fetched_at from headlines""",
    ),
    "sf18_label_mapping": (
        lambda s, d: classified(s, d).select("doc_id", "category", "confidence", "model"),
        "select doc_id, category, confidence, model from headlines_raw",
    ),
    "ag18_topic_counts": (
        lambda s, d: news.topic_counts(news.staged_headlines(classified(s, d), ["doc_id"])),
        """select category as topic, count(*) as headlines from headlines
           where category is not null group by 1""",
    ),
    "ag18_topic_totals": (
        lambda s, d: news.topic_totals(news.staged_headlines(classified(s, d), ["doc_id"])),
        """select count(*) as total, count(*) filter (category is null) as filtered from headlines""",
    ),
    "ud03_keyword_topics": (
        keyword_topics,
        f"""select doc_id, {KEYWORD_CASE} as category,
                   if({KEYWORD_N} > 0, 1e0 / ({KEYWORD_N}), null) as confidence, 'keywords' as model
            from (select doc_id, {KEYWORD_HITS} from documents)""",
    ),
    "ud03_batch_topics": (
        batch_topics,
        """select doc_id, if(length(text) > 1000, null, 'gas') as category,
                  if(length(text) > 1000, null, 0.5e0) as confidence, 'length' as model from documents""",
    ),
    "sf14_page_titles": (
        page_titles,
        f"""select page_id, {_clean("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")} as title from pages""",
    ),
    "sf14_page_texts": (page_texts, f"select page_id, md5({_clean('html')}) as digest from pages"),
    "sf15_feed_dates": (
        mail_dates,
        """select o_orderkey, o_orderdate + interval '13 hours 30 minutes' as mail,
                  o_orderdate + interval '6 hours 30 minutes' as iso, null::timestamp as junk from orders""",
    ),
    "sf16_source_names": (
        lambda s, d: b.table(s, d, "pages").select("page_id", source_name("url").alias("source")),
        "select page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as source from pages",
    ),
}
