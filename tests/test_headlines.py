import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourmart.functions.text import clean_text, parse_feed_date, source_name
from hourmart.plans import headlines as news
from hourmart.sinks import tables
from hourmart.sources import feeds
from hourmart.sources.documents import quarantine
from tests.helpers import plan_of, rows, ts

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:atom="http://www.w3.org/2005/Atom"><channel><title>Feed</title>
<item><title>Wind &amp;amp; <![CDATA[<b>solar</b>]]></title><link> https://x.example/1 </link>
<pubDate>Mon, 24 Aug 2026 10:00:00 +0200</pubDate></item>
<item><title>No link</title></item>
<item><title>Again</title><link>https://x.example/1</link></item>
<item><title>Gas</title><link>https://x.example/2</link><pubDate>nonsense</pubDate></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title>
<entry><title type="html">Hydrogen  plant</title><link rel="alternate" href="https://y.example/1"/><updated>2026-08-24T08:00:00Z</updated></entry>
<entry><title>Grid</title><link href="https://y.example/2"/><published>2026-08-24T10:00:00+02:00</published></entry>
</feed>"""


def parsed(spark, *docs):
    df = spark.createDataFrame(list(docs), "source string, content string")
    return quarantine(feeds.parse_feeds(df, "content", ["source"]))


def test_rss(spark):
    good, _ = parsed(spark, ("x", RSS))
    assert rows(feeds.headlines(good, ["source"])) == [
        ("x", "https://x.example/1", "Wind & solar", ts("2026-08-24 08:00")),
        ("x", "https://x.example/2", "Gas", None),
    ]


def test_atom(spark):
    good, _ = parsed(spark, ("y", ATOM))
    assert rows(feeds.headlines(good, ["source"])) == [
        ("y", "https://y.example/1", "Hydrogen plant", ts("2026-08-24 08:00")),
        ("y", "https://y.example/2", "Grid", ts("2026-08-24 08:00")),
    ]


def test_broken_feed_is_isolated(spark):
    docs = [("x", RSS), ("bad", "<rss><channel><item>"), ("y", ATOM)]
    _, broken = parsed(spark, *docs)
    assert rows(broken, "source") == [("bad",)]
    df = spark.createDataFrame(docs, "source string, content string")
    found = feeds.headlines(feeds.parse_feeds(df, "content", ["source"]), ["source"])
    assert {r[0] for r in rows(found, "source")} == {"x", "y"}
    assert plan_of(found).count("from_xml(") == 1


@pytest.mark.parametrize(
    "text, want",
    [
        ("Mon, 24 Aug 2026 10:00:00 +0200", "2026-08-24 08:00"),
        ("24 Aug 2026 10:00:00 GMT", "2026-08-24 10:00"),
        ("Mon, 24 Aug 2026 10:00 EST", "2026-08-24 15:00"),
        ("Mon, 4 May 2026 10:00:00", "2026-05-04 10:00"),
        ("2026-08-24T08:00:00Z", "2026-08-24 08:00"),
        ("2026-08-24T10:00:00+02:00", "2026-08-24 08:00"),
        ("2026-08-24 10:00:00", "2026-08-24 10:00"),
        ("next week", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(frame, text, want):
    got = frame("d string", (text,)).select(parse_feed_date("d")).first()[0]
    assert got == (ts(want) if want else None)


DATE_PATTERNS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm")


def test_shapes_admit_all_that_the_patterns_parse(frame):
    """Odd texts give what trying every pattern gives."""
    days = ("4", "04", "+4", "-4", "31", "004")
    months = ("May", "may", "MAY", "Sept", "Sep", "May.", "M")
    years = ("2026", "+2026", "-2026", "12026", "+12026", "26")
    times = ("10:00", "10:00:00", "9:00", "10:00:60", "24:00", "10:00:00.5")
    zones = ("", " +0200", " -0330", " +02:00", " +02", " 0200", "  +0200", " +0200 ")
    texts = [f"{d} {m} {y} {t}{z}" for d in days for m in months for y in years for t in times for z in zones]
    texts += [f"Mon, {t}\n" for t in texts[:50]] + ["4  May 2026 10:00", "4 May 2026", "5-LOW", "4\tMay 2026 10:00"]
    df = frame("d string", *[(t,) for t in texts])
    bare = F.regexp_replace(F.trim("d"), r"^[A-Za-z]{3,9},?\s+", "")
    every = F.coalesce(*[F.try_to_timestamp(bare, F.lit(p)) for p in DATE_PATTERNS]).cast("timestamp_ntz")
    found = df.select("d", parse_feed_date("d").cast("string").alias("got"), every.cast("string").alias("want")).collect()
    assert [r for r in found if r["got"] != r["want"]] == []
    assert sum(r["got"] is not None for r in found) > 100


def test_no_pattern_sees_texts_of_another_shape(frame):
    """A pattern that does not fit costs an error; nearly all the time went there."""
    plan = plan_of(frame("d string", ("x",)).select(parse_feed_date("d")))
    for shape in (r":\d\d \S+$", r"\d\d:\d\d \S+$", r":\d\d:\d\d$", r" \d\d:\d\d$"):
        assert shape in plan


def test_clean_text_and_hosts(frame):
    df = frame("t string", ("  <p>A&nbsp;&amp;\n\t&eacute;</p> ",), (None,), ("a &lt;b&gt; c",))
    assert [r[0] for r in df.select(clean_text("t")).collect()] == ["A & é", "", "a <b> c"]
    urls = frame("u string", ("https://www.x.example/feed?a=1",), ("plain",))
    assert [r[0] for r in urls.select(source_name("u")).collect()] == ["www.x.example", "plain"]


def test_label_mapping(frame):
    headlines = frame("k int", (1,), (2,), (3,), (4,))
    results = frame(
        "k int, label string, confidence double, model string",
        (1, "gas", 0.9, "m"), (2, "none of these", 0.8, "m"), (3, None, 0.7, "m"),
    )
    assert rows(news.apply_labels(headlines, results, ["k"])) == [
        (1, "gas", 0.9, "m"), (2, None, None, "m"), (3, None, None, "m"), (4, None, None, None),
    ]


@pytest.mark.parametrize("batch_rows", ["2", "3", "100"])
def test_failing_classifier_leaves_its_headlines_unclassified(spark, batch_rows):
    """Only titles that fail stay unlabelled, however the rows are batched."""
    df = spark.createDataFrame([(t,) for t in "abcdefgh"], "title string").coalesce(1)

    def picky(titles: pd.Series):
        if titles.isin(["c", "f"]).any():
            raise news.ClassifierError("no answer")
        return pd.DataFrame({"label": "gas", "confidence": 0.5, "model": "m"}, index=titles.index)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        out = news.classify_batches(df, picky).select("title", *news.category_columns())
        got = {r[0]: r[1] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {t: None if t in "cf" else "gas" for t in "abcdefgh"}


def test_other_faults_of_a_classifier_are_not_hidden(spark):
    df = spark.createDataFrame([("a",)], "title string")
    with pytest.raises(Exception, match="KeyError"):
        news.classify_batches(df, lambda titles: {}["label"]).collect()


def test_keyword_labels(frame):
    df = frame("t string", ("New WIND park",), ("Gas and hydrogen",), ("Windows update",), ("windé",))
    got = [tuple(r)[1:] for r in news.classify_by_keywords(df, "t").collect()]
    assert got == [
        ("renewables", 1.0, "keywords"),
        ("hydrogen", 0.5, "keywords"),
        ("none of these", None, "keywords"),
        ("none of these", None, "keywords"),
    ]
    assert set(news.KEYWORDS) < set(news.TOPICS)


def test_fetching_again_replaces_a_headline(spark, tmp_path):
    path = str(tmp_path / "h")
    schema = "source string, link string, category string, fetched_at timestamp_ntz"
    for category in (None, "gas"):
        df = spark.createDataFrame([("x", "l", category, ts("2026-01-01"))], schema)
        tables.upsert_table(spark, path, df, ["source", "link"], "feed", F.col("source"), "fetched_at")
    staged = news.staged_headlines(spark.read.parquet(path))
    assert rows(staged, "headline_key", "category") == [("x|l", "gas")]
    assert rows(news.topic_counts(staged)) == [("gas", 1)]
    assert rows(news.topic_totals(staged)) == [(1, 0)]
