"""Headlines: classification, label mapping, staging and topic counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.functions.numbers import count_if
from hourmart.operators.revisions import latest_revision

OFF_TOPIC = "none of these"

# The topic labels.
TOPICS = (
    "grid and infrastructure", "policy and regulation", "power prices and markets", "gas",
    "renewables", "batteries and storage", "hydrogen", "companies and projects", "weather",
    OFF_TOPIC,
)

# Words of the built-in classifier; whole words, any case.
KEYWORDS = {
    "hydrogen": ("hydrogen", "electrolyser", "waterstof", "wasserstoff"),
    "batteries and storage": ("battery", "batteries", "storage", "batterij", "speicher"),
    "renewables": ("solar", "wind", "renewable", "zon", "zonnepanelen", "windpark"),
    "gas": ("gas", "lng", "aardgas", "erdgas"),
    "grid and infrastructure": ("grid", "network", "congestion", "stroomnet", "netz"),
    "power prices and markets": ("price", "prices", "market", "prijs", "markt", "strom"),
    "policy and regulation": ("policy", "law", "subsidy", "minister", "wet", "gesetz"),
    "companies and projects": ("project", "company", "contract", "bedrijf", "projekt"),
    "weather": ("weather", "storm", "heat", "weer", "wetter"),
}


def _words(words: Sequence[str]) -> Column:
    return F.array(*map(F.lit, words))


def keyword_hits(title: Column) -> Column:
    """The keywords that occur in a text, each once: one pass over its words,
    whatever the number of topics."""
    known = [w for words in KEYWORDS.values() for w in words]
    return F.array_intersect(F.split(F.lower(title), r"[^\p{L}\p{N}]+"), _words(known))


def keyword_labels(hits: Column) -> Column:
    """Struct (label, confidence, model) from ``keyword_hits``: the first topic
    with a word, in the order of ``KEYWORDS``; confidence falls with rival topics."""
    label, n = F.lit(OFF_TOPIC), F.lit(0)
    for topic, words in reversed(KEYWORDS.items()):
        hit = F.arrays_overlap(hits, _words(words))
        label = F.when(hit, topic).otherwise(label)
        n = n + hit.cast("int")
    return F.struct(
        label.alias("label"),
        F.when(n > 0, F.lit(1.0) / n).alias("confidence"),
        F.lit("keywords").alias("model"),
    )


def classify_by_keywords(headlines: DataFrame, title: str = "title") -> DataFrame:
    """Add label, confidence and model from the built-in keywords."""
    hits = headlines.withColumn("__hits", keyword_hits(F.col(title)))
    labelled = hits.withColumn("__r", keyword_labels(F.col("__hits")))
    return labelled.select(*headlines.columns, "__r.*")


class ClassifierError(RuntimeError):
    """A classifier's answer cannot be used for some of the titles."""


def classify_batches(
    headlines: DataFrame,
    classifier: Callable,
    title: str = "title",
    failures: tuple[type[Exception], ...] = (ClassifierError,),
) -> DataFrame:
    """Classify with any function of a pandas Series of titles that returns the
    columns label, confidence and model.

    A batch that it fails on with one of ``failures`` is asked title by title, and
    titles that it fails on stay unlabelled: the result does not depend on the size
    of batches.  Any other error fails the job.
    """
    schema = headlines.select("*").schema.add("label", "string").add("confidence", "double").add(
        "model", "string"
    )

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for part in labelled(batch):
                yield part

    def labelled(batch):  # noqa: ANN001, ANN202
        try:
            result = classifier(batch[title])
            yield batch.assign(**{c: result[c].to_numpy() for c in ("label", "confidence", "model")})
        except failures:
            if len(batch) > 1:
                for k in range(len(batch)):
                    yield from labelled(batch.iloc[k : k + 1])
            else:
                yield batch.assign(label=None, confidence=None, model=None)

    return headlines.mapInPandas(run, schema)


def category_columns() -> list[Column]:
    """Map (label, confidence, model): off-topic and missing labels become NULL,
    together with their confidence; the model name is kept."""
    on_topic = F.col("label").isNotNull() & (F.col("label") != OFF_TOPIC)
    return [
        F.when(on_topic, F.col("label")).alias("category"),
        F.when(on_topic, F.col("confidence")).alias("confidence"),
        F.col("model"),
    ]


def apply_labels(headlines: DataFrame, results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join classifier results; headlines without one stay unclassified."""
    joined = headlines.join(results, list(keys), "left")
    return joined.select(*[F.col(c) for c in headlines.columns], *category_columns())


def staged_headlines(raw: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Newest revision per (source, link) with its combined key."""
    rows = latest_revision(raw, ["source", "link"], "fetched_at", ties)
    return rows.withColumn(
        "headline_key", F.concat("source", F.lit("|"), "link")
    ).withColumnRenamed("fetched_at", "source_fetched_at")


def topic_counts(staged: DataFrame) -> DataFrame:
    """Headlines per topic, most frequent first."""
    return (
        staged.where(F.col("category").isNotNull())
        .groupBy(F.col("category").alias("topic"))
        .agg(F.count(F.lit(1)).alias("headlines"))
        .orderBy(F.col("headlines").desc(), "topic")
    )


def topic_totals(staged: DataFrame) -> DataFrame:
    """All headlines and those without a topic."""
    return staged.agg(
        F.count(F.lit(1)).alias("total"), count_if(F.col("category").isNull()).alias("filtered")
    )
