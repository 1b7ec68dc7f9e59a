"""Driver tables in the roles of raw prices, weather, run log and headlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.functions.exact import exact_mean
from hourmart.functions.numbers import count_if, round_scaled
from hourmart.functions.zones import hour_floor, hours
from hourmart.operators.revisions import latest_revision
from hourmart.plans.hourly import hourly_fact

# Declared, not inferred: inference would open files before every query.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "labels": "doc_id long, quality int, toxic int",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id long, url string, html string",
}
TIES = ("event_id",)
PRICE_EVENTS = {"primary": "purchase", "secondary": "view"}
WEATHER_EVENTS = {"station": ("click", 260), "reanalysis": ("signup", 0)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str, role: str, *extra: str) -> DataFrame:
    """Price revisions of one publisher."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") == PRICE_EVENTS[role])
    return events.select(
        *extra,
        hour_floor("ts").alias("hour_utc"),
        (F.col("value") - 20.0).alias("price_eur_mwh"),
        F.col("ts").alias("fetched_at"),
        "event_id",
    )


def weather(spark: SparkSession, sf_dir: str, role: str, *extra: str) -> DataFrame:
    """Weather revisions with wall-clock labels (January: UTC + 1, interval end + 1)."""
    kind, station = WEATHER_EVENTS[role]
    events = table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        *extra,
        F.lit(station).alias("station"),
        (hour_floor("ts") + hours(2)).alias("interval_end_local"),
        (F.col("value") / 10.0).alias("temp_c"),
        (k / 5.0).alias("wind_ms"),
        (k * 30000.0).alias("radiation_jm2"),
        F.col("ts").alias("fetched_at"),
        "event_id",
    )


def raw_tables(spark: SparkSession, sf_dir: str, *extra: str) -> list[DataFrame]:
    return [
        prices(spark, sf_dir, "primary", *extra),
        prices(spark, sf_dir, "secondary", *extra),
        weather(spark, sf_dir, "station", *extra),
        weather(spark, sf_dir, "reanalysis", *extra),
    ]


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_fact(*raw_tables(spark, sf_dir), ties=TIES)


def dst_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall-clock weather labels over seven years, change days included."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("station"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias(
            "interval_end_local"
        ),
        F.col("l_quantity").alias("temp_c"),
        (F.col("l_discount") * 100.0).alias("wind_ms"),
        F.col("l_extendedprice").alias("radiation_jm2"),
        (F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int"))).alias(
            "fetched_at"
        ),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
    )


LABEL_TIES = ("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per event type and day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("source"), F.col("ts").cast("date").alias("day"))
        .agg(
            F.max("ts").alias("run_at"),
            F.min("ts").alias("window_start"),
            F.max("ts").alias("window_end"),
            F.count(F.lit(1)).alias("rows_written"),
        )
        .drop("day")
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a long hourly-priced history: one row per order, dated locally."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        F.col("o_orderdate").alias("hour_local"),
        (F.col("o_totalprice") / 100.0 - 1500.0).alias("price_eur_mwh"),
    )


def order_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily averages over seven years of orders."""
    return (
        order_days(spark, sf_dir)
        .groupBy(F.col("hour_local").cast("date").alias("local_date"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            round_scaled(exact_mean("price_eur_mwh"), 2).alias("avg_price_eur_mwh"),
            count_if(F.col("price_eur_mwh") < 0).alias("negative_price_hours"),
        )
    )


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest value per quarter hour over all events."""
    quarter = F.make_dt_interval(F.lit(0), F.lit(0), (F.floor(F.minute("ts") / 15) * 15).cast("int"))
    rows = table(spark, sf_dir, "events").select(
        (hour_floor("ts") + quarter).alias("slot"), F.col("value").alias("price"), "ts", "event_id"
    )
    return latest_revision(rows, ["slot"], "ts", TIES).select("slot", "price")


def label_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier output per document: toxic means off topic."""
    topic = (
        F.when(F.col("toxic") == 1, "none of these")
        .when(F.col("quality") == 1, "renewables")
        .otherwise("gas")
    )
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        topic.alias("label"),
        ((F.col("quality") + F.col("toxic") + 1) / 4.0).alias("confidence"),
        F.lit("labels").alias("model"),
    )


def headline_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as headlines: copies of a text share a link, newer ids are newer."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.md5("text").alias("link"),
        F.col("text").alias("title"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id"))
        .cast("timestamp_ntz")
        .alias("fetched_at"),
    )
