"""Queries of what surrounds the models: rejected rows, parsed tables and windows, landing and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from adloom.plans.cm360 import KEYS as CM360_KEYS
from adloom.plans.labels import MOUNTAIN, TOURISM
from adloom.plans.runner import Run, run_model
from adloom.queries.base import Tables, as_envelope, comparable, nulls_last, query
from adloom.queries.model_queries import ADVERTISER, LATEST_FIRST, _CM_KEYS, _CM_TYPED, _cm360_streams, _label, sql_first
from adloom.sources import payloads, raw, sinks
from adloom.sources.staging import Staging
from adloom.sources.streams import ENVELOPE_STREAMS, Streams, store_parsed

# --- rows that do not parse ------------------------------------------------------

# One document per order: a bad date, a bad number, a broken document, or a good one.
_KIND = "CASE o_orderkey % 6 WHEN 0 THEN 'Date does not parse' WHEN 1 THEN 'malformed document' WHEN 2 THEN 'bad number' ELSE 'good' END"


@query(
    "bad_rows_kept",
    f"""
    SELECT CASE WHEN kind IN ('bad number', 'good') THEN 'kept' ELSE kind END AS outcome, count(*) AS n,
           CAST(sum(CASE WHEN kind = 'good' THEN o_custkey % 9 END) AS BIGINT) AS clicks
    FROM (SELECT *, {_KIND} AS kind FROM orders) o GROUP BY 1
    UNION ALL SELECT 'all', count(*), NULL FROM orders
    """,
)
def bad_rows_kept(t: Tables) -> DataFrame:
    """Kept and rejected rows add up to the input: keys that do not parse never merge rows."""
    run = Run(Streams(t.spark, given={"dv360.standard": bad_documents(t)}))
    kept = run.model("dv360_standard", TOURISM).agg(F.lit("kept").alias("outcome"), F.count("*").alias("n"), F.sum("clicks").alias("clicks"))
    rejected = run.rejects("dv360_standard", TOURISM).groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("n"))
    every = t.orders.agg(F.lit("all").alias("outcome"), F.count("*").alias("n"))
    nothing = F.lit(None).cast("bigint")
    return kept.unionByName(rejected.withColumn("clicks", nothing)).unionByName(every.withColumn("clicks", nothing))


def bad_documents(t: Tables) -> DataFrame:
    """A raw table with one document per order, as ``_KIND`` says."""
    rows = t.sql(
        f"""SELECT {_KIND} AS kind, CAST(o_orderkey AS STRING) AS id, replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '/') AS day,
            CAST(o_custkey % 9 AS STRING) AS clicks FROM {{orders}}"""
    )
    members = {
        "Date": F.when(F.col("kind") == "Date does not parse", F.replace("day", F.lit("/"), F.lit("."))).otherwise(F.col("day")),
        "Insertion Order ID": F.col("id"),
        "Clicks": F.when(F.col("kind") == "bad number", F.concat("clicks", F.lit(".5"))).otherwise(F.col("clicks")),
    }
    whole = as_envelope(rows, members | {"Creative": F.col("kind")})
    cut = F.when(F.col("data").contains("malformed"), F.substring("data", 1, 20)).otherwise(F.col("data"))
    return whole.withColumn("data", cut)


# --- parsed tables and windows -----------------------------------------------------

WINDOW_DAY = dt.date(1996, 6, 2)


def cm360_window_streams(t: Tables) -> Streams:
    """The shared report, parsed once into a table by advertiser and day of load, read with a window."""
    folder = Staging(t.spark).folder
    source = Streams(t.spark, given=_cm360_streams(t))
    wanted = payloads.CM360_ATTRIBUTES + payloads.CM360_METRICS + payloads.CM360_SITE
    store_parsed(source, "cm360.report", MOUNTAIN.name, wanted, CM360_KEYS, folder)
    return Streams(t.spark, parsed=folder, as_of=WINDOW_DAY)


@query(
    "model_cm360_window",
    f"""
    SELECT {_CM_KEYS}, CAST(clicks AS BIGINT) AS clicks, impressions, CAST(1 AS BIGINT) AS row_num FROM
    {sql_first(f"(SELECT * FROM {_CM_TYPED} y WHERE advertiser = '{ADVERTISER['mountain']}') z", _CM_KEYS, LATEST_FIRST + nulls_last("clicks", "impressions"))} p
    WHERE date >= '1996-06-01'
    """,
)
def model_cm360_window(t: Tables) -> DataFrame:
    """The days of the window come out as in a full run."""
    return comparable(run_model("cm360_serialised", _label(MOUNTAIN), cm360_window_streams(t)))


# --- landing and sinks ----------------------------------------------------------------


@query(
    "land_envelope",
    """
    SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date, count(DISTINCT o_orderpriority) AS n,
           count(DISTINCT o_orderpriority) AS total
    FROM orders GROUP BY 1
    """,
)
def land_envelope(t: Tables) -> DataFrame:
    """JSON lines land in a raw envelope table, and a model reads it from its folder."""
    folder = Staging(t.spark).folder
    lines = t.orders.select(
        F.to_json(
            F.struct(
                F.date_format("o_orderdate", "yyyyMMdd").alias("date"),
                F.col("o_orderpriority").alias("eventName"),
                F.lit("1").alias("eventCount"),
            )
        ).alias("value")
    )
    lines.write.text(f"{folder}/lines")
    raw.land_json_lines(t.spark, f"{folder}/lines", f"{folder}/raw/ga4_raw__tourism/{ENVELOPE_STREAMS['ga4.goal']}")
    goal = run_model("ga4_goal", "tourism", Streams(t.spark, root=f"{folder}/raw"))
    return comparable(goal.groupBy("date").agg(F.count_distinct("eventName").alias("n"), F.sum("eventCount").alias("total")))


@query(
    "sink_table",
    """
    SELECT event_type, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n,
           CASE WHEN event_type = 'error' THEN 'again' ELSE 'first' END AS written
    FROM events GROUP BY 1, 2
    """,
)
def sink_table(t: Tables) -> DataFrame:
    """A full refresh by partition, then one kind of event replaced."""
    path = f"{Staging(t.spark).folder}/events"
    rows = t.events.select("event_id", "event_type", F.to_date("ts").alias("day"), F.lit("first").alias("written"))
    sinks.save_path(rows, path, ["event_type", "day"])
    sinks.replace_partitions(rows.where("event_type = 'error'").withColumn("written", F.lit("again")), path, ["event_type", "day"])
    back = t.spark.read.parquet(path)
    return comparable(back.groupBy("event_type", "day", "written").agg(F.count("*").alias("n")))


@query("sink_json_lines", "SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM orders")
def sink_json_lines(t: Tables) -> DataFrame:
    path = f"{Staging(t.spark).folder}/orders"
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    sinks.save_json_lines(rows, path)
    return comparable(t.spark.read.schema(rows.schema).json(path))
