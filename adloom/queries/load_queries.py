"""Queries of tables that grow load by load: winners, sums, spellings, landing, parsed tables and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from adloom.functions.names import initcap_punct
from adloom.operators.arrays import distinct_array
from adloom.operators.canonical import SpellingTable
from adloom.operators.classify import classify_by_map
from adloom.operators.envelope import Field, as_variant, fields, json_member, parse_envelope, rejects
from adloom.operators.latest import LatestTable, Sums
from adloom.plans import rules
from adloom.plans.facebook import facebook_labels
from adloom.plans.labels import MOUNTAIN, TOURISM
from adloom.plans.runner import run_model
from adloom.queries.base import Tables, comparable, query
from adloom.queries.model_queries import _SQL_TIKTOK, _facebook_streams, _sql_facebook, _tiktok_streams
from adloom.queries.operator_queries import _CHANNEL_ROWS, _SPELLED, sql_channel, sql_ga4_publisher
from adloom.queries.run_queries import _KIND, bad_documents
from adloom.sources import payloads, raw, sinks
from adloom.sources.staging import Staging, stage
from adloom.sources.streams import Streams, store_bucketed, store_parsed, stored_counts

# --- winners and sums ----------------------------------------------------------------

# Three loads of all events: late rows in each, and some events once more, corrected, in the last.
_EVENT_LOADS = """
    SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, value,
           CASE WHEN event_id % 10 < 5 THEN 1 WHEN event_id % 10 < 8 THEN 2 ELSE 3 END AS load
    FROM {events}
    UNION ALL
    SELECT event_id, user_id, event_type, CAST(ts AS DATE), value + 1000, 3 FROM {events} WHERE event_id % 50 = 0
"""


@query(
    "pick_one_incremental",
    f"""
    SELECT user_id, event_type, strftime(day, '%Y-%m-%d') AS day, event_id, round(value, 2) AS value, load
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY load DESC, value DESC NULLS LAST, event_id) AS n
          FROM ({_EVENT_LOADS}) l) r
    WHERE n = 1
    """,
)
def pick_one_incremental(t: Tables) -> DataFrame:
    """The latest event per user, type and day, kept over three loads, is that of all rows at once."""
    every = t.sql(_EVENT_LOADS)
    keys = ["user_id", "event_type", "day"]
    table = LatestTable(t.spark, Staging(t.spark).folder, keys, ["load", "value"], "day")
    for load in (1, 2, 3):
        table.load(every.where(F.col("load") == load))
    return comparable(table.rows(every.schema).select(*keys, "event_id", "value", "load"))


# Two loads of all order lines, then corrections that change amounts and move lines to another flag.
_LINE_LOADS = """
    SELECT l_orderkey, l_linenumber, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS day, l_returnflag, l_linestatus, l_quantity, l_extendedprice,
           1 + l_orderkey % 2 AS load
    FROM {lineitem}
    UNION ALL
    SELECT l_orderkey, l_linenumber, CAST(date_trunc('quarter', l_shipdate) AS DATE), CASE l_returnflag WHEN 'A' THEN 'R' ELSE l_returnflag END,
           l_linestatus, l_quantity + 3, l_extendedprice - 1.25, 3
    FROM {lineitem} WHERE l_orderkey % 20 = 0
"""


@query(
    "sums_incremental",
    f"""
    SELECT strftime(day, '%Y-%m-%d') AS day, l_returnflag, l_linestatus, count(*) AS n,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS l_quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, day
                                       ORDER BY load DESC, l_returnflag, l_linestatus, l_quantity, l_extendedprice) AS n
          FROM ({_LINE_LOADS}) l) r
    WHERE n = 1 GROUP BY day, l_returnflag, l_linestatus
    """,
)
def sums_incremental(t: Tables) -> DataFrame:
    """Sums corrected by replaced rows equal those computed again from all winners."""
    every = t.sql(_LINE_LOADS)
    sums = {"by_flag": Sums(("l_returnflag", "l_linestatus"), {"l_quantity": "bigint", "l_extendedprice": "decimal(18,2)"})}
    table = LatestTable(t.spark, Staging(t.spark).folder, ["l_orderkey", "l_linenumber", "day"], ["load"], "day", sums)
    for load in (1, 2, 3):
        table.load(every.where(F.col("load") == load))
    found = table.summed("by_flag", every.schema)
    return comparable(found.withColumn("l_extendedprice", F.col("l_extendedprice").cast("double")))


# --- spellings as state ----------------------------------------------------------------

_SPELLED_DAYS = f"SELECT s.event_id, s.spelled, CAST(e.ts AS DATE) AS day FROM ({_SPELLED}) s JOIN {{events}} e ON s.event_id = e.event_id"


@query(
    "spelling_incremental",
    f"""
    WITH e AS ({_SPELLED_DAYS}), m AS (SELECT lower(spelled) AS k, min(spelled) AS s FROM e GROUP BY 1)
    SELECT event_id, strftime(day, '%Y-%m-%d') AS day, spelled, s AS canonical FROM e LEFT JOIN m ON lower(spelled) = k
    """,
)
def spelling_incremental(t: Tables) -> DataFrame:
    """Days loaded one third after the other get the spellings that all rows at once would get."""
    every = t.sql(_SPELLED_DAYS)
    table = SpellingTable(t.spark, Staging(t.spark).folder, "spelled", "canonical", "day")
    for third in range(3):
        table.load(every.where(F.dayofmonth("day") % 3 == third))
    return comparable(table.rows(every.schema))


# --- landing ---------------------------------------------------------------------------


@query("land_once", "SELECT o_orderstatus AS status, count(*) AS n, count(*) AS documents, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def land_once(t: Tables) -> DataFrame:
    """Each file lands once: a run, a file more, a run, and a run with nothing new."""
    folder = Staging(t.spark).folder
    lines = t.orders.select("o_orderkey", F.to_json(F.struct("o_orderkey", F.col("o_orderstatus").alias("status"))).alias("value"))
    for part in (0, 1, None):
        if part is not None:
            lines.where(F.col("o_orderkey") % 2 == part).select("value").write.mode("append").text(f"{folder}/lines")
        raw.land_files(t.spark, f"{folder}/lines", f"{folder}/raw", f"{folder}/log")
    landed = raw.read_envelope(t.spark, f"{folder}/raw")
    parsed = parse_envelope(landed, [*fields("long", o_orderkey="o_orderkey"), *fields(status="status")])
    found = parsed.groupBy("status").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
    documents = landed.groupBy(json_member("data", "status").alias("status")).agg(F.count("*").alias("documents"))
    return found.join(documents, "status")


# Orders and events as documents; every ninth order is cut off, and every seventh event is no object.
_DOCUMENTS_SQL = """
    SELECT 'order' AS kind, CASE WHEN o_orderkey % 9 = 0 THEN 'malformed document' END AS reason,
           CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey END AS id,
           CASE WHEN o_orderkey % 9 <> 0 THEN round(o_totalprice, 2) END AS price,
           CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
           CASE WHEN o_orderkey % 9 <> 0 THEN '[' || o_orderstatus || '] kept' END AS note,
           CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS second
    FROM orders
    UNION ALL
    SELECT 'event', CASE WHEN event_id % 7 = 0 THEN 'malformed document' WHEN event_id % 7 = 1 THEN 'no document' END,
           CASE WHEN event_id % 7 > 1 THEN event_id END, CASE WHEN event_id % 7 > 1 THEN round(value, 2) END,
           CASE WHEN event_id % 7 > 1 THEN strftime(ts, '%Y-%m-%d') END, CASE WHEN event_id % 7 > 1 THEN event_type END, NULL
    FROM events
"""

_DOCUMENT_FIELDS = [
    Field("id", "id", "long"),
    Field("Price % net", "price", "double"),
    Field("Day", "day", "iso_text:year_first_slash"),
    *fields(note="note", details="details"),
    Field("parts", "parts", "json:array<struct<name:string>>"),
]


def _documents(t: Tables) -> DataFrame:
    whole = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("string").alias("Price % net"), F.date_format("o_orderdate", "yyyy/MM/dd").alias("Day"),
        F.concat(F.lit("["), "o_orderstatus", F.lit("] kept")).alias("note"), F.struct("o_orderkey").alias("details"),
        F.array(F.struct(F.lit("first").alias("name")), F.struct(F.col("o_orderpriority").alias("name"))).alias("parts"),
    )
    text = F.to_json(whole)
    orders = t.orders.select(F.lit("order").alias("kind"), F.when(F.col("o_orderkey") % 9 == 0, F.substring(text, 1, 30)).otherwise(text).alias("data"))
    text = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("value").alias("Price % net"), F.date_format("ts", "yyyy/MM/dd").alias("Day"), F.col("event_type").alias("note")))
    odd = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("["), text, F.lit("]"))).when(F.col("event_id") % 7 > 1, text)
    return stage(orders.unionByName(t.events.select(F.lit("event").alias("kind"), odd.alias("data"))), "documents")


def _read_documents(raw_rows: DataFrame) -> DataFrame:
    found = parse_envelope(raw_rows, _DOCUMENT_FIELDS, keep=["kind"]).where("details IS NULL")
    good = found.select("kind", F.lit(None).cast("string").alias("reason"), "id", F.round("price", 2).alias("price"), "day", "note", F.get("parts", 1)["name"].alias("second"))
    bad = rejects(raw_rows, _DOCUMENT_FIELDS, keep=["kind"]).select("kind", "reason")
    return good.unionByName(bad, allowMissingColumns=True)


@query("variant_envelope", _DOCUMENTS_SQL)
def variant_envelope(t: Tables) -> DataFrame:
    """Documents parsed once into VARIANT and stored give the same members and rejects as their texts."""
    return _read_documents(stage(as_variant(_documents(t)), "variants"))


@query("variant_as_text", _DOCUMENTS_SQL)
def variant_as_text(t: Tables) -> DataFrame:
    """The same documents, read from their texts."""
    return _read_documents(_documents(t))


# --- parsed tables -----------------------------------------------------------------------


def bucketed_tiktok(t: Tables) -> Streams:
    """Parsed daily metrics in buckets of their key."""
    given = _tiktok_streams(t)
    folder = Staging(t.spark).folder
    source = Streams(t.spark, given=given)
    for name, wanted in (("tiktok.basic", payloads.TIKTOK_BASIC), ("tiktok.video", payloads.TIKTOK_VIDEO)):
        store_parsed(source, name, "mountain", wanted, ["ad_id", "date"], folder)
        store_bucketed(source, name, "mountain", ["ad_id", "date"], folder)
    store_parsed(source, "tiktok.ads", "mountain", payloads.TIKTOK_ADS, [], folder)
    return Streams(t.spark, parsed=folder)


@query("pick_bucketed", _SQL_TIKTOK)
def pick_bucketed(t: Tables) -> DataFrame:
    """The model over bucketed tables: its picks, join and sums need no exchange of facts."""
    return comparable(run_model("tiktok", "mountain", bucketed_tiktok(t)))


@query(
    "bad_rows_one_pass",
    f"""
    SELECT CASE WHEN kind IN ('bad number', 'good') THEN 'kept' ELSE kind END AS outcome, count(*) AS n,
           CAST(sum(CASE WHEN kind = 'good' THEN o_custkey % 9 END) AS BIGINT) AS clicks
    FROM (SELECT *, {_KIND} AS kind FROM orders) o GROUP BY 1
    UNION ALL SELECT 'counted', count(*), CAST(sum(CASE WHEN o_orderkey % 6 IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) FROM orders
    """,
)
def bad_rows_one_pass(t: Tables) -> DataFrame:
    """One parse writes kept and rejected rows; what was counted on the way adds up to the input."""
    folder = Staging(t.spark).folder
    streams = Streams(t.spark, given={"dv360.standard": bad_documents(t)})
    bad = store_parsed(streams, "dv360.standard", "tourism", payloads.DV360_STANDARD, ["date", "campaign_id", "line_item_id", "creative_name"], folder)
    kept = Streams(t.spark, parsed=folder).rows("dv360.standard", "tourism", payloads.DV360_STANDARD)
    counts = stored_counts[f"{folder}/dv360.standard__tourism"]
    nothing = F.lit(None).cast("bigint")
    rows = kept.agg(F.lit("kept").alias("outcome"), F.count("*").alias("n"), F.sum("clicks").alias("clicks"))
    rows = rows.unionByName(bad.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("n")).withColumn("clicks", nothing))
    total = [("counted", counts["kept"] + counts["rejected"], counts["rejected"])]
    return rows.unionByName(t.spark.createDataFrame(total, rows.schema))


# --- distinct values -----------------------------------------------------------------------


@query("classify_channel_by_map", f"SELECT event_id, {sql_channel('site_name')} AS channel FROM ({_CHANNEL_ROWS}) r")
def classify_channel_by_map(t: Tables) -> DataFrame:
    """Rules tried once per distinct site name."""
    rows = t.sql(_CHANNEL_ROWS)
    return classify_by_map(rows, "channel", rules.GA4_CHANNEL, rules.GA4_CHANNEL_DEFAULT).select("event_id", "channel")


@query(
    "classify_publisher_by_map",
    f"SELECT event_id, {sql_ga4_publisher('source', 'site_name', 'c', 'ac')} AS publisher FROM ({_CHANNEL_ROWS}) r",
)
def classify_publisher_by_map(t: Tables) -> DataFrame:
    """Rules over four columns, tried once per distinct tuple, NULLs among them."""
    names = {"source": "sessionSourceMedium", "c": "sessionCampaignName", "ac": "sessionManualAdContent"}
    rows = t.sql(_CHANNEL_ROWS).withColumnsRenamed(names)
    fallback = initcap_punct(F.col("sessionSourceMedium"))
    return classify_by_map(rows, "publisher", rules.GA4_PUBLISHER, fallback, ["sessionSourceMedium"]).select("event_id", "publisher")


@query(
    "distinct_arrays",
    """
    SELECT CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_suppkey END AS supplier,
           array_to_string(coalesce(list_sort(list(DISTINCT l_returnflag || l_linestatus)), []), '|') AS flags,
           array_to_string(coalesce(list_sort(list(DISTINCT CASE WHEN l_linenumber > 3 THEN l_linenumber END)
             FILTER (l_linenumber > 3)), []), '|') AS numbers,
           array_to_string(coalesce(list_sort(list(DISTINCT CAST(l_quantity AS BIGINT))), []), '|') AS quantities
    FROM lineitem GROUP BY 1
    """,
)
def distinct_arrays(t: Tables) -> DataFrame:
    """Three columns of all lines, collected in one scan."""
    rows = t.lineitem.select(
        F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey")).alias("supplier"),
        F.concat("l_returnflag", "l_linestatus").alias("flags"),
        F.when(F.col("l_linenumber") > 3, F.col("l_linenumber")).alias("numbers"),
        F.col("l_quantity").cast("bigint").alias("quantities"),
    )
    return comparable(distinct_array(rows, ["supplier"], ["flags", "numbers", "quantities"]))


# --- reports and tables ----------------------------------------------------------------------

_REPORT = ["Order ID", "Status", "Comment", "Total (net)"]


@query(
    "report_csv",
    """
    SELECT o_orderkey AS id, o_orderstatus AS status, 'said "' || o_orderpriority || '",' || chr(10) || 'then left' AS comment,
           round(o_totalprice, 2) AS total, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS n
    FROM orders WHERE o_orderkey % 8 > 1
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, CASE o_orderkey % 8 WHEN 0 THEN 'header: Status, Order ID, Comment, Total (net)' ELSE 'row does not fit the header' END,
           count(*) FROM orders WHERE o_orderkey % 8 <= 1 GROUP BY 5
    """,
)
def report_csv(t: Tables) -> DataFrame:
    """Report files with quoted line breaks; one export has its columns in another order, and some rows have too few."""
    folder = Staging(t.spark).folder
    comment = F.concat(F.lit('said "'), "o_orderpriority", F.lit('",\nthen left'))
    rows = t.orders.select(
        F.col("o_orderkey").alias("Order ID"), F.col("o_orderstatus").alias("Status"), comment.alias("Comment"), F.round("o_totalprice", 2).alias("Total (net)")
    )
    group = F.col("Order ID") % 8
    options = {"header": True, "escape": '"', "quoteAll": True}
    rows.where(group > 1).repartition(4).write.options(**options).csv(f"{folder}/reports")
    rows.where(group == 0).select("Status", "Order ID", "Comment", "Total (net)").write.mode("append").options(**options).csv(f"{folder}/reports")
    cut = rows.where(group == 1).select(F.concat_ws(",", "Order ID", "Status").alias("value"))
    header = t.spark.createDataFrame([(",".join(_REPORT),)], "value string")
    short = cut.select(F.lit(1).alias("o"), "value").unionByName(header.select(F.lit(0).alias("o"), "value"))
    short.coalesce(1).sortWithinPartitions("o").select("value").write.mode("append").text(f"{folder}/reports")
    good, bad = raw.read_report(t.spark, f"{folder}/reports", _REPORT)
    kept = good.select(
        F.col("Order ID").cast("bigint").alias("id"), F.col("Status").alias("status"), F.col("Comment").alias("comment"), F.col("Total (net)").cast("double").alias("total")
    )
    return kept.unionByName(bad.groupBy("reason").agg(F.count("*").alias("n")), allowMissingColumns=True)


@query(
    "sink_catalogue_table",
    """
    SELECT event_type, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 2) AS value
    FROM events GROUP BY 1, 2
    """,
)
def sink_catalogue_table(t: Tables) -> DataFrame:
    """A full refresh of a catalogue table, twice: the second takes the place of the first."""
    name = f"adloom_events_{uuid.uuid4().hex[:12]}"
    rows = t.events.select("event_type", F.to_date("ts").alias("day"), "value")
    sinks.save_table(rows.where("value > 50"), name, ["event_type"])
    sinks.save_table(rows, name, ["event_type"])
    return comparable(t.spark.table(name).groupBy("event_type", "day").agg(F.count("*").alias("n"), F.sum("value").alias("value")))


# --- labels ------------------------------------------------------------------------------------

_ALL_LABELS = " UNION ALL ".join(f"SELECT '{label.name}' AS label, * FROM ({_sql_facebook(label)}) {label.name}" for label in (TOURISM, MOUNTAIN))


@query("labels_facebook", _ALL_LABELS)
def labels_facebook(t: Tables) -> DataFrame:
    """Both labels in one plan, with one scan per stream, equal both runs of their own."""
    # Rows dealt by ad alone stay as they are for joins on label and ad.
    t = t.wide(**{"spark.sql.requireAllClusterKeysForCoPartition": "false"})
    by_label = {name: both_labels(rows) for name, rows in _facebook_streams(t, "zstd").items()}
    model = facebook_labels(Streams(t.spark, given=by_label), (TOURISM, MOUNTAIN))
    return comparable(model).withColumn("device_platforms", F.coalesce("device_platforms", F.lit("")))


def both_labels(rows: DataFrame) -> DataFrame:
    return rows.withColumn("label", F.explode(F.array(F.lit(TOURISM.name), F.lit(MOUNTAIN.name))))
