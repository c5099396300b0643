"""Plans of the models that must not grow faster than their input."""

import datetime as dt
from dataclasses import replace
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import DataFrameWriter, functions as F

from adloom.functions import casts
from adloom.operators import latest
from adloom.operators.arrays import order_text
from adloom.operators.envelope import fields, parse_envelope, rejects
from adloom.operators.latest import LatestTable
from adloom.plans import google_ads
from adloom.plans.labels import MOUNTAIN, TOURISM
from adloom.plans.runner import run_model
from adloom.queries import base, load_queries, model_queries
from adloom.session import METHOD_BYTES
from adloom.sources import payloads, sinks
from adloom.sources.staging import Staging, shared_folder, stage
from adloom.sources.streams import Streams
from test_models import INSIGHT, facebook_streams


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def google(spark):
    day = dt.date(2024, 5, 1)
    stats = spark.createDataFrame(
        [(1, 10, g, c, day, 1.0, 2.0, 3_000_000, 4, 5, 6) for g in (5, 6) for c in (7, 8)],
        "customer_id bigint, ad_group_ad_ad_id bigint, ad_group_id bigint, campaign_id bigint, _DATA_DATE date, metrics_conversions_value double, "
        "metrics_conversions double, metrics_cost_micros bigint, metrics_clicks bigint, metrics_impressions bigint, metrics_interactions bigint",
    )
    versions = [(1, c, f"n_{v}", str(v % 3), "ENABLED", dt.date(2024, 1, 1 + v % 2)) for c in (7, 8) for v in range(20)]
    return {
        "google_ads.ad": spark.createDataFrame(
            [(1, 10, f"a{v % 2}", f"u{9 - v}") for v in range(10)],
            "customer_id bigint, ad_group_ad_ad_id bigint, ad_group_ad_ad_name string, ad_group_ad_ad_final_urls string",
        ),
        "google_ads.campaign": spark.createDataFrame(
            versions, "customer_id bigint, campaign_id bigint, campaign_name string, campaign_campaign_budget string, campaign_status string, _LATEST_DATE date"
        ),
        "google_ads.ad_group": spark.createDataFrame([(1, 5, "x"), (1, 6, "y")], "customer_id bigint, ad_group_id bigint, ad_group_name string"),
        "google_ads.ad_stats": stats,
        "google_ads.campaign_stats": stats,
    }


def test_versions_of_ads_and_campaigns_do_not_repeat_the_stats(spark, monkeypatch):
    seen, pick = [], google_ads.pick_one

    def counted(df, keys, *args, **named):
        seen.append((keys, df))
        return pick(df, keys, *args, **named)

    monkeypatch.setattr(google_ads, "pick_one", counted)
    label = TOURISM.with_accounts(display_customer_id=1, search_customer_id=1)
    display = run_model("google_ads_display", label, Streams(spark, given=google(spark)))
    got = display.select("ad_name", "ad_group_name", "click_url", "clicks", "_LATEST_DATE", "campaign_external_id", "campaign_budget", "campaign_name")
    assert [tuple(r) for r in got.collect()] == [(["a0"], ["x"], "u1", 4, dt.date(2024, 1, 1), 7, "0", "n_0")]
    assert {tuple(k): df.count() for k, df in seen}["ad_id", "date"] == 4  # one row for each group and campaign, not 400 x 4
    search = run_model("google_ads_search", label, Streams(spark, given=google(spark)))
    assert [tuple(r) for r in search.select("campaign_id", "clicks", "campaign_name").orderBy("campaign_id").collect()] == [(7, 8, "n_0"), (8, 8, "n_0")]
    assert {tuple(k): df.count() for k, df in seen}["date", "campaign_id"] == 2


def test_rows_that_many_tasks_read_are_staged_without_a_shuffle(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(base, "stage", lambda df, *_: staged.append(df) or df)
    base.as_envelope(spark.range(0, 1000, 1, 8), {"id": "id"})
    base.as_envelope(spark.range(0, 1000, 1, 1), {"id": "id"})
    assert [plan(df).count("Exchange") for df in staged] == [0, 1]
    assert [df.count() for df in staged] == [1000, 1000]


def test_both_labels_share_the_stored_rows(spark, data, monkeypatch):
    def no_copy(df, name, *_):
        raise AssertionError(name)

    monkeypatch.setattr(load_queries, "stage", no_copy)
    assert load_queries.labels_facebook(base.Tables(spark, data)).columns[0] == "label"


def test_facebook_stats_are_dealt_once_after_the_pick(spark):
    model = run_model("facebook", "tourism", facebook_streams(spark, INSIGHT))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = [line for line in plan(model).splitlines() if "Exchange" in line and "date_start" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("account_id" in line for line in dealt), dealt


def test_a_load_picks_its_winners_once(spark, monkeypatch):
    calls, pick = [], latest.pick_one
    monkeypatch.setattr(latest, "pick_one", lambda *a, **k: calls.append(a[1]) or pick(*a, **k))
    table = LatestTable(spark, Staging(spark).folder, ["k", "day"], ["load"], "day")
    rows = spark.createDataFrame([(1, dt.date(2024, 5, 1), 1, "a"), (1, dt.date(2024, 5, 1), 2, "b")], "k int, day date, load int, v string")
    table.load(rows)
    assert len(calls) == 1
    assert [r.v for r in table.rows(rows.schema).select(F.col("v")).collect()] == ["b"]


def test_buckets_of_parsed_facts_are_not_held_to_a_few_tasks(spark, data, monkeypatch):
    seen = []
    monkeypatch.setattr(load_queries, "store_bucketed", lambda *a, **named: seen.append(named))
    load_queries.bucketed_tiktok(base.Tables(spark, data))
    assert seen == [{}, {}]


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {f for d in dirs for f in Path(d).rglob("shuffle_*.data")}

    before = shuffled()
    stored = stage(spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffled() <= before
    assert stored.count() == 7


def test_media_sources_are_stored_and_freed_one_after_the_other(spark, data):
    label = replace(MOUNTAIN, media_sources=("tiktok", "hivestack"))
    streams = model_queries._media_streams(base.Tables(spark, data), label)
    rows, stored = streams.given, []

    def store(df, name):
        stored.append((name, [*rows.made]))
        return stage(df, name)

    table = run_model("dash_table", label, streams, store=store)
    assert stored == [("facts_tiktok", ["tiktok"]), ("facts_hivestack", ["hivestack"]), ("spellings", [])]
    assert {r.publisher for r in table.select("publisher").distinct().collect()} == {"Tiktok", "Hivestack"}


def test_freed_raw_rows_leave_nothing_behind(spark, data):
    streams = model_queries._media_streams(base.Tables(spark, data), MOUNTAIN)
    folder = Path(shared_folder(spark).removeprefix("file://")) / "adloom"
    before = {*folder.iterdir()}
    streams.read("hivestack.report", "mountain").count()
    assert len({*folder.iterdir()} - before) == 1
    streams.done("hivestack")
    assert {*folder.iterdir()} == before


def test_tiktok_days_are_not_summed_again(spark, data):
    model = run_model("tiktok", "mountain", Streams(spark, given=model_queries._tiktok_streams(base.Tables(spark, data))))
    sums = [line for line in plan(model).splitlines() if "Aggregate" in line and "sum(" in line]
    assert not sums, sums


def test_partitions_are_written_without_a_sort_of_their_rows(spark, tmp_path, monkeypatch):
    key, write, seen = "spark.sql.maxConcurrentOutputFileWriters", DataFrameWriter.parquet, []
    before = spark.conf.get(key)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: seen.append(spark.conf.get(key)) or write(self, *a, **k))
    days = 3 * sinks.OPEN_FILES  # more than a task keeps open: the rest goes sorted
    rows = spark.range(0, 1000, 1, 4).withColumn("day", F.when(F.col("id") % 5 > 0, F.col("id") % days))
    sinks.replace_partitions(rows, str(tmp_path / "days"), ["day"])
    sinks.replace_partitions(rows.where("day = 1").withColumn("id", -F.col("id")), str(tmp_path / "days"), ["day"])
    assert [int(s) > 0 for s in seen] == [True, True] and spark.conf.get(key) == before
    found = sorted((r.id, r.day) for r in spark.read.parquet(str(tmp_path / "days")).collect() if r.day is not None)
    assert found == sorted((-i if i % days == 1 else i, i % days) for i in range(1000) if i % 5)
    assert spark.read.parquet(str(tmp_path / "days")).where("day IS NULL").count() == 200


def test_numbers_are_read_without_a_look_at_their_type(spark):
    rows = spark.createDataFrame([('{"d": "1.5", "c": "1,5", "p": "2%"}',)], "data string")
    wanted = [*fields("double", d="d"), *fields("decimal_comma", c="c"), *fields("percent", p="p")]
    assert plan(parse_envelope(rows, wanted)).count("schemaOfVariant") == 0
    assert plan(parse_envelope(rows, wanted, keys=["d"])).count("schemaOfVariant") > 0
    assert parse_envelope(rows, wanted).collect() == [(1.5, 1.5, 2.0)]


def test_numbers_are_read_as_before(spark):
    texts = ["1", "1.5", "12d", "12D", "12f", "12F ", "12d\t", "12d\n", "12d\u0085", "12d\x01", "12 ", "", "inf", "-Infinity", "NaN", "5.", "5.d", "d", "0x1fp3", "0x1p1f", "1e5f", "1,5", "[1", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    before = F.when(~F.col("t").rlike(r"[0-9.][dDfF]\s*$"), F.col("t").try_cast("double"))
    assert [r for r in rows.select("t", before.alias("a"), casts.to_double(F.col("t")).alias("b")).collect() if repr(r.a) != repr(r.b)] == []


def test_a_container_is_no_number_and_no_bad_key(spark):
    wanted = [*fields("long", k="k", n="n"), *fields("double", d="d"), *fields("date:iso", day="day"), *fields("percent", p="p"), *fields(t="t")]
    texts = ['{"k": 1, "n": [1], "d": {"a": 1}, "day": ["2024-01-01"], "p": "[1%", "t": "[x"}', '{"k": [1], "n": 2}', '{"k": "[1", "n": 3}', '{"k": "{", "t": {}}']
    rows = spark.createDataFrame([(t,) for t in texts], "data string")
    kept = parse_envelope(rows, wanted, keys=["k"])
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, None, None, None, None, "[x"), (None, 2, None, None, None, None)]
    assert [r.data for r in rejects(rows, wanted, keys=["k"]).collect()] == texts[2:]


def test_wide_models_run_in_a_session_of_their_own(spark, data):
    limit, key = "spark.sql.codegen.hugeMethodLimit", "spark.sql.shuffle.partitions"
    before = spark.conf.get(limit)
    spark.conf.set(key, "7")
    try:
        model = model_queries.model_ttd_serialised(base.Tables(spark, data))
    finally:
        spark.conf.set(key, "4")
    assert int(model.sparkSession.conf.get(limit)) == METHOD_BYTES and model.sparkSession.conf.get(key) == "7"
    assert spark.conf.get(limit) == before


def test_arrays_sort_by_their_text(spark):
    texts = [None, "", "a", "ab", "a\0", "a\0b", "a\1", "\0", "\1", "\2", "é", "10", "9"]
    elements = [None, *[(k, v) for k in texts for v in (None, "", "\1", "5", "50")]]
    arrays = [None, [], *[[e] for e in elements], *[[e, f] for e in elements[:20] for f in elements[:20:3]]]
    rows = spark.createDataFrame([(a, arrays[i * 7 % len(arrays)]) for i, a in enumerate(arrays)], "a array<struct<k:string,v:string>>, b array<struct<k:string,v:string>>")
    text = order_text((F.col("a"), ("k", "v")), (F.col("b"), ("k", "v")))
    ranked = rows.withColumn("o", text).selectExpr("dense_rank() OVER (ORDER BY a NULLS LAST, b NULLS LAST) AS of_arrays", "dense_rank() OVER (ORDER BY o) AS of_text")
    assert ranked.where("of_arrays <> of_text").count() == 0


def test_facebook_shuffles_no_arrays_and_settles_ties_by_them(spark):
    def insight(shares):
        return INSIGHT | {"actions": [{"action_type": "other", "value": "1"}, {"action_type": "post", "value": shares}]}

    model = run_model("facebook", "tourism", facebook_streams(spark, insight("9"), insight("10"), insight("11"), loaded=["2024-05-01"] * 3))
    assert [r.shares for r in model.select("shares").collect()] == [10]
    dealt = [line for line in plan(model).splitlines() if "WindowGroupLimit" in line and "account_id" in line]
    assert dealt and not [line for line in dealt if "actions" in line], dealt


def test_labels_of_an_ad_are_dealt_once(spark, data):
    model = load_queries.labels_facebook(base.Tables(spark, data))
    model.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffles = [line for line in plan(model).splitlines() if "Exchange" in line and "account_id" in line]
    assert not shuffles, shuffles
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_packed_documents_are_kept_in_small_row_groups(spark):
    rows = spark.range(0, 300_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 512).alias("data"))
    stored = stage(rows, "raw", "zstd")
    parts = [p.removeprefix("file://") for p in stored.inputFiles()]
    groups = [pq.ParquetFile(p).metadata.num_row_groups for p in parts]
    assert len(groups) == 1 and groups[0] > 1 and stored.count() == 300_000
