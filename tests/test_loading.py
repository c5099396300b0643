"""Landing, VARIANT documents, parsed tables, reports, and maps that are kept."""

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from adloom.operators.arrays import distinct_array
from adloom.operators.canonical import SpellingTable, canonical_spelling
from adloom.operators.classify import classify, classify_by_map, has, like, no, one_of
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import LATEST, LOAD_COLUMNS, Field, as_variant, fields, outcomes, parse_envelope, rejects
from adloom.operators.latest import LatestTable
from adloom.plans.facebook import facebook_labels
from adloom.plans.labels import MOUNTAIN, TOURISM
from adloom.plans.runner import Run, run_model
from adloom.queries.base import Tables
from adloom.queries.load_queries import bucketed_tiktok
from adloom.queries.model_queries import _facebook_streams
from adloom.sources import payloads, raw
from adloom.sources.streams import ENVELOPE_STREAMS, Streams, store_latest, store_parsed, stored_counts


def plan(df):
    return df._jdf.queryExecution().toString()


def listed(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


# --- landing


def test_files_land_once_though_a_run_dies(spark, tmp_path):
    source, target, log = (f"{tmp_path}/{n}" for n in ("in", "out", "log"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"n": 1}\n\n  \n{"n": 2}\n')
    raw.land_files(spark, source, target, log)
    (tmp_path / "in" / "b.jsonl").write_text('{"n": 3}\n{"n": "bad luck"}\n{"n": 4}\n')
    dying = F.when(F.col("value").contains("luck"), F.raise_error(F.lit("died")).cast("timestamp")).otherwise(F.current_timestamp())
    with pytest.raises(Exception, match="died"):
        raw.land_files(spark, source, target, log, loaded_at=dying)
    (tmp_path / "in" / "c.jsonl").write_text('{"n": 5}')
    for _ in range(2):
        raw.land_files(spark, source, target, log)
    rows = raw.read_envelope(spark, target)
    assert rows.columns == ["data", *LOAD_COLUMNS]
    assert sorted(json.loads(r.data)["n"] for r in rows.collect() if "luck" not in r.data) == [1, 2, 3, 4, 5] and rows.count() == 6


def test_landed_variants_are_read_by_models(spark, tmp_path):
    (tmp_path / "in").mkdir()
    docs = [{"date": "20240501", "eventName": "x", "eventCount": n, "sessionSourceMedium": "google / cpc"} for n in (1, 2)]
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(map(json.dumps, docs)) + "\n{broken")
    raw.land_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/log", variant=True)
    landed = raw.read_envelope(spark, f"{tmp_path}/out", variant=True)
    assert [r.malformed for r in landed.collect() if r.malformed] == ["{broken"]
    as_text = landed.select(F.coalesce(F.to_json("data"), "malformed").alias("data"), *LOAD_COLUMNS)
    found = [run_model("ga4_goal", "tourism", Streams(spark, given={"ga4.goal": rows})) for rows in (landed, as_text)]
    assert listed(found[0]) == listed(found[1]) and found[0].count() == 1


# --- documents

DOCUMENTS = [
    None, "", "  ", "{", "[]", "[1]", "7", '"x"', "null", "{}", '{"a": null, "b": null}', '{"a": "x", "b": "12", "d": "2024/05/01"}',
    '{"a": 12, "b": 12, "c": "1,5"}', '{"a": {"x": 1}, "b": [1], "l": []}', '{"a": "{x", "b": "[", "c": "[1]"}', '{"a": "[1, 2]", "l": [{"k": "v", "n": 3}, {}, null]}',
    '{"a": true, "b": 1.5, "d": "2024/05/41"}', '{"a": "é", "it\'s [odd] $.x": "yes"}', '{"l": {"k": "v"}}', '{"l": "text"}', ' {"a": "blank"} ', '{"a": "\\"q\\" \\n"}', '{"a": 12345678901234567890, "b": 99999999999}',
]
WANTED = [
    *fields(a="a", odd="it's [odd] $.x"), *fields("long", b="b"), *fields("decimal_comma", c="c"),
    Field("d", "d", "iso_text:year_first_slash"), Field("l", "l", "json:array<struct<k:string,n:string>>"),
]


def test_variants_give_the_members_of_the_text(spark):
    text = spark.createDataFrame(list(enumerate(DOCUMENTS)), "i int, data string")
    variant = as_variant(text)
    assert variant.columns == ["i", "data", "malformed"]
    pairs = [[parse_envelope(rows, WANTED, ["i"], keys=keys) for rows in (text, variant)] for keys in ((), ("b", "d"))]
    for of_text, of_variant in pairs:
        assert listed(of_text) == listed(of_variant)
    reasons = [{r.i: r.reason for r in rejects(rows, WANTED, ["i"], keys=["b", "d"]).collect()} for rows in (text, variant)]
    kept = {r.i for r in pairs[1][1].collect()}
    assert reasons[0].keys() == reasons[1].keys() and kept | reasons[1].keys() == set(range(len(DOCUMENTS)))
    assert reasons[0] == reasons[1]
    assert "from_json" not in plan(pairs[0][1])


def test_a_member_named_twice_is_malformed_as_variant(spark):
    rows = as_variant(spark.createDataFrame([('{"a": 1, "a": 2}',)], "data string"))
    assert [r.reason for r in rejects(rows, fields(a="a")).collect()] == ["malformed document"]


# --- parsed tables


def test_one_pass_keeps_and_rejects(spark, tmp_path):
    load = ", ".join(f"CAST('2024-01-01' AS timestamp) AS {c}" if k == "timestamp" else f"1L AS {c}" for c, k in LOAD_COLUMNS.items())
    source = spark.createDataFrame([(d,) for d in DOCUMENTS], "data string").selectExpr("data", load.split(", ")[0], *load.split(", ")[1:])
    both = outcomes(source, WANTED, LATEST, keys=["b", "d"])
    assert plan(both).split("Physical Plan")[-1].count("from_json") == plan(parse_envelope(source, WANTED)).split("Physical Plan")[-1].count("from_json")
    assert plan(both).split("Physical Plan")[-1].count("Scan") == 1
    bad = store_parsed(Streams(spark, given={"ga4.goal": source}), "ga4.goal", "tourism", WANTED, ["b", "d"], str(tmp_path))
    kept = Streams(spark, parsed=str(tmp_path)).rows("ga4.goal", "tourism", WANTED)
    assert listed(kept) == listed(parse_envelope(source, WANTED, LATEST, keys=["b", "d"]))
    assert listed(bad.select("reason", "data")) == listed(rejects(source, WANTED, keys=["b", "d"]))
    assert stored_counts[f"{tmp_path}/ga4.goal__tourism"] == {"kept": kept.count(), "rejected": bad.count()}


def test_bucketed_facts_are_not_exchanged(spark, data):
    streams = bucketed_tiktok(Tables(spark, data))
    basic = streams.rows("tiktok.basic", "mountain", payloads.TIKTOK_BASIC, day="date")
    assert "Exchange" not in plan(basic.groupBy("ad_id", "date").count()).split("Physical Plan")[-1]
    daily = [
        pick_one(streams.rows(name, "mountain", wanted, day="date"), ["ad_id", "date"], LATEST)
        for name, wanted in (("tiktok.basic", payloads.TIKTOK_BASIC), ("tiktok.video", payloads.TIKTOK_VIDEO))
    ]
    joined = daily[0].join(daily[1].hint("merge"), ["ad_id", "date"]).groupBy("ad_id", "date").agg(F.sum("clicks"))
    physical = plan(joined).split("Physical Plan")[-1]
    assert "Exchange" not in physical and physical.count("Bucketed: true") == 2 and "SortMergeJoin" in physical
    assert plan(run_model("tiktok", "mountain", streams)).split("Physical Plan")[-1].count("Bucketed: true") == 2


def test_a_reload_corrects_a_day_before_the_window(spark, tmp_path):
    def loads(rows):
        made = spark.createDataFrame(rows, "day string, name string, count string, loaded string")
        body = F.to_json(F.struct(F.col("day").alias("date"), F.col("name").alias("eventName"), F.col("count").alias("eventCount")))
        meta = [(F.col("loaded").cast("timestamp") if k == "timestamp" else F.lit(1).cast("bigint")).alias(c) for c, k in LOAD_COLUMNS.items()]
        return made.select(body.alias("data"), *meta)

    keys = ["date", "sessionSourceMediumraw", "sessionCampaignName", "sessionManualAdContent", "eventName"]
    first = loads([("20240110", "a", "1", "2024-03-01"), ("20240301", "a", "2", "2024-03-02"), ("20240301", "b", "3", "2024-03-02")])
    later = loads([("20240110", "a", "9", "2024-05-02"), ("20240501", "a", "5", "2024-05-02")])
    table = LatestTable(spark, f"{tmp_path}/latest", keys, LATEST, "date")
    wanted, parsed = payloads.GA4_GOAL, f"{tmp_path}/parsed"
    changed = []
    for rows, as_of in ((first, dt.date(2024, 3, 2)), (later, dt.date(2024, 5, 2))):
        source = Streams(spark, given={"ga4.goal": rows}, as_of=as_of)
        store_parsed(source, "ga4.goal", "tourism", wanted, keys, parsed)
        changed.append(store_latest(Streams(spark, parsed=parsed, as_of=as_of), "ga4.goal", "tourism", wanted, table, list(LOAD_COLUMNS)))
    assert [sorted(map(str, c)) for c in changed] == [["2024-01-10", "2024-03-01"], ["2024-01-10", "2024-05-01"]]
    kept = run_model("ga4_goal", "tourism", Streams(spark, latest={"ga4.goal": table}))
    whole = run_model("ga4_goal", "tourism", Streams(spark, given={"ga4.goal": first.unionByName(later)}))
    assert listed(kept) == listed(whole) and kept.count() == 4


# --- maps


def test_rules_are_tried_once_per_distinct_value(spark):
    rules = [("one", has("a", "x", "y")), ("two", one_of(like("b", "Q%"), no(has("a", "z"))))]
    rows = spark.createDataFrame([(i, [None, "x", "Y", "z"][i % 4], [None, "Q1", "q"][i % 3], "w") for i in range(200)], "i int, a string, b string, out2 string")
    stored = []

    def store(df, name):
        stored.append(df)
        return df

    found = classify_by_map(rows, "out", rules, F.col("out2"), ["out2"], store)
    assert listed(found) == listed(classify(rows, "out", rules, F.col("out2")))
    assert stored[0].count() == 12 and found.columns == [*rows.columns, "out"]


def test_arrays_of_several_columns_take_one_scan(spark, data):
    lines = spark.read.parquet(f"{data}/lineitem.parquet")
    found = distinct_array(lines, ["l_suppkey"], ["l_returnflag", "l_linenumber", "l_linestatus"])
    physical = plan(found).split("Physical Plan")[-1]
    assert physical.count("FileScan") == 1 and "Join" not in physical
    odd = spark.createDataFrame([(None, None, 1), (None, "b", None), (1, None, None), (1, None, None), (2, "a", 2), (2, "a", 1)], "k int, s string, n int")
    assert listed(distinct_array(odd, ["k"], ["s", "n"])) == sorted(map(repr, [(None, ["b"], [1]), (1, [], []), (2, ["a"], [1, 2])]))


def test_spellings_rewrite_only_days_that_change(spark, tmp_path):
    schema = "day date, i int, name string"
    table = SpellingTable(spark, f"{tmp_path}/s", "name", "one", "day")
    d = [dt.date(2024, 1, n) for n in range(1, 6)]
    loads = [[(d[0], 1, "ski"), (d[0], 2, None), (d[1], 3, "Snow")], [(d[2], 4, "Ski"), (d[2], 5, "snow")], [(d[3], 6, "SNOW"), (d[4], 7, "new")]]
    written = [table.load(spark.createDataFrame(rows, schema)) for rows in loads]
    assert written == [["2024-01-01", "2024-01-02"], ["2024-01-01", "2024-01-03"], ["2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"]]
    every = spark.createDataFrame([r for rows in loads for r in rows], schema)
    assert listed(table.rows(every.schema)) == listed(canonical_spelling(every, "name", "one"))
    assert table.load(spark.createDataFrame([], schema)) == []
    assert table.rows(every.schema).count() == 7


# --- reports


def test_reports_with_drift_and_broken_rows(spark, tmp_path):
    columns = ["Id", "Name", "Cost (net)"]
    (tmp_path / "r").mkdir()
    files = {
        "good": 'Id,Name,Cost (net)\n1,"a ""q"",\nb",1.5\n2,,\n3,x\n4,x,1,extra\n',
        "order": "Name,Id,Cost (net)\nx,5,1\n",
        "more": "Id,Name,Cost (net),New\n6,x,1,2\n",
        "fewer": "Id,Name\n7,x\n",
        "header": "Id,Name,Cost (net)\n",
    }
    for name, text in files.items():
        (tmp_path / "r" / f"{name}.csv").write_text(text)
    good, bad = raw.read_report(spark, str(tmp_path / "r"), columns)
    assert listed(good) == sorted(map(repr, [("1", 'a "q",\nb', "1.5"), ("2", None, None)]))
    reasons = sorted((r.file.rsplit("/", 1)[1], r.reason) for r in bad.collect())
    fits = "row does not fit the header"
    assert reasons == [
        ("fewer.csv", "header: Id, Name"), ("good.csv", fits), ("good.csv", fits),
        ("more.csv", "header: Id, Name, Cost (net), New"), ("order.csv", "header: Name, Id, Cost (net)"),
    ]
    drift = {r.file.rsplit("/", 1)[1]: r.drift for r in raw.report_files(spark, str(tmp_path / "r"), columns).collect()}
    assert drift["good.csv"] is None and drift["header.csv"] is None and len(drift) == 5


# --- labels


def test_labels_share_one_scan_per_stream(spark, data, tmp_path):
    streams = _facebook_streams(Tables(spark, data))
    for name, rows in streams.items():
        for label, part in (("tourism", rows.where("hash(data) % 3 <> 0")), ("mountain", rows.where("hash(data) % 2 = 0"))):
            part.write.parquet(f"{tmp_path}/facebook_raw__{label}/{ENVELOPE_STREAMS[name]}")
    root = Streams(spark, root=str(tmp_path))
    both = facebook_labels(root, (TOURISM, MOUNTAIN))
    physical = plan(both).split("Physical Plan")[-1]
    assert physical.count("FileScan") == len(streams) == 4
    for label in (TOURISM, MOUNTAIN):
        alone = run_model("facebook", label, root)
        assert alone.count() and listed(both.where(F.col("label") == label.name).drop("label")) == listed(alone)


def test_models_that_a_run_has_stored_are_not_built_again(spark):
    run = Run(Streams(spark, given={"google_ads.x": spark.range(1)}))
    run._stored["google_ads_search", "tourism"] = spark.range(3).withColumn("mark", F.lit("stored"))
    assert run._built("google_ads_search", TOURISM).columns == ["id", "mark"]
    with pytest.raises(KeyError):
        run._built("google_ads_search", replace(MOUNTAIN, search_customer_id=1))
