"""Landing, catalogue, sinks."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adloom.plans import cm360
from adloom.plans.labels import MOUNTAIN, TOURISM
from adloom.plans.runner import Run, run_model
from adloom.sources import payloads, raw, sinks, staging
from adloom.sources.staging import shared_folder, stage
from adloom.sources.streams import Streams, store_parsed


def test_land_and_read(spark, tmp_path):
    source = tmp_path / "records.jsonl"
    source.write_text('{"a": 1}\n\n{"a": "2"}\n')
    target = str(tmp_path / "table")
    for _ in range(2):
        raw.land_json_lines(spark, str(source), target)
    table = raw.read_envelope(spark, target)
    assert table.count() == 4
    assert table.where("_sdc_extracted_at is null or _sdc_deleted_at is not null").count() == 0


def test_csv_report_as_envelope(spark, tmp_path):
    path = tmp_path / "report.csv"
    path.write_text("Line Item ID,Revenue (Adv Currency)\n12,1.5\n")
    report = raw.read_report_csv(spark, str(path))
    assert raw.csv_as_envelope(report).first()["data"] == '{"Line Item ID":"12","Revenue (Adv Currency)":"1.5"}'
    assert raw.read_report_csv(spark, str(path), normalise=True).columns == ["line_item_id", "revenue__adv_currency_"]


def test_model_from_folders(spark, tmp_path):
    frames = {
        "campaign": (
            [(7, 1, "My Brand", "b", "ON", dt.date(2024, 1, 1)), (8, 2, "Other account", "b", "ON", dt.date(2024, 1, 1))],
            "customer_id bigint, campaign_id bigint, campaign_name string, campaign_campaign_budget string, campaign_status string, _LATEST_DATE date",
        ),
        "campaign_stats": (
            [(7, 1, dt.date(2024, 1, 2), 1.0, 2500000, 3, 4, 5), (8, 1, dt.date(2024, 1, 2), 1.0, 1, 1, 1, 1)],
            "customer_id bigint, campaign_id bigint, _DATA_DATE date, metrics_conversions double, metrics_cost_micros bigint, "
            "metrics_clicks bigint, metrics_impressions bigint, metrics_interactions bigint",
        ),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "google_ads" / name))
    lookup = spark.createDataFrame([("google ads SEARCH", "Paid Search")], "publisher string, channel string")
    lookup.write.parquet(str(tmp_path / "publisher_channel"))

    streams = Streams(spark, root=str(tmp_path))
    row = run_model("dash_table_search", TOURISM.with_accounts(search_customer_id=7), streams).collect()
    assert [r.asDict() for r in row] == [
        {
            "clicks": 3, "impressions": 4, "media_cost": 2.5, "campaign_name": "My Brand", "date": dt.date(2024, 1, 2),
            "search_type": "Brand Search", "channel": "Paid Search", "publisher": "google ads SEARCH",
        }
    ]
    with pytest.raises(ValueError, match="search_customer_id"):
        run_model("google_ads_search", "tourism", streams)
    with pytest.raises(KeyError):
        Streams(spark).read("ga4.goal", "tourism")


def test_customer_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2)], "customer_id bigint, x bigint").write.parquet(path)
    raw.read_typed(spark, path, "customer_id bigint, x bigint", 1).explain("formatted")
    assert "EqualTo(customer_id,1)" in capsys.readouterr().out


def test_replace_partitions_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-01-02", 1), ("b", "2024-01-02", 1)], "label string, date string, n int")
    sinks.save_path(old, path, ["label", "date"])
    sinks.replace_partitions(old.where("label = 'a' and date = '2024-01-02'").withColumn("n", F.lit(9)), path, ["label", "date"])
    rows = {(r.label, str(r.date), r.n) for r in spark.read.parquet(path).collect()}
    assert rows == {("a", "2024-01-01", 1), ("a", "2024-01-02", 9), ("b", "2024-01-02", 1)}


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.save_json_lines(spark.createDataFrame([(1, "x")], "a int, b string"), path)
    assert spark.read.text(path).first()[0] == '{"a":1,"b":"x"}'


def test_tables_are_gathered_by_partition(spark, tmp_path):
    path = tmp_path / "t"
    days = spark.range(0, 6400, 1, 16).withColumn("day", F.col("id") % 200)
    sinks.save_path(days, str(path), ["day"])
    assert len(list(path.rglob("*.parquet"))) <= 400


def test_staging_needs_a_folder_and_leaves_nothing(spark, tmp_path):
    staging.use_folder(None)
    try:
        if not spark.conf.get("spark.checkpoint.dir", None):
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                stage(spark.range(1), "t")
        staging.use_folder(str(tmp_path))
        frames = {
            "ga4.goal": raw.envelope(spark.createDataFrame([('{"date": "20240501", "eventName": "x", "sessionCampaignName": "a_B"}',)], "value string")),
        }
        with Run(Streams(spark, given=frames)) as run:
            assert run.model("ga4_channel", TOURISM).count() == 1
            staged = Path(run._staging.folder.removeprefix("file:"))
            assert list(staged.rglob("*.parquet"))
        assert not staged.exists()
    finally:
        staging.use_folder(str(tmp_path))


def test_parsed_tables_prune_by_advertiser_and_load(spark, tmp_path):
    docs = [{"advertiser": a, "placementId": str(d), "date": f"2024-05-{d:02}", "clicks": str(d)} for a in ("Acme", "Else") for d in (1, 2, 3)]
    rows = spark.createDataFrame([(json.dumps(d), d["date"]) for d in docs], "value string, day string")
    source = Streams(spark, given={"cm360.report": raw.envelope(rows, loaded_at=F.col("day").cast("timestamp"))})
    wanted = payloads.CM360_ATTRIBUTES + payloads.CM360_METRICS + payloads.CM360_SITE
    assert store_parsed(source, "cm360.report", "tourism", wanted, cm360.KEYS, str(tmp_path)).count() == 0
    label = TOURISM.with_accounts(cm360_advertiser="Acme")
    full = run_model("cm360_serialised", label, Streams(spark, parsed=str(tmp_path)))
    assert full.count() == 3
    window = run_model("cm360_serialised", label, Streams(spark, parsed=str(tmp_path), as_of=dt.date(2024, 5, 3)))
    assert {r.clicks for r in window.collect()} == {2, 3}
    scan = next(line for line in window._jdf.queryExecution().toString().splitlines() if "FileScan" in line)
    filters = scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "advertiser" in filters and "loaded_on" in filters


def test_reload_windows(spark):
    streams = Streams(spark, as_of=dt.date(2024, 5, 31))
    assert streams.first_day("ga4.goal") == dt.date(2024, 5, 1)
    assert streams.first_day("ttd.standard") == dt.date(2024, 5, 30)
    assert Streams(spark).first_day("ga4.goal") is None


def test_run_writes_by_label_and_day(spark, tmp_path):
    def streams(n):
        doc = json.dumps({"date": "20240501", "eventName": "x", "eventCount": str(n)})
        return Streams(spark, given={"ga4.goal": raw.envelope(spark.createDataFrame([(doc,)], "value string"))})

    for label, n in ((TOURISM, 1), (MOUNTAIN, 2), (TOURISM, 3)):
        Run(streams(n)).write("ga4_goal", label, str(tmp_path))
    got = {(r.label, str(r.date), r.eventCount) for r in spark.read.parquet(str(tmp_path / "ga4_goal")).collect()}
    assert got == {("tourism", "2024-05-01", 3), ("mountain", "2024-05-01", 2)}


def test_stage_uses_the_sessions_folder(spark, tmp_path):
    if not spark.conf.get("spark.checkpoint.dir", None):
        staging.use_folder(str(tmp_path))
    staged = stage(spark.range(3).select(F.lit("2024-01-01").cast("date").alias("d"), "id"), "t")
    assert staged.count() == 3 and shared_folder(spark) in staged.inputFiles()[0]
