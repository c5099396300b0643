"""Golden rows per model, worked out by hand."""

import datetime as dt
import json
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from adloom.operators.envelope import LOAD_COLUMNS
from adloom.plans.labels import MOUNTAIN, TOURISM
from adloom.plans.runner import MODELS, Run, run_labels, run_model
from adloom.sources.streams import Streams


def envelope(spark, *docs, loaded=None):
    loaded = loaded or ["2024-05-02"] * len(docs)
    df = spark.createDataFrame([(json.dumps(d), t) for d, t in zip(docs, loaded)], "data string, t string")
    return df.select(
        "data", *[(F.col("t").cast(k) if k == "timestamp" else F.lit(None).cast(k)).alias(n) for n, k in LOAD_COLUMNS.items()]
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


INSIGHT = {
    "account_id": "1", "ad_id": "10", "ad_name": "a_b_c_d_e_Reel_Vid_Winter", "adset_id": "5", "adset_name": "a_b_c_d_e_f_g_Families",
    "campaign_id": "7", "campaign_name": "ACM_Ski_2024_SOCIALVID", "clicks": "9", "impressions": "100", "spend": "1.50",
    "date_start": "2024-05-01",
    "actions": [{"action_type": "post", "value": "2"}, {"action_type": "post", "value": "8"}, {"action_type": "link_click", "value": "4"}],
    "video_play_actions": [{"action_type": "video_view", "value": "30"}],
    "video_p25_watched_actions": [{"value": "3"}, {"value": "5"}],
    "video_p50_watched_actions": [],
}


def facebook_streams(spark, *insights, loaded=None):
    return Streams(
        spark,
        given={
            "facebook.insights": envelope(spark, *insights, loaded=loaded),
            "facebook.campaigns": envelope(spark, {"id": 7, "status": "OLD", "start_time": "2023"}, {"id": "7", "status": "ON", "start_time": "2024"}),
            "facebook.ads": envelope(spark, {"id": "10", "targeting": {"flexible_spec": [{"interests": [{"name": "Ski"}, {"name": "Art"}]}]}}),
            "facebook.devices": envelope(spark, {"ad_id": "10", "device_platform": "mobile_app"}, {"ad_id": "10", "device_platform": "desktop"}),
        },
    )


def test_facebook(spark):
    older = {**INSIGHT, "spend": "99", "actions": []}
    short = {**INSIGHT, "ad_id": "11", "ad_name": "short", "adset_name": "short", "campaign_id": "8", "campaign_name": "Solo"}
    model = run_model("facebook", "tourism", facebook_streams(spark, older, INSIGHT, short, loaded=["2024-05-01", "2024-05-03", "2024-05-03"]))
    got = rows(
        model, "ad_id", "clicks", "shares", "likes", "video_played", "video_25_completion", "video_50_completion", "media_cost",
        "campaign_status", "interest_names", "device_platforms", "audience_name", "media_format", "ad_format_detail", "campaign_descr",
    )
    assert got == [
        ("10", 4, 2, None, 30, 5, None, 1.5, "ON", "Art, Ski", ["desktop", "mobile"], "Families", "Social Video", "Reel", "Ski"),
        ("11", 4, 2, None, 30, 5, None, 1.5, None, None, None, None, "Other", None, None),
    ]


def test_facebook_mountain_fills_short_names(spark):
    short = {**INSIGHT, "ad_name": None, "adset_name": "short", "campaign_name": "Solo"}
    model = run_model("facebook", "mountain", facebook_streams(spark, short))
    assert rows(model, "audience_name", "ad_format_detail", "creative_descr", "campaign_descr") == [("Other",) * 4]


def test_facebook_unknown_campaigns_share_one_key(spark):
    two = [{**INSIGHT, "account_id": a, "campaign_id": c} for a, c in (("1", "98"), ("2", "99"))]
    assert run_model("facebook", "tourism", facebook_streams(spark, *two)).count() == 1


DV = {
    "Date": "2024/05/01", "Insertion Order": "ACM_Ski_x_YT1", "Insertion Order ID": "1", "Line Item": "a_PLATFORM_Meta_c", "Line Item ID": "2",
    "Creative": "tile", "Clicks": "1.5", "Impressions": 10, "Revenue (Adv Currency)": "2.5", "Complete Views (Video)": "3",
}


def test_dv360_standard(spark):
    docs = [DV, {**DV, "Revenue (Adv Currency)": "9.5", "Clicks": "4"}, {**DV, "Revenue (Adv Currency)": None}, {**DV, "Creative": "nzme", "Insertion Order": "x_y_z"}]
    model = run_model("dv360_standard", "tourism", Streams(spark, given={"dv360.standard": envelope(spark, *docs)}))
    assert rows(model, "date", "media_cost", "clicks", "media_format", "publisher", "audience_name", "ad_format", "campaign_descr") == [
        ("2024-05-01", 2.5, None, "Other", "Nzme", "Other", "No Valid", "y"),
        ("2024-05-01", 9.5, 4, "Youtube Video", "Youtube", "Other", "No Valid", "Ski"),
    ]


def test_dv360_youtube(spark):
    docs = [{**DV, "YouTube Ad": "a_b_c_d_e_Bumper_g_Winter"}, {**DV, "YouTube Ad": "x", "Line Item": "none"}]
    model = run_model("dv360_youtube", "mountain", Streams(spark, given={"dv360.youtube": envelope(spark, *docs)}))
    assert rows(model, "audience_name", "ad_format_detail", "creative_descr", "publisher") == [
        ("Meta", "Bumper", "Winter", "Youtube"), (None, "Other", "Other", "Youtube"),
    ]


def test_cm360(spark):
    base = {"advertiser": "Acme", "placementId": "1", "placement": "a_b_c_d_Aud", "creative": "a_b_c_d_e_Tile", "campaign": "a_b_Ski",
            "clickThroughUrl": "http://x?utm_medium=paid-display", "date": "2024-05-01", "clicks": "2", "impressions": "3", "site": "stuff-co_nz home"}
    docs = [base, base, {**base, "site": "Google Ads", "placementId": "2"}, {**base, "placementId": "3", "site": None},
            {**base, "placementId": "4", "site": "NZME x", "clickThroughUrl": "http://x?utm_medium=paid-social", "placement": "Vid"},
            {**base, "advertiser": "Else", "placementId": "5"}]
    streams = Streams(spark, given={"cm360.report": envelope(spark, *docs)})
    label = TOURISM.with_accounts(cm360_advertiser="Acme")
    direct = run_model("cm360_direct_buy", label, streams)
    assert rows(direct, "publisher", "audience_name", "media_format", "ad_format_detail", "ad_format", "campaign_descr", "media_cost", "date") == [
        ("Nzme", "Other", "Social Video", "Tile", None, "Ski", 0, dt.date(2024, 5, 1)),
        ("Stuff-Co_Nz", "Aud", "High Impact Display", "Tile", None, "Ski", 0, dt.date(2024, 5, 1)),
    ]
    assert run_model("cm360_serialised", label, streams).count() == 4


TTD = {"Date": "01/05/2024", "Campaign": "ACM_Ski", "Campaign ID": "c", "Creative": "a_b_c_d_e_Film_g_Families", "Ad Group": "x_y_DISP_z", "Ad Format": "f",
       "Impressions": "5", "Clicks": "1", "Player Views": "2", "Player 25% Complete": "1,5", "Partner Cost (Partner Currency)": "2,25", "01 - Click Conversion": "7"}


def test_ttd(spark):
    docs = [TTD, {**TTD, "Impressions": "6"}, {**TTD, "Deal ID": "d"}, {**TTD, "Ad Group": "vidod", "Creative": "youtube"}]
    streams = Streams(spark, given={"ttd.standard": envelope(spark, *docs)})
    summed = run_model("ttd_transformed", "tourism", streams)
    assert rows(summed, "date", "publisher", "media_format", "audience_name", "creative_descr", "impressions", "video_25_completion", "media_cost") == [
        ("2024-05-01", "Ttd", "Display", "Families", "Film", 10, 3.0, 4.5),
        ("2024-05-01", "Youtube", "Video OnDemand", "Other", "Other", 5, 1.5, 2.25),
    ]
    full = run_model("ttd_serialised", "tourism", streams)
    assert full.count() == 4 and full.columns.index("row_num") == 82
    assert full.select("click_conversion_01").distinct().first()[0] == 7


def test_strict_stops_on_bad_numbers(spark):
    streams = Streams(spark, given={"ttd.standard": envelope(spark, {**TTD, "Clicks": "many"})})
    assert run_model("ttd_transformed", "tourism", streams).first()["clicks"] is None
    with pytest.raises(Exception):
        run_model("ttd_transformed", "tourism", streams, strict=True).collect()


@pytest.mark.parametrize(
    "model, stream, doc, key, bad",
    [
        ("dv360_standard", "dv360.standard", {"Date": "2024/05/01", "Insertion Order ID": "1"}, "Date", ["01-05-2024", "02-05-2024", "03-05-2024"]),
        ("dv360_youtube", "dv360.youtube", {"Date": "2024/05/01", "Insertion Order ID": "1"}, "Date", ["01-05-2024", "02-05-2024"]),
        ("cm360_serialised", "cm360.report", {"advertiser": "Acme", "date": "2024-05-01"}, "date", ["1 May", "2 May"]),
        ("cm360_direct_buy", "cm360.report", {"advertiser": "Acme", "date": "2024-05-01", "site": "x"}, "date", ["1 May", "2 May"]),
        ("ttd_serialised", "ttd.standard", {"Date": "01/05/2024"}, "Date", ["2024-05-01", "2024-05-02"]),
        ("ttd_transformed", "ttd.standard", {"Date": "01/05/2024"}, "Date", ["2024-05-01", "2024-05-02"]),
        ("hivestack", "hivestack.report", {"datetime": "2024-05-01", "campaign_id": "1"}, "campaign_id", ["x", "y"]),
        ("ga4_goal", "ga4.goal", {"date": "20240501", "eventName": "a"}, "date", ["2024-05-01", "1 May"]),
    ],
)
def test_keys_that_do_not_parse_are_rejected_and_never_merge(spark, model, stream, doc, key, bad):
    docs = [doc, *({**doc, key: b} for b in bad)]
    table = envelope(spark, *docs).union(envelope(spark, doc).withColumn("data", F.lit('{"broken')))
    label = TOURISM.with_accounts(cm360_advertiser="Acme")
    run = Run(Streams(spark, given={stream: table if model[:5] != "cm360" else envelope(spark, *docs)}))
    assert run.model(model, label).count() == 1
    reasons = Counter(r.reason for r in run.rejects(model, label).collect())
    expected = {f"{key} does not parse": len(bad)} | ({"malformed document": 1} if model[:5] != "cm360" else {})
    assert reasons == expected
    with pytest.raises(Exception):
        run_model(model, label, run.streams, strict=True).collect()


def test_safe_fields_stay_safe_in_a_strict_run(spark):
    streams = Streams(spark, given={"dv360.standard": envelope(spark, DV)})
    assert run_model("dv360_standard", "tourism", streams, strict=True).first()["clicks"] is None


def test_the_later_load_wins(spark):
    cases = [
        ("hivestack", "hivestack.report", {"datetime": "2024-05-01", "campaign_id": "1"}, "spend", "media_cost"),
        ("ttd_transformed", "ttd.standard", {"Date": "01/05/2024"}, "Partner Cost (Partner Currency)", "media_cost"),
        ("cm360_serialised", "cm360.report", {"advertiser": "Acme", "date": "2024-05-01"}, "clicks", "clicks"),
    ]
    for model, stream, doc, member, column in cases:
        for first, second in (("1", "9"), ("9", "1")):
            loads = envelope(spark, {**doc, member: first}, {**doc, member: second}, loaded=["2024-05-02", "2024-05-04"])
            label = TOURISM.with_accounts(cm360_advertiser="Acme")
            assert [float(r[column]) for r in run_model(model, label, Streams(spark, given={stream: loads})).collect()] == [float(second)]


def test_second_labels_video_is_whole(spark):
    streams = facebook_streams(spark, INSIGHT)
    lookup = spark.createDataFrame([("facebook", "Social")], "publisher string, channel string")
    for label, kind in ((TOURISM, "double"), (MOUNTAIN, "bigint")):
        only = replace(label, media_sources=("facebook",))
        streams.given["publisher_channel"] = lookup
        table = run_model("dash_table", only, streams)
        assert dict(table.dtypes)["video_completion"] == kind and table.count() == 1
        assert Run(streams).unmapped(only).count() == 0


def test_tiktok(spark):
    day = {"ad_id": "1", "stat_time_day": "2024-05-01 00:00:00"}
    ads = [{"ad_id": "01", "ad_name": "vid", "campaign_name": "ACM_Ski_x_SOCIAL", "adgroup_name": "PLATFORM_App_x"}] * 2
    streams = Streams(spark, given={
        "tiktok.ads": envelope(spark, *ads),
        "tiktok.basic": envelope(spark, {**day, "spend": "1.5", "clicks": "2"}, {**day, "spend": "1.5", "clicks": "2"}, {**day, "stat_time_day": "2024-05-02 00:00:00"}),
        "tiktok.video": envelope(spark, {**day, "video_views_p100": "4", "video_watched_2s": "5"}),
    })
    model = run_model("tiktok", MOUNTAIN, streams)
    assert rows(model, "ad_id", "date", "clicks", "video_100_completion", "video_view", "audience_name", "media_format", "ad_format", "campaign_descr") == [
        ("01", dt.date(2024, 5, 1), 2, 4, 5, "App", "Social Video", "Other", "Ski")
    ]


def test_hivestack(spark):
    base = {"datetime": "2024-05-01", "campaign": "ACM_Ski", "campaign_id": "1", "creative": "a_b_c_d_e_Tile_Big_Wide", "line_item": "x", "line_item_id": "2",
            "concentration": "12%", "impressions": "1.5", "plays": "3", "spend": "2"}
    docs = [base, base, {**base, "plays": "4", "city": "AKL"}, {**base, "campaign": "Solo", "campaign_id": "9"}]
    streams = Streams(spark, given={"hivestack.report": envelope(spark, *docs)})
    model = run_model("hivestack", "tourism", streams)
    assert rows(model, "impressions", "media_cost", "campaign_descr", "ad_format_detail", "creative_descr", "ad_format", "audience_name", "media_format", "clicks") == [
        (1.5, 2.0, "Other", "Wide", "Tile", "Big", "Other", "PDOOH", 0), (3.0, 4.0, "Ski", "Wide", "Tile", "Big", "Other", "PDOOH", 0),
    ]
    assert "media_format" not in run_model("hivestack", "mountain", streams).columns
    both = run_labels("hivestack", [TOURISM, MOUNTAIN], streams)
    assert {r["label"] for r in both.collect()} == {"tourism", "mountain"}


def google_streams(spark):
    day = dt.date(2024, 1, 2)
    stats = [(1, 10, 5, 7, day, 1.0, 2.0, 1500000, 1, 2, 3), (1, 10, 6, 7, day, 1.0, 2.0, 500000, 1, 2, 3), (1, 11, 5, 99, day, 1.0, 2.0, 1000000, 1, 2, 3),
             (1, 12, 5, 98, day, 1.0, 2.0, 1000000, 1, 2, 3), (2, 10, 5, 7, day, 9.0, 9.0, 9, 9, 9, 9)]
    frame = spark.createDataFrame(
        stats, "customer_id bigint, ad_group_ad_ad_id bigint, ad_group_id bigint, campaign_id bigint, _DATA_DATE date, metrics_conversions_value double, "
        "metrics_conversions double, metrics_cost_micros bigint, metrics_clicks bigint, metrics_impressions bigint, metrics_interactions bigint")
    return Streams(spark, given={
        "google_ads.ad": spark.createDataFrame(
            [(1, 10, "a_b_c_d_e_Img_Sq_Winter", "u"), (1, 10, None, "u")],
            "customer_id bigint, ad_group_ad_ad_id bigint, ad_group_ad_ad_name string, ad_group_ad_ad_final_urls string"),
        "google_ads.campaign": spark.createDataFrame(
            [(1, 7, "ACM_Ski", "b1", "ON", day), (1, 7, "ACM_Ski", "b1", "OFF", day), (1, 7, "ACM_Ski", "b2", "ON", day)],
            "customer_id bigint, campaign_id bigint, campaign_name string, campaign_campaign_budget string, campaign_status string, _LATEST_DATE date"),
        "google_ads.ad_group": spark.createDataFrame([(1, 5, "x_PLATFORM_Web_y"), (1, 6, "x_PLATFORM_Web_y")], "customer_id bigint, ad_group_id bigint, ad_group_name string"),
        "google_ads.ad_stats": frame,
        "google_ads.campaign_stats": frame,
    })


def test_google_ads_display(spark):
    model = run_model("google_ads_display", TOURISM.with_accounts(display_customer_id=1), google_streams(spark))
    assert rows(model, "ad_id", "media_cost", "ad_name", "audience_name", "media_format", "ad_format", "creative_descr", "campaign_budget", "campaign_status", "campaign_descr") == [
        (10, 2.0, ["Unknown", "a_b_c_d_e_Img_Sq_Winter"], ["Web"], ["Img"], ["Sq"], ["Winter"], "b1", ["OFF", "ON"], "Ski"),
        (11, 1.0, None, ["Web"], None, None, None, None, None, None),
        (12, 1.0, None, ["Web"], None, None, None, None, None, None),
    ]


def test_google_ads_search(spark):
    model = run_model("google_ads_search", TOURISM.with_accounts(search_customer_id=1), google_streams(spark))
    assert rows(model, "campaign_id", "media_cost", "clicks", "campaign_budget", "publisher") == [
        (7, 2.0, 2, "b1", "Google Ads Search"), (None, 2.0, 2, None, "Google Ads Search"),
    ]


def test_ga4(spark):
    base = {"date": "20240501", "sessionSourceMedium": "google / cpc", "sessionCampaignName": "ACM_Search_x", "eventName": "buy", "eventCount": "1"}
    docs = [base, {**base, "eventCount": "2"}, {**base, "sessionCampaignName": "acm_SEARCH"}, {**base, "sessionSourceMedium": "(direct) / (none)", "sessionCampaignName": None}]
    streams = Streams(spark, given={"ga4.goal": envelope(spark, *docs, loaded=["2024-05-01", "2024-05-03", "2024-05-01", "2024-05-01"])})
    assert rows(run_model("ga4_goal", "tourism", streams), "sessionSourceMedium", "eventCount", "site_name") == [
        ("(Direct) ", 1, "other"), ("Google ", 1, "google_ads_search"), ("Google ", 2, "google_ads_search"),
    ]
    assert rows(run_model("ga4_channel", "tourism", streams), "channel", "publisher", "campaign_name_selection") == [
        ("Paid Search", "Google Ads Search", "SEARCH"), ("Paid Search", "Google Ads Search", "SEARCH"), ("Unknown", "(Direct) ", None),
    ]


def test_every_model_is_known():
    assert len(MODELS) == 15
