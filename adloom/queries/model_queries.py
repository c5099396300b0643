"""One query per model, on raw rows derived from the test tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial
from itertools import chain

from pyspark.sql import DataFrame, functions as F

from adloom.operators.unify import unify
from adloom.plans import dash
from adloom.plans.labels import MOUNTAIN, TOURISM, Label
from adloom.plans.runner import run_labels, run_model
from adloom.queries.base import Tables, as_envelope, choose, comparable, nulls_last, query, raw_in
from adloom.queries.operator_queries import (
    AD_CONTENTS,
    GA4_CAMPAIGNS,
    SOURCE_MEDIUMS,
    SQL_DV360_FORMAT,
    SQL_MEDIUM,
    _CAMPAIGNS,
    _CREATIVES,
    sql_channel,
    sql_cm360_format,
    sql_cm360_publisher,
    sql_display_source,
    sql_dv360_publisher,
    sql_ga4_publisher,
    sql_site_name,
    sql_social,
    sql_ttd_format,
    sql_ttd_publisher,
)
from adloom.sources.staging import Staging, stage
from adloom.sources.streams import Streams

ADVERTISER = {"tourism": "Acme - Tours", "mountain": "Acme - Snow"}


def _label(label: Label) -> Label:
    return label.with_accounts(
        cm360_advertiser=ADVERTISER[label.name], display_customer_id=1, search_customer_id=2
    )


def sql_token(name: str, n: int, min_len: int | None = None, default: str | None = "Other", null_default: bool = False) -> str:
    """SQL text of a guarded token (``n`` counts from 0)."""
    parts = f"string_split({name}, '_')"
    if min_len is None:
        return f"{parts}[{n + 1}]"
    other = "NULL" if default is None else f"'{default}'"
    if null_default:
        return f"CASE WHEN len({parts}) >= {min_len} THEN {parts}[{n + 1}] ELSE {other} END"
    return f"CASE WHEN len({parts}) < {min_len} THEN {other} ELSE {parts}[{n + 1}] END"


def sql_first(rows: str, keys: str, order: str) -> str:
    """SQL text: the first row per key."""
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {rows}) w WHERE rn = 1)"


#: Loads differ per row, and the latest one wins.
LATEST_FIRST = "loaded DESC NULLS LAST, "

# Coded ad names: long ones, short ones, an empty one and a missing one.
AD_NAMES = [
    "a_b_c_d_e_Reel_Vid_Winter", "a_b_c_d_e_Still_Disp_Summer", "short_name", "", "a_b_c_d_e_Tile_x_nzme_extra",
    "a_b_c_d_e_f_g", None, "spot_Native_c_d_e_f_three_h",
]
CAMPAIGNS = [
    "ACM_Ski_2024_SOCIALVID", "ACM_ski_2024_SOCIAL", "ACM_SKI _2024_YTX", "Solo", "ACM_Cruise_2024_DISP_nzme",
    "ACM_cruise_2024_SOCIAL_Vidod", None, "", "acm_tvnz_24_VID_x", "perf_Max_24_pmax",
]
LINE_NAMES = ["a_b_c_d_e_f_g_Families", "x_PLATFORM_Meta_y", "a_b", None, "p_PLATFORM_", "a_b_c_d_e_f_g_Couples_PLATFORM_Web_z"]
YEAR_DAY = "CAST(make_date(year(l_shipdate), 1, 1) AS STRING)"
MONTH_DAY = "CAST(make_date(year(l_shipdate), month(l_shipdate), 1) AS STRING)"


# --- Facebook ----------------------------------------------------------------

_FB_ROWS = f"""
    SELECT CAST(l_suppkey % 3 AS STRING) AS account_id, CAST(l_partkey AS STRING) AS ad_id,
           {choose("l_suppkey", AD_NAMES)} AS ad_name, CAST(l_suppkey % 10 AS STRING) AS adset_id,
           {choose("l_suppkey", LINE_NAMES)} AS adset_name, CAST(l_suppkey % 30 AS STRING) AS campaign_id,
           {choose("l_suppkey", CAMPAIGNS)} AS campaign_name, {YEAR_DAY} AS date_start,
           CAST(l_quantity AS BIGINT) AS impressions, l_extendedprice AS spend, l_shipdate AS loaded
    FROM {{lineitem}}
"""
_FB_CAMPAIGNS = """
    SELECT CAST(s_suppkey % 25 AS STRING) AS id, CASE s_nationkey % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PAUSED' END AS status,
           'OBJ_' || s_nationkey AS objective, CAST(s_acctbal AS STRING) AS start_time, s_name AS stop_time
    FROM {supplier}
"""


def _facebook_streams(t: Tables, compression: str | None = None) -> dict[str, DataFrame]:
    def action(kind, value):
        return F.struct(F.lit(kind).alias("action_type"), value.cast("string").alias("value"))

    n = F.col("impressions")
    actions = F.when(n % 5 == 0, F.lit(None)).otherwise(
        F.array(
            action("post", n + 1), action("post", n + 2), action("like", n + 3), action("comment", F.lit("many")),
            action("post_reaction", n + 4), action("post_engagement", n + 5), action("link_click", n + 6),
        )
    )

    def watched(extra):
        both = F.array(action("video_view", n + extra), action("video_view", n + extra + 50))
        return F.when(n % 4 == 0, F.slice(both, 1, 0)).when(n % 4 != 1, both)

    members = {
        c: F.col(c)
        for c in ("account_id", "ad_id", "ad_name", "adset_id", "adset_name", "campaign_id", "campaign_name", "date_start")
    }
    insights = as_envelope(
        t.sql(_FB_ROWS),
        {
            **members,
            "clicks": F.lit("9"),
            "impressions": n.cast("string"),
            "spend": F.col("spend").cast("string"),
            "actions": actions,
            "video_play_actions": watched(100),
            "video_p25_watched_actions": watched(200),
            "video_p50_watched_actions": watched(300),
            "video_p75_watched_actions": watched(400),
            "video_p100_watched_actions": watched(500),
        },
        "loaded",
        compression,
    )
    campaigns = t.sql(_FB_CAMPAIGNS)

    def named(name):
        return F.struct(F.col(name).alias("name"))

    spec = F.array(
        F.struct(F.array(named("p_type"), named("p_brand")).alias("interests")),
        F.struct(F.array(named("p_brand")).alias("interests")),
    )
    ads = t.part.select(
        F.to_json(
            F.struct(
                F.col("p_partkey").cast("string").alias("id"),
                F.when(F.col("p_size") % 10 != 0, F.struct(F.when(F.col("p_size") % 10 == 1, F.slice(spec, 1, 0)).otherwise(spec).alias("flexible_spec"))).alias("targeting"),
            )
        ).alias("data")
    )
    device = t.sql(
        "SELECT CAST(l_partkey AS STRING) AS ad_id, CASE l_linenumber % 4 WHEN 0 THEN 'mobile_app' "
        "WHEN 1 THEN 'mobile_web' WHEN 2 THEN 'desktop' END AS device_platform FROM {lineitem}"
    )
    return {
        "facebook.insights": insights,
        "facebook.campaigns": as_envelope(campaigns, {c: c for c in campaigns.columns}),
        "facebook.ads": ads,
        "facebook.devices": as_envelope(device, {c: c for c in device.columns}),
    }


def _sql_facebook(label: Label) -> str:
    first = "CASE WHEN impressions % 4 >= 2 THEN impressions + {0} END"
    watched = {
        "video_played": first.format(100), "video_25_completion": first.format(250),
        "video_50_completion": first.format(350), "video_75_completion": first.format(450),
        "video_completion": first.format(550),
    }
    acted = {"shares": 1, "likes": 3, "delivery_social_post_like": 4, "social_post_engagement": 5, "clicks": 6}
    sums = [f"CAST(sum(CASE WHEN impressions % 5 <> 0 THEN impressions + {n} END) AS BIGINT) AS {c}" for c, n in acted.items()]
    sums += [f"CAST(sum({e}) AS BIGINT) AS {c}" for c, e in watched.items()]
    tie = ["ad_name", "adset_id", "adset_name", "campaign_id", "campaign_name", "impressions", "spend"]
    latest = sql_first(f"({_FB_ROWS}) r", "account_id, ad_id, date_start", f"loaded DESC NULLS LAST, {nulls_last(*tie)}")
    # Column order of the aggregated stats decides the last pick.
    stats_order = [
        "ad_name", "campaign_id", "campaign_name", "adset_id", "adset_name", "shares", "delivery_social_post_like",
        "comments", "likes", "social_post_engagement", "clicks", "video_played", "video_25_completion",
        "video_50_completion", "video_75_completion", "video_completion", "impressions", "media_cost",
    ]
    campaigns = sql_first(
        f"({_FB_CAMPAIGNS}) k", "id", f"start_time DESC NULLS LAST, {nulls_last('status', 'objective', 'stop_time')}"
    )
    strict = label.facebook_short_name is not None
    guard = {"min_len": 8, "null_default": True} if strict else {}
    descr = sql_token("campaign_name", 1, 2) if strict else sql_token("campaign_name", 1)
    audience = sql_token("adset_name", 7, 8, label.facebook_short_name, True)
    return f"""
    WITH latest AS {latest},
    stats AS (SELECT date_start, ad_id, ad_name, campaign_id, campaign_name, adset_id, adset_name, {", ".join(sums)},
                     CAST(NULL AS BIGINT) AS comments, CAST(sum(impressions) AS BIGINT) AS impressions, sum(spend) AS media_cost
              FROM latest GROUP BY 1, 2, 3, 4, 5, 6, 7),
    known AS {campaigns},
    joined AS (SELECT stats.*, known.id AS known_id, status AS campaign_status, objective AS campaign_objective, start_time, stop_time
               FROM stats LEFT JOIN known ON known.id = stats.campaign_id),
    picked AS {sql_first("joined", "date_start, ad_id, known_id", nulls_last(*stats_order))},
    interest AS (SELECT CAST(p_partkey AS VARCHAR) AS ad_id, least(p_type, p_brand) || ', ' || greatest(p_type, p_brand) AS interest_names
                 FROM part WHERE p_size % 10 > 1),
    device AS (SELECT CAST(l_partkey AS VARCHAR) AS ad_id,
                 array_to_string(list_sort(list(DISTINCT CASE l_linenumber % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'mobile' WHEN 2 THEN 'desktop' END)
                   FILTER (l_linenumber % 4 < 3)), '|') AS device_platforms FROM lineitem GROUP BY 1)
    SELECT date_start AS date, picked.ad_id, interest_names, adset_id AS media_buy_external_id, adset_name AS media_buy_external_name,
      campaign_id, campaign_name, shares, likes, comments, campaign_status, campaign_objective, start_time, stop_time,
      video_25_completion, video_50_completion, video_75_completion, video_completion, video_played, coalesce(device_platforms, '') AS device_platforms,
      clicks, social_post_engagement, impressions, delivery_social_post_like, round(media_cost, 2) AS media_cost,
      CAST(1 AS BIGINT) AS row_number, ad_name AS creative_name, 'Facebook' AS publisher, {audience} AS audience_name,
      {sql_social("campaign_name", "ad_name")} AS media_format, {sql_token("ad_name", 5, **guard)} AS ad_format_detail,
      {sql_token("ad_name", 6, **guard)} AS ad_format, {sql_token("ad_name", 7, **guard)} AS creative_descr, {descr} AS campaign_descr
    FROM picked LEFT JOIN interest ON interest.ad_id = picked.ad_id LEFT JOIN device ON device.ad_id = picked.ad_id
    """


def _facebook(t: Tables, label: Label) -> DataFrame:
    t = t.wide()
    model = run_model("facebook", label, Streams(t.spark, given=_facebook_streams(t, "zstd")))
    # An ad without devices has no array; compared as empty text.
    return comparable(model).withColumn("device_platforms", F.coalesce("device_platforms", F.lit("")))


@query("model_facebook", _sql_facebook(TOURISM))
def model_facebook(t: Tables) -> DataFrame:
    return _facebook(t, TOURISM)


@query("model_facebook_mountain", _sql_facebook(MOUNTAIN))
def model_facebook_mountain(t: Tables) -> DataFrame:
    return _facebook(t, MOUNTAIN)


# --- DV360 -------------------------------------------------------------------

_DV_ROWS = f"""
    SELECT 'NZD' AS currency, CAST(l_orderkey % 50 AS STRING) AS post_click, CAST(l_tax AS STRING) AS post_view,
           CAST(l_linenumber AS STRING) AS clicks, CAST(CAST(l_quantity AS BIGINT) AS STRING) AS done,
           {choose("l_partkey", _CREATIVES)} AS creative, replace({YEAR_DAY}, '-', '/') AS day,
           CASE WHEN l_linenumber = 5 THEN 'n/a' ELSE CAST(l_linenumber * 3 AS STRING) END AS first_quartile,
           CAST(l_suppkey % 4 AS STRING) AS activity_id, 'Activity ' || l_returnflag AS activity,
           CAST(CAST(l_quantity AS BIGINT) * 10 AS STRING) AS impressions, {choose("l_suppkey", _CAMPAIGNS + CAMPAIGNS)} AS io,
           CAST(l_suppkey AS STRING) AS io_id, CASE l_linestatus WHEN 'O' THEN 'Active' END AS io_status,
           {choose("l_partkey", LINE_NAMES)} AS line, CAST(l_partkey % 17 AS STRING) AS line_id,
           CAST(l_linenumber * 2 AS STRING) AS midpoint, CAST(l_discount AS STRING) AS click_conversions, '0' AS view_conversions,
           CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_extendedprice AS STRING) END AS revenue,
           CAST(l_linenumber + 1 AS STRING) AS third_quartile, l_linestatus AS conversions,
           make_date(2024, 1, CAST(l_linenumber AS INT)) AS loaded,
           {choose("l_partkey", AD_NAMES)} AS ad, 'Group ' || l_returnflag AS ad_group, CAST(l_suppkey % 7 AS STRING) AS ad_group_id
    FROM {{lineitem}}
"""


def _dv360_streams(t: Tables, report: str = "standard", compression: str | None = None) -> dict[str, DataFrame]:
    rows = t.sql(_DV_ROWS)
    shared = {
        "Advertiser Currency": "currency", "Clicks": "clicks", "Complete Views (Video)": "done", "Date": "day",
        "First-Quartile Views (Video)": "first_quartile", "Impressions": "impressions", "Insertion Order": "io",
        "Insertion Order ID": "io_id", "Insertion Order Status": "io_status", "Line Item": "line",
        "Line Item ID": "line_id", "Midpoint Views (Video)": "midpoint", "Revenue (Adv Currency)": "revenue",
        "Third-Quartile Views (Video)": "third_quartile",
    }
    standard = {
        "CM360 Post-Click Revenue": "post_click", "CM360 Post-View Revenue": "post_view", "Creative": "creative",
        "Floodlight Activity ID": "activity_id", "Floodlight Activity Name": "activity",
        "Post-Click Conversions": "click_conversions", "Post-View Conversions": "view_conversions",
        "Total Conversions": "conversions",
    }
    youtube = {"YouTube Ad": "ad", "YouTube Ad Group": "ad_group", "YouTube Ad Group ID": "ad_group_id"}
    if report == "youtube":
        return {"dv360.youtube": as_envelope(rows, shared | youtube, "loaded", compression)}
    return {"dv360.standard": as_envelope(rows, shared | standard, "loaded", compression)}


_DV_TYPED = f"""
    SELECT currency AS advertiser_currency, post_click AS cm360_post_click_revenue, post_view AS cm360_post_view_revenue,
      CAST(clicks AS BIGINT) AS clicks, CAST(done AS BIGINT) AS video_completion, creative AS creative_name,
      replace(day, '/', '-') AS date, TRY_CAST(first_quartile AS BIGINT) AS video_25_completion,
      activity_id AS floodlight_activity_id, activity AS floodlight_activity_name, CAST(impressions AS BIGINT) AS impressions,
      io AS campaign_name, io_id AS campaign_id, io_status AS campaign_status, line AS line_item, line_id AS line_item_id,
      CAST(midpoint AS BIGINT) AS video_50_completion, click_conversions AS post_click_conversions,
      view_conversions AS post_view_conversions, CAST(revenue AS DOUBLE) AS media_cost,
      CAST(third_quartile AS BIGINT) AS video_75_completion, conversions AS total_conversions,
      ad AS youtube_ad, ad_group AS youtube_ad_group, ad_group_id AS youtube_ad_group_id, loaded FROM ({_DV_ROWS}) r
"""


_DV_STANDARD_PICK = sql_first(
    f"({_DV_TYPED}) p",
    "date, campaign_id, line_item_id, creative_name",
    "media_cost DESC NULLS LAST, "
    + LATEST_FIRST
    + nulls_last(
        "advertiser_currency", "cm360_post_click_revenue", "cm360_post_view_revenue", "clicks", "video_completion",
        "video_25_completion", "floodlight_activity_id", "floodlight_activity_name", "impressions", "campaign_name",
        "campaign_status", "line_item", "video_50_completion", "post_click_conversions", "post_view_conversions",
        "video_75_completion", "total_conversions",
    ),
)
_SQL_DV_STANDARD = f"""
    SELECT * EXCLUDE (rn, loaded, youtube_ad, youtube_ad_group, youtube_ad_group_id, media_cost), round(media_cost, 2) AS media_cost,
      CAST(1 AS BIGINT) AS row_num, {SQL_DV360_FORMAT} AS media_format, {sql_dv360_publisher()} AS publisher,
      {sql_token("line_item", 7, 8)} AS audience_name, 'No Valid' AS creative_descr, 'No Valid' AS ad_format,
      'No Valid' AS ad_format_detail, {sql_token("campaign_name", 1, 2)} AS campaign_descr
    FROM {_DV_STANDARD_PICK} b
"""


@query("model_dv360_standard", _SQL_DV_STANDARD)
def model_dv360_standard(t: Tables) -> DataFrame:
    return comparable(run_model("dv360_standard", "tourism", Streams(t.spark, given=_dv360_streams(t))))


_DV_YOUTUBE_PICK = sql_first(
    f"({_DV_TYPED}) p",
    "date, campaign_id, line_item_id, youtube_ad",
    "media_cost DESC NULLS LAST, "
    + LATEST_FIRST
    + nulls_last(
        "advertiser_currency", "clicks", "video_completion", "video_25_completion", "impressions", "campaign_name",
        "campaign_status", "line_item", "video_50_completion", "video_75_completion", "youtube_ad_group",
        "youtube_ad_group_id",
    ),
)


@query(
    "model_dv360_youtube",
    f"""
    SELECT advertiser_currency, clicks, video_completion, date, video_25_completion, impressions, campaign_name, campaign_id,
      campaign_status, line_item, line_item_id, video_50_completion, round(media_cost, 2) AS media_cost, video_75_completion,
      youtube_ad, youtube_ad_group, youtube_ad_group_id,
      nullif(regexp_extract(line_item, 'PLATFORM_([^_]+)', 1), '') AS audience_name, 'Youtube' AS publisher,
      'Youtube Video' AS media_format, {sql_token("youtube_ad", 5, 8)} AS ad_format_detail,
      {sql_token("youtube_ad", 7, 8)} AS creative_descr, 'No Valid' AS ad_format, {sql_token("campaign_name", 1, 2)} AS campaign_descr
    FROM {_DV_YOUTUBE_PICK} b
    """,
)
def model_dv360_youtube(t: Tables) -> DataFrame:
    return comparable(run_model("dv360_youtube", "tourism", Streams(t.spark, given=_dv360_streams(t, "youtube"))))


# --- CM360 -------------------------------------------------------------------

_CM_SITES = ["NZME digital", "spotify", "TikTok ads", "YouTube", "stuff-co_nz home", "Google Ads", None, "The Trade Desk", "nz herald"]
_CM_MEDIUMS = ["?utm_medium=paid-display&x=1", "?utm_medium=paid-social", "?utm_medium=cpc", "", "?utm_medium=x-native", None, "?v=vid&utm_medium=paid-social"]
_CM_ROWS = f"""
    SELECT CAST(l_partkey % 40 AS STRING) AS placement_id,
           CASE WHEN l_suppkey % 2 = 0 THEN 'Acme - Tours' ELSE 'Acme - Snow' END AS advertiser, 'Display' AS creative_type,
           CAST(l_suppkey % 6 AS STRING) AS creative_id, {choose("l_suppkey", AD_NAMES)} AS creative_name,
           CAST(l_suppkey % 2 AS STRING) AS advertiser_id, CAST(make_date(year(l_shipdate), 12, 31) AS STRING) AS campaign_end_date,
           CAST(l_suppkey % 10 AS STRING) AS campaign_id, {choose("l_suppkey", CAMPAIGNS)} AS campaign_name,
           {YEAR_DAY} AS campaign_start_date, 'https://x.example/' || {choose("l_partkey", _CM_MEDIUMS)} AS click_through_url,
           {MONTH_DAY} AS date, 'CPM' AS placement_cost_structure, CASE WHEN l_linenumber = 7 THEN 'soon' ELSE {YEAR_DAY} END AS placement_end_date,
           {choose("l_partkey", LINE_NAMES)} AS placement, CASE WHEN l_partkey % 40 > 20 THEN 'r1' END AS package_roadblock_id,
           CASE WHEN l_partkey % 40 > 20 THEN 'Road' END AS package_roadblock, '300x250' AS placement_size,
           {YEAR_DAY} AS placement_start_date, 'Reach' AS placement_strategy, 'key' || l_suppkey % 6 AS site_keyname,
           l_linenumber AS clicks, CAST(l_quantity AS BIGINT) AS impressions, {choose("l_orderkey", _CM_SITES)} AS site_name,
           make_date(2024, 1, CAST(l_linenumber AS INT)) AS loaded
    FROM {{lineitem}}
"""
_CM_KEYS = (
    "placement_id, advertiser, creative_type, creative_id, creative_name, advertiser_id, campaign_end_date, campaign_id, "
    "campaign_name, campaign_start_date, click_through_url, date, placement_cost_structure, placement_end_date, placement, "
    "package_roadblock_id, package_roadblock, placement_size, placement_start_date, placement_strategy, site_keyname"
)


def _cm360_streams(t: Tables, compression: str | None = None) -> dict[str, DataFrame]:
    names = {
        "placementId": "placement_id", "advertiser": "advertiser", "creativeType": "creative_type",
        "creativeId": "creative_id", "creative": "creative_name", "advertiserId": "advertiser_id",
        "campaignEndDate": "campaign_end_date", "campaignId": "campaign_id", "campaign": "campaign_name",
        "campaignStartDate": "campaign_start_date", "clickThroughUrl": "click_through_url", "date": "date",
        "placementCostStructure": "placement_cost_structure", "placementEndDate": "placement_end_date",
        "placement": "placement", "packageRoadblockId": "package_roadblock_id", "packageRoadblock": "package_roadblock",
        "placementSize": "placement_size", "placementStartDate": "placement_start_date",
        "placementStrategy": "placement_strategy", "siteKeyname": "site_keyname", "clicks": "clicks",
        "impressions": "impressions", "site": "site_name",
    }
    return {"cm360.report": as_envelope(t.sql(_CM_ROWS), names, "loaded", compression)}


# Rows with a key that is no date are rejected.
_CM_TYPED = f"(SELECT * FROM ({_CM_ROWS}) r WHERE placement_end_date <> 'soon')"


@query(
    "model_cm360_serialised",
    f"""
    SELECT {_CM_KEYS}, CAST(clicks AS BIGINT) AS clicks, impressions, CAST(1 AS BIGINT) AS row_num FROM
    {sql_first(f"(SELECT * FROM {_CM_TYPED} y WHERE advertiser = 'Acme - Snow') z", _CM_KEYS, LATEST_FIRST + nulls_last("clicks", "impressions"))} p
    """,
)
def model_cm360_serialised(t: Tables) -> DataFrame:
    return comparable(run_model("cm360_serialised", _label(MOUNTAIN), Streams(t.spark, given=_cm360_streams(t))))


_SQL_CM_DIRECT = f"""
    SELECT {_CM_KEYS}, CAST(clicks AS BIGINT) AS clicks, impressions, site_name, CAST(1 AS BIGINT) AS row_num,
      {sql_cm360_publisher()} AS publisher, {sql_token("placement", 4, 5, null_default=True)} AS audience_name,
      {sql_cm360_format("medium")} AS media_format, {sql_token("creative_name", 5, 6, null_default=True)} AS ad_format_detail,
      {sql_token("creative_name", 6)} AS ad_format, {sql_token("creative_name", 7)} AS creative_descr,
      {sql_token("campaign_name", 2)} AS campaign_descr, CAST(0 AS BIGINT) AS media_cost
    FROM (SELECT *, {SQL_MEDIUM} AS medium FROM {sql_first(
        f"(SELECT * FROM {_CM_TYPED} y WHERE advertiser = '@advertiser' AND lower(site_name) NOT IN "
        "('the trade desk', 'ttd', 'facebook', 'twitch', 'programmatic', 'dart', 'google ads', 'sem')) z",
        _CM_KEYS, LATEST_FIRST + nulls_last("site_name", "clicks", "impressions"))} p) m
"""


@query("model_cm360_direct_buy", _SQL_CM_DIRECT.replace("@advertiser", ADVERTISER["tourism"]))
def model_cm360_direct_buy(t: Tables) -> DataFrame:
    return comparable(run_model("cm360_direct_buy", _label(TOURISM), Streams(t.spark, given=_cm360_streams(t))))


# --- The Trade Desk ----------------------------------------------------------

_TTD_KINDS = ["Click Conversion", "Conversion Touch", "View Through Conversion", "Time Weighted Decay Conversion"]
_TTD_ROWS = f"""
    SELECT substr({MONTH_DAY}, 9, 2) || '/' || substr({MONTH_DAY}, 6, 2) || '/' || substr({MONTH_DAY}, 1, 4) AS day,
           {MONTH_DAY} AS iso_day, 'p' || l_suppkey % 2 AS partner_id, 'adv' || l_suppkey % 3 AS advertiser_id,
           'c' || l_suppkey % 20 AS campaign_id, 'g' || l_partkey % 5 AS ad_group_id, l_returnflag AS ad_format,
           'cr' || l_partkey % 16 AS creative_id, l_discount * 100 AS frequency, 'Acme' AS advertiser,
           {choose("l_suppkey", _CAMPAIGNS + CAMPAIGNS)} AS campaign_name,
           {choose("l_partkey", ["a_b_DISP_d", "a_b_DISP", "g_VIDOD_x_y", None, "x_y_z_w"])} AS ad_group,
           {choose("l_partkey", AD_NAMES + _CREATIVES)} AS creative, CASE WHEN l_partkey % 16 > 9 THEN 'deal' END AS deal_id,
           'srv' || l_linenumber % 2 AS ad_server_name, 'pl' || l_partkey % 16 AS placement,
           CAST(l_quantity AS BIGINT) AS impressions, CAST(l_linenumber AS BIGINT) AS clicks, l_extendedprice AS cost,
           CAST(l_suppkey % 9 AS BIGINT) AS conversions, make_date(2024, 1, CAST(l_linenumber AS INT)) AS loaded
    FROM {{lineitem}}
"""


def _ttd_streams(t: Tables) -> dict[str, DataFrame]:
    comma = F.replace(F.col("cost").cast("string"), F.lit("."), F.lit(","))
    quarter = F.replace((F.col("clicks") / 4).cast("string"), F.lit("."), F.lit(","))
    text = F.col("conversions").cast("string")
    members = {
        "Date": "day", "Partner ID": "partner_id", "Advertiser ID": "advertiser_id", "Campaign ID": "campaign_id",
        "Ad Group ID": "ad_group_id", "Ad Format": "ad_format", "Creative ID": "creative_id",
        "Frequency": F.col("frequency").cast("string"), "Advertiser": "advertiser", "Campaign": "campaign_name",
        "Ad Group": "ad_group", "Advertiser Currency Code": F.lit("NZD"), "Partner Currency Code": F.lit("USD"),
        "Creative": "creative", "Deal ID": "deal_id", "Ad Server Name": "ad_server_name",
        "Ad Server Creative Placement ID": "placement", "Bids": text, "Impressions": "impressions", "Clicks": "clicks",
        "Player Views": F.col("clicks") + 1, "Player Starts": F.col("clicks") + 2,
    }
    for kind in ("Total Bid Amount", "TTD Cost", "Partner Cost", "Advertiser Cost"):
        for currency in ("Adv", "Partner"):
            members[f"{kind} ({currency} Currency)"] = comma
    for part in ("25", "50", "75", "100"):
        members[f"Player {part}% Complete"] = quarter
    for tag in ("01", "02", "03", "04", "05", "06"):
        for kind in _TTD_KINDS:
            members[f"{tag} - {kind}"] = text
            members[f"{tag} - {kind} Revenue"] = F.concat(text, F.lit(".5"))
    return {"ttd.standard": as_envelope(t.sql(_TTD_ROWS), members, "loaded", "zstd")}


def _sql_ttd_serialised() -> str:
    conversions = []
    for tag in ("01", "02", "03", "04", "05", "06"):
        for kind in _TTD_KINDS:
            stem = kind.lower().replace(" ", "_")
            conversions += [f"conversions AS {stem}_{tag}", f"conversions + 0.5::DOUBLE AS {stem}_revenue_{tag}"]
    costs = [
        f"round(cost, 2) AS {kind}_{currency}_currency"
        for kind in ("total_bid_amount", "ttd_cost", "partner_cost", "advertiser_cost")
        for currency in ("adv", "partner")
    ]
    # Within a key only the ad server name, costs and conversions are left to differ.
    keys = (
        "iso_day, partner_id, advertiser_id, campaign_id, ad_group_id, ad_format, creative_id, frequency, advertiser, "
        "campaign_name, ad_group, creative, deal_id, ad_server_name, placement, impressions, clicks"
    )
    return f"""
    SELECT iso_day AS date, partner_id, advertiser_id, campaign_id, ad_group_id, ad_format, creative_id,
      round(frequency, 2) AS frequency, advertiser, campaign_name, ad_group, 'NZD' AS advertiser_currency_code,
      'USD' AS partner_currency_code, creative, deal_id, ad_server_name, placement AS ad_server_creative_placement_id,
      conversions AS bids, {", ".join(costs)}, impressions, clicks,
      round(clicks / 4, 2) AS player_25_complete, round(clicks / 4, 2) AS player_50_complete,
      round(clicks / 4, 2) AS player_75_complete, round(clicks / 4, 2) AS player_100_complete,
      clicks + 1 AS video_views, clicks + 2 AS player_starts, {", ".join(conversions)},
      CAST(1 AS BIGINT) AS row_num, {sql_ttd_publisher("campaign_name", "creative")} AS publisher,
      {sql_ttd_format("creative")} AS media_format, {sql_token("creative", 7, 8)} AS audience_name,
      {sql_token("creative", 5, 8)} AS creative_descr, {sql_token("creative", 7, 8)} AS ad_format_detail,
      {sql_token("campaign_name", 1, 2)} AS campaign_descr
    FROM {sql_first(f"({_TTD_ROWS}) r", keys, LATEST_FIRST + nulls_last("conversions", "cost"))} p
    """


@query("model_ttd_serialised", _sql_ttd_serialised())
def model_ttd_serialised(t: Tables) -> DataFrame:
    t = t.wide()
    return comparable(run_model("ttd_serialised", "tourism", Streams(t.spark, given=_ttd_streams(t))))


# Tie-break in report order: cost, then impressions, clicks, players, views.
_TTD_PICK = sql_first(
    f"({_TTD_ROWS}) r",
    "iso_day, partner_id, advertiser_id, campaign_id, ad_group_id, ad_format, creative_id, advertiser, campaign_name, "
    "ad_group, creative, deal_id, placement",
    LATEST_FIRST + nulls_last("impressions", "clicks", "cost"),
)
_SQL_TTD_TRANSFORMED = f"""
    SELECT ad_server_creative_placement_id, date, campaign_name, campaign_id, creative AS creative_name, creative_id, advertiser,
      advertiser_id, {sql_ttd_publisher("campaign_name", "creative")} AS publisher, media_format,
      {sql_token("creative", 7, 8)} AS audience_name, ad_format, {sql_token("creative", 7, 8)} AS ad_format_detail,
      {sql_token("creative", 5, 8)} AS creative_descr, {sql_token("campaign_name", 1, 2)} AS campaign_descr,
      q AS video_25_completion, q AS video_50_completion, q AS video_75_completion, q AS video_completion, clicks, video_views,
      impressions, media_cost
    FROM (SELECT placement AS ad_server_creative_placement_id, iso_day AS date, campaign_name, campaign_id, creative, creative_id,
            advertiser, advertiser_id, media_format, ad_format, sum(clicks / 4) AS q, CAST(sum(clicks) AS BIGINT) AS clicks,
            CAST(sum(clicks + 1) AS BIGINT) AS video_views, CAST(sum(impressions) AS BIGINT) AS impressions,
            round(sum(cost), 2) AS media_cost
          FROM (SELECT *, {sql_ttd_format("creative")} AS media_format FROM {_TTD_PICK} p) f GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10) g
"""


@query("model_ttd_transformed", _SQL_TTD_TRANSFORMED)
def model_ttd_transformed(t: Tables) -> DataFrame:
    t = t.wide()
    return comparable(run_model("ttd_transformed", "tourism", Streams(t.spark, given=_ttd_streams(t))))


# --- TikTok ------------------------------------------------------------------

_TT_BASIC = f"""
    SELECT CASE WHEN l_partkey % 100 = 99 THEN 'x' ELSE CAST(l_partkey AS STRING) END AS ad_id, {YEAR_DAY} || ' 00:00:00' AS day,
           l_extendedprice AS spend, CAST(l_quantity AS BIGINT) AS impressions, CAST(l_linenumber AS BIGINT) AS clicks,
           l_suppkey AS p25, l_linestatus AS status, make_date(2024, 1, CAST(l_linenumber AS INT)) AS loaded
    FROM {{lineitem}}
"""
_TT_ADS = f"""
    SELECT '0' || CAST(p_partkey AS STRING) AS ad_id, {choose("p_partkey", AD_NAMES)} AS ad_name, p_name AS ad_text,
           {choose("p_partkey", CAMPAIGNS)} AS campaign_name, {choose("p_partkey", LINE_NAMES)} AS adgroup_name
    FROM {{part}}
    UNION ALL
    SELECT CAST(p_partkey AS STRING), {choose("p_size", AD_NAMES)}, 'again', {choose("p_size", CAMPAIGNS)}, 'vid group'
    FROM {{part}}
"""


def _tiktok_streams(t: Tables, compression: str | None = None) -> dict[str, DataFrame]:
    basic = t.sql(_TT_BASIC)
    ads = t.sql(_TT_ADS)
    # Some ads have no video rows.
    video = basic.where("status = 'O'")
    p25 = F.col("p25")
    return {
        "tiktok.basic": as_envelope(
            basic,
            {"ad_id": "ad_id", "spend": F.col("spend").cast("string"), "impressions": "impressions", "clicks": "clicks", "stat_time_day": "day"},
            "loaded",
            compression,
        ),
        "tiktok.video": as_envelope(
            video,
            {
                "ad_id": "ad_id", "stat_time_day": "day", "video_views_p25": p25, "video_views_p50": p25 + 1,
                "video_views_p75": p25 + 2, "video_views_p100": p25 + 3, "video_play_actions": p25 + 4,
                "video_watched_2s": F.concat(p25.cast("string"), F.lit(".5")),
            },
            "loaded",
            compression,
        ),
        "tiktok.ads": as_envelope(ads, {c: c for c in ads.columns}),
    }


_TT_TYPED = f"(SELECT * REPLACE (TRY_CAST(ad_id AS BIGINT) AS ad_id) FROM ({_TT_BASIC}) r)"
_SQL_TIKTOK = f"""
    WITH basic AS {sql_first(_TT_TYPED + " y", "ad_id, day", LATEST_FIRST + nulls_last("spend", "impressions", "clicks"))},
    video AS {sql_first(f"(SELECT * FROM {_TT_TYPED} y WHERE status = 'O') z", "ad_id, day", LATEST_FIRST + nulls_last("p25"))},
    daily AS (SELECT b.ad_id AS stat_id, b.day, b.spend, b.impressions, b.clicks, v.p25 FROM basic b JOIN video v ON b.ad_id = v.ad_id AND b.day = v.day),
    ads AS (SELECT DISTINCT * FROM ({_TT_ADS}) a)
    SELECT clicks, round(spend, 2) AS media_cost, impressions, p25 AS video_25_completion, p25 + 1 AS video_50_completion,
      p25 + 2 AS video_75_completion, p25 + 3 AS video_100_completion, p25 + 4 AS video_play, CAST(NULL AS BIGINT) AS video_view,
      ads.ad_id, ad_text, campaign_name, adgroup_name, substr(day, 1, 10) AS date, ad_name AS creative_name, 'Tiktok' AS publisher,
      nullif(regexp_extract(adgroup_name, 'PLATFORM_([^_]+)', 1), '') AS audience_name,
      {sql_social("ad_name", "campaign_name", "adgroup_name")} AS media_format,
      {sql_token("ad_name", 5, 8, null_default=True)} AS ad_format_detail, {sql_token("ad_name", 6, 8, null_default=True)} AS ad_format,
      {sql_token("ad_name", 7, 8, null_default=True)} AS creative_descr, {sql_token("campaign_name", 1)} AS campaign_descr
    FROM daily LEFT JOIN ads ON TRY_CAST(ads.ad_id AS BIGINT) = stat_id
"""


@query("model_tiktok", _SQL_TIKTOK)
def model_tiktok(t: Tables) -> DataFrame:
    return comparable(run_model("tiktok", "mountain", Streams(t.spark, given=_tiktok_streams(t))))


# --- Hivestack ---------------------------------------------------------------

_HV_ROWS = f"""
    SELECT {MONTH_DAY} || CASE WHEN l_linestatus = 'O' THEN ' 06:00:00' ELSE '' END AS day,
           {choose("l_suppkey", CAMPAIGNS)} AS campaign, CAST(l_suppkey % 10 AS STRING) AS campaign_id, 'City ' || l_returnflag AS city,
           {choose("l_partkey", AD_NAMES)} AS creative, {choose("l_partkey", LINE_NAMES)} AS line_item,
           CAST(l_partkey % 6 AS STRING) AS line_item_id, CAST(l_linenumber AS STRING) || '%' AS concentration,
           l_quantity / 4 AS impressions, CAST(l_linenumber AS STRING) AS plays, l_discount AS progress, l_extendedprice AS spend,
           make_date(2024, 1, CAST(l_linenumber AS INT)) AS loaded
    FROM {{lineitem}}
"""


def _hivestack_streams(t: Tables, compression: str | None = None) -> dict[str, DataFrame]:
    rows = t.sql(_HV_ROWS)
    numbers = {c: F.col(c).cast("string") for c in ("impressions", "progress", "spend")}
    return {"hivestack.report": as_envelope(rows, {c: c for c in rows.columns if c not in ("day", "loaded")} | numbers | {"datetime": "day"}, "loaded", compression)}


def _sql_hivestack(label: Label) -> str:
    pick = sql_first(
        f"({_HV_ROWS}) r", "campaign_id, line_item_id, day, creative, plays",
        LATEST_FIRST + nulls_last("campaign", "city", "line_item", "CAST(replace(concentration, '%', '') AS DOUBLE)", "impressions", "progress", "spend"),
    )
    media_format = "'PDOOH' AS media_format," if label.hivestack_media_format else ""
    return f"""
    SELECT impressions, media_cost, campaign AS campaign_name, creative AS creative_name, {media_format} CAST(0 AS BIGINT) AS clicks,
      audience_name, date, 'Hivestack' AS publisher, {sql_token("campaign", 1, 2, null_default=True)} AS campaign_descr,
      {sql_token("creative", 7, 8)} AS ad_format_detail, {sql_token("creative", 5, 8)} AS creative_descr, {sql_token("creative", 6, 8)} AS ad_format
    FROM (SELECT campaign, creative, {sql_token("line_item", 7, 8, null_default=True)} AS audience_name, substr(day, 1, 10) AS date,
            round(sum(impressions), 2) AS impressions, round(sum(spend), 2) AS media_cost FROM {pick} p GROUP BY 1, 2, 3, 4) g
    """


@query("model_hivestack", _sql_hivestack(TOURISM))
def model_hivestack(t: Tables) -> DataFrame:
    return comparable(run_model("hivestack", "tourism", Streams(t.spark, given=_hivestack_streams(t))))


@query("model_hivestack_mountain", _sql_hivestack(MOUNTAIN))
def model_hivestack_mountain(t: Tables) -> DataFrame:
    return comparable(run_model("hivestack", "mountain", Streams(t.spark, given=_hivestack_streams(t))))


# --- Google Ads --------------------------------------------------------------

_GA_AD = f"""
    SELECT CAST(1 + p_partkey % 5 / 4 * 0 AS BIGINT) AS customer_id, p_partkey AS ad_group_ad_ad_id,
           {choose("p_size", AD_NAMES)} AS ad_group_ad_ad_name, 'https://x.example/' || p_size % 2 AS ad_group_ad_ad_final_urls
    FROM {{part}}
    UNION ALL
    SELECT CAST(1 AS BIGINT), p_partkey, {choose("p_partkey", AD_NAMES)}, 'https://x.example/' || p_size % 3 FROM {{part}}
    UNION ALL
    SELECT CAST(9 AS BIGINT), p_partkey, 'other account', 'https://other.example/' FROM {{part}}
"""
_GA_CAMPAIGN = f"""
    SELECT CAST(1 + s_suppkey % 2 AS BIGINT) AS customer_id, s_suppkey % 40 AS campaign_id,
           {choose("s_suppkey", [c for c in CAMPAIGNS if c] + ["Brand_push"])} AS campaign_name,
           CAST(s_nationkey % 3 AS STRING) AS campaign_campaign_budget,
           CASE s_nationkey % 4 WHEN 0 THEN 'ENABLED' WHEN 1 THEN 'PAUSED' WHEN 2 THEN 'REMOVED' END AS campaign_status,
           make_date(2024, 1, 1 + s_nationkey % 2) AS _LATEST_DATE
    FROM {{supplier}}
"""
_GA_GROUP = f"""
    SELECT CAST(1 AS BIGINT) AS customer_id, s_suppkey % 60 AS ad_group_id, {choose("s_suppkey", LINE_NAMES)} AS ad_group_name
    FROM {{supplier}}
"""
_GA_STATS = """
    SELECT CAST(1 + l_suppkey % 2 AS BIGINT) AS customer_id, l_partkey AS ad_group_ad_ad_id, l_suppkey % 70 AS ad_group_id,
           l_suppkey % 50 AS campaign_id, make_date(year(l_shipdate), 1, 1) AS _DATA_DATE, l_quantity / 4 AS metrics_conversions_value,
           l_quantity / 2 AS metrics_conversions, CAST(round(l_extendedprice * 100, 0) AS BIGINT) * 10000 AS metrics_cost_micros,
           CAST(l_linenumber AS BIGINT) AS metrics_clicks, CAST(l_quantity AS BIGINT) AS metrics_impressions,
           CAST(l_linenumber + 1 AS BIGINT) AS metrics_interactions
    FROM {lineitem}
"""
_GA_AD = _GA_AD.replace("CAST(1 + p_partkey % 5 / 4 * 0 AS BIGINT)", "CAST(1 AS BIGINT)")


def _google_streams(t: Tables) -> dict[str, DataFrame]:
    stats = t.sql(_GA_STATS)
    return {
        "google_ads.ad": t.sql(_GA_AD),
        "google_ads.campaign": t.sql(_GA_CAMPAIGN),
        "google_ads.ad_group": t.sql(_GA_GROUP),
        "google_ads.ad_stats": stats,
        "google_ads.campaign_stats": stats.drop("ad_group_ad_ad_id", "ad_group_id", "metrics_conversions_value"),
    }


def _sql_array(expr: str) -> str:
    return f"list_sort(list(DISTINCT {expr}) FILTER ({expr} IS NOT NULL))"


def _sql_campaigns(customer: int) -> str:
    return f"""(SELECT campaign_id, campaign_name, campaign_campaign_budget AS campaign_budget, _LATEST_DATE,
        coalesce({_sql_array("campaign_status")}, []) AS campaign_status
        FROM ({_GA_CAMPAIGN}) c WHERE customer_id = {customer} GROUP BY campaign_id, campaign_name, campaign_campaign_budget, _LATEST_DATE)"""


def _sql_mapped(names: str, n: int) -> str:
    return (
        f"array_to_string(list_filter(list_transform({names}, lambda x: string_split(x, '_')[{n + 1}]), "
        "lambda x: x IS NOT NULL AND x <> ''), '@')"
    )


_SQL_PLATFORMS = (
    "array_to_string(list_filter(list_transform(ad_group_name, lambda x: nullif(regexp_extract(x, 'PLATFORM_([^_]+)', 1), '')), "
    "lambda x: x IS NOT NULL), '@')"
)


def _sql_display(sep: str) -> str:
    order = nulls_last(
        "ad_name", "ad_group_name", "click_url", "revenue", "total_conversions", "media_cost", "clicks", "impressions",
        "interactions", "_LATEST_DATE", "campaign_external_id", "campaign_budget", "campaign_name", "campaign_status",
    )
    return f"""
    WITH ads AS (SELECT ad_group_ad_ad_id AS ad_id, ad_group_ad_ad_final_urls AS click_url,
                   {_sql_array("coalesce(ad_group_ad_ad_name, 'Unknown')")} AS ad_name
                 FROM ({_GA_AD}) a WHERE customer_id = 1 GROUP BY 1, 2),
    grps AS (SELECT ad_group_id, coalesce({_sql_array("ad_group_name")}, []) AS ad_group_name FROM ({_GA_GROUP}) g WHERE customer_id = 1 GROUP BY 1),
    camp AS {_sql_campaigns(1)},
    res AS (SELECT s.ad_group_ad_ad_id AS ad_id, ads.ad_name, grps.ad_group_name, ads.click_url, sum(metrics_conversions_value) AS revenue,
              sum(metrics_conversions) AS total_conversions, CAST(sum(metrics_cost_micros) AS DOUBLE) / 1000000 AS media_cost,
              CAST(sum(metrics_clicks) AS BIGINT) AS clicks, CAST(sum(metrics_impressions) AS BIGINT) AS impressions,
              CAST(sum(metrics_interactions) AS BIGINT) AS interactions, _DATA_DATE AS date, camp._LATEST_DATE,
              camp.campaign_id AS campaign_external_id, camp.campaign_budget, camp.campaign_name, camp.campaign_status
            FROM ({_GA_STATS}) s LEFT JOIN ads ON ads.ad_id = s.ad_group_ad_ad_id LEFT JOIN camp ON camp.campaign_id = s.campaign_id
            LEFT JOIN grps ON grps.ad_group_id = s.ad_group_id WHERE s.customer_id = 1
            GROUP BY s.ad_group_ad_ad_id, ads.ad_name, grps.ad_group_name, ads.click_url, _DATA_DATE, camp._LATEST_DATE,
              camp.campaign_id, camp.campaign_budget, camp.campaign_name, camp.campaign_status)
    SELECT ad_id, array_to_string(ad_name, '@') AS ad_name, array_to_string(ad_group_name, '@') AS ad_group_name, click_url,
      round(revenue, 2) AS revenue, round(total_conversions, 2) AS total_conversions, round(media_cost, 2) AS media_cost, clicks,
      impressions, interactions, strftime(date, '%Y-%m-%d') AS date, strftime(_LATEST_DATE, '%Y-%m-%d') AS _LATEST_DATE,
      campaign_external_id, campaign_budget, campaign_name, array_to_string(campaign_status, '@') AS campaign_status,
      CAST(1 AS BIGINT) AS row_num, 'Demand Gen' AS publisher, {_SQL_PLATFORMS} AS audience_name,
      {_sql_mapped("ad_name", 5)} AS media_format, {_sql_mapped("ad_name", 5)} AS ad_format_detail,
      {_sql_mapped("ad_name", 6)} AS ad_format, {_sql_mapped("ad_name", 7)} AS creative_descr, {sql_token("campaign_name", 1)} AS campaign_descr
    FROM {sql_first("res", "ad_id, date", order)} p
    """.replace("'@'", f"'{sep}'")


@query("model_google_ads_display", _sql_display("|"))
def model_google_ads_display(t: Tables) -> DataFrame:
    return comparable(run_model("google_ads_display", _label(TOURISM), Streams(t.spark, given=_google_streams(t))))


def _sql_search() -> str:
    order = nulls_last(
        "_LATEST_DATE", "campaign_budget", "campaign_name", "campaign_status", "total_conversions", "media_cost", "clicks",
        "impressions", "interactions",
    )
    return f"""
    WITH camp AS {_sql_campaigns(2)},
    res AS (SELECT sum(metrics_conversions) AS total_conversions, CAST(sum(metrics_cost_micros) AS DOUBLE) / 1000000 AS media_cost,
              CAST(sum(metrics_clicks) AS BIGINT) AS clicks, CAST(sum(metrics_impressions) AS BIGINT) AS impressions,
              CAST(sum(metrics_interactions) AS BIGINT) AS interactions, _DATA_DATE AS date, camp._LATEST_DATE, camp.campaign_id,
              camp.campaign_budget, camp.campaign_name, camp.campaign_status
            FROM ({_GA_STATS}) s LEFT JOIN camp ON camp.campaign_id = s.campaign_id WHERE s.customer_id = 2
            GROUP BY _DATA_DATE, camp._LATEST_DATE, camp.campaign_id, camp.campaign_budget, camp.campaign_name, camp.campaign_status),
    picked AS {sql_first("res", "date, campaign_id", order)}
    """


@query(
    "model_google_ads_search",
    f"""
    {_sql_search()}
    SELECT round(total_conversions, 2) AS total_conversions, round(media_cost, 2) AS media_cost, clicks, impressions, interactions,
      strftime(date, '%Y-%m-%d') AS date, strftime(_LATEST_DATE, '%Y-%m-%d') AS _LATEST_DATE, campaign_id, campaign_budget, campaign_name,
      'Google Ads Search' AS publisher, array_to_string(campaign_status, '|') AS campaign_status, CAST(1 AS BIGINT) AS row_number
    FROM picked
    """,
)
def model_google_ads_search(t: Tables) -> DataFrame:
    return comparable(run_model("google_ads_search", _label(TOURISM), Streams(t.spark, given=_google_streams(t))))


# --- GA4 ---------------------------------------------------------------------

_G4_ROWS = f"""
    SELECT CAST(CAST(ts AS DATE) AS STRING) AS day, {choose("user_id", SOURCE_MEDIUMS)} AS sm, {choose("user_id", GA4_CAMPAIGNS)} AS c,
           {choose("user_id", AD_CONTENTS)} AS ac, event_type AS event, event_id % 97 AS n, CAST(value AS STRING) AS v,
           date_trunc('day', ts) AS loaded
    FROM {{events}}
"""


def _ga4_streams(t: Tables) -> dict[str, DataFrame]:
    rows = t.sql(_G4_ROWS)
    members = {
        "date": F.replace("day", F.lit("-"), F.lit("")), "sessionSourceMedium": F.col("sm"), "sessionCampaignName": F.col("c"),
        "sessionManualAdContent": F.col("ac"), "eventName": F.col("event"), "eventCount": F.col("n").cast("string"),
        "eventValue": F.col("v"), "report_start_date": F.lit("2024-01-01"), "report_end_date": F.col("day"),
    }
    return {"ga4.goal": as_envelope(rows, members, "loaded")}


_SQL_GA4_GOAL = f"""
    SELECT day AS date, {sql_display_source("sm")} AS "sessionSourceMedium", c AS "sessionCampaignName", c AS campaign_name,
      ac AS "sessionManualAdContent", sm AS "sessionSourceMediumraw", event AS "eventName", n AS "eventCount", v AS "eventValue",
      '2024-01-01' AS report_start_date, day AS report_end_date, strftime(loaded, '%Y-%m-%d %H:%M:%S') AS _sdc_extracted_at,
      strftime(loaded, '%Y-%m-%d %H:%M:%S') AS _sdc_received_at, strftime(loaded, '%Y-%m-%d %H:%M:%S') AS _sdc_batched_at,
      CAST(NULL AS VARCHAR) AS _sdc_deleted_at, CAST(epoch_ms(loaded) AS BIGINT) AS _sdc_sequence,
      CAST(NULL AS BIGINT) AS _sdc_table_version, {sql_site_name("sm", "c")} AS site_name
    FROM {sql_first(f"({_G4_ROWS}) r", "day, sm, c, ac, event", f"loaded DESC NULLS LAST, {nulls_last('n', 'v')}")} p
"""


@query("model_ga4_goal", _SQL_GA4_GOAL)
def model_ga4_goal(t: Tables) -> DataFrame:
    return comparable(run_model("ga4_goal", "tourism", Streams(t.spark, given=_ga4_streams(t))))


@query(
    "model_ga4_channel",
    f"""
    WITH goal AS ({_SQL_GA4_GOAL}),
    named AS (SELECT *, {sql_channel("site_name")} AS channel,
        {sql_ga4_publisher('"sessionSourceMedium"', "site_name", '"sessionCampaignName"', '"sessionManualAdContent"')} AS publisher,
        coalesce(string_split(campaign_name, '_')[2], campaign_name) AS raw_name FROM goal),
    spelling AS (SELECT lower(raw_name) AS k, min(raw_name) AS s FROM named GROUP BY 1)
    SELECT named.* EXCLUDE (raw_name), s AS campaign_name_selection FROM named LEFT JOIN spelling ON k = lower(raw_name)
    """,
)
def model_ga4_channel(t: Tables) -> DataFrame:
    return comparable(run_model("ga4_channel", "tourism", Streams(t.spark, given=_ga4_streams(t))))


# --- reporting tables --------------------------------------------------------

# Every publisher but Stuff is known, in another case; one of them twice.
_LOOKUP = """
    SELECT DISTINCT upper(publisher) AS publisher, 'Channel ' || length(publisher) AS channel, 'NZ' AS region FROM (
      SELECT CASE p_size % 12 WHEN 0 THEN 'facebook' WHEN 1 THEN 'hivestack' WHEN 2 THEN 'dv360' WHEN 3 THEN 'nzme'
        WHEN 4 THEN 'youtube' WHEN 5 THEN 'ttd' WHEN 6 THEN 'demand gen' WHEN 7 THEN 'tiktok' WHEN 8 THEN 'threenow'
        WHEN 9 THEN 'spotify' WHEN 10 THEN 'google ads search' WHEN 11 THEN 'tvnz' END AS publisher FROM {part}) x
    UNION ALL SELECT 'Nzme', 'Second channel', 'AU' FROM (SELECT DISTINCT r_regionkey FROM {region} WHERE r_name = 'ASIA') y
"""
_SQL_VOCABULARY = "['aud', 'disp', 'native', 'pdooh', 'rmdisp', 'social', 'vid', 'vidod', 'yt']"
_SQL_WORD = f"""coalesce(list_filter(string_split(creative_name, '_'), lambda x: list_contains({_SQL_VOCABULARY}, lower(x)))[1],
        list_filter(string_split(campaign_name, '_'), lambda x: list_contains({_SQL_VOCABULARY}, lower(x)))[1], 'Other')"""


def _sql_labelled(facts: str) -> str:
    """SQL text: lookup, canonical campaign and media format on top of facts."""
    return f"""
    , chan AS (SELECT f.* EXCLUDE (publisher), k.region, f.publisher, k.channel,
                 coalesce(string_split(campaign_name, '_')[2], campaign_name) AS raw_name
               FROM {facts} f JOIN ({_LOOKUP}) k ON lower(f.publisher) = lower(k.publisher)),
    spelling AS (SELECT lower(raw_name) AS k, min(raw_name) AS s FROM chan GROUP BY 1)
    SELECT chan.* EXCLUDE (raw_name), trim(s) AS campaign_name_selection, {_SQL_WORD} AS media_format
    FROM chan LEFT JOIN spelling ON k = lower(raw_name)
    """


# Columns of the unified table and their types; dates are compared as text.
_SQL_TYPES = {
    "media_cost": "DOUBLE", "impressions": "DOUBLE", "clicks": "BIGINT", "creative_name": "VARCHAR", "audience_name": "VARCHAR",
    "ad_format": "VARCHAR", "ad_format_detail": "VARCHAR", "video_completion": "DOUBLE", "video_25_completion": "DOUBLE",
    "video_50_completion": "DOUBLE", "video_75_completion": "DOUBLE", "video_views": "BIGINT", "campaign_name": "VARCHAR",
    "publisher": "VARCHAR", "campaign_descr": "VARCHAR", "creative_descr": "VARCHAR", "date": "VARCHAR",
}
_SQL_WHOLE_VIDEO = {
    "video_completion": "BIGINT", "video_25_completion": "BIGINT", "video_50_completion": "BIGINT", "video_75_completion": "BIGINT",
}


def _sql_part(model: str, whole_video: bool = False, **columns: str) -> str:
    """SQL text: one source on the contract; columns given by name are expressions."""
    types = _SQL_TYPES | (_SQL_WHOLE_VIDEO if whole_video else {})
    picked = [f"CAST({columns.get(name, name)} AS {kind}) AS {name}" for name, kind in types.items()]
    return f"SELECT {', '.join(picked)} FROM ({model}) m"


_NO_VIDEO = {c: "0" for c in ("video_completion", "video_25_completion", "video_50_completion", "video_75_completion", "video_views")}
_SQL_TOURISM = " UNION ALL ".join(
    [
        _sql_part(_sql_facebook(TOURISM), video_views="video_played"),
        _sql_part(_SQL_DV_STANDARD, video_views="video_25_completion"),
        _sql_part(_SQL_CM_DIRECT.replace("@advertiser", ADVERTISER["tourism"]), **_NO_VIDEO),
        _sql_part(_SQL_TTD_TRANSFORMED),
        _sql_part(_sql_hivestack(TOURISM), clicks="0", **_NO_VIDEO),
        _sql_part(_sql_display(", "), creative_name="ad_group_name", **_NO_VIDEO),
    ]
)
_SQL_MOUNTAIN = " UNION ALL ".join(
    [
        _sql_part(_sql_facebook(MOUNTAIN), True, video_views="video_played"),
        _sql_part(_SQL_DV_STANDARD, True, video_views="video_25_completion"),
        _sql_part(_SQL_CM_DIRECT.replace("@advertiser", ADVERTISER["mountain"]), True, **_NO_VIDEO),
        _sql_part(_SQL_TIKTOK, True, video_completion="video_100_completion", video_views="video_view"),
        _sql_part(_sql_hivestack(MOUNTAIN), True, clicks="0", **_NO_VIDEO),
    ]
)


# Their readers take small pieces, so the documents may be packed closely.
_BUILDERS = {
    "facebook": partial(_facebook_streams, compression="zstd"),
    "dv360": partial(_dv360_streams, compression="zstd"),
    "cm360": partial(_cm360_streams, compression="zstd"),
    "ttd": _ttd_streams,
    "tiktok": partial(_tiktok_streams, compression="zstd"),
    "hivestack": partial(_hivestack_streams, compression="zstd"),
    "google_ads": _google_streams,
}


class _MediaRows(Mapping):
    """The raw streams of a label's media sources: staged when a model first asks for one of a platform, removed when its facts are stored."""

    def __init__(self, t: Tables, label: Label):
        self.t = t
        self.platforms = [p for p in _BUILDERS if any(s.startswith(p) for s in label.media_sources)]
        self.lookup = {"publisher_channel": stage(t.sql(_LOOKUP), "publisher_channel")}
        self.made: dict[str, tuple[Staging, dict[str, DataFrame]]] = {}

    def _of(self, platform: str) -> dict[str, DataFrame]:
        if platform not in self.made:
            space = Staging(self.t.spark)
            with raw_in(space):
                self.made[platform] = space, _BUILDERS[platform](self.t)
        return self.made[platform][1]

    def done(self, source: str) -> None:
        for platform in [p for p in self.made if source.startswith(p)]:
            self.made.pop(platform)[0].close()

    def __getitem__(self, name: str) -> DataFrame:
        platform = name.split(".")[0]
        if platform not in self.platforms or "@" in name:  # rows are the same for every label
            return self.lookup[name]
        return self._of(platform)[name]

    def __iter__(self) -> Iterator[str]:
        return chain(self.lookup, *(self._of(p) for p in self.platforms))

    def __len__(self) -> int:
        return len([*self])


def _media_streams(t: Tables, label: Label) -> Streams:
    rows = _MediaRows(t, label)
    return Streams(t.spark, given=rows, done=rows.done)


@query("model_dash_table", f"WITH facts AS ({_SQL_TOURISM}) {_sql_labelled('facts')}")
def model_dash_table(t: Tables) -> DataFrame:
    return comparable(run_model("dash_table", _label(TOURISM), _media_streams(t.wide(), TOURISM)))


@query("model_dash_table_mountain", f"WITH facts AS ({_SQL_MOUNTAIN}) {_sql_labelled('facts')}")
def model_dash_table_mountain(t: Tables) -> DataFrame:
    return comparable(run_model("dash_table", _label(MOUNTAIN), _media_streams(t.wide(), MOUNTAIN)))


@query(
    "model_dash_table_search",
    f"""
    {_sql_search()}
    SELECT clicks, impressions, media_cost, campaign_name, date, search_type, channel, region, k.publisher FROM
      (SELECT CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(impressions) AS BIGINT) AS impressions, round(sum(media_cost), 2) AS media_cost,
         campaign_name, strftime(date, '%Y-%m-%d') AS date, 'Google Ads Search' AS publisher,
         CASE WHEN regexp_matches(lower(campaign_name), 'brand') THEN 'Brand Search' ELSE 'Generic Search' END AS search_type
       FROM picked GROUP BY campaign_name, picked.date) s JOIN ({_LOOKUP}) k ON lower(k.publisher) = lower(s.publisher)
    """,
)
def model_dash_table_search(t: Tables) -> DataFrame:
    given = {**_google_streams(t), "publisher_channel": stage(t.sql(_LOOKUP), "publisher_channel")}
    return comparable(run_model("dash_table_search", _label(TOURISM), Streams(t.spark, given=given)))


@query(
    "labels_hivestack",
    f"""
    SELECT 'tourism' AS label, publisher, count(*) AS n, round(sum(media_cost), 2) AS media_cost FROM ({_sql_hivestack(TOURISM)}) a GROUP BY 2
    UNION ALL
    SELECT 'mountain', publisher, count(*), round(sum(media_cost), 2) FROM ({_sql_hivestack(MOUNTAIN)}) b GROUP BY 2
    """,
)
def labels_hivestack(t: Tables) -> DataFrame:
    both = run_labels("hivestack", [TOURISM, MOUNTAIN], Streams(t.spark, given=_hivestack_streams(t)))
    return comparable(
        both.groupBy("label", "publisher").agg(F.count("*").alias("n"), F.sum("media_cost").alias("media_cost"))
    )


# --- flagship ----------------------------------------------------------------

_UNIFIED = {
    "lineitem": f"""
        SELECT l_extendedprice AS media_cost, l_quantity AS impressions, CAST(l_linenumber AS BIGINT) AS clicks,
          {choose("l_partkey", AD_NAMES)} AS creative_name, l_returnflag AS audience_name, l_linestatus AS ad_format,
          CAST(NULL AS STRING) AS ad_format_detail, {choose("l_suppkey", CAMPAIGNS)} AS campaign_name,
          {choose("l_suppkey", ["Facebook", "Nzme", "Stuff", "Dv360"])} AS publisher, CAST(NULL AS STRING) AS campaign_descr,
          CAST(NULL AS STRING) AS creative_descr, CAST(l_shipdate AS DATE) AS date FROM {{lineitem}}""",
    "orders": f"""
        SELECT o_totalprice AS media_cost, 1.0 AS impressions, CAST(0 AS BIGINT) AS clicks,
          {choose("o_custkey", AD_NAMES)} AS creative_name, o_orderpriority AS audience_name, o_orderstatus AS ad_format,
          CAST(NULL AS STRING) AS ad_format_detail, {choose("o_custkey", CAMPAIGNS)} AS campaign_name,
          'Hivestack' AS publisher, CAST(NULL AS STRING) AS campaign_descr, CAST(NULL AS STRING) AS creative_descr,
          CAST(o_orderdate AS DATE) AS date FROM {{orders}}""",
    "events": f"""
        SELECT 0.0 AS media_cost, value AS impressions, user_id AS clicks, {choose("user_id", AD_NAMES)} AS creative_name,
          event_type AS audience_name, CAST(NULL AS STRING) AS ad_format, CAST(NULL AS STRING) AS ad_format_detail,
          {choose("user_id", GA4_CAMPAIGNS)} AS campaign_name, {choose("user_id", ["tiktok", "YOUTUBE", None])} AS publisher,
          CAST(NULL AS STRING) AS campaign_descr, CAST(NULL AS STRING) AS creative_descr, CAST(ts AS DATE) AS date FROM {{events}}""",
}


@query(
    "dash_unified",
    "WITH facts AS ("
    + " UNION ALL ".join(
        _sql_part(sql, **_NO_VIDEO, media_cost="round(media_cost, 2)", impressions="round(impressions, 2)", date="strftime(date, '%Y-%m-%d')")
        for sql in _UNIFIED.values()
    )
    + f") {_sql_labelled('facts')}",
)
def dash_unified(t: Tables) -> DataFrame:
    """Three sources, zero-filled union, lookup, canonical campaign, media format."""
    frames = {name: t.sql(sql) for name, sql in _UNIFIED.items()}
    facts = unify(frames, given={name: {c: F.lit(0) for c in _NO_VIDEO} for name in frames})
    lookup = stage(t.sql(_LOOKUP), "publisher_channel")
    return comparable(dash.label_facts(facts, lookup))
