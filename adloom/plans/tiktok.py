"""TikTok ads: basic and video metrics of the same ad and day, with the ad's names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adloom.functions.casts import datetime_day
from adloom.functions.names import Token, decode_names, regex_first
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import LATEST
from adloom.plans.dv360 import PLATFORM
from adloom.plans.formats import social_format
from adloom.plans.labels import Label
from adloom.sources import payloads
from adloom.sources.streams import Streams

_METRICS = [
    "clicks", "media_cost", "impressions", "video_25_completion", "video_50_completion", "video_75_completion",
    "video_100_completion", "video_play", "video_view",
]


def tiktok(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    def daily_rows(stream, wanted):
        parsed = streams.rows(stream, label.name, wanted, ["ad_id", "date"], strict, day="date")
        return pick_one(parsed, ["ad_id", "date"], LATEST).drop(*LATEST)

    basic = daily_rows("tiktok.basic", payloads.TIKTOK_BASIC)
    video = daily_rows("tiktok.video", payloads.TIKTOK_VIDEO)
    ads = streams.rows("tiktok.ads", label.name, payloads.TIKTOK_ADS, strict=strict, keep=()).distinct()

    # Both sides are partitioned by (ad_id, date) after the pick, so the join
    # needs no further shuffle, and it has one row per key: its sums are the row's
    # own values. Days without video rows vanish.
    stats = basic.join(video, ["ad_id", "date"], "inner").withColumnRenamed("ad_id", "stat_ad_id")
    # Ad ids are text here and integers there; several versions of an ad repeat its metrics.
    named = stats.join(ads, F.col("stat_ad_id") == F.col("ad_id").try_cast("bigint"), "left").drop("stat_ad_id")

    guard = {"min_len": 8, "default": "Other", "null_default": "Other"}
    decoded = decode_names(
        social_format(named, ["ad_name", "campaign_name", "adgroup_name"]),
        {
            "ad_format_detail": Token("ad_name", 5, **guard),
            "ad_format": Token("ad_name", 6, **guard),
            "creative_descr": Token("ad_name", 7, **guard),
            "campaign_descr": Token("campaign_name", 1),
        },
    )
    return decoded.select(
        *_METRICS, "ad_id", "ad_text", "campaign_name", "adgroup_name",
        datetime_day(F.col("date"), strict).alias("date"),
        F.col("ad_name").alias("creative_name"),
        F.lit("Tiktok").alias("publisher"),
        regex_first(F.col("adgroup_name"), PLATFORM).alias("audience_name"),
        "media_format", "ad_format_detail", "ad_format", "creative_descr", "campaign_descr",
    )
