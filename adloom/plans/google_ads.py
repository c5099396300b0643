"""Google Ads: display ads with array-valued attributes, and search campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adloom.functions.casts import from_micros
from adloom.functions.names import map_regex, map_tokens, token
from adloom.operators.arrays import distinct_array
from adloom.operators.dedup import pick_one
from adloom.plans.dv360 import PLATFORM
from adloom.plans.labels import Label
from adloom.sources.streams import Streams

_COUNTS = ["clicks", "impressions", "interactions"]


def _sums(*names: str) -> list:
    return [F.sum(n).alias(n) for n in names]


def campaign_attributes(campaigns: DataFrame) -> DataFrame:
    """One row per campaign version, with all its statuses in one array."""
    versions = campaigns.select(
        F.col("campaign_id").alias("known_campaign"),
        F.col("campaign_campaign_budget").alias("campaign_budget"),
        "_LATEST_DATE",
        "campaign_name",
        "campaign_status",
    )
    return distinct_array(
        versions, ["known_campaign", "campaign_budget", "_LATEST_DATE", "campaign_name"], ["campaign_status"]
    )


def first_version(campaigns: DataFrame) -> DataFrame:
    """The version of every campaign that a pick by its attributes takes.

    All versions of a campaign get the same sums, so a pick that compares
    attributes can only end at this one; the others would repeat every row.
    """
    return pick_one(
        campaigns, ["known_campaign"], tie_break=["_LATEST_DATE", "campaign_budget", "campaign_name", "campaign_status"]
    )


def _of_customer(streams: Streams, label: Label, customer_id: int):
    def read(name: str) -> DataFrame:
        return streams.read(name, label.name).where(F.col("customer_id") == customer_id)

    return read


def google_ads_display(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    read = _of_customer(streams, label, label.account("display_customer_id"))
    ads = distinct_array(
        read("google_ads.ad").select(
            F.col("ad_group_ad_ad_id").alias("ad_id"),
            F.col("ad_group_ad_ad_final_urls").alias("click_url"),
            F.coalesce("ad_group_ad_ad_name", F.lit("Unknown")).alias("ad_name"),
        ),
        ["ad_id", "click_url"],
        ["ad_name"],
    )
    # An ad's names and links are compared before its sums, which they do not
    # change: one version of each ad is left to join, as of each campaign.
    ads = pick_one(ads, ["ad_id"], tie_break=["ad_name", "click_url"])
    groups = distinct_array(read("google_ads.ad_group"), ["ad_group_id"], ["ad_group_name"])
    campaigns = first_version(campaign_attributes(read("google_ads.campaign")))

    # Sum per raw key before the joins; the sums carry over.
    metrics = ["revenue", "total_conversions", "cost_micros", *_COUNTS]
    stats = (
        read("google_ads.ad_stats")
        .groupBy(
            F.col("_DATA_DATE").alias("date"),
            F.col("ad_group_ad_ad_id").alias("ad_id"),
            "ad_group_id",
            "campaign_id",
        )
        .agg(
            F.sum("metrics_conversions_value").alias("revenue"),
            F.sum("metrics_conversions").alias("total_conversions"),
            F.sum("metrics_cost_micros").alias("cost_micros"),
            *[F.sum(f"metrics_{c}").alias(c) for c in _COUNTS],
        )
    )
    per_ad = (
        stats.join(campaigns, stats.campaign_id == campaigns.known_campaign, "left")
        .join(groups, "ad_group_id", "left")
        .join(ads, "ad_id", "left")
        .groupBy(
            "date", "ad_id", "ad_name", F.col("known_campaign").alias("campaign_external_id"), "campaign_budget",
            "_LATEST_DATE", "campaign_status", "campaign_name", "click_url", "ad_group_name",
        )
        .agg(*_sums(*metrics))
    )
    order = [
        "ad_name", "ad_group_name", "click_url", "revenue", "total_conversions", "media_cost", *_COUNTS,
        "_LATEST_DATE", "campaign_external_id", "campaign_budget", "campaign_name", "campaign_status",
    ]
    costed = per_ad.withColumn("media_cost", from_micros(F.col("cost_micros"))).drop("cost_micros")
    picked = pick_one(costed, ["ad_id", "date"], tie_break=order, number_as="row_num")
    return picked.select(
        "ad_id", *order[:9], "date", *order[9:], "row_num",
        F.lit("Demand Gen").alias("publisher"),
        map_regex(F.col("ad_group_name"), PLATFORM).alias("audience_name"),
        map_tokens(F.col("ad_name"), 5).alias("media_format"),
        map_tokens(F.col("ad_name"), 5).alias("ad_format_detail"),
        map_tokens(F.col("ad_name"), 6).alias("ad_format"),
        map_tokens(F.col("ad_name"), 7).alias("creative_descr"),
        token(F.col("campaign_name"), 1).alias("campaign_descr"),
    )


def google_ads_search(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    read = _of_customer(streams, label, label.account("search_customer_id"))
    campaigns = first_version(campaign_attributes(read("google_ads.campaign")))
    metrics = ["total_conversions", "cost_micros", *_COUNTS]
    stats = (
        read("google_ads.campaign_stats")
        .groupBy(F.col("_DATA_DATE").alias("date"), "campaign_id")
        .agg(
            F.sum("metrics_conversions").alias("total_conversions"),
            F.sum("metrics_cost_micros").alias("cost_micros"),
            *[F.sum(f"metrics_{c}").alias(c) for c in _COUNTS],
        )
    )
    # Stats of unknown campaigns fall together in one NULL campaign per day.
    per_campaign = (
        stats.join(campaigns, stats.campaign_id == campaigns.known_campaign, "left")
        .groupBy(
            "date", F.col("known_campaign").alias("campaign_id"), "campaign_budget", "_LATEST_DATE",
            "campaign_status", "campaign_name",
        )
        .agg(*_sums(*metrics))
    )
    costed = per_campaign.withColumn("media_cost", from_micros(F.col("cost_micros")))
    values = ["total_conversions", "media_cost", *_COUNTS]
    attributes = ["_LATEST_DATE", "campaign_budget", "campaign_name", "campaign_status"]
    picked = pick_one(
        costed.drop("cost_micros"), ["date", "campaign_id"], tie_break=attributes + values, number_as="row_number"
    )
    return picked.select(
        *values, "date", "_LATEST_DATE", "campaign_id", "campaign_budget", "campaign_name",
        F.lit("Google Ads Search").alias("publisher"), "campaign_status", "row_number",
    )
