"""The Trade Desk standard report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adloom.functions.names import Token, decode_names
from adloom.operators.classify import classify
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import LATEST
from adloom.plans import rules
from adloom.plans.formats import ttd_format
from adloom.plans.labels import Label
from adloom.sources import payloads
from adloom.sources.streams import Streams

_SERIALISED_KEYS = [
    "date", "partner_id", "advertiser_id", "campaign_id", "ad_group_id", "ad_format", "creative_id", "frequency",
    "advertiser", "campaign_name", "ad_group", "creative", "deal_id", "ad_server_name",
    "ad_server_creative_placement_id", "impressions", "clicks",
]
_TRANSFORMED_KEYS = [
    "date", "partner_id", "advertiser_id", "campaign_id", "ad_group_id", "ad_format", "creative_id", "advertiser",
    "campaign_name", "ad_group", "creative", "deal_id", "ad_server_creative_placement_id",
]

# Summed columns of the transformed model, by report column.
_SUMS = {
    "player_25_complete": "video_25_completion",
    "player_50_complete": "video_50_completion",
    "player_75_complete": "video_75_completion",
    "player_100_complete": "video_completion",
    "clicks": "clicks",
    "video_views": "video_views",
    "impressions": "impressions",
    "partner_cost_partner_currency": "media_cost",
}


def _labels(df: DataFrame) -> DataFrame:
    """Labels that follow from the campaign and creative names alone."""
    published = classify(df, "publisher", rules.TTD_PUBLISHER, rules.TTD_PUBLISHER_DEFAULT)
    return decode_names(
        published,
        {
            "audience_name": Token("creative", 7, min_len=8, default="Other"),
            "creative_descr": Token("creative", 5, min_len=8, default="Other"),
            "ad_format_detail": Token("creative", 7, min_len=8, default="Other"),
            "campaign_descr": Token("campaign_name", 1, min_len=2, default="Other"),
        },
    )


def ttd_serialised(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    parsed = streams.rows("ttd.standard", label.name, payloads.TTD_STANDARD, _SERIALISED_KEYS, strict, day="date")
    picked = pick_one(parsed, _SERIALISED_KEYS, LATEST, number_as="row_num").drop(*LATEST)
    return _labels(ttd_format(picked)).select(
        *picked.columns, "publisher", "media_format", "audience_name", "creative_descr", "ad_format_detail",
        "campaign_descr",
    )


def ttd_transformed(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    needed = [f for f in payloads.TTD_STANDARD if f.name in {*_TRANSFORMED_KEYS, *_SUMS}]
    parsed = streams.rows("ttd.standard", label.name, needed, _TRANSFORMED_KEYS, strict, day="date")
    picked = ttd_format(pick_one(parsed, _TRANSFORMED_KEYS, LATEST).drop(*LATEST))
    # Only media_format needs the ad group; the other labels follow from group
    # keys, so they are worked out once per result row.
    grouped = picked.groupBy(
        "ad_server_creative_placement_id", "date", "campaign_name", "campaign_id", "creative", "creative_id",
        "advertiser", "advertiser_id", "media_format", "ad_format",
    ).agg(*[F.sum(c).alias(name) for c, name in _SUMS.items()])
    return (
        _labels(grouped)
        .withColumnRenamed("creative", "creative_name")
        .select(
            "ad_server_creative_placement_id", "date", "campaign_name", "campaign_id", "creative_name", "creative_id",
            "advertiser", "advertiser_id", "publisher", "media_format", "audience_name", "ad_format",
            "ad_format_detail", "creative_descr", "campaign_descr", *_SUMS.values(),
        )
    )
