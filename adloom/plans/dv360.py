"""DV360 reports: the highest-revenue row per day, insertion order, line item and ad."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adloom.functions.names import Token, decode_names, regex_first
from adloom.operators.classify import classify
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import LATEST
from adloom.plans import rules
from adloom.plans.formats import dv360_format
from adloom.plans.labels import Label
from adloom.sources import payloads
from adloom.sources.streams import Streams

# Fixed value: the platform in a coded line item name.
PLATFORM = "PLATFORM_([^_]+)"


def dv360_standard(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    keys = ["date", "campaign_id", "line_item_id", "creative_name"]
    parsed = streams.rows("dv360.standard", label.name, payloads.DV360_STANDARD, keys, strict, day="date")
    best = pick_one(
        parsed,
        keys,
        ["media_cost", *LATEST],
        number_as="row_num",
    ).drop(*LATEST)
    formatted = best.withColumn("media_format", dv360_format(F.col("campaign_name")))
    published = classify(formatted, "publisher", rules.DV360_PUBLISHER, rules.DV360_PUBLISHER_DEFAULT)
    constant = published.withColumns({c: F.lit("No Valid") for c in ("creative_descr", "ad_format", "ad_format_detail")})
    decoded = decode_names(
        constant,
        {
            "audience_name": Token("line_item", 7, min_len=8, default="Other"),
            "campaign_descr": Token("campaign_name", 1, min_len=2, default="Other"),
        },
    )
    return decoded.select(
        *best.columns, "media_format", "publisher", "audience_name", "creative_descr", "ad_format",
        "ad_format_detail", "campaign_descr",
    )


def dv360_youtube(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    keys = ["date", "campaign_id", "line_item_id", "youtube_ad"]
    parsed = streams.rows("dv360.youtube", label.name, payloads.DV360_YOUTUBE, keys, strict, day="date")
    best = pick_one(
        parsed,
        keys,
        ["media_cost", *LATEST],
    ).drop(*LATEST)
    labelled = best.withColumns(
        {
            "audience_name": regex_first(F.col("line_item"), PLATFORM),
            "publisher": F.lit("Youtube"),
            "media_format": F.lit("Youtube Video"),
            "ad_format": F.lit("No Valid"),
        }
    )
    decoded = decode_names(
        labelled,
        {
            "ad_format_detail": Token("youtube_ad", 5, min_len=8, default="Other"),
            "creative_descr": Token("youtube_ad", 7, min_len=8, default="Other"),
            "campaign_descr": Token("campaign_name", 1, min_len=2, default="Other"),
        },
    )
    return decoded.select(
        *best.columns, "audience_name", "publisher", "media_format", "ad_format_detail", "creative_descr",
        "ad_format", "campaign_descr",
    )
