"""Hivestack out-of-home report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adloom.functions.casts import day_of
from adloom.functions.names import Token, decode_names, token
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import LATEST
from adloom.plans.labels import Label
from adloom.sources import payloads
from adloom.sources.streams import Streams


def hivestack(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    keys = ["campaign_id", "line_item_id", "date", "creative_name", "plays"]
    parsed = streams.rows("hivestack.report", label.name, payloads.HIVESTACK_REPORT, keys, strict, day="date")
    picked = pick_one(parsed, keys, LATEST)
    audience = token(F.col("line_item"), 7, min_len=8, default="Other", null_default="Other")
    # Sums of sums are one sum: a single grouping at the reported grain. The
    # other labels follow from the group keys.
    grouped = picked.groupBy(
        "campaign_name", "creative_name", audience.alias("audience_name"), day_of(F.col("date"), strict).alias("date")
    ).agg(F.sum("impressions").alias("impressions"), F.sum("media_cost").alias("media_cost"))
    decoded = decode_names(
        grouped,
        {
            "campaign_descr": Token("campaign_name", 1, min_len=2, default="Other", null_default="Other"),
            "ad_format_detail": Token("creative_name", 7, min_len=8, default="Other"),
            "creative_descr": Token("creative_name", 5, min_len=8, default="Other"),
            "ad_format": Token("creative_name", 6, min_len=8, default="Other"),
        },
    ).withColumns(
        {"publisher": F.lit("Hivestack"), "media_format": F.lit("PDOOH"), "clicks": F.lit(0).cast("bigint")}
    )
    tail = ["clicks", "audience_name", "ad_format_detail", "date", "publisher", "campaign_descr", "creative_descr"]
    if label.hivestack_media_format:
        return decoded.select(
            "impressions", "media_cost", "creative_name", "ad_format", "campaign_name", "media_format", *tail
        )
    return decoded.select("impressions", "media_cost", "ad_format", "campaign_name", "creative_name", *tail)
