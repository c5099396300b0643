"""CM360 report: one row per full set of attributes, for one advertiser."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adloom.functions.names import Token, decode_names, initcap_punct, regex_first, token
from adloom.operators.classify import classify
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import LATEST, Field
from adloom.plans import rules
from adloom.plans.labels import Label
from adloom.sources import payloads
from adloom.sources.streams import Streams

KEYS = [f.name for f in payloads.CM360_ATTRIBUTES]


def _rows(streams: Streams, label: Label, wanted: list[Field], strict: bool) -> DataFrame:
    advertiser = label.account("cm360_advertiser")
    return streams.rows("cm360.report", label.name, wanted, KEYS, strict, day="date", advertiser=advertiser)


def cm360_serialised(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    parsed = _rows(streams, label, payloads.CM360_ATTRIBUTES + payloads.CM360_METRICS, strict)
    return pick_one(parsed, KEYS, LATEST, number_as="row_num").drop(*LATEST)


def exclude_sites(df: DataFrame, col: str, sites: list[str]) -> DataFrame:
    """Drop the listed sites, case ignored; a NULL site is dropped too."""
    return df.where(~F.lower(col).isin(*sites))


def cm360_direct_buy(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    parsed = _rows(streams, label, payloads.CM360_ATTRIBUTES + payloads.CM360_METRICS + payloads.CM360_SITE, strict)
    bought = exclude_sites(parsed, "site_name", rules.CM360_EXCLUDED_SITES)
    # The site is no key though it drives the labels: it settles ties.
    picked = pick_one(bought, KEYS, LATEST, tie_break=["site_name", "clicks", "impressions"], number_as="row_num")
    picked = picked.drop(*LATEST)

    first_word = initcap_punct(token(F.col("site_name"), 0, sep=" "))
    medium = token(regex_first(F.col("click_through_url"), "utm_medium=([^&]+)"), 1, sep="-")
    published = classify(picked, "publisher", rules.CM360_PUBLISHER, first_word)
    formatted = classify(
        published.withColumn("__medium", medium), "media_format", rules.CM360_MEDIA_FORMAT, F.col("__medium")
    )
    decoded = decode_names(
        formatted,
        {
            "audience_name": Token("placement", 4, min_len=5, default="Other", null_default="Other"),
            "ad_format_detail": Token("creative_name", 5, min_len=6, default="Other", null_default="Other"),
            "ad_format": Token("creative_name", 6),
            "creative_descr": Token("creative_name", 7),
            "campaign_descr": Token("campaign_name", 2),
        },
    )
    return decoded.withColumn("media_cost", F.lit(0).cast("bigint")).select(
        *picked.columns, "publisher", "audience_name", "media_format", "ad_format_detail", "ad_format",
        "creative_descr", "campaign_descr", "media_cost",
    )
