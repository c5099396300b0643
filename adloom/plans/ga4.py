"""GA4 goal report: latest load per key, site names, channels and publishers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from adloom.functions.names import initcap_punct, token
from adloom.operators.canonical import canonical_spelling
from adloom.operators.classify import classify
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import LATEST, LOAD_COLUMNS
from adloom.plans import rules
from adloom.plans.labels import Label
from adloom.sources import payloads
from adloom.sources.staging import stage
from adloom.sources.streams import Streams


def display_source(source_medium: Column) -> Column:
    """``google / cpc`` -> ``Google ``: the text before the slash, capitalised, blank kept."""
    return initcap_punct(token(source_medium, 0, sep="/"))


def campaign_token(campaign: Column) -> Column:
    """Second token of a coded campaign name, the whole name when there is none."""
    return F.coalesce(token(campaign, 1), campaign)


def ga4_goal(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    keys = ["date", "sessionSourceMediumraw", "sessionCampaignName", "sessionManualAdContent", "eventName"]
    parsed = streams.rows("ga4.goal", label.name, payloads.GA4_GOAL, keys, strict, list(LOAD_COLUMNS), day="date")
    latest = pick_one(parsed, keys, LATEST)
    named = classify(latest, "site_name", rules.GA4_SITE_NAME, rules.GA4_SITE_NAME_DEFAULT)
    return named.select(
        "date",
        display_source(F.col("sessionSourceMediumraw")).alias("sessionSourceMedium"),
        "sessionCampaignName",
        F.col("sessionCampaignName").alias("campaign_name"),
        "sessionManualAdContent", "sessionSourceMediumraw", "eventName", "eventCount", "eventValue",
        "report_start_date", "report_end_date", *LOAD_COLUMNS, "site_name",
    )


def ga4_channel(goal: DataFrame, store: Callable[[DataFrame, str], DataFrame] = stage) -> DataFrame:
    """Channel, publisher and one spelling per campaign on top of the goal model."""
    channelled = classify(goal, "channel", rules.GA4_CHANNEL, rules.GA4_CHANNEL_DEFAULT)
    published = classify(
        channelled, "publisher", rules.GA4_PUBLISHER, initcap_punct(F.col("sessionSourceMedium"))
    )
    coded = published.withColumn("__campaign", campaign_token(F.col("campaign_name")))
    return canonical_spelling(coded, "__campaign", "campaign_name_selection", store=store).drop("__campaign")
