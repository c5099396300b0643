"""Media format rules that look at a token of the campaign name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from adloom.functions.names import token
from adloom.operators.classify import classify
from adloom.plans import rules


def social_format(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Social campaigns are video when a name says so, display when no name does."""
    social = token(F.col("campaign_name"), 3).like("%SOCIAL%")
    video = [F.lower(n).like("%vid%") for n in names]
    return df.withColumn(
        "media_format",
        F.when(social & reduce(or_, video), F.lit("Social Video"))
        .when(social & reduce(and_, (~v for v in video)), F.lit("Social Display"))
        .otherwise(F.lit("Other")),
    )


def dv360_format(campaign: Column) -> Column:
    fourth = token(campaign, 3)
    return (
        F.when(fourth.like("%YT%"), F.lit("Youtube Video")).when(fourth.isNotNull(), fourth).otherwise(F.lit("Other"))
    )


def ttd_format(df: DataFrame) -> DataFrame:
    """Display by the ad group's third token, video on demand by keyword."""
    on_demand = classify(df, "media_format", [("Video OnDemand", rules.TTD_VIDEO_ON_DEMAND)], "Other")
    third = token(F.col("ad_group"), 2, min_len=4)
    return on_demand.withColumn(
        "media_format", F.when(third.like("%DISP%"), F.lit("Display")).otherwise(F.col("media_format"))
    )
