"""Facebook ads: one row per day, ad and campaign."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adloom.functions.json_arrays import json_first, json_first_match, json_integer, json_last
from adloom.functions.names import Token, decode_names
from adloom.operators.arrays import distinct_array, order_text
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import LATEST, Field, flatten_names, parse_envelope
from adloom.plans.formats import social_format
from adloom.plans.labels import Label
from adloom.sources import payloads
from adloom.sources.streams import Streams

_AD_DAY = ["date_start", "ad_id", "ad_name", "campaign_id", "campaign_name", "adset_id", "adset_name"]

# Output column per action type.
ACTION_COLUMNS = {
    "shares": "post",
    "delivery_social_post_like": "post_reaction",
    "comments": "comment",
    "likes": "like",
    "social_post_engagement": "post_engagement",
    "clicks": "link_click",
}


_KEYS = ["account_id", "ad_id", "date_start"]


def insights(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    """Latest load per account, ad and day, summed per ad, campaign and ad set."""
    parsed = streams.rows("facebook.insights", label.name, payloads.FACEBOOK_INSIGHTS, _KEYS, strict, day="date_start")
    return _summed(parsed, strict)


def _summed(parsed: DataFrame, strict: bool, by: Sequence[str] = ()) -> DataFrame:
    action = {name: json_first_match(F.col("actions"), "action_type", kind, "value") for name, kind in ACTION_COLUMNS.items()}
    watched = {
        "video_played": json_first(F.col("play"), "value"),
        "video_25_completion": json_last(F.col("p25"), "value"),
        "video_50_completion": json_last(F.col("p50"), "value"),
        "video_75_completion": json_last(F.col("p75"), "value"),
        "video_completion": json_last(F.col("p100"), "value"),
    }
    # Of the arrays, most of a row, the pick gets the values that are reported and
    # a text that settles ties as the arrays would. A strict run stops at bad
    # numbers of the picked rows only.
    arrays = ("actions", "play", "p25", "p50", "p75", "p100")
    order = order_text(*[(F.col(a), ("action_type", "value")) for a in arrays]).alias("__order")
    values = {n: json_integer(c) for n, c in action.items()} | {n: c if strict else c.try_cast("bigint") for n, c in watched.items()}
    rows = parsed.select(*[c for c in parsed.columns if c not in arrays], *[c.alias(n) for n, c in values.items()], order)
    tie_break = [c for c in rows.columns if c not in (*by, *_KEYS, *LATEST, *values)]
    if by:
        # Labels may share their ads; an ad's rows lie together, dealt once for all that follows.
        rows = rows.repartition("ad_id")
    latest = pick_one(rows, [*by, *_KEYS], LATEST, tie_break)

    metrics = {n: F.col(n).cast("bigint") for n in values} | {"impressions": F.col("impressions"), "media_cost": F.col("spend")}
    per_ad = latest.select(*by, *_AD_DAY, *[c.alias(n) for n, c in metrics.items()])
    if not by:
        # One row per account, ad and day is left, so no ad has many: dealt by ad,
        # the sums, the joins on ad_id and the last pick need no further shuffle.
        per_ad = per_ad.repartition("ad_id")
    return per_ad.groupBy(*by, *_AD_DAY).agg(*[F.sum(n).alias(n) for n in metrics])


def campaigns(streams: Streams, label: Label) -> DataFrame:
    """Latest-starting version of every campaign."""
    parsed = streams.rows("facebook.campaigns", label.name, payloads.FACEBOOK_CAMPAIGNS, keep=())
    return pick_one(parsed, ["campaign_id"], ["start_time"])


def interests(raw: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Names of the interests an ad targets."""
    return flatten_names(
        raw, "id", ["targeting", "flexible_spec"], ["interests", "name"], "interest_names", by=by
    ).withColumnRenamed("id", "ad_id")


def device_platform(platform: Column) -> Column:
    """All mobile platforms are one."""
    return F.when(platform.startswith("mobile"), F.lit("mobile")).otherwise(platform)


def devices(streams: Streams, label: Label) -> DataFrame:
    """Device platforms an ad was delivered to; all mobile ones count as one."""
    return _platforms(streams.rows("facebook.devices", label.name, payloads.FACEBOOK_DEVICES, keep=()))


def _platforms(parsed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    named = parsed.select(*by, "ad_id", device_platform(F.col("device_platform")).alias("device_platforms"))
    return distinct_array(named, [*by, "ad_id"], ["device_platforms"])


# Output order.
COLUMNS = [
    "date", "ad_id", "interest_names", "media_buy_external_id", "media_buy_external_name", "campaign_id",
    "campaign_name", "shares", "likes", "comments", "campaign_status", "campaign_objective", "start_time",
    "stop_time", "video_25_completion", "video_50_completion", "video_75_completion", "video_completion",
    "video_played", "device_platforms", "clicks", "social_post_engagement", "impressions",
    "delivery_social_post_like", "media_cost", "row_number", "creative_name", "publisher", "audience_name",
    "media_format", "ad_format_detail", "ad_format", "creative_descr", "campaign_descr",
]


def facebook(streams: Streams, label: Label, strict: bool = False) -> DataFrame:
    interest = interests(streams.read("facebook.ads", label.name))
    picked = _enriched(insights(streams, label, strict), campaigns(streams, label), interest, devices(streams, label))
    return _named(decode_names(social_format(picked, ["campaign_name", "ad_name"]), _tokens(label.facebook_short_name)))


def facebook_labels(streams: Streams, labels: Sequence[Label], strict: bool = False) -> DataFrame:
    """The model of several labels in one plan, the label as first column; every stream is scanned once.

    The label is a part of every key. Settings make one set of decoded columns
    for each value that labels differ in, however many labels there are.
    """
    by, names = ["label"], [label.name for label in labels]

    def rows(name: str, wanted: Sequence[Field], keys: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
        return parse_envelope(streams.read_labels(name, names), wanted, [*keep, *by], strict, keys=keys)

    stats = _summed(rows("facebook.insights", payloads.FACEBOOK_INSIGHTS, _KEYS, LATEST), strict, by)
    campaign = pick_one(rows("facebook.campaigns", payloads.FACEBOOK_CAMPAIGNS), [*by, "campaign_id"], ["start_time"])
    interest = interests(streams.read_labels("facebook.ads", names), by)
    device = _platforms(rows("facebook.devices", payloads.FACEBOOK_DEVICES), by)
    decoded = social_format(_enriched(stats, campaign, interest, device, by), ["campaign_name", "ad_name"])
    settings: dict[str | None, list[str]] = {}
    for label in labels:
        settings.setdefault(label.facebook_short_name, []).append(label.name)
    of_label = {out: F.lit(None).cast("string") for out in _tokens(None)}
    for i, (short, of) in enumerate(settings.items()):
        decoded = decode_names(decoded, {f"__{i}_{out}": token for out, token in _tokens(short).items()})
        of_label = {out: F.when(F.col("label").isin(*of), F.col(f"__{i}_{out}")).otherwise(c) for out, c in of_label.items()}
    return _named(decoded.withColumns(of_label), by)


def _enriched(stats: DataFrame, campaign: DataFrame, interest: DataFrame, device: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The stats with their campaign's, ad's and devices' attributes, one row per day, ad and campaign."""
    campaign = campaign.withColumnsRenamed({"campaign_id": "known_campaign", **{c: f"__{c}" for c in by}})
    same = [stats.campaign_id == campaign.known_campaign, *[stats[c] == campaign[f"__{c}"] for c in by]]
    # Campaigns first: the joins on ad_id then leave the rows partitioned the
    # way the final pick needs them.
    enriched = (
        stats.join(campaign, same, "left")
        .drop(*[f"__{c}" for c in by])
        .join(interest, [*by, "ad_id"], "left")
        .join(device, [*by, "ad_id"], "left")
    )
    # Attributes depend on the key alone, so the stats columns settle every tie.
    # Ads of unknown campaigns share the NULL key.
    return pick_one(
        enriched,
        [*by, "date_start", "ad_id", "known_campaign"],
        tie_break=[c for c in stats.columns if c not in ("date_start", "ad_id", *by)],
        number_as="row_number",
    )


def _tokens(short: str | None) -> dict[str, Token]:
    """Where the coded columns lie; ``short`` stands for those of a name that is too short."""
    name_guard = {"min_len": 8, "default": short, "null_default": short}
    campaign_guard = {} if short is None else {"min_len": 2, "default": short}
    return {
        "audience_name": Token("adset_name", 7, **name_guard),
        "ad_format_detail": Token("ad_name", 5, **({} if short is None else name_guard)),
        "ad_format": Token("ad_name", 6, **({} if short is None else name_guard)),
        "creative_descr": Token("ad_name", 7, **({} if short is None else name_guard)),
        "campaign_descr": Token("campaign_name", 1, **campaign_guard),
    }


def _named(decoded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (
        decoded.withColumn("publisher", F.lit("Facebook"))
        .withColumnsRenamed(
            {
                "date_start": "date",
                "adset_id": "media_buy_external_id",
                "adset_name": "media_buy_external_name",
                "ad_name": "creative_name",
            }
        )
        .select(*by, *COLUMNS)
    )
