"""The two reporting tables: unified media facts and the search rollup."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from adloom.functions.casts import day_of
from adloom.functions.names import join_array, token_in
from adloom.operators.canonical import canonical_spelling
from adloom.operators.classify import classify
from adloom.operators.lookup import lookup_ci
from adloom.operators.unify import MEDIA_CONTRACT, unify
from adloom.plans import rules
from adloom.plans.ga4 import campaign_token
from adloom.sources.staging import small_reads, stage


def _no_video() -> dict[str, Column]:
    names = ("video_completion", "video_25_completion", "video_50_completion", "video_75_completion", "video_views")
    return {name: F.lit(0) for name in names}


def source_columns(strict: bool = False) -> dict[str, dict[str, Column]]:
    """Per source: contract columns that are renamed, joined or filled with zero."""
    day = {"date": day_of(F.col("date"), strict)}
    return {
        "facebook": {"video_views": F.col("video_played"), **day},
        # DV360 reports no views: the first quartile stands in.
        "dv360_standard": {"video_views": F.col("video_25_completion"), **day},
        "cm360_direct_buy": {**_no_video(), **day},
        "ttd_transformed": day,
        "tiktok": {
            "video_completion": F.col("video_100_completion"),
            "video_views": F.col("video_view"),
            **day,
        },
        "hivestack": {"clicks": F.lit(0), **_no_video(), **day},
        "google_ads_display": {
            "creative_name": join_array(F.col("ad_group_name")),
            "audience_name": join_array(F.col("audience_name")),
            "ad_format": join_array(F.col("ad_format")),
            "ad_format_detail": join_array(F.col("ad_format_detail")),
            "creative_descr": join_array(F.col("creative_descr")),
            **_no_video(),
            **day,
        },
    }


def media_format(df: DataFrame) -> Column:
    """First vocabulary word in the creative name, else in the campaign name, else Other."""
    return token_in([F.col("creative_name"), F.col("campaign_name")], rules.MEDIA_VOCABULARY, "Other")


def label_facts(
    facts: DataFrame, lookup: DataFrame, store: Callable[[DataFrame, str], DataFrame] = stage
) -> DataFrame:
    """Channel, canonical campaign and media format for already unified (and stored) facts."""
    channelled = lookup_ci(facts, lookup, "publisher", keep="fact")
    coded = channelled.withColumn("__campaign", campaign_token(F.col("campaign_name")))
    # The spellings need two columns, each pair once; unmapped publishers don't count.
    pairs = lookup_ci(facts.select("campaign_name", "publisher").distinct(), lookup, "publisher", keep="fact")
    names = pairs.select(campaign_token(F.col("campaign_name")).alias("__campaign"))
    named = canonical_spelling(coded, "__campaign", "campaign_name_selection", True, store, names).drop("__campaign")
    formatted = named.withColumn("media_format", media_format(named))
    last = ["publisher", "channel", "campaign_name_selection", "media_format"]
    return formatted.select(*[c for c in formatted.columns if c not in last], *last)


def dash_table(
    models: Mapping[str, DataFrame | Callable[[], DataFrame]],
    lookup: DataFrame,
    contract: Mapping[str, str] = MEDIA_CONTRACT,
    strict: bool = False,
    store: Callable[[DataFrame, str], DataFrame] = stage,
    done: Callable[[str], None] | None = None,
) -> DataFrame:
    """Unified media table of one label; ``models`` maps source names to their models, or to what builds them.

    The unified facts are stored once, as they are read twice: in full, and
    campaign and publisher only for the spellings. They are stored source by
    source, so the shuffles of one source are gone before the next one's begin;
    ``done`` hears of every source whose facts are stored.
    """
    given = source_columns(strict)
    parts = []
    for source, model in models.items():
        df = model if isinstance(model, DataFrame) else model()
        facts = unify({source: df}, dict(contract), {source: given.get(source, {})})
        with small_reads(lookup.sparkSession):
            parts.append(store(facts, f"facts_{source}"))
        if done is not None:
            done(source)
    return label_facts(reduce(DataFrame.unionByName, parts), lookup, store)


def dash_table_search(search: DataFrame, lookup: DataFrame) -> DataFrame:
    """Paid search by campaign, day and publisher."""
    summed = search.groupBy("campaign_name", "date", "publisher").agg(
        *[F.sum(m).alias(m) for m in ("clicks", "impressions", "media_cost")]
    )
    typed = classify(summed, "search_type", rules.SEARCH_TYPE, rules.SEARCH_TYPE_DEFAULT)
    ordered = typed.select("clicks", "impressions", "media_cost", "campaign_name", "publisher", "date", "search_type")
    return lookup_ci(ordered, lookup, "publisher", keep="lookup")
