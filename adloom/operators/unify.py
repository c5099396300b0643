"""Several fact frames to one, by contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The unified media fact: column order and types.
MEDIA_CONTRACT = {
    "media_cost": "double",
    "impressions": "double",
    "clicks": "bigint",
    "creative_name": "string",
    "audience_name": "string",
    "ad_format": "string",
    "ad_format_detail": "string",
    "video_completion": "double",
    "video_25_completion": "double",
    "video_50_completion": "double",
    "video_75_completion": "double",
    "video_views": "bigint",
    "campaign_name": "string",
    "publisher": "string",
    "campaign_descr": "string",
    "creative_descr": "string",
    "date": "date",
}

# For labels whose sources all count video in whole numbers.
WHOLE_VIDEO_CONTRACT = {name: "bigint" if name.startswith("video_") else kind for name, kind in MEDIA_CONTRACT.items()}


def align(df: DataFrame, contract: dict[str, str], given: dict[str, Column] | None = None) -> DataFrame:
    """Project ``df`` onto the contract; ``given`` overrides or supplies columns."""
    given = given or {}
    return df.select(*[given.get(name, F.col(name)).cast(kind).alias(name) for name, kind in contract.items()])


def unify(
    frames: dict[str, DataFrame],
    contract: dict[str, str] = MEDIA_CONTRACT,
    given: dict[str, dict[str, Column]] | None = None,
) -> DataFrame:
    """UNION ALL of the frames in contract order and types.

    ``given`` maps a source to the columns it spells differently or fills with a
    constant. A contract column a source neither has nor is given is an error.
    """
    given = given or {}
    for source, df in frames.items():
        known = {*df.columns, *given.get(source, {})}
        missing = [c for c in contract if c not in known]
        if missing:
            raise ValueError(f"{source} lacks {missing}")
    aligned = [align(df, contract, given.get(source)) for source, df in frames.items()]
    return reduce(DataFrame.unionByName, aligned)
