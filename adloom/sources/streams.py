"""The input streams of every model, by name.

Models ask a ``Streams`` for the frames they need. Streams come from a folder
(``<root>/<source>_raw__<label>/<stream>``), from given frames, or both.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from adloom.operators.envelope import LATEST, LOAD_COLUMNS, Field, json_member, outcomes, parse_envelope, rejects
from adloom.operators.latest import LatestTable
from adloom.sources import raw, sinks

# Stream names as the extractors write them.
ENVELOPE_STREAMS = {
    "facebook.insights": "ads_insights_action_video_type",
    "facebook.campaigns": "campaigns",
    "facebook.ads": "ads",
    "facebook.devices": "ads_insights_delivery_device",
    "dv360.standard": "dv360_standard",
    "dv360.youtube": "dv360_youtube",
    "cm360.report": "cm360_report_stream",
    "ttd.standard": "standard_streams",
    "tiktok.ads": "ads",
    "tiktok.basic": "ads_basic_data_metrics_by_day",
    "tiktok.video": "ads_video_play_metrics_by_day",
    "hivestack.report": "report",
    "ga4.goal": "goal",
}

# Typed transfer tables, shared by all labels.
TYPED_STREAMS = {
    "google_ads.ad": (
        "customer_id bigint, ad_group_ad_ad_id bigint, ad_group_ad_ad_name string, ad_group_ad_ad_final_urls string"
    ),
    "google_ads.campaign": (
        "customer_id bigint, campaign_id bigint, campaign_name string, campaign_campaign_budget string, "
        "campaign_status string, _LATEST_DATE date"
    ),
    "google_ads.ad_group": "customer_id bigint, ad_group_id bigint, ad_group_name string",
    "google_ads.ad_stats": (
        "customer_id bigint, ad_group_ad_ad_id bigint, ad_group_id bigint, campaign_id bigint, _DATA_DATE date, "
        "metrics_conversions_value double, metrics_conversions double, metrics_cost_micros bigint, "
        "metrics_clicks bigint, metrics_impressions bigint, metrics_interactions bigint"
    ),
    "google_ads.campaign_stats": (
        "customer_id bigint, campaign_id bigint, _DATA_DATE date, metrics_conversions double, "
        "metrics_cost_micros bigint, metrics_clicks bigint, metrics_impressions bigint, metrics_interactions bigint"
    ),
}

LOOKUP_STREAM = "publisher_channel"

# One report holds all advertisers; the label filter is part of the model.
SHARED = {"cm360.report"}

# Days before the day of a run that its sources load again.
RELOAD_DAYS = {"ga4": 30}
RELOAD_DAYS_DEFAULT = 1

# The day of a row in the typed tables that grow by day.
TYPED_DAYS = {"google_ads.ad_stats": "_DATA_DATE", "google_ads.campaign_stats": "_DATA_DATE"}


@dataclass
class Streams:
    """``parsed`` is a folder of tables made by ``store_parsed``; ``as_of`` limits daily rows to the reload window."""

    spark: SparkSession
    root: str | None = None
    given: Mapping[str, DataFrame] = field(default_factory=dict)
    parsed: str | None = None
    #: A folder of tables kept by ``store_latest``, read instead of parsed ones where a stream has one.
    latest: Mapping[str, LatestTable] = field(default_factory=dict)
    as_of: dt.date | None = None
    #: Where given, every parse adds the frame of its rejected rows.
    rejected: list[DataFrame] | None = None
    #: Where given, hears of every source that a composed model has stored and reads no more.
    done: Callable[[str], None] | None = None

    def first_day(self, name: str) -> dt.date | None:
        """First day of the window of a stream, None without a window."""
        days = RELOAD_DAYS.get(name.split(".")[0], RELOAD_DAYS_DEFAULT)
        return None if self.as_of is None else self.as_of - dt.timedelta(days=days)

    def rows(
        self,
        name: str,
        label: str,
        wanted: Sequence[Field],
        keys: Sequence[str] = (),
        strict: bool = False,
        keep: Sequence[str] = LATEST,
        day: str | None = None,
        advertiser: str | None = None,
    ) -> DataFrame:
        """The typed rows of an envelope stream: its parsed table where there is one, else its raw rows, parsed.

        Of a stream with kept winners (``latest``) one row per key comes, the
    window's days only. ``day`` names the column that the window filters. No day is loaded before
        it is over or running, so the window also prunes a parsed table's days
        of load; ``advertiser`` prunes a shared report.
        """
        first = self.first_day(name) if day else None
        kept = self.latest.get(f"{name}@{label}", self.latest.get(name))
        if kept is not None or self.parsed is not None:
            if kept is not None:
                table = kept.rows(typed_schema(wanted, keep))
            else:
                table = self._parsed(name, label)
                if first is not None:
                    table = table.where(F.col("loaded_on") >= F.lit(first))
            if advertiser is not None:
                table = table.where(F.col("advertiser") == advertiser)
            found = table.select(*[f.name for f in wanted], *keep)
        else:
            source = self.read(name, label)
            if advertiser is not None:
                source = source.where(json_member("data", "advertiser") == advertiser)
            if self.rejected is not None:
                bad = rejects(source, wanted, LATEST, keys=keys)
                self.rejected.append(bad.select(F.lit(name).alias("stream"), F.lit(label).alias("label"), *bad.columns))
            found = parse_envelope(source, wanted, keep, strict, keys=keys)
        return found if first is None else found.where(F.col(day) >= F.lit(str(first)))

    def _parsed(self, name: str, label: str) -> DataFrame:
        """The kept rows of a parsed table; one in buckets where ``store_bucketed`` made it."""
        table = bucketed_name(self.parsed, name, label)
        if self.spark.catalog.tableExists(table):
            return self.spark.table(table)
        return self.spark.read.parquet(parsed_path(self.parsed, name, label)).where("outcome = 'kept'")

    def read(self, name: str, label: str) -> DataFrame:
        for key in (f"{name}@{label}", name):
            if key in self.given:
                return self._windowed(self.given[key], name)
        if self.root is None:
            raise KeyError(f"no stream {name!r} for label {label!r}")
        source = name.split(".")[0]
        if name in TYPED_STREAMS:
            table = raw.read_typed(self.spark, f"{self.root}/{name.replace('.', '/')}", TYPED_STREAMS[name])
            return self._windowed(table, name)
        if name in ENVELOPE_STREAMS:
            folder = f"{source}_raw" if name in SHARED else f"{source}_raw__{label}"
            return raw.read_envelope(self.spark, f"{self.root}/{folder}/{ENVELOPE_STREAMS[name]}")
        if name == LOOKUP_STREAM:
            return self.spark.read.parquet(f"{self.root}/{name}")
        raise KeyError(name)

    def read_labels(self, name: str, labels: Sequence[str]) -> DataFrame:
        """The raw rows of an envelope stream of several labels, told apart by a column ``label``, in one scan.

        A given frame has that column itself.
        """
        if name in self.given:
            return self.given[name].where(F.col("label").isin(*labels))
        if self.root is None or name in SHARED:
            raise KeyError(f"no stream {name!r} by label")
        folder = f"{self.root}/{name.split('.')[0]}_raw__"
        rows = self.spark.read.schema(raw.ENVELOPE).parquet(*[f"{folder}{label}/{ENVELOPE_STREAMS[name]}" for label in labels])
        return rows.withColumn("label", F.regexp_extract("_metadata.file_path", "_raw__([^/]+)/[^/]+/[^/]*$", 1))

    def _windowed(self, table: DataFrame, name: str) -> DataFrame:
        first = self.first_day(name)
        if first is None or name not in TYPED_DAYS:
            return table
        return table.where(F.col(TYPED_DAYS[name]) >= F.lit(first))


def parsed_path(root: str, name: str, label: str) -> str:
    return f"{root}/{name}" if name in SHARED else f"{root}/{name}__{label}"


def store_parsed(
    streams: Streams, name: str, label: str, wanted: Sequence[Field], keys: Sequence[str], root: str, strict: bool = False
) -> DataFrame:
    """Parse a stream once into a typed table by day of load (a shared report by advertiser first); returns the rejects.

    Kept and rejected rows are written by the same pass, as partitions of their
    own, and counted on the way (``stored_counts``). With ``as_of`` set only rows
    loaded within the window are parsed, and only their days of load are replaced.
    """
    source = streams.read(name, label)
    first = streams.first_day(name)
    if first is not None:
        source = source.where(F.col("_sdc_extracted_at") >= F.lit(first))
    if strict:
        rows = parse_envelope(source, wanted, list(LOAD_COLUMNS), strict, keys=keys)
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("reason", "data")})
    else:
        rows = outcomes(source, wanted, list(LOAD_COLUMNS), keys=keys)
    bad = F.col("reason").isNotNull()
    by = ["outcome", "advertiser", "loaded_on"] if name in SHARED else ["outcome", "loaded_on"]
    dated = rows.withColumn("loaded_on", F.to_date("_sdc_extracted_at")).withColumn("outcome", F.when(bad, "rejected").otherwise("kept"))
    counts = Observation()
    dated = dated.observe(counts, F.count_if(~bad).alias("kept"), F.count_if(bad).alias("rejected"))
    path = parsed_path(root, name, label)
    sinks.replace_partitions(dated, path, by)
    stored_counts[path] = counts.get
    stored = streams.spark.read.schema(dated.schema).parquet(path).where("outcome = 'rejected'")
    if first is not None:
        stored = stored.where(F.col("loaded_on") >= F.lit(first))
    return stored.select("reason", "data", *LATEST)


#: Kept and rejected rows of the last pass over each parsed table, by its path.
stored_counts: dict[str, dict[str, int]] = {}


def bucketed_name(root: str, name: str, label: str) -> str:
    """The catalogue's name of a parsed table in buckets."""
    place = hashlib.blake2b(parsed_path(root, name, label).encode(), digest_size=8).hexdigest()
    return f"parsed_{name.replace('.', '_')}_{place}"


def store_bucketed(streams: Streams, name: str, label: str, by: Sequence[str], root: str, buckets: int = 64) -> None:
    """Keep the parsed table of a stream in buckets of ``by``, its key: picks and joins on it then need no exchange.

    Picks do with buckets of a part of the key, joins want all of it. Tables that
    will be joined take equal columns, types and numbers of buckets.
    """
    rows = streams.spark.read.parquet(parsed_path(root, name, label)).where("outcome = 'kept'").drop("outcome", "reason", "data")
    (
        rows.repartition(buckets, *by)
        .write.mode("overwrite")
        .bucketBy(buckets, *by)
        .sortBy(*by)
        .option("path", f"{parsed_path(root, name, label)}__buckets")
        .saveAsTable(bucketed_name(root, name, label))
    )


def store_latest(
    streams: Streams, name: str, label: str, wanted: Sequence[Field], table: LatestTable, keep: Sequence[str] = LATEST
) -> list[str]:
    """Bring the kept winners of a parsed stream up to date with what was loaded in its window; returns the days that changed.

    Rows count by their day of load, so a reload corrects days that lie before
    the window too. Without ``as_of`` all loads are compared again.
    """
    rows = streams._parsed(name, label)
    first = streams.first_day(name)
    if first is not None:
        rows = rows.where(F.col("loaded_on") >= F.lit(first))
    return table.load(rows.select(*typed_schema(wanted, keep).names))


def typed_schema(wanted: Sequence[Field], keep: Sequence[str]) -> T.StructType:
    """Columns of a stream's typed rows."""
    kinds = {f.name: f.typed for f in wanted} | {c: LOAD_COLUMNS[c] for c in keep}
    return T.StructType.fromDDL(", ".join(f"`{c}` {kind}" for c, kind in kinds.items()))


def all_rejected(spark: SparkSession, frames: Sequence[DataFrame]) -> DataFrame:
    """One frame of rejected rows: stream, label, reason, data and the load columns."""
    if frames:
        return reduce(DataFrame.unionByName, frames)
    return spark.createDataFrame([], "stream string, label string, reason string, data string, _sdc_extracted_at timestamp, _sdc_sequence bigint")
