"""Run a model by name, for one label or for several.

Order between models is function composition: a model that reads another one
asks for it here. ``store`` keeps a finished model for its readers; the default
stages it in a folder of the run, which ``close`` (or leaving the ``with``
block) removes, so write results before that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from adloom.operators.lookup import unmapped
from adloom.operators.unify import unify
from adloom.plans import cm360, dash, dv360, facebook, ga4, google_ads, hivestack, tiktok, ttd
from adloom.plans.labels import LABELS, Label
from adloom.sources.sinks import replace_partitions
from adloom.sources.staging import Staging
from adloom.sources.streams import LOOKUP_STREAM, Streams, all_rejected

SOURCE_MODELS: dict[str, Callable[..., DataFrame]] = {
    "facebook": facebook.facebook,
    "dv360_standard": dv360.dv360_standard,
    "dv360_youtube": dv360.dv360_youtube,
    "cm360_serialised": cm360.cm360_serialised,
    "cm360_direct_buy": cm360.cm360_direct_buy,
    "ttd_serialised": ttd.ttd_serialised,
    "ttd_transformed": ttd.ttd_transformed,
    "tiktok": tiktok.tiktok,
    "hivestack": hivestack.hivestack,
    "google_ads_display": google_ads.google_ads_display,
    "google_ads_search": google_ads.google_ads_search,
    "ga4_goal": ga4.ga4_goal,
}
COMPOSED_MODELS = ("ga4_channel", "dash_table", "dash_table_search")
MODELS = (*SOURCE_MODELS, *COMPOSED_MODELS)


@dataclass
class Run:
    """One run over a set of streams; every model is built and stored once per label."""

    streams: Streams
    strict: bool = False
    store: Callable[[DataFrame, str], DataFrame] | None = None
    _stored: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    _staging: Staging | None = None

    def __enter__(self) -> Run:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Remove what the run has staged."""
        if self._staging is not None:
            self._staging.close()
            self._staging = None
        self._stored.clear()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        if self.store is not None:
            return self.store(df, name)
        if self._staging is None:
            self._staging = Staging(self.streams.spark)
        return self._staging(df, name)

    def model(self, name: str, label: Label) -> DataFrame:
        if name in SOURCE_MODELS:
            return SOURCE_MODELS[name](self.streams, label, self.strict)
        if name == "ga4_channel":
            return ga4.ga4_channel(self.stored("ga4_goal", label), self.keep)
        lookup = self.streams.read(LOOKUP_STREAM, label.name)
        if name == "dash_table":
            sources = {s: partial(self._built, s, label) for s in label.media_sources}
            return dash.dash_table(sources, lookup, label.contract, self.strict, self.keep, self.streams.done)
        if name == "dash_table_search":
            return dash.dash_table_search(self._built("google_ads_search", label), lookup)
        raise KeyError(f"unknown model {name!r}")

    def _built(self, name: str, label: Label) -> DataFrame:
        """The model as the run has stored it for another reader, else its plan."""
        return self._stored.get((name, label.name)) or self.model(name, label)

    def stored(self, name: str, label: Label) -> DataFrame:
        key = (name, label.name)
        if key not in self._stored:
            self._stored[key] = self.keep(self.model(name, label), f"{name}__{label.name}")
        return self._stored[key]

    def rejects(self, name: str, label: Label) -> DataFrame:
        """The raw rows that the model leaves out because a key or the document does not parse, with the reason."""
        found: list[DataFrame] = []
        SOURCE_MODELS[name](replace(self.streams, rejected=found), label, False)
        return all_rejected(self.streams.spark, found)

    def unmapped(self, label: Label) -> DataFrame:
        """Publishers of the label's media sources that the lookup does not know, with their rows."""
        given = dash.source_columns(self.strict)
        sources = {s: self.stored(s, label) for s in label.media_sources}
        facts = unify(sources, {"publisher": "string"}, {s: given.get(s, {}) for s in sources})
        return unmapped(facts, self.streams.read(LOOKUP_STREAM, label.name), "publisher")

    def write(self, name: str, label: Label, path: str, day: str = "date") -> None:
        """Replace the model's days of this label below ``path``; with a window in the streams, only those days."""
        rows = self.model(name, label).withColumn("label", F.lit(label.name))
        replace_partitions(rows, f"{path}/{name}", ["label", day])


def run_model(
    name: str,
    label: Label | str,
    streams: Streams,
    strict: bool = False,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """One model; what a composed model stages stays behind unless ``store`` says where it goes."""
    chosen = LABELS[label] if isinstance(label, str) else label
    return Run(streams, strict, store).model(name, chosen)


def run_labels(
    name: str,
    labels: Iterable[Label],
    streams: Streams,
    strict: bool = False,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """The same model for several labels, with the label as first column."""
    run = Run(streams, strict, store)
    frames = [
        run.model(name, label).select(F.lit(label.name).alias("label"), "*") for label in labels
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
