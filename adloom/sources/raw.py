"""Raw data in: JSON lines, envelopes, report CSVs and typed transfer tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adloom.operators.columns import normalise_columns
from adloom.operators.envelope import LOAD_COLUMNS, as_variant
from adloom.sources.staging import stage

ENVELOPE = ", ".join(["data string", *(f"{name} {kind}" for name, kind in LOAD_COLUMNS.items())])


def envelope(records: DataFrame, data: Column | str = "value", loaded_at: Column | None = None) -> DataFrame:
    """Add the load metadata to one JSON text per row."""
    now = F.current_timestamp() if loaded_at is None else loaded_at
    return records.select(
        (F.col(data) if isinstance(data, str) else data).alias("data"),
        now.alias("_sdc_extracted_at"),
        now.alias("_sdc_received_at"),
        now.alias("_sdc_batched_at"),
        F.lit(None).cast("timestamp").alias("_sdc_deleted_at"),
        F.unix_millis(now).alias("_sdc_sequence"),
        F.lit(None).cast("bigint").alias("_sdc_table_version"),
    )


def land_json_lines(
    spark: SparkSession, source: str, target: str, loaded_at: Column | None = None
) -> None:
    """Append JSON-lines records to a raw envelope table."""
    lines = spark.read.text(source).where(F.trim("value") != "")
    envelope(lines, loaded_at=loaded_at).write.mode("append").parquet(target)


def land_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, loaded_at: Column | None = None, variant: bool = False
) -> None:
    """Append the records of all JSON-lines files that have not landed yet; each file lands once.

    The stream's checkpoint knows the files of every finished batch, and the
    target's log the files that count, so a run that is repeated adds nothing,
    and one that died halfway is finished by the next without a row too many.
    Read the target with ``read_envelope``.
    """
    lines = spark.readStream.schema("value string").text(source).where(F.trim("value") != "")
    landed = envelope(lines, loaded_at=loaded_at)
    started = (
        (as_variant(landed) if variant else landed)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()


def read_envelope(spark: SparkSession, path: str, variant: bool = False) -> DataFrame:
    schema = ENVELOPE.replace("data string", "data variant") + ", malformed string" if variant else ENVELOPE
    return spark.read.schema(schema).parquet(path)


def read_report_csv(spark: SparkSession, path: str, normalise: bool = False) -> DataFrame:
    """A report export with a header row; every column stays text."""
    report = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False)
    return normalise_columns(report) if normalise else report


#: Line breaks in quotes: a file is read by one task. All columns are parsed, or rows that do not fit would not show.
_CSV = {"multiLine": True, "escape": '"', "mode": "PERMISSIVE", "columnPruning": False}


def report_files(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """What the header of every file of a report export says: ``file``, ``drift`` (NULL where it has the given columns in order).

    A header of another order, or with columns more or less, would shift the values of the whole file.
    """
    found = [f"c{i}" for i in range(len(columns) + 1)]
    lines = spark.read.schema(", ".join(f"{c} string" for c in found)).options(header=False, **_CSV).csv(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"), F.array(*found).alias("names"))
    head = lines.groupBy("file").agg(F.min_by("names", "n").alias("names"))
    head = head.select("file", F.filter("names", lambda x: x.isNotNull()).alias("names"))
    same = F.col("names") == F.array(*[F.lit(c) for c in columns])
    return head.select("file", F.when(~same, F.concat(F.lit("header: "), F.array_join("names", ", "))).alias("drift"))


def read_report(
    spark: SparkSession, path: str, columns: Sequence[str], store: Callable[[DataFrame, str], DataFrame] = stage
) -> tuple[DataFrame, DataFrame]:
    """The rows of a report export with the given header, all text, and the rejected rows (file, reason, line).

    Quoted fields may hold line breaks, commas and doubled quotes. A row with
    fields more or less is rejected with its text, and so is every row of a file
    whose header differs. The files are parsed once and the outcome is stored.
    """
    schema = ", ".join(f"`{c}` string" for c in columns) + ", __line string"
    rows = spark.read.schema(schema).options(header=True, columnNameOfCorruptRecord="__line", **_CSV).csv(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("__file"))
    judged = rows.join(report_files(spark, path, columns), F.col("__file") == F.col("file"))
    reason = F.when(F.col("drift").isNotNull(), F.col("drift")).when(F.col("__line").isNotNull(), "row does not fit the header")
    judged = store(judged.withColumn("reason", reason), "report")
    line = F.coalesce("__line", F.to_csv(F.struct(*[f"`{c}`" for c in columns])))
    bad = judged.where("reason IS NOT NULL").select("file", "reason", line.alias("line"))
    return judged.where("reason IS NULL").select(*[f"`{c}`" for c in columns]), bad


def csv_as_envelope(report: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """A report export in the shape of a raw envelope."""
    return envelope(report.select(F.to_json(F.struct("*")).alias("value")), loaded_at=loaded_at)


def read_typed(spark: SparkSession, path: str, schema: str, customer_id: int | None = None) -> DataFrame:
    """A typed transfer table; the account filter reaches the Parquet scan."""
    table = spark.read.schema(schema).parquet(path)
    return table if customer_id is None else table.where(F.col("customer_id") == customer_id)
