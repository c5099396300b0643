"""Session settings shared by the tests, the bench and small local runs.

On a cluster the session usually exists already; nothing in this package needs
more than adaptive execution (on by default) and a UTC session time zone.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("adloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes of generated code per method; of longer ones, wide rows make many, the JVM leaves some uncompiled.
METHOD_BYTES = 4000

#: Parts a shuffle of wide rows is dealt to before adaptive execution joins small ones, and bytes that it joins.
WIDE_PARTS, WIDE_PART_BYTES = 1000, 32 << 20


def wide_session(spark: SparkSession, read_bytes: int, **settings: str) -> SparkSession:
    """A session beside ``spark``, with its settings, for frames of many columns.

    Spark fuses the steps of a stage into one method, which for some 80 columns
    is too long for the JVM to compile. There the steps run one by one instead.
    A task reads ``read_bytes`` of a file at most and gets a small part of a
    shuffle, so that it can hold its rows. ``settings`` are set besides.
    """
    beside = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if beside.conf.get(key, None) != value:
            beside.conf.set(key, value)
    now = spark._jsparkSession.sessionState().conf()
    settings = {
        "spark.sql.codegen.hugeMethodLimit": str(min(int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")), METHOD_BYTES)),
        "spark.sql.files.maxPartitionBytes": str(min(now.filesMaxPartitionBytes(), read_bytes)),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(now.numShufflePartitions(), WIDE_PARTS)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(WIDE_PART_BYTES),
        **settings,
    }
    for key, value in settings.items():
        beside.conf.set(key, value)
    return beside
