"""Winners and sums kept load by load."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adloom.operators.dedup import pick_one
from adloom.operators.latest import LatestTable, Sums
from adloom.sources import refresh

SCHEMA = "day date, id bigint, flag string, amount double, count bigint, load bigint"
KEYS = ["day", "id"]
SUMS = {"flags": Sums(("flag",), {"amount": "decimal(18,2)", "count": "bigint"})}


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def rows(rng, n, load):
    return [
        (day(rng.choice([None, *range(8)])), rng.choice([None, *range(6)]), rng.choice(["a", "b", None]),
         rng.choice([None, rng.randrange(-500, 500) / 100]), rng.randrange(9), load)
        for _ in range(n)
    ]


def plain_sums(frame):
    return frame.groupBy("day", "flag").agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.col("amount").cast("decimal(18,2)")), F.lit(0)).cast("double").alias("amount"), F.sum("count").alias("count")
    )


def listed(frame):
    return sorted(map(repr, (tuple(r) for r in frame.collect())))


@pytest.mark.parametrize("seed", [0, 1])
def test_loads_give_what_all_rows_give(spark, tmp_path, seed):
    rng = random.Random(seed)
    table = LatestTable(spark, f"file://{tmp_path}/t", KEYS, ["load"], "day", SUMS)
    every = []
    for load, n in enumerate([40, 15, 25, 0, 10]):
        every += (new := rows(rng, n, load))
        frame = spark.createDataFrame(new, SCHEMA)
        table.load(frame)
        assert table.load(frame) == []  # once more changes nothing
        want = pick_one(spark.createDataFrame(every, SCHEMA), KEYS, ["load"])
        assert listed(table.rows(frame.schema)) == listed(want)
        found = table.summed("flags", frame.schema).withColumn("amount", F.col("amount").cast("double"))
        assert listed(found.select("day", "flag", "n", "amount", "count")) == listed(plain_sums(want))


def test_only_touched_days_are_read_and_changed_days_written(spark, tmp_path):
    table = LatestTable(spark, f"file://{tmp_path}/t", KEYS, ["load"], "day", SUMS)
    first = spark.createDataFrame([(day(d), i, "a", 1.0, 1, 0) for d in range(6) for i in range(3)], SCHEMA)
    assert table.load(first) == [day(d) for d in range(6)]
    others = [p for p in (tmp_path / "t").rglob("*.parquet") if p.parent.name != "day=2024-01-03"]
    assert len(others) >= 10
    for path in others:  # a scan of any other day would fail
        path.write_bytes(b"no parquet")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    new = spark.createDataFrame([(day(2), 1, "b", 5.0, 1, 1), (day(2), 0, "a", 1.0, 1, 0)], SCHEMA)
    assert table.load(new) == [day(2)]
    assert all(p.read_bytes() == b"no parquet" for p in others)
    assert table.rows(first.schema).where(F.col("day") == day(2)).where("load = 1").count() == 1


@pytest.mark.parametrize("dies_at", ["prepare", "replace"])
def test_a_run_that_dies_is_finished_by_the_next(spark, tmp_path, monkeypatch, dies_at):
    table = LatestTable(spark, f"file://{tmp_path}/t", KEYS, ["load"], "day", SUMS)
    first = spark.createDataFrame([(day(d), i, "a", 1.0, 1, 0) for d in range(3) for i in range(3)], SCHEMA)
    table.load(first)
    second = spark.createDataFrame([(day(1), 1, "b", 5.0, 2, 1), (day(2), 7, "b", 2.5, 3, 1)], SCHEMA)
    name = "save_path" if dies_at == "prepare" else "replace_partitions"
    real = getattr(refresh, name)

    def dying(df, path, *by):
        if path.endswith("flags"):
            raise RuntimeError("died")
        real(df, path, *by)

    monkeypatch.setattr(refresh, name, dying)
    with pytest.raises(RuntimeError):
        table.load(second)
    assert (tmp_path / "t" / "_pending").exists()
    monkeypatch.setattr(refresh, name, real)
    table.load(second)
    want = pick_one(first.unionByName(second), KEYS, ["load"])
    assert listed(table.rows(first.schema)) == listed(want)
    found = table.summed("flags", first.schema).withColumn("amount", F.col("amount").cast("double"))
    assert listed(found.select("day", "flag", "n", "amount", "count")) == listed(plain_sums(want))
    assert not (tmp_path / "t" / "_pending").exists()


def test_the_day_must_be_a_key(spark):
    with pytest.raises(ValueError, match="one of the keys"):
        LatestTable(spark, "file:///nowhere", ["id"], [], "day")
