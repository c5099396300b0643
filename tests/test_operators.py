"""Operators on literal rows: NULL, empty, short, doubled, tied, mixed case, bad numbers."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from adloom.functions import casts
from adloom.functions.json_arrays import json_first, json_first_match, json_integer, json_last
from adloom.functions.names import initcap_punct, regex_first, token, token_in
from adloom.operators.arrays import distinct_array
from adloom.operators.canonical import canonical_spelling
from adloom.operators.classify import classify, every, has, like, no, one_of
from adloom.operators.columns import normal_name, normalise_columns, select_glob, select_streams
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import Field, fields, flatten_names, parse_envelope, rejects
from adloom.operators.incremental import incremental_since, lookback
from adloom.operators.lookup import lookup_ci, unmapped
from adloom.operators.report import dimension_report
from adloom.operators.unify import unify
from adloom.plans import rules


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


def envelope(spark, *docs):
    texts = [(d if isinstance(d, str) or d is None else json.dumps(d),) for d in docs]
    return spark.createDataFrame(texts, "data string")


# --- casts ---


@pytest.mark.parametrize(
    "text, long, double",
    [("12", 12, 12.0), ("1.5", None, 1.5), ("abc", None, None), (None, None, None), ("12d", None, None), ("3f", None, None), ("", None, None), ("inf", None, float("inf"))],
)
def test_safe_casts(spark, text, long, double):
    assert one(spark, casts.to_long(F.col("x")), text) == long
    assert one(spark, casts.to_double(F.col("x")), text) == double


@pytest.mark.parametrize("cast, text", [(casts.to_long, "1.5"), (casts.to_double, "abc"), (casts.to_double, "12d")])
def test_strict_casts_raise(spark, cast, text):
    with pytest.raises(Exception):
        one(spark, cast(F.col("x"), strict=True), text)


def test_comma_and_percent(spark):
    assert one(spark, casts.decimal_comma(F.col("x")), "1,5") == 1.5
    assert one(spark, casts.percent(F.col("x")), "12%") == 12.0


@pytest.mark.parametrize(
    "spelling, text, day",
    [
        ("year_first_slash", "2024/05/01", dt.date(2024, 5, 1)),
        ("year_first_slash", "2024/5/1", dt.date(2024, 5, 1)),
        ("day_first_slash", "01/05/2024", dt.date(2024, 5, 1)),
        ("iso", "2024-05-01", dt.date(2024, 5, 1)),
        ("compact", "20240501", dt.date(2024, 5, 1)),
        ("compact", "2024-05-01", None),
        ("iso", "soon", None),
    ],
)
def test_dates(spark, spelling, text, day):
    assert one(spark, casts.to_date(F.col("x"), spelling), text) == day


def test_datetime_day_needs_a_time(spark):
    assert one(spark, casts.datetime_day(F.col("x")), "2024-05-01 00:00:00") == dt.date(2024, 5, 1)
    assert one(spark, casts.datetime_day(F.col("x")), "2024-05-01") is None
    assert one(spark, casts.day_of(F.col("x")), "2024-05-01") == dt.date(2024, 5, 1)


# --- envelope ---


def test_envelope_scalars_only(spark):
    docs = envelope(spark, {"a b": "[kept]", "c": {"k": 1}, "d": [1], "e": 7, "f%": True}, "not json", None, {"c": "{x"})
    wanted = fields(a="a b", c="c", d="d", f="f%") + [Field("e", "e", "long")]
    rows = [tuple(r) for r in parse_envelope(docs, wanted).collect()]
    assert sorted(rows, key=str) == sorted([("[kept]", None, None, "true", 7), (None, "{x", None, None, None)], key=str)
    reasons = [(r.reason, r.data) for r in rejects(docs, wanted).collect()]
    assert sorted(reasons, key=str) == [("malformed document", "not json"), ("no document", None)]


def test_envelope_parses_once_under_a_filter(spark, capsys):
    parsed = parse_envelope(envelope(spark, {"a": "1", "b": "2"}), fields("long", a="a", b="b"))
    parsed.where("a > 0 and b > 0").explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json(StructField(a") == 1


def test_flatten_names(spark):
    docs = envelope(
        spark,
        {"id": "1", "targeting": {"flexible_spec": [{"interests": [{"name": "Ski"}, {"name": "Art"}]}, {"interests": [{"name": "Ski"}]}]}},
        {"id": "2", "targeting": {"flexible_spec": []}},
        {"id": "3"},
        {"id": "4", "targeting": {"flexible_spec": [{}, {"interests": [{"id": 5}]}]}},
    )
    flat = flatten_names(docs, "id", ["targeting", "flexible_spec"], ["interests", "name"], "names")
    assert {tuple(r) for r in flat.collect()} == {("1", "Art, Ski"), ("4", None)}


def test_array_picks(spark):
    kind = "array<struct<action_type:string,value:string>>"
    actions = [("post", "2"), ("post", "3"), ("like", "x")]
    assert one(spark, json_first_match(F.col("x"), "action_type", "post", "value"), actions, kind) == "2"
    assert one(spark, json_first_match(F.col("x"), "action_type", "none", "value"), actions, kind) is None
    assert one(spark, json_first(F.col("x"), "value"), actions, kind) == "2"
    assert one(spark, json_last(F.col("x"), "value"), actions, kind) == "x"
    for pick in (json_first, json_last):
        assert one(spark, pick(F.col("x"), "value"), [], kind) is None
        assert one(spark, pick(F.col("x"), "value"), None, kind) is None


@pytest.mark.parametrize("text, value", [("5", 5), (" -5 ", -5), ("05", None), ("5.0", None), ("x", None), (None, None)])
def test_json_integer(spark, text, value):
    assert one(spark, json_integer(F.col("x")), text) == value


# --- names ---


@pytest.mark.parametrize(
    "text, null_stays, null_other, safe",
    [("a_b", "Other", "Other", None), ("a_b_c", "c", "c", "c"), ("", "Other", "Other", None), (None, None, "Other", None), ("a_b_", "", "", "")],
)
def test_token_guards(spark, text, null_stays, null_other, safe):
    x = F.col("x")
    assert one(spark, token(x, 2, min_len=3, default="Other"), text) == null_stays
    assert one(spark, token(x, 2, min_len=3, default="Other", null_default="Other"), text) == null_other
    assert one(spark, token(x, 2), text) == safe


@pytest.mark.parametrize(
    "text, word",
    [("a_Vid_disp", "Vid"), ("video_x", "Other"), ("x_PDOOH", "PDOOH"), ("", "Other"), (None, "Other"), ("vid", "vid"), ("rmdisp_yt", "rmdisp"), ("a_vid\n", "Other")],
)
def test_token_in(spark, text, word):
    assert one(spark, token_in([F.col("x")], rules.MEDIA_VOCABULARY, "Other"), text) == word


@pytest.mark.parametrize(
    "text, capital", [("foo-bar_baz/QUX&q", "Foo-Bar_Baz/Qux&Q"), ("google ", "Google "), ("it's", "It's"), ("", ""), (None, None), ("a--b", "A--B")]
)
def test_initcap(spark, text, capital):
    assert one(spark, initcap_punct(F.col("x")), text) == capital


def test_regex_first(spark):
    assert one(spark, regex_first(F.col("x"), "PLATFORM_([^_]+)"), "a_PLATFORM_Meta_b") == "Meta"
    assert one(spark, regex_first(F.col("x"), "PLATFORM_([^_]+)"), "a") is None


# --- pick one ---


def test_pick_one_ignores_input_order(spark):
    rows = [(k, v, w) for k in (1, 2, None) for v in (1.0, 2.0, 2.0, None) for w in ("b", "a", None)]
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v double, w string").repartition(3)
        picked = pick_one(df, ["k"], ["v"], number_as="n").collect()
        picks.add(tuple(sorted(map(str, picked))))
        assert {tuple(r) for r in picked} == {(1, 2.0, "a", 1), (2, 2.0, "a", 1), (None, 2.0, "a", 1)}
    assert len(picks) == 1


def test_pick_one_cuts_groups_before_the_shuffle(spark, data, capsys):
    pick_one(spark.read.parquet(f"{data}/lineitem.parquet"), ["l_orderkey"]).explain()
    plan = capsys.readouterr().out
    assert "row_number(), 1, Partial" in plan.split("Exchange")[-1]


# --- classify ---


def test_classify_first_match_and_nulls(spark):
    listed = [("A", has(("x", "y"), "foo", "b_r")), ("B", every(has("x", "q"), no(like("y", "Z%")))), ("C", one_of(like("x", "desk%", fold=True)))]
    df = spark.createDataFrame(
        [("FOO", None), (None, "bxr"), ("q", "Zed"), ("q", "z"), ("q", None), ("DESKtop", ""), (None, None)], "x string, y string"
    )
    found = [r.out for r in classify(df, "out", listed, "none").collect()]
    assert found == ["A", "A", "none", "B", "none", "C", "none"]


# --- spelling and lookup ---


def test_canonical_spelling(spark):
    df = spark.createDataFrame([("Ski",), ("SKI",), ("ski",), ("SKI",), ("Solo",), (None,), (" x ",)], "c string")
    named = canonical_spelling(df, "c", "out", trim=True)
    assert sorted(map(str, (r.out for r in named.collect()))) == sorted(["SKI"] * 4 + ["Solo", "None", "x"])
    again = canonical_spelling(canonical_spelling(df, "c", "out").drop("c"), "out", "out2")
    assert again.where("out <=> out2").count() == df.count()


def test_lookup(spark):
    facts = spark.createDataFrame([("Facebook", 1), ("stuff", 2), (None, 3)], "publisher string, n int")
    lookup = spark.createDataFrame([("FACEBOOK", "Social", "NZ"), ("facebook", "Again", "AU")], "publisher string, channel string, region string")
    kept = lookup_ci(facts, lookup, "publisher")
    assert kept.columns == ["n", "channel", "region", "publisher"]
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "Again", "AU", "Facebook"), (1, "Social", "NZ", "Facebook")]
    assert {r.publisher for r in lookup_ci(facts, lookup, "publisher", keep="lookup").collect()} == {"FACEBOOK", "facebook"}
    spent = facts.withColumns({"media_cost": F.lit(5.0), "channel": F.lit("old")})
    assert {r.channel for r in lookup_ci(spent, lookup, "publisher").collect()} == {"Social", "Again"}
    with pytest.raises(ValueError, match="media_cost"):
        lookup_ci(spent, lookup.withColumn("media_cost", F.lit(None)), "publisher")
    assert sorted(map(str, (r.publisher for r in unmapped(facts, lookup, "publisher").collect()))) == ["None", "stuff"]


# --- arrays, union, columns ---


def test_distinct_array(spark):
    df = spark.createDataFrame([(1, "b", "x"), (1, "a", "x"), (1, None, "y"), (1, "b", None), (None, "c", "z")], "k int, v string, w string")
    assert {(r.k, tuple(r.v), tuple(r.w)) for r in distinct_array(df, ["k"], ["v", "w"]).collect()} == {
        (1, ("a", "b"), ("x", "y")), (None, ("c",), ("z",)),
    }


def test_unify_keeps_rows_and_sums(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "n bigint, name string")
    b = spark.createDataFrame([(1.5,)], "n double")
    both = unify({"a": a, "b": b}, {"n": "double", "name": "string"}, {"b": {"name": F.lit("z")}})
    assert both.count() == 3 and both.agg(F.sum("n")).first()[0] == 4.5
    with pytest.raises(ValueError, match="b lacks"):
        unify({"a": a, "b": b}, {"n": "double", "name": "string"})


@pytest.mark.parametrize(
    "name, normal", [("CustomerID", "customer_id"), ("Full Name", "full_name"), ("1st", "_1st"), ("a%b", "a_b"), ("already_ok", "already_ok"), ("adGroupID2x", "ad_group_id2x")]
)
def test_normal_name(name, normal):
    assert normal_name(name) == normal


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "ads_a int, ads_b int, other int")
    assert select_glob(df, "ads_*").columns == ["ads_a", "ads_b"]
    chosen = select_streams({"ads_insights_x": df, "campaigns": df, "zzz": df}, ["ads_insights_*.*", "campaigns.o*"])
    assert {k: v.columns for k, v in chosen.items()} == {"ads_insights_x": df.columns, "campaigns": ["other"]}
    with pytest.raises(ValueError, match="collide"):
        normalise_columns(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


# --- windows and reports ---


def test_incremental(spark):
    new = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)] + [(None,)], "day date")
    done = spark.createDataFrame([(dt.date(2024, 1, 2),)], "day date")
    assert {r.day.day for r in incremental_since(new, done, "day").collect()} == {2, 3}
    assert incremental_since(new, done.limit(0), "day").count() == 3


@pytest.mark.parametrize("kind, values", [("int", [-5, 7]), ("bigint", [-(2**40), 7]), ("double", [-1.5, 2.5]), ("string", ["", "b"])])
def test_incremental_of_any_type_starts_at_the_lowest(spark, kind, values):
    new = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    assert incremental_since(new, new.limit(0), "x").count() == 2
    assert incremental_since(new, new, "x").count() == 1


def test_incremental_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select id, date_add(date'2024-01-01', cast(id as int)) as day from range(20)").write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    fresh = incremental_since(table, table.where("id = 18"), "day")
    assert fresh.count() == 2
    scan = next(line for line in fresh._jdf.queryExecution().toString().splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(day" in scan and "scalar-subquery" in scan.lower().replace("subquery#", "scalar-subquery#")


def test_lookback(spark):
    days = spark.sql("select explode(sequence(date_sub(current_date(), 40), date_add(current_date(), 1))) as day")
    assert lookback(days, "day", 30, as_of="2024-01-31").count() == days.count()
    first = lookback(days, "day", 30).agg(F.min("day")).first()[0]
    assert abs((dt.datetime.now(dt.timezone.utc).date() - first).days - 30) <= 1


def test_report_pushes_range_and_filter_to_the_scan(spark, data, capsys):
    lineitem = spark.read.parquet(f"{data}/lineitem.parquet")
    report = dimension_report(
        lineitem, ["l_returnflag"], ["l_quantity"], "l_shipdate", "1997-01-01", "1997-12-31", [F.col("l_linenumber") == 1]
    )
    report.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(l_shipdate" in plan and "EqualTo(l_linenumber,1)" in plan
    assert "l_extendedprice" not in plan


def test_report_empty_rows(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 0), ("b", "2024-01-01", None), ("c", "2024-01-02", 5)], "d string, day string, m int")
    df = df.withColumn("day", F.col("day").cast("date"))
    args = (df, ["d"], ["m"], "day", "2024-01-01", "2024-01-02")
    assert dimension_report(*args).count() == 1
    assert dimension_report(*args, keep_empty=True).count() == 3
