"""One query per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adloom.functions import casts
from adloom.functions.json_arrays import json_first, json_first_match, json_integer, json_last
from adloom.functions.names import (
    initcap_punct,
    join_array,
    map_regex,
    map_tokens,
    regex_first,
    split_on,
    token,
    token_in,
)
from adloom.operators.arrays import distinct_array
from adloom.operators.canonical import canonical_spelling
from adloom.operators.classify import classify
from adloom.operators.columns import normalise_columns, select_glob, select_streams, star_except
from adloom.operators.dedup import pick_one
from adloom.operators.envelope import Field, fields, flatten_names, json_member, parse_envelope
from adloom.operators.incremental import incremental_since, lookback
from adloom.operators.lookup import lookup_ci, unmapped
from adloom.operators.report import dimension_report
from adloom.operators.unify import unify
from adloom.plans import rules
from adloom.plans.cm360 import exclude_sites
from adloom.plans.facebook import device_platform
from adloom.plans.formats import dv360_format, social_format, ttd_format
from adloom.plans.ga4 import campaign_token, display_source
from adloom.queries.base import Tables, as_envelope, choose, comparable, nulls_last, query
from adloom.sources.staging import stage

# --- pick one ----------------------------------------------------------------


@query(
    "dedup_latest",
    """
    SELECT user_id, event_type, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type
             ORDER BY ts DESC NULLS LAST, event_id ASC NULLS LAST) AS rn FROM events) t
    WHERE rn = 1
    """,
)
def dedup_latest(t: Tables) -> DataFrame:
    events = t.events.select("user_id", "event_type", "event_id", "ts", "value")
    latest = pick_one(events, ["user_id", "event_type"], ["ts"], tie_break=["event_id"])
    return latest.select("user_id", "event_type", "event_id", "value")


@query(
    "dedup_max_metric",
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, price FROM (
      SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, price,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY price DESC NULLS LAST,
               {nulls_last("l_partkey", "l_linenumber", "l_quantity")}) AS rn
      FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_extendedprice END AS price FROM lineitem) x) t
    WHERE rn = 1
    """,
)
def dedup_max_metric(t: Tables) -> DataFrame:
    price = F.when(F.col("l_linenumber") != 1, F.col("l_extendedprice"))
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", price.alias("price"))
    return pick_one(
        rows, ["l_orderkey"], ["price"], tie_break=["l_partkey", "l_linenumber", "l_quantity"]
    )


@query(
    "dedup_total_order",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
        {nulls_last("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")}) AS rn
      FROM lineitem) t
    WHERE rn = 1
    """,
)
def dedup_total_order(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    return pick_one(rows, ["l_orderkey", "l_linenumber"])


@query(
    "pick_after_group",
    f"""
    SELECT o_orderpriority, c_nationkey, c_mktsegment, orders, total FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderpriority, c_nationkey
             ORDER BY {nulls_last("c_mktsegment", "orders", "total")}) AS rn
      FROM (SELECT o_orderpriority, c_nationkey, c_mktsegment, count(*) AS orders,
                   round(sum(o_totalprice), 2) AS total
            FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3) g) t
    WHERE rn = 1
    """,
)
def pick_after_group(t: Tables) -> DataFrame:
    grouped = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .groupBy("o_orderpriority", "c_nationkey", "c_mktsegment")
        .agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    return pick_one(grouped, ["o_orderpriority", "c_nationkey"])


# --- JSON --------------------------------------------------------------------


@query(
    "json_envelope",
    """
    SELECT o_orderkey AS order_id, CAST(o_custkey AS BIGINT) AS customer, o_totalprice AS price,
           CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS odd_count,
           o_orderpriority AS "first_priority",
           strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(NULL AS VARCHAR) AS absent,
           CAST(NULL AS VARCHAR) AS details, '[' || o_orderstatus || '] kept' AS bracketed
    FROM orders
    """,
)
def json_envelope(t: Tables) -> DataFrame:
    odd = F.when(F.col("o_orderkey") % 4 == 0, F.lit("1.5")).otherwise(F.col("o_custkey").cast("string"))
    raw = as_envelope(
        t.orders,
        {
            "order id": F.col("o_orderkey"),
            "Customer (ID)": F.col("o_custkey").cast("string"),
            "Price % net": F.col("o_totalprice").cast("string"),
            "odd": odd,
            "First-Priority": F.col("o_orderpriority"),
            "Day": F.date_format("o_orderdate", "yyyy/MM/dd"),
            "details": F.struct("o_orderstatus", "o_custkey"),
            "bracketed": F.concat(F.lit("["), F.col("o_orderstatus"), F.lit("] kept")),
        },
    )
    wanted = [
        Field("order id", "order_id", "long"),
        Field("Customer (ID)", "customer", "long"),
        Field("Price % net", "price", "double"),
        Field("odd", "odd_count", "long"),
        Field("First-Priority", "first_priority"),
        Field("Day", "day", "iso_text:year_first_slash"),
        *fields(absent="absent", details="details", bracketed="bracketed"),
    ]
    return parse_envelope(raw, wanted)


@query(
    "json_props",
    """
    SELECT event_type, json_extract_string(props, '$.k') = '7' AS seven,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n
    FROM events GROUP BY 1, 2, 3
    """,
)
def json_props(t: Tables) -> DataFrame:
    marked = t.events.withColumn("seven", json_member("props", "k") == "7")
    parsed = parse_envelope(marked, fields("long", k="k"), keep=["event_type", "seven"], data="props")
    return parsed.groupBy("event_type", "seven", "k").agg(F.count("*").alias("n"))


# A line's actions: none at all, an empty array, or two elements of its type.
_LINE_ACTIONS = """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS qty, l_returnflag
    FROM {lineitem}
"""


def _line_actions(t: Tables) -> DataFrame:
    def action(kind, value):
        return F.struct(kind.alias("action_type"), value.cast("string").alias("value"))

    qty = F.col("qty")
    full = F.array(
        action(F.lit("view"), qty + 100),
        action(F.col("l_returnflag"), qty),
        action(F.col("l_returnflag"), qty + 1),
        action(F.lit("last"), F.col("l_partkey")),
    )
    actions = F.when(F.col("l_linenumber") == 1, F.lit(None)).when(
        F.col("l_linenumber") == 2, F.slice(full, 1, 0)
    ).otherwise(full)
    raw = t.sql(_LINE_ACTIONS).select(
        F.to_json(F.struct("l_orderkey", "l_linenumber", actions.alias("actions"))).alias("data")
    )
    array = "json:array<struct<action_type:string,value:string>>"
    return parse_envelope(
        raw, [*fields("long", l_orderkey="l_orderkey", l_linenumber="l_linenumber"), *fields(array, actions="actions")]
    )


@query(
    "json_first_match",
    """
    SELECT l_orderkey, CAST(sum(CASE WHEN l_linenumber > 2 AND l_returnflag = 'R' THEN l_quantity END) AS BIGINT) AS r,
           CAST(sum(CASE WHEN l_linenumber > 2 AND l_returnflag = 'A' THEN l_quantity END) AS BIGINT) AS a,
           count(*) AS lines
    FROM lineitem GROUP BY l_orderkey
    """,
)
def json_first_match_query(t: Tables) -> DataFrame:
    first = {k: json_integer(json_first_match(F.col("actions"), "action_type", k.upper(), "value")) for k in ("r", "a")}
    picked = _line_actions(t).select("l_orderkey", *[c.alias(k) for k, c in first.items()])
    return picked.groupBy("l_orderkey").agg(F.sum("r").alias("r"), F.sum("a").alias("a"), F.count("*").alias("lines"))


@query(
    "json_first_last",
    """
    SELECT l_orderkey, CAST(sum(CASE WHEN l_linenumber > 2 THEN l_quantity + 100 END) AS BIGINT) AS first_value,
           CAST(sum(CASE WHEN l_linenumber > 2 THEN l_partkey END) AS BIGINT) AS last_value
    FROM lineitem GROUP BY l_orderkey
    """,
)
def json_first_last(t: Tables) -> DataFrame:
    picked = _line_actions(t).select(
        "l_orderkey",
        casts.to_long(json_first(F.col("actions"), "value")).alias("f"),
        casts.to_long(json_last(F.col("actions"), "value")).alias("l"),
    )
    return picked.groupBy("l_orderkey").agg(F.sum("f").alias("first_value"), F.sum("l").alias("last_value"))


@query(
    "json_nested_flatten",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS id,
           string_agg(DISTINCT name, ', ' ORDER BY name) AS names
    FROM (SELECT l_orderkey, l_returnflag || l_linestatus AS name FROM lineitem WHERE l_linenumber > 2
          UNION ALL SELECT l_orderkey, 'line ' || l_linenumber FROM lineitem WHERE l_linenumber > 2) x
    GROUP BY l_orderkey
    """,
)
def json_nested_flatten(t: Tables) -> DataFrame:
    def named(text):
        return F.struct(text.alias("name"))

    spec = F.array(
        F.struct(F.array(named(F.concat("l_returnflag", "l_linestatus"))).alias("interests")),
        F.struct(F.lit(None).cast("array<struct<name:string>>").alias("interests")),
        F.struct(
            F.array(
                named(F.concat(F.lit("line "), F.col("l_linenumber"))),
                named(F.concat("l_returnflag", "l_linestatus")),
            ).alias("interests")
        ),
    )
    targeting = F.when(F.col("l_linenumber") > 1, F.struct(F.when(F.col("l_linenumber") == 2, F.slice(spec, 1, 0)).otherwise(spec).alias("flexible_spec")))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    raw = lines.select(
        F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("id"), targeting.alias("targeting"))).alias("data")
    )
    return flatten_names(raw, "id", ["targeting", "flexible_spec"], ["interests", "name"], "names")


# --- numbers and dates -------------------------------------------------------


@query(
    "decimal_comma_percent",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price,
           round(l_discount * 100, 0) AS discount_percent,
           CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax END AS tax
    FROM lineitem
    """,
)
def decimal_comma_percent(t: Tables) -> DataFrame:
    price = F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(","))
    percent = F.concat(F.round(F.col("l_discount") * 100, 0).cast("bigint").cast("string"), F.lit("%"))
    tax = F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.col("l_tax").cast("string"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        casts.decimal_comma(price).alias("price"),
        casts.percent(percent).alias("discount_percent"),
        casts.to_double(tax).alias("tax"),
    )


@query(
    "date_formats",
    """
    SELECT o_orderkey, d AS year_first, d AS day_first, d AS iso, d AS compact, d AS moment,
           CAST(NULL AS VARCHAR) AS wrong
    FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders) x
    """,
)
def date_formats(t: Tables) -> DataFrame:
    def spelled(pattern, spelling):
        return casts.iso_text(casts.to_date(F.date_format("o_orderdate", pattern), spelling))

    return t.orders.select(
        "o_orderkey",
        spelled("yyyy/M/d", "year_first_slash").alias("year_first"),
        spelled("dd/MM/yyyy", "day_first_slash").alias("day_first"),
        spelled("yyyy-MM-dd", "iso").alias("iso"),
        spelled("yyyyMMdd", "compact").alias("compact"),
        casts.iso_text(casts.datetime_day(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))).alias("moment"),
        spelled("dd.MM.yyyy", "iso").alias("wrong"),
    )


@query(
    "micros_scale",
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(micros) AS DOUBLE) / 1000000 AS cost
    FROM (SELECT *, CAST(round(l_extendedprice * 100, 0) AS BIGINT) * 10000 AS micros FROM lineitem) x
    GROUP BY 1, 2
    """,
)
def micros_scale(t: Tables) -> DataFrame:
    micros = F.round(F.col("l_extendedprice") * 100, 0).cast("bigint") * 10000
    rows = t.lineitem.select("l_returnflag", "l_linestatus", micros.alias("micros"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(casts.from_micros(F.sum("micros")).alias("cost"))


# --- coded names -------------------------------------------------------------

# Names of 1, 4, 7, 8 and 9 tokens, an empty one and a missing one.
_PART_NAMES = f"""
    SELECT p_partkey, p_brand, p_size,
           CASE p_partkey % 7
             WHEN 0 THEN p_brand
             WHEN 1 THEN concat_ws('_', p_brand, p_type, 'x', p_name)
             WHEN 2 THEN concat_ws('_', 'a', 'b', 'c', 'd', 'e', p_type, p_brand)
             WHEN 3 THEN concat_ws('_', 'a', 'b', 'c', 'd', 'e', p_type, p_brand, p_name)
             WHEN 4 THEN concat_ws('_', 'a', '', 'c', 'd', 'e', p_type, '', p_name, 'i')
             WHEN 5 THEN ''
           END AS coded,
           {choose("p_size", ["Vid", "x_SOCIAL_y", "promo_yt_DISP", "PDOOH", None, "video_audio", "a_rmdisp", "socialx"])} AS creative,
           {choose("p_partkey", ["k_vidod", "plain", None, "k_Native_aud", "disp_z"])} AS campaign
    FROM {{part}}
"""


@query(
    "token_guards",
    f"""
    WITH n AS ({_PART_NAMES}), s AS (SELECT *, string_split(coded, '_') AS parts FROM n)
    SELECT p_partkey, parts[8] AS safe, CASE WHEN len(parts) < 8 THEN 'Other' ELSE parts[8] END AS null_stays,
           CASE WHEN len(parts) >= 8 THEN parts[8] ELSE 'Other' END AS null_other,
           CASE WHEN len(parts) <= 1 THEN 'Other' ELSE parts[2] END AS second,
           CAST(len(parts) AS BIGINT) AS tokens
    FROM s
    """,
)
def token_guards(t: Tables) -> DataFrame:
    coded = F.col("coded")
    return t.sql(_PART_NAMES).select(
        "p_partkey",
        token(coded, 7).alias("safe"),
        token(coded, 7, min_len=8, default="Other").alias("null_stays"),
        token(coded, 7, min_len=8, default="Other", null_default="Other").alias("null_other"),
        token(coded, 1, min_len=2, default="Other").alias("second"),
        F.array_size(split_on(coded)).cast("bigint").alias("tokens"),
    )


@query(
    "media_format_vocab",
    f"""
    WITH n AS ({_PART_NAMES}),
    v AS (SELECT ['aud', 'disp', 'native', 'pdooh', 'rmdisp', 'social', 'vid', 'vidod', 'yt'] AS words)
    SELECT p_partkey, coalesce(
        list_filter(string_split(creative, '_'), lambda x: list_contains(words, lower(x)))[1],
        list_filter(string_split(campaign, '_'), lambda x: list_contains(words, lower(x)))[1], 'Other') AS media_format
    FROM n, v
    """,
)
def media_format_vocab(t: Tables) -> DataFrame:
    found = token_in([F.col("creative"), F.col("campaign")], rules.MEDIA_VOCABULARY, "Other")
    return t.sql(_PART_NAMES).select("p_partkey", found.alias("media_format"))


@query(
    "url_param",
    """
    SELECT page_id, nullif(regexp_extract(url, 'ref=([^&#]+)', 1), '') AS ref,
           nullif(regexp_extract(url, 'utm_source=([^&#]+)', 1), '') AS utm_source
    FROM pages
    """,
)
def url_param(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        regex_first(F.col("url"), "ref=([^&#]+)").alias("ref"),
        regex_first(F.col("url"), "utm_source=([^&#]+)").alias("utm_source"),
    )


@query(
    "array_map_filter",
    f"""
    WITH n AS ({_PART_NAMES}),
    b AS (SELECT p_partkey % 1000 AS k, p_brand, coalesce(list_sort(list(DISTINCT coded) FILTER (coded IS NOT NULL)), []) AS names
          FROM n GROUP BY ALL)
    SELECT k, p_brand, array_to_string(list_filter(list_transform(names, lambda x: string_split(x, '_')[2]),
             lambda x: x IS NOT NULL AND x <> ''), '|') AS seconds,
           array_to_string(list_filter(list_transform(names, lambda x: nullif(regexp_extract(x, '_e_([^_]+)', 1), '')),
             lambda x: x IS NOT NULL), '|') AS types
    FROM b
    """,
)
def array_map_filter(t: Tables) -> DataFrame:
    keyed = t.sql(_PART_NAMES).withColumn("k", F.col("p_partkey") % 1000)
    names = distinct_array(keyed, ["k", "p_brand"], ["coded"])
    return comparable(
        names.select(
            "k",
            "p_brand",
            map_tokens(F.col("coded"), 1).alias("seconds"),
            map_regex(F.col("coded"), "_e_([^_]+)").alias("types"),
        )
    )


@query(
    "array_join",
    """
    SELECT p_brand, p_type,
           array_to_string(list_sort(list(DISTINCT p_name)), ', ') AS names,
           coalesce(array_to_string(list_sort(list(DISTINCT size) FILTER (size IS NOT NULL)), ', '), '') AS sizes
    FROM (SELECT *, CASE WHEN p_size < 25 THEN lpad(CAST(p_size AS VARCHAR), 2, '0') END AS size FROM part) x
    GROUP BY 1, 2
    """,
)
def array_join(t: Tables) -> DataFrame:
    size = F.when(F.col("p_size") < 25, F.lpad(F.col("p_size").cast("string"), 2, "0"))
    rows = t.part.select("p_brand", "p_type", F.col("p_name").alias("names"), size.alias("sizes"))
    arrays = distinct_array(rows, ["p_brand", "p_type"], ["names", "sizes"])
    return arrays.select(
        "p_brand", "p_type", join_array(F.col("names")).alias("names"), join_array(F.col("sizes")).alias("sizes")
    )


_SQL_BREAKS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def sql_initcap(expr: str) -> str:
    """SQL text of the punctuation-aware INITCAP."""
    pieces = f"regexp_extract_all(lower({expr}), '[^{_SQL_BREAKS}]+|[{_SQL_BREAKS}]+')"
    return f"array_to_string(list_transform({pieces}, lambda p: upper(p[1]) || p[2:]), '')"


_MIXED_TEXT = """
    SELECT p_partkey, CASE p_partkey % 6
        WHEN 0 THEN p_brand || '-' || p_name
        WHEN 1 THEN lower(p_type) || '_' || upper(p_name) || '.co.nz'
        WHEN 2 THEN 'google / cpc ' || p_name
        WHEN 3 THEN 'it''s (' || p_name || ')&' || lower(p_brand)
        WHEN 4 THEN ''
      END AS mixed
    FROM {part}
"""


@query(
    "initcap_punct",
    f"SELECT p_partkey, {sql_initcap('mixed')} AS capital FROM ({_MIXED_TEXT}) x",
)
def initcap_punct_query(t: Tables) -> DataFrame:
    return t.sql(_MIXED_TEXT).select("p_partkey", initcap_punct(F.col("mixed")).alias("capital"))


# --- classifiers -------------------------------------------------------------

_CAMPAIGNS = [
    "ACM_Nzme_2024_DISP", "acm_3NOW_x_SOCIALVID", "ACM_Youtube_24_YT", "ACM_tvnz_24_VID", "ACM_metservice_24_x",
    "ACM_mediaworks", "ACM_business_24_desk", "ACM_acast_24_AUD", "ACM_Perf_24_Max", "pmax_push", "ACM_stuff_24_NATIVE",
    "ACM_plain_24_SOCIAL", None, "", "one", "a_b_c_vidod_d",
]
_CREATIVES = [
    "plain", "a_b_c_d_e_f_g_h", "spot_three_x", "nzme_tile", "yt_bumper", None, "tvnz_spot", "business_desk_tile",
    "acast_audio", "stuff_tile", "x_Vid_y", "metservice_tile", "MediaWorks_x",
]
_DOC_NAMES = f"""
    SELECT doc_id, lang, source, {choose("doc_id", _CAMPAIGNS)} AS campaign_name,
           {choose("doc_id", _CREATIVES)} AS creative_name,
           {choose("n_chars", ["a_b_DISP_d", "a_b_DISP", "g_VIDOD_x_y", None, "x_y_z_w"])} AS ad_group
    FROM {{documents}}
"""


def sql_has(column: str, *keywords: str) -> str:
    return "(" + " OR ".join(f"lower({column}) LIKE '%{k}%'" for k in keywords) + ")"


def sql_dv360_publisher(c: str = "campaign_name", n: str = "creative_name") -> str:
    def both(*keywords):
        return f"{sql_has(c, *keywords)} OR {sql_has(n, *keywords)}"

    return f"""CASE WHEN {both('nzme')} THEN 'Nzme' WHEN {both('3now', 'three')} THEN 'Threenow'
      WHEN {sql_has(c, 'youtube', 'yt')} OR {sql_has(n, 'yt')} THEN 'Youtube' WHEN {both('tvnz')} THEN 'TVNZ'
      WHEN {both('metservice')} THEN 'Metservice' WHEN {both('mediaworks')} THEN 'MediaWorks'
      WHEN ({sql_has(c, 'business')} AND {sql_has(c, 'desk')}) OR ({sql_has(n, 'business')} AND {sql_has(n, 'desk')})
        THEN 'Business Desk'
      WHEN {both('acast')} THEN 'Acast'
      WHEN ({sql_has(c, 'perf')} AND {sql_has(c, 'max')}) OR {sql_has(c, 'pmax')} THEN 'Performance Max'
      WHEN {both('stuff')} THEN 'Stuff' ELSE 'Dv360' END"""


def sql_ttd_publisher(c: str = "campaign_name", n: str = "creative_name") -> str:
    def both(*keywords):
        return f"{sql_has(c, *keywords)} OR {sql_has(n, *keywords)}"

    return f"""CASE WHEN {both('acast')} THEN 'Acast' WHEN {both('3now', 'three')} THEN 'Threenow'
      WHEN {both('nzme')} THEN 'Nzme' WHEN {both('tvnz')} THEN 'Tvnz' WHEN {both('youtube', 'yt')} THEN 'Youtube'
      WHEN {both('stuff')} THEN 'Stuff' ELSE 'Ttd' END"""


@query(
    "classify_publisher",
    f"SELECT doc_id, {sql_dv360_publisher()} AS dv360, {sql_ttd_publisher()} AS ttd FROM ({_DOC_NAMES}) d",
)
def classify_publisher(t: Tables) -> DataFrame:
    names = t.sql(_DOC_NAMES)
    dv360 = classify(names, "dv360", rules.DV360_PUBLISHER, rules.DV360_PUBLISHER_DEFAULT)
    ttd = classify(
        dv360.withColumnRenamed("creative_name", "creative"), "ttd", rules.TTD_PUBLISHER, rules.TTD_PUBLISHER_DEFAULT
    )
    return ttd.select("doc_id", "dv360", "ttd")


_SITES = [
    "NZME digital", "spotify", "TikTok ads", "YouTube", "stuff-co_nz home", "Google Ads", "SEM", None, "metservice.com",
    "", "The Trade Desk", "nz herald",
]
_MEDIUMS = [
    "?utm_medium=paid-display&x=1", "?utm_medium=paid-social", "?utm_medium=paid-socialx-y&v=vid", "?utm_medium=cpc",
    "", "?a=b&utm_medium=email-native", "?utm_medium=paid-DISPLAY", None,
]
_PAGE_SITES = f"""
    SELECT page_id, {choose("page_id", _SITES)} AS site_name,
           url || {choose("page_id", _MEDIUMS)} AS click_through_url,
           {choose("page_id", _CAMPAIGNS)} AS campaign_name, {choose("page_id", _CREATIVES)} AS creative_name,
           {choose("page_id", ["a_b_c_d_e", "vid_x", "a_b", None])} AS placement
    FROM {{pages}}
"""


def sql_cm360_publisher(site: str = "site_name") -> str:
    word = sql_initcap(f"string_split({site}, ' ')[1]")
    return f"""CASE WHEN {sql_has(site, 'nzme')} THEN 'Nzme' WHEN {sql_has(site, 'spotify')} THEN 'Spotify'
      WHEN {sql_has(site, 'tiktok')} THEN 'Tiktok' WHEN {sql_has(site, 'youtube')} THEN 'Youtube' ELSE {word} END"""


def sql_cm360_format(medium: str) -> str:
    video = " OR ".join(sql_has(c, "vid") for c in ("campaign_name", "creative_name", "placement", "click_through_url"))
    still = " AND ".join(
        f"NOT {sql_has(c, 'vid')}" for c in ("campaign_name", "creative_name", "placement", "click_through_url")
    )
    return f"""CASE WHEN {medium} LIKE '%display%' THEN 'High Impact Display'
      WHEN {medium} LIKE '%social%' AND {still} THEN 'Social Display'
      WHEN {medium} LIKE '%social%' AND ({video}) THEN 'Social Video' ELSE {medium} END"""


SQL_MEDIUM = "string_split(nullif(regexp_extract(click_through_url, 'utm_medium=([^&]+)', 1), ''), '-')[2]"


@query(
    "classify_site",
    f"""
    SELECT page_id, {sql_cm360_publisher()} AS publisher, {sql_cm360_format("medium")} AS media_format
    FROM (SELECT *, {SQL_MEDIUM} AS medium FROM ({_PAGE_SITES}) p) q
    """,
)
def classify_site(t: Tables) -> DataFrame:
    sites = t.sql(_PAGE_SITES)
    first_word = initcap_punct(token(F.col("site_name"), 0, sep=" "))
    medium = token(regex_first(F.col("click_through_url"), "utm_medium=([^&]+)"), 1, sep="-")
    published = classify(sites.withColumn("__medium", medium), "publisher", rules.CM360_PUBLISHER, first_word)
    formatted = classify(published, "media_format", rules.CM360_MEDIA_FORMAT, F.col("__medium"))
    return formatted.select("page_id", "publisher", "media_format")


@query(
    "site_exclude",
    f"""
    SELECT page_id, site_name FROM ({_PAGE_SITES}) p
    WHERE lower(site_name) NOT IN ('the trade desk', 'ttd', 'facebook', 'twitch', 'programmatic', 'dart', 'google ads', 'sem')
    """,
)
def site_exclude(t: Tables) -> DataFrame:
    sites = t.sql(_PAGE_SITES).select("page_id", "site_name")
    return exclude_sites(sites, "site_name", rules.CM360_EXCLUDED_SITES)


SOURCE_MEDIUMS = [
    "google / organic", "(direct) / (none)", "newsletter / email", "automated / crm", "Facebook / cpc",
    "instagram.com / referral", "google / cpc", "Google / CPC", "googleads / display", "kargo / cpm",
    "linkedin / cpm", "linkedin.com / social", "twitter / organic_post", "stuff.co.nz / referral", "snapchat / cpc",
    "spotify / audio", "stuff-co_nz / banner", "tiktok / cpm", "twitter / cpc", "bing / cpc", "ttd / display",
    "yt / video", "three / video", "NZME / display", "acast / audio", None, "mailout", "social / cpm", "facebook / Referral / cpc",
]
GA4_CAMPAIGNS = [
    "wat-brand", "wat-", "ACM_Search_24", "acm_search_24", "sem generic", "performance max", "x_uow0_search", "_uow_native",
    "1uow push", "demand gen push", "automated email", None, "pmax", "perf winter max", "desk buseinss", "googleads x",
    "ACM_Ski_24_nzme", "ACM_SKI_24_tvnz", "plain",
]
AD_CONTENTS = ["youtube spot", "nzme tile", None, "three spot", "stuff tile", "metservice", "mediaworks", "acast", "desk x buseinss", "tvnz"]

_SESSIONS = f"""
    SELECT event_id, {choose("event_id", SOURCE_MEDIUMS)} AS sm, {choose("event_id", GA4_CAMPAIGNS)} AS c
    FROM {{events}}
"""


def sql_site_name(sm: str, c: str) -> str:
    paid = sql_has(sm, "cpm", "cpc")
    return f"""CASE WHEN {sql_has(sm, 'organic')} THEN 'organic_search'
      WHEN {sql_has(sm, 'direct')} AND {c} NOT LIKE 'wat-' THEN 'direct'
      WHEN {sql_has(sm, 'email', 'mailout')} OR ({sql_has(sm, 'automated')} AND {sql_has(c, 'email')}) THEN 'email'
      WHEN {sql_has(sm, 'facebook', 'instagram', 'social')} AND {paid} THEN 'facebook'
      WHEN {sm} LIKE '%google / cpc%' AND {sql_has(c, 'search', 'sem', 'performance max')}
        AND lower({c}) NOT LIKE '%_uow0%' AND lower({c}) NOT LIKE '%wat-%' THEN 'google_ads_search'
      WHEN {sql_has(sm, 'googleads')} OR {sql_has(c, 'googleads', 'native')}
        OR ({sql_has(c, 'demand')} AND {sql_has(c, 'gen')})
        OR ({sm} LIKE '%google / cpc%' AND {c} LIKE 'wat-%')
        OR ({sm} LIKE '%google / cpc%' AND {c} LIKE '_uow%' AND NOT {sql_has(c, 'sem')} AND NOT {sql_has(c, 'search')})
        THEN 'google_ads_display'
      WHEN {sql_has(sm, 'kargo')} AND NOT {sql_has(sm, 'referral')} THEN 'kargo'
      WHEN {sql_has(sm, 'linkedin')} AND {paid} THEN 'linkedin'
      WHEN {sql_has(sm, 'facebook', 'instagram', 'twitter', 'linkedin')} AND NOT {paid} THEN 'own_social'
      WHEN {sql_has(sm, 'facebook', 'instagram', 'twitter', 'linkedin')} AND {sm} LIKE '%referral%' THEN 'own_social'
      WHEN {sql_has(sm, 'referral')} THEN 'referral'
      WHEN {sql_has(sm, 'snapchat')} AND {paid} THEN 'snapchat'
      WHEN {sql_has(sm, 'spotify')} AND NOT {sql_has(sm, 'referral')} THEN 'spotify'
      WHEN {sql_has(sm, 'stuff')} AND NOT {sql_has(sm, 'referral')} THEN 'stuff'
      WHEN {sql_has(sm, 'tiktok')} AND {paid} THEN 'tiktok'
      WHEN {sql_has(sm, 'twitter')} AND {paid} THEN 'twitter' ELSE 'other' END"""


def sql_display_source(sm: str) -> str:
    return sql_initcap(f"string_split({sm}, '/')[1]")


@query(
    "classify_ga4_site",
    f"SELECT event_id, {sql_site_name('sm', 'c')} AS site_name, {sql_display_source('sm')} AS source FROM ({_SESSIONS}) s",
)
def classify_ga4_site(t: Tables) -> DataFrame:
    sessions = t.sql(_SESSIONS).withColumnsRenamed({"sm": "sessionSourceMediumraw", "c": "sessionCampaignName"})
    named = classify(sessions, "site_name", rules.GA4_SITE_NAME, rules.GA4_SITE_NAME_DEFAULT)
    return named.select("event_id", "site_name", display_source(F.col("sessionSourceMediumraw")).alias("source"))


CHANNEL_SITES = [
    "acast", "Adfenix", "adobe", "apple_ads_search", "appleXadsXsearch", "bing_ads_search", "blis", "business_desk",
    "clearscore", "dart_search", "demand_gen", "direct", "dv-360", "dv360", "email", "facebook", "gdn", "gmb",
    "google_ads_display", "google_ads_search", "google_my_business", "homes.co.nz", "linkedin", "listinglogic",
    "mediaworks", "metservice", "nzh_business", "nzherald", "nzme", "organic search", "organic_search",
    "organic social", "outbrain", "own_social", "pinterest", "quora", "referral", "remarketing", "snapchat", "spotify",
    "stuff", "teads", "tiktok", "trademe", "ttd", "tvnz", "twitch", "verizon", "youtube", "other", "kargo", None,
    "nzme business desk", "ttd dv360",
]
_CHANNEL_ROWS = f"""
    SELECT event_id, {choose("event_id", CHANNEL_SITES)} AS site_name, {choose("user_id", SOURCE_MEDIUMS)} AS source,
           {choose("event_id", GA4_CAMPAIGNS)} AS c, {choose("user_id", AD_CONTENTS)} AS ac
    FROM {{events}}
"""


# Keyword in the site name and the channel it stands for, first match wins.
CHANNELS = [
    ("acast", "Paid Display"),
    ("adfenix", "Owned Display"),
    ("adobe", "Paid Display"),
    ("apple_ads_search", "Paid Search"),
    ("bing_ads_search", "Paid Search"),
    ("blis", "Paid Display"),
    ("business_desk", "Paid Display"),
    ("clearscore", "Affiliate"),
    ("dart_search", "Paid Search"),
    ("demand_gen", "Paid Display"),
    ("direct", "Direct"),
    ("dv_360", "Paid Display"),
    ("dv360", "Paid Display"),
    ("email", "Email"),
    ("facebook", "Paid Social"),
    ("gdn", "Owned Display"),
    ("gmb", "Google My Business"),
    ("google_ads_display", "Paid Display"),
    ("google_ads_search", "Paid Search"),
    ("google_my_business", "Google My Business"),
    ("homes.co.nz", "Paid Display"),
    ("linkedin", "Paid Social"),
    ("listinglogic", "Owned Display"),
    ("mediaworks", "Paid Display"),
    ("metservice", "Paid Display"),
    ("nzh_business", "Paid Display"),
    ("nzherald", "Paid Display"),
    ("nzme", "Paid Display"),
    ("organic search", "Organic Search"),
    ("organic social", "Organic Social"),
    ("outbrain", "Paid Display"),
    ("own_social", "Owned Social"),
    ("pinterest", "Paid Social"),
    ("quora", "Paid Social"),
    ("referral", "Referral"),
    ("rem", "Owned Display"),
    ("snapchat", "Paid Social"),
    ("spotify", "Paid Display"),
    ("stuff", "Paid Display"),
    ("teads", "Paid Display"),
    ("tiktok", "Paid Social"),
    ("trademe", "Paid Display"),
    ("ttd", "Paid Display"),
    ("tvnz", "Paid Display"),
    ("twitch", "Paid Display"),
    ("verizon", "Paid Display"),
    ("youtube", "Paid Display"),
]


def sql_channel(site: str) -> str:
    arms = " ".join(f"WHEN lower({site}) LIKE '%{k}%' THEN '{v}'" for k, v in CHANNELS)
    return f"CASE {arms} ELSE 'Unknown' END"


def sql_ga4_publisher(s: str, site: str, c: str, ac: str) -> str:
    def named(*keywords):
        return f"({sql_has(c, *keywords)} OR {sql_has(ac, *keywords)})"

    prog = sql_has(site, "ttd", "dv360")
    return f"""CASE WHEN {sql_has(s, 'facebook')} THEN 'Facebook' WHEN {sql_has(site, 'demand_gen')} THEN 'Demand Gen'
      WHEN {sql_has(site, 'google_ads_search')} THEN 'Google Ads Search' WHEN {sql_has(s, 'ttd')} THEN 'Ttd'
      WHEN {sql_has(s, 'tiktok')} THEN 'Tiktok' WHEN {sql_has(s, 'snapchat')} THEN 'Snapchat'
      WHEN {sql_has(s, 'youtube', 'yt')} THEN 'Youtube' WHEN {sql_has(s, '3now', 'three')} THEN 'Threenow'
      WHEN {sql_has(s, 'nzme')} THEN 'Nzme' WHEN {sql_has(s, 'acast')} THEN 'Acast'
      WHEN {prog} AND {named('youtube', 'yt')} THEN 'Youtube' WHEN {prog} AND {named('nzme')} THEN 'Nzme'
      WHEN {prog} AND {named('tvnz')} THEN 'Tvnz' WHEN {prog} AND {named('3now', 'three')} THEN 'Threenow'
      WHEN {prog} AND {named('stuff')} THEN 'Stuff'
      WHEN {sql_has(site, 'dv360', 'metservice')} AND {named('metservice')} THEN 'Metservice'
      WHEN {sql_has(site, 'dv360', 'mediaworks')} AND {named('mediaworks')} THEN 'Mediaworks'
      WHEN {sql_has(site, 'dv360', 'nzme')} AND {sql_has(c, 'buseinss')} AND lower({c}) LIKE 'desk%' THEN 'Business Desk'
      WHEN {sql_has(site, 'dv360', 'nzme')} AND {sql_has(ac, 'buseinss')} AND lower({ac}) LIKE 'desk%' THEN 'Business Desk'
      WHEN {sql_has(site, 'business')} AND {sql_has(site, 'desk')} THEN 'Business Desk'
      WHEN {prog} AND {named('acast')} THEN 'Acast'
      WHEN ({sql_has(c, 'perf')} AND {sql_has(c, 'max')}) OR {sql_has(c, 'pmax')} THEN '%Performance Max'
      ELSE {sql_initcap(s)} END"""


@query("classify_channel", f"SELECT event_id, {sql_channel('site_name')} AS channel FROM ({_CHANNEL_ROWS}) r")
def classify_channel(t: Tables) -> DataFrame:
    rows = t.sql(_CHANNEL_ROWS)
    return classify(rows, "channel", rules.GA4_CHANNEL, rules.GA4_CHANNEL_DEFAULT).select("event_id", "channel")


@query(
    "classify_ga4_publisher",
    f"SELECT event_id, {sql_ga4_publisher('source', 'site_name', 'c', 'ac')} AS publisher FROM ({_CHANNEL_ROWS}) r",
)
def classify_ga4_publisher(t: Tables) -> DataFrame:
    rows = t.sql(_CHANNEL_ROWS).withColumnsRenamed(
        {"source": "sessionSourceMedium", "c": "sessionCampaignName", "ac": "sessionManualAdContent"}
    )
    fallback = initcap_punct(F.col("sessionSourceMedium"))
    return classify(rows, "publisher", rules.GA4_PUBLISHER, fallback).select("event_id", "publisher")


def sql_social(*names: str) -> str:
    video = " OR ".join(sql_has(n, "vid") for n in names)
    still = " AND ".join(f"NOT {sql_has(n, 'vid')}" for n in names)
    social = "string_split(campaign_name, '_')[4] LIKE '%SOCIAL%'"
    return f"CASE WHEN {social} AND ({video}) THEN 'Social Video' WHEN {social} AND {still} THEN 'Social Display' ELSE 'Other' END"


SQL_DV360_FORMAT = """CASE WHEN string_split(campaign_name, '_')[4] LIKE '%YT%' THEN 'Youtube Video'
    WHEN len(string_split(campaign_name, '_')) >= 4 THEN string_split(campaign_name, '_')[4] ELSE 'Other' END"""


def sql_ttd_format(creative: str) -> str:
    return f"""CASE WHEN len(string_split(ad_group, '_')) > 3 AND string_split(ad_group, '_')[3] LIKE '%DISP%' THEN 'Display'
    WHEN {sql_has('ad_group', 'vidod')} OR {sql_has('campaign_name', 'vidod')} OR {sql_has(creative, 'vidod')}
      THEN 'Video OnDemand' ELSE 'Other' END"""


@query(
    "media_formats",
    f"""
    SELECT doc_id, {sql_social('campaign_name', 'creative_name')} AS social, {SQL_DV360_FORMAT} AS dv360,
           {sql_ttd_format('creative_name')} AS ttd FROM ({_DOC_NAMES}) d
    """,
)
def media_formats(t: Tables) -> DataFrame:
    names = t.sql(_DOC_NAMES).withColumn("creative", F.col("creative_name"))
    social = social_format(names, ["campaign_name", "creative_name"]).withColumnRenamed("media_format", "social")
    ttd = ttd_format(social).withColumnRenamed("media_format", "ttd")
    return ttd.select("doc_id", "social", dv360_format(F.col("campaign_name")).alias("dv360"), "ttd")


@query(
    "device_prefix",
    """
    SELECT l_partkey, array_to_string(list_sort(list(DISTINCT d) FILTER (d IS NOT NULL)), '|') AS devices
    FROM (SELECT l_partkey, CASE l_linenumber % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'mobile' WHEN 2 THEN 'desktop' END AS d
          FROM lineitem) x GROUP BY l_partkey
    """,
)
def device_prefix(t: Tables) -> DataFrame:
    platforms = t.sql(
        "SELECT l_partkey, CASE l_linenumber % 4 WHEN 0 THEN 'mobile_app' WHEN 1 THEN 'mobile_web' "
        "WHEN 2 THEN 'desktop' END AS d FROM {lineitem}"
    )
    plain = device_platform(F.col("d"))
    return comparable(distinct_array(platforms.select("l_partkey", plain.alias("devices")), ["l_partkey"], ["devices"]))


@query(
    "search_type",
    f"""
    SELECT o_orderpriority, search_type, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM (SELECT *, CASE WHEN regexp_matches(lower(campaign_name), 'brand') THEN 'Brand Search' ELSE 'Generic Search' END AS search_type
          FROM (SELECT *, {choose("o_orderkey", ["My BRAND x", "generic", None, "rebranded"])} AS campaign_name FROM orders) y) x
    GROUP BY 1, 2
    """,
)
def search_type(t: Tables) -> DataFrame:
    named = t.sql(
        f"SELECT o_orderpriority, o_totalprice, {choose('o_orderkey', ['My BRAND x', 'generic', None, 'rebranded'])} "
        "AS campaign_name FROM {orders}"
    )
    typed = classify(named, "search_type", rules.SEARCH_TYPE, rules.SEARCH_TYPE_DEFAULT)
    return typed.groupBy("o_orderpriority", "search_type").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


# --- spelling and lookup -----------------------------------------------------

_SPELLED = """
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN upper(event_type) WHEN 1 THEN event_type
        WHEN 2 THEN upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' '
        WHEN 3 THEN 'only_' || event_type END AS spelled
    FROM {events}
"""


@query(
    "canonical_spelling",
    f"""
    WITH e AS ({_SPELLED}), m AS (SELECT lower(spelled) AS k, min(spelled) AS s FROM e GROUP BY 1)
    SELECT event_id, spelled, s AS canonical, trim(s) AS trimmed FROM e LEFT JOIN m ON lower(spelled) = k
    """,
)
def canonical_spelling_query(t: Tables) -> DataFrame:
    spelled = t.sql(_SPELLED)
    one = canonical_spelling(spelled, "spelled", "canonical")
    return one.withColumn("trimmed", F.trim("canonical"))


_PUBLISHERS = """
    SELECT DISTINCT upper(event_type) AS publisher, 'Channel ' || length(event_type) AS channel,
           CASE WHEN length(event_type) % 2 = 0 THEN 'North' ELSE 'South' END AS region
    FROM {events} WHERE event_type <> 'error'
"""


@query(
    "lookup_join_ci",
    f"""
    SELECT event_id, round(value, 2) AS value, channel, region, event_type AS publisher
    FROM events JOIN ({_PUBLISHERS}) p ON lower(event_type) = lower(p.publisher)
    """,
)
def lookup_join_ci(t: Tables) -> DataFrame:
    lookup = stage(t.sql(_PUBLISHERS), "publisher_channel")
    facts = t.events.select("event_id", F.round("value", 2).alias("value"), F.col("event_type").alias("publisher"))
    return lookup_ci(facts, lookup, "publisher", keep="fact")


@query(
    "lookup_spelling",
    f"""
    SELECT p.publisher AS publisher, channel, count(*) AS n
    FROM events JOIN ({_PUBLISHERS}) p ON lower(event_type) = lower(p.publisher) GROUP BY 1, 2
    """,
)
def lookup_spelling(t: Tables) -> DataFrame:
    lookup = stage(t.sql(_PUBLISHERS), "publisher_channel")
    facts = t.events.select(F.col("event_type").alias("publisher"))
    named = lookup_ci(facts, lookup, "publisher", keep="lookup")
    return named.groupBy("publisher", "channel").agg(F.count("*").alias("n"))


@query(
    "lookup_unmapped",
    """
    SELECT event_type AS publisher, count(*) AS "rows" FROM events WHERE event_type = 'error' GROUP BY 1
    """,
)
def lookup_unmapped(t: Tables) -> DataFrame:
    lookup = stage(t.sql(_PUBLISHERS), "publisher_channel")
    return unmapped(t.events.select(F.col("event_type").alias("publisher")), lookup, "publisher")


# --- joins and sums ----------------------------------------------------------


@query(
    "left_enrich",
    """
    WITH seg AS (SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), '|') AS segments
                 FROM customer GROUP BY 1)
    SELECT o_orderkey, c_name, n_name, segments
    FROM orders LEFT JOIN customer ON c_custkey = CASE WHEN o_orderkey % 4 = 0 THEN -1 - o_custkey ELSE o_custkey END
    LEFT JOIN nation ON n_nationkey = customer.c_nationkey LEFT JOIN seg ON seg.c_nationkey = customer.c_nationkey
    """,
)
def left_enrich(t: Tables) -> DataFrame:
    segments = distinct_array(t.customer, ["c_nationkey"], ["c_mktsegment"]).withColumnRenamed("c_mktsegment", "segments")
    enriched = (
        t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 4 = 0 THEN -1 - o_custkey ELSE o_custkey END AS buyer")
        .join(t.customer.drop("c_mktsegment"), F.col("buyer") == F.col("c_custkey"), "left")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(segments, "c_nationkey", "left")
    )
    return comparable(enriched.select("o_orderkey", "c_name", "n_name", "segments"))


@query(
    "inner_two_facts",
    """
    SELECT strftime(o.day, '%Y-%m-%d') AS day, o.orders, o.total, l.lines, l.price FROM
      (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) o
    JOIN (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS lines, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1) l
    ON o.day = l.day
    """,
)
def inner_two_facts(t: Tables) -> DataFrame:
    placed = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count("*").alias("orders"), F.sum("o_totalprice").alias("total")
    )
    shipped = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(
        F.count("*").alias("lines"), F.sum("l_extendedprice").alias("price")
    )
    return comparable(placed.join(shipped, "day", "inner"))


@query(
    "cast_key_join",
    """
    SELECT o_orderkey, c_name FROM orders
    LEFT JOIN customer ON CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey END = o_custkey
    """,
)
def cast_key_join(t: Tables) -> DataFrame:
    # Text keys; some do not parse and match nothing.
    key = F.when(F.col("c_custkey") % 9 == 0, F.concat(F.lit("x"), F.col("c_custkey"))).otherwise(
        F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    )
    named = t.customer.select(key.alias("text_key"), "c_name")
    joined = t.orders.join(named, F.col("o_custkey") == casts.to_long(F.col("text_key")), "left")
    return joined.select("o_orderkey", "c_name")


@query(
    "two_level_sum",
    """
    SELECT l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS day, round(sum(l_extendedprice), 2) AS price,
           sum(l_quantity) AS quantity
    FROM lineitem GROUP BY 1, 2
    """,
)
def two_level_sum(t: Tables) -> DataFrame:
    return comparable(
        t.lineitem.groupBy("l_returnflag", F.col("l_shipdate").cast("date").alias("day")).agg(
            F.sum("l_extendedprice").alias("price"), F.sum("l_quantity").alias("quantity")
        )
    )


@query(
    "having_dups",
    f"""
    SELECT lower(spelled) AS folded, count(*) AS spellings FROM (SELECT DISTINCT spelled FROM ({_SPELLED}) s) x
    GROUP BY 1 HAVING count(*) > 1
    """,
)
def having_dups(t: Tables) -> DataFrame:
    spellings = t.sql(_SPELLED).select("spelled").distinct()
    return (
        spellings.groupBy(F.lower("spelled").alias("folded")).agg(F.count("*").alias("spellings")).where("spellings > 1")
    )


@query("distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@query(
    "union_zero_fill",
    """
    SELECT source, count(*) AS n, round(sum(media_cost), 2) AS media_cost, round(sum(impressions), 2) AS impressions,
           CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(video_views) AS BIGINT) AS video_views, min(day) AS first_day
    FROM (SELECT 'lineitem' AS source, l_extendedprice AS media_cost, l_quantity AS impressions, l_linenumber AS clicks, 0 AS video_views,
                 strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem
          UNION ALL SELECT 'orders', o_totalprice, 1, 0, 0, strftime(o_orderdate, '%Y-%m-%d') FROM orders
          UNION ALL SELECT 'events', 0, value, 1, user_id, strftime(ts, '%Y-%m-%d') FROM events) u
    GROUP BY 1
    """,
)
def union_zero_fill(t: Tables) -> DataFrame:
    contract = {
        "source": "string", "media_cost": "double", "impressions": "double", "clicks": "bigint",
        "video_views": "bigint", "day": "date",
    }
    frames = {
        "lineitem": t.lineitem.select(
            F.col("l_extendedprice").alias("media_cost"), F.col("l_quantity").alias("impressions"),
            F.col("l_linenumber").alias("clicks"), F.col("l_shipdate").alias("day"),
        ),
        "orders": t.orders.select(F.col("o_totalprice").alias("media_cost"), F.col("o_orderdate").alias("day")),
        "events": t.events.select(
            F.col("value").alias("impressions"), F.col("user_id").alias("video_views"), F.col("ts").alias("day")
        ),
    }
    zero, one = F.lit(0), F.lit(1)
    given = {
        "lineitem": {"source": F.lit("lineitem"), "video_views": zero},
        "orders": {"source": F.lit("orders"), "impressions": one, "clicks": zero, "video_views": zero},
        "events": {"source": F.lit("events"), "media_cost": zero, "clicks": one},
    }
    facts = unify(frames, contract, given)
    summed = facts.groupBy("source").agg(
        F.count("*").alias("n"), *[F.sum(m).alias(m) for m in ("media_cost", "impressions", "clicks", "video_views")],
        F.min("day").alias("first_day"),
    )
    return comparable(summed)


# --- columns -----------------------------------------------------------------


@query("star_except", "SELECT * EXCLUDE (c_acctbal, c_nationkey) FROM customer")
def star_except_query(t: Tables) -> DataFrame:
    return star_except(t.customer, "c_acctbal", "c_nationkey")


@query("glob_select", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def glob_select(t: Tables) -> DataFrame:
    streams = select_streams(
        {"customer": t.customer, "custom_other": t.nation, "orders": t.orders}, ["customer*.c_c*", "cust*.c_na*"]
    )
    assert set(streams) == {"customer", "custom_other"}
    return select_glob(streams["customer"], "c_[cn]*")


@query(
    "rename_cols",
    'SELECT c_custkey AS customer_id, c_name AS full_name, c_nationkey AS _1st_nation, c_mktsegment AS "market_segment__" FROM customer',
)
def rename_cols(t: Tables) -> DataFrame:
    odd = t.customer.select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("Full Name"),
        F.col("c_nationkey").alias("1stNation"),
        F.col("c_mktsegment").alias("market segment%)"),
    )
    return normalise_columns(odd)


# --- reload windows and reports ----------------------------------------------


@query(
    "incremental_since",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) < 2001)
    """,
)
def incremental_since_query(t: Tables) -> DataFrame:
    done = t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")))
    fresh = incremental_since(t.orders, done, "o_orderdate")
    return comparable(fresh.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")))


@query(
    "incremental_first_load",
    "SELECT o_orderkey, o_custkey FROM orders",
)
def incremental_first_load(t: Tables) -> DataFrame:
    nothing = t.orders.where(F.col("o_orderstatus") == "no such status")
    return incremental_since(t.orders, nothing, "o_orderdate").select("o_orderkey", "o_custkey")


@query(
    "lookback",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - 30
    """,
)
def lookback_query(t: Tables) -> DataFrame:
    recent = lookback(t.orders, "o_orderdate", days=30, as_of="2001-08-01")
    return comparable(recent.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")))


@query(
    "dimension_report",
    """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice
    FROM lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1999-07-01' AND l_discount > 0.02
    GROUP BY 1, 2
    """,
)
def dimension_report_query(t: Tables) -> DataFrame:
    return comparable(
        dimension_report(
            t.lineitem, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"], "l_shipdate",
            "1997-01-01", "1999-06-30", filters=[F.col("l_discount") > 0.02],
        )
    )


@query(
    "dimension_report_nonempty",
    """
    SELECT l_suppkey, l_linenumber, round(sum(tax), 2) AS tax FROM
      (SELECT *, CASE WHEN l_returnflag = 'R' THEN l_tax ELSE 0 END AS tax FROM lineitem) x
    WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1996-03-01' GROUP BY 1, 2 HAVING sum(tax) <> 0
    """,
)
def dimension_report_nonempty(t: Tables) -> DataFrame:
    taxed = t.lineitem.withColumn("tax", F.when(F.col("l_returnflag") == "R", F.col("l_tax")).otherwise(F.lit(0.0)))
    return comparable(
        dimension_report(taxed, ["l_suppkey", "l_linenumber"], ["tax"], "l_shipdate", "1996-01-01", "1996-02-29")
    )


@query(
    "campaign_token",
    f"SELECT doc_id, coalesce(string_split(campaign_name, '_')[2], campaign_name) AS campaign FROM ({_DOC_NAMES}) d",
)
def campaign_token_query(t: Tables) -> DataFrame:
    return t.sql(_DOC_NAMES).select("doc_id", campaign_token(F.col("campaign_name")).alias("campaign"))
