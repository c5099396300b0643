"""Raw envelope rows (one JSON object per row) to typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from adloom.functions import casts

# Load metadata next to ``data`` in every raw table.
LOAD_COLUMNS = {
    "_sdc_extracted_at": "timestamp",
    "_sdc_received_at": "timestamp",
    "_sdc_batched_at": "timestamp",
    "_sdc_deleted_at": "timestamp",
    "_sdc_sequence": "bigint",
    "_sdc_table_version": "bigint",
}

# The later load wins where nothing reported decides.
LATEST = ("_sdc_extracted_at", "_sdc_sequence")

# How each kind turns the JSON text into its column.
_READERS = {
    "text": lambda x, strict: x,
    "long": casts.to_long,
    "double": casts.to_double,
    "decimal_comma": casts.decimal_comma,
    "percent": casts.percent,
}


@dataclass(frozen=True)
class Field:
    """One JSON member.

    ``kind`` is a reader name, ``date:<spelling>``, ``iso_text:<spelling>`` (a
    date written back as ``yyyy-MM-dd`` text) or ``json:<type>`` for nested data.

    ``mode`` says what happens to text that does not parse: ``run`` follows the
    run (NULL, or an error in a strict one), ``safe`` is always NULL.
    """

    key: str
    name: str
    kind: str = "text"
    mode: str = "run"

    @property
    def nested(self) -> bool:
        return self.kind.startswith("json:")

    @property
    def ddl(self) -> str:
        return self.kind.removeprefix("json:") if self.nested else "string"

    @property
    def typed(self) -> str:
        """The SQL type of the column."""
        if self.nested:
            return self.ddl
        kind = self.kind.split(":")[0]
        return {"text": "string", "iso_text": "string", "long": "bigint", "date": "date"}.get(kind, "double")

    def read(self, value: Column, strict: bool) -> Column:
        if self.nested:
            return value
        strict = strict and self.mode != "safe"
        if ":" in self.kind:
            kind, spelling = self.kind.split(":")
            day = casts.to_date(value, spelling, strict)
            return casts.iso_text(day) if kind == "iso_text" else day
        return _READERS[self.kind](value, strict)


def fields(kind: str = "text", mode: str = "run", /, **key_by_name: str) -> list[Field]:
    """Fields of one kind and mode, as ``name="JSON key"``."""
    return [Field(key, name, kind, mode) for name, key in key_by_name.items()]


def _scalar(key: str, name: str) -> str:
    """SQL text: the parsed member, NULL where the document holds an object or array.

    Spark hands out the JSON text of a container read as a string, yet a real
    string may start with a bracket too, so the value's type decides. The second
    look at the document happens only for values with such a leading bracket.
    """
    value, text = f"`{key}`", key.replace("\\", "\\\\").replace("'", "\\'")
    kind = f"schema_of_variant(element_at(from_json(__data, 'map<string,variant>'), '{text}'))"
    return (
        f"CASE WHEN startswith({value}, '{{') OR startswith({value}, '[') "
        f"THEN CASE WHEN NOT rlike({kind}, '^(OBJECT|ARRAY)') THEN {value} END ELSE {value} END AS `{name}`"
    )


def parse_envelope(
    df: DataFrame,
    wanted: Sequence[Field],
    keep: Sequence[str] = (),
    strict: bool = False,
    data: str = "data",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Parse ``data`` once and return one typed column per field plus ``keep``.

    ``data`` is a JSON text, or a VARIANT as ``as_variant`` makes it: then nothing
    is parsed here, and members are read by their type. Of the latter a number
    read as text is spelled plainly (``1.50`` as ``1.5``).

    ``keys`` are the columns that will tell rows apart. A key that is NULL
    because its text does not parse would merge rows that have nothing in
    common, so such rows are left out, as are rows whose document does not
    parse; ``rejects`` returns them. A strict run stops at them instead.
    """
    parsed = _parse(df, wanted, keep, strict, data, keys)
    reason = _reason(wanted, keys)
    if strict:
        stop = F.raise_error(F.concat(F.lit("rejected row: "), reason)).cast("boolean")
        good = parsed.where(F.when(reason.isNotNull(), stop).otherwise(True))
    else:
        good = parsed.where(reason.isNull())
    return good.select(*[f.name for f in wanted], *keep)


def rejects(
    df: DataFrame, wanted: Sequence[Field], keep: Sequence[str] = (), data: str = "data", keys: Sequence[str] = ()
) -> DataFrame:
    """The rows that ``parse_envelope`` leaves out: ``reason``, the raw document and ``keep``."""
    parsed = _parse(df, wanted, keep, False, data, keys)
    return parsed.select(_reason(wanted, keys).alias("reason"), F.col("__data").alias(data), *keep).where("reason IS NOT NULL")


def outcomes(
    df: DataFrame, wanted: Sequence[Field], keep: Sequence[str] = (), data: str = "data", keys: Sequence[str] = ()
) -> DataFrame:
    """What ``parse_envelope`` keeps and what ``rejects`` returns, in one pass: the fields, ``keep``, ``reason`` and the document.

    Kept rows have neither reason nor document, rejected ones no fields.
    """
    parsed = _parse(df, wanted, keep, False, data, keys).withColumn("reason", _reason(wanted, keys))
    given = [F.when(F.col("reason").isNull(), F.col(f.name)).alias(f.name) for f in wanted]
    return parsed.select(*given, *keep, "reason", F.when(F.col("reason").isNotNull(), F.col("__data")).alias(data))


def as_variant(df: DataFrame, data: str = "data") -> DataFrame:
    """Parse the documents once, for good: ``data`` becomes a VARIANT, and ``malformed`` holds the text of what is no object.

    A blank text is no document. An object that names a member twice counts as
    malformed.
    """
    parsed = df.withColumn("__variant", F.when(F.ltrim(data).startswith("{"), F.try_parse_json(data)))
    bad = F.when(F.col("__variant").isNull() & (F.trim(data) != ""), F.col(data)).alias("malformed")
    return parsed.select(*[F.col("__variant").alias(c) if c == data else F.col(c) for c in df.columns], bad)


def _typed_keys(wanted: Sequence[Field], keys: Sequence[str]) -> list[Field]:
    return [f for f in wanted if f.name in keys and f.kind != "text"]


def _reason(wanted: Sequence[Field], keys: Sequence[str]) -> Column:
    """Why a parsed row is rejected, or NULL."""
    arms = F.when(F.col("__none"), "no document").when(F.col("__corrupt").isNotNull(), "malformed document")
    for f in _typed_keys(wanted, keys):
        arms = arms.when(F.col(f"__text_{f.name}").isNotNull() & F.col(f.name).isNull(), f"{f.key} does not parse")
    return arms


def _parse(
    df: DataFrame, wanted: Sequence[Field], keep: Sequence[str], strict: bool, data: str, keys: Sequence[str]
) -> DataFrame:
    """``__data``, ``__none`` (no document), ``__corrupt`` (set if it does not parse), one typed column per field, ``__text_<name>`` of every typed key, and ``keep``."""
    read = _variant_members if isinstance(df.schema[data].dataType, T.VariantType) else _json_members
    # A text with a leading bracket is no number. So where it becomes NULL, a number
    # needs no look at the type of its value, and is read from the member itself.
    plain = {f.name for f in wanted if f.typed == "double" and f.name not in keys and not (strict and f.mode != "safe")}
    texts = read(df, wanted, keep, data, plain)
    typed = {f"__text_{f.name}": F.col(f.name) for f in _typed_keys(wanted, keys)}
    typed |= {f.name: f.read(F.col(f.name), strict) for f in wanted if f.kind != "text" and not f.nested}
    return texts.withColumns(typed) if typed else texts


def _variant_members(df: DataFrame, wanted: Sequence[Field], keep: Sequence[str], data: str, plain: set[str]) -> DataFrame:
    def path(key: str) -> str:
        quote = '"' if "'" in key else "'"
        return "'" + f"$[{quote}{key}{quote}]".replace("\\", "\\\\").replace("'", "\\'") + "'"

    def member(f: Field) -> str:
        if f.nested:
            return f"try_variant_get(__doc, {path(f.key)}, '{f.ddl}') AS `{f.name}`"
        text = f"try_variant_get(__doc, {path(f.key)}, 'string')"
        if f.name in plain:
            return f"{text} AS `{f.name}`"
        # Only a text with a leading bracket may be a container; its type decides.
        container = f"rlike(schema_of_variant(try_variant_get(__doc, {path(f.key)}, 'variant')), '^(OBJECT|ARRAY)')"
        return f"CASE WHEN (startswith({text}, '{{') OR startswith({text}, '[')) AND {container} THEN NULL ELSE {text} END AS `{f.name}`"

    def misshapen(f: Field) -> str:
        """Text of a document whose member is there in another shape; a text document does not parse then either."""
        given = f"try_variant_get(__doc, {path(f.key)}, 'variant')"
        lost = f"try_variant_get(__doc, {path(f.key)}, '{f.ddl}') IS NULL AND {given} IS NOT NULL AND NOT is_variant_null({given})"
        return f"CASE WHEN {lost} THEN to_json(__doc) END"

    document = df.selectExpr(f"`{data}` AS __doc", "malformed", *[f"`{c}` AS `__keep_{c}`" for c in keep])
    return document.selectExpr(
        "coalesce(malformed, to_json(__doc)) AS __data",
        "__doc IS NULL AND malformed IS NULL AS __none",
        f"coalesce({', '.join(['malformed', *[misshapen(f) for f in wanted if f.nested], 'NULL'])}) AS __corrupt",
        *[member(f) for f in wanted],
        *[f"`__keep_{c}` AS `{c}`" for c in keep],
    )


def _json_members(df: DataFrame, wanted: Sequence[Field], keep: Sequence[str], data: str, plain: set[str]) -> DataFrame:
    schema = ", ".join(f"`{key}` {ddl}" for key, ddl in {f.key: f.ddl for f in wanted}.items()) + ", __corrupt string"
    corrupt = {"columnNameOfCorruptRecord": "__corrupt"}
    kept = [f"__keep_{c}" for c in keep]
    document = df.selectExpr(f"`{data}` AS __data", *[f"`{c}` AS `{k}`" for c, k in zip(keep, kept)])
    # Unpacking the document as a one-element array (always one row) keeps later
    # filters and join conditions above the parse; as a plain projection Spark
    # would copy the parse into every one of them.
    members = document.select("__data", *kept, F.inline_outer(F.array(F.from_json("__data", schema, corrupt))))
    return members.selectExpr(
        "__data",
        "__data IS NULL OR trim(__data) = '' AS __none",
        "__corrupt",
        *[f"`{f.key}` AS `{f.name}`" if f.nested or f.name in plain else _scalar(f.key, f.name) for f in wanted],
        *[f"`{k}` AS `{c}`" for c, k in zip(keep, kept)],
    )


def _container(value: Column) -> Column:
    """Whether a variant is an object or array; NULL counts as none."""
    return F.coalesce(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.lit(False))


def json_member(data: str, key: str) -> Column:
    """One scalar member of an envelope, for filters that run before the full parse."""
    return F.from_json(data, T.StructType().add(key, T.StringType())).getField(key)


def flatten_names(
    df: DataFrame,
    key: str,
    outer_path: Sequence[str],
    inner_path: Sequence[str],
    out: str,
    sep: str = ", ",
    data: str = "data",
    by: Sequence[str] = (),
) -> DataFrame:
    """Distinct names of a twice nested array, joined per key, and per columns ``by`` beside the document.

    ``outer_path`` leads from the document to the outer array, ``inner_path``
    from an outer element to the inner array and then to the name. Rows with an
    empty or missing array give nothing.
    """
    *inner_array, leaf = inner_path
    inner: T.DataType = T.ArrayType(T.StructType().add(leaf, T.VariantType()))
    for step in reversed(inner_array):
        inner = T.StructType().add(step, inner)
    outer: T.DataType = T.ArrayType(inner)
    for step in reversed(outer_path):
        outer = T.StructType().add(step, outer)
    # ``key`` sits at the top of the document, next to the first step.
    schema = T.StructType([T.StructField(key, T.StringType()), *outer.fields])

    doc = F.from_json(data, schema)
    items = reduce(lambda c, step: c.getField(step), outer_path, F.col("__json"))
    names = reduce(lambda c, step: c.getField(step), inner_array, F.col("__item"))
    element = F.col("__inner").getField(leaf)
    exploded = (
        df.select(*by, doc.alias("__json"))
        .select(*by, F.col("__json").getField(key).alias(key), F.explode(items).alias("__item"))
        .select(*by, key, F.explode(names).alias("__inner"))
        .select(*by, key, element.cast("string").alias(out), element.alias("__element"))
        # Only a text with a leading bracket may be a container; its type decides.
        .select(*by, key, F.when(~((F.col(out).startswith("{") | F.col(out).startswith("[")) & _container(F.col("__element"))), F.col(out)).alias(out))
    )
    # Reloads repeat every row: reduce to distinct pairs first, so no group
    # carries its repeats into the join of names.
    joined = exploded.distinct().groupBy(*by, key).agg(F.sort_array(F.collect_list(out)).alias("__names"))
    return joined.select(
        *by, key, F.when(F.array_size("__names") > 0, F.array_join("__names", sep)).alias(out)
    )
