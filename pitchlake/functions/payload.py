"""JSON pack / unpack.

Pack: key columns stay typed, every other column goes into one JSON text column,
with NULLs written as JSON ``null`` (Spark's default would drop them).

Unpack: the JSON is parsed **once** per row with ``from_json`` and a schema that
holds only the requested keys, each read as text; every field is then cast to its
declared type with ``try_cast`` (lenient) or ``cast`` (strict). Reading all keys as
text makes ``"95.1"``, ``95.1`` and ``" 95.1"`` parse the same way, and keeps a bad
value from failing the whole query.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_JSON_OPTS = {"ignoreNullFields": "false"}

# Type names accepted in unpack specs.
_TYPE = {
    "text": T.StringType(),
    "string": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "numeric": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def spark_type(name: str) -> T.DataType:
    return _TYPE[name]


def pack_json(df: DataFrame, pk_cols: Sequence[str], extra_cols: Sequence[str] = (), data_col: str = "data") -> DataFrame:
    """Keys (+ extra kept columns) and one JSON text column with the rest."""
    keep = [c for c in dict.fromkeys([*pk_cols, *extra_cols]) if c in df.columns]
    rest = [c for c in df.columns if c not in keep]
    if not rest:
        return df.select(*keep)
    return df.select(*keep, F.to_json(F.struct(*rest), _JSON_OPTS).alias(data_col))


def payload_struct(json_col: Column, keys: Iterable[str]) -> Column:
    """Parse once: a struct with one text field per requested key."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in dict.fromkeys(keys)])
    return F.from_json(json_col, schema)


def typed_field(struct_col: Column, key: str, type_name: str, strict: bool = False) -> Column:
    """One field of a parsed payload, cast to its declared type."""
    raw = struct_col.getField(key)
    dtype = spark_type(type_name)
    if isinstance(dtype, T.StringType):
        return raw
    raw = F.trim(raw)
    return raw.cast(dtype) if strict else raw.try_cast(dtype)


def unpack(
    df: DataFrame,
    json_col: str,
    spec: Sequence[tuple[str, str]],
    keep: Sequence[str] = (),
    strict: bool = False,
    parsed_alias: str = "_payload",
) -> DataFrame:
    """Keep ``keep`` columns and add one typed column per ``(key, type)`` in spec.

    The parse is a projection of its own, so it runs once per row however many
    fields are read; only the spec's keys are in its schema.
    """
    if is_variant(df, json_col):
        v = F.col(json_col)
        return df.select(*keep, *[variant_field(v, k, t, strict).alias(k) for k, t in spec])
    parsed = df.select(*keep, payload_struct(F.col(json_col), [k for k, _ in spec]).alias(parsed_alias))
    p = F.col(parsed_alias)
    return parsed.select(*keep, *[typed_field(p, k, t, strict).alias(k) for k, t in spec])


def bad_value_counts(df: DataFrame, json_col: str, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """Per key: how many rows hold a non-NULL value that fails the typed cast.
    One aggregate row (partial aggregation, no shuffle of rows)."""
    p = payload_struct(F.col(json_col), [k for k, _ in spec]).alias("_p")
    parsed = df.select(p)
    aggs = []
    for k, t in spec:
        raw = F.col("_p").getField(k)
        typed = typed_field(F.col("_p"), k, t)
        aggs.append(F.count_if(raw.isNotNull() & typed.isNull()).alias(k))
    return parsed.agg(*aggs)


def to_variant(json_col: Column, strict: bool = False) -> Column:
    """Text -> VARIANT once, on load (``parse_json``; lenient: malformed -> NULL).
    A VARIANT column survives Parquet, and reading a key from it navigates the
    binary form instead of re-parsing text."""
    return F.parse_json(json_col) if strict else F.try_parse_json(json_col)


def variant_field(variant_col: Column, key: str, type_name: str, strict: bool = False) -> Column:
    """One key of a VARIANT payload, read as text and cast like ``typed_field``
    (JSON null and a missing key both give NULL)."""
    raw = F.try_variant_get(variant_col, f"$.{key}", "string")
    dtype = spark_type(type_name)
    if isinstance(dtype, T.StringType):
        return raw
    raw = F.trim(raw)
    return raw.cast(dtype) if strict else raw.try_cast(dtype)


def is_variant(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.VariantType)


def json_text(json_col: Column, key: str) -> Column:
    """``data->>'key'`` for a single ad-hoc key (top level)."""
    return F.get_json_object(json_col, f"$.{key}")
