"""Value expressions: JSON, typed maps, ids, ISO times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def iso_timestamp(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def epoch_seconds(col: Column | str) -> Column:
    return F.unix_micros(_c(col).cast("timestamp")) / F.lit(1_000_000.0)


def is_object_id(col: Column | str) -> Column:
    """24 hexadecimal digits; such ids travel as strings."""
    return _c(col).rlike(r"\A[0-9a-fA-F]{24}\z")


def encode_list(col: Column | str) -> Column:
    return F.to_json(_c(col))


def decode_list(col: Column | str) -> Column:
    """JSON list of strings; anything malformed is null."""
    return F.from_json(_c(col), "array<string>", {"mode": "PERMISSIVE"})


def typed_metadata(col: Column | str) -> Column:
    """Map of legacy JSON texts -> map of ``{"type": ..., "value": ...}`` JSON texts."""
    return F.transform_values(
        _c(col), lambda _, v: F.to_json(F.struct(F.lit("json").alias("type"), v.alias("value"))))


def metadata_equals(col: Column | str, spec: dict[str, str]) -> Column:
    """Equality on typed metadata; keys and JSON-encoded values come from the caller."""
    out = F.lit(True)
    for key, encoded in spec.items():
        if key.startswith("$"):
            raise ValueError(f"filter keys must not hold operators: {key}")
        typed = F.get_json_object(F.try_element_at(_c(col), F.lit(key)), "$.value")
        out = out & F.coalesce(typed == F.lit(encoded), F.lit(False))
    return out


def _json_ready(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(col)
    if isinstance(kind, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(kind, T.BinaryType):
        return F.base64(col)
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _json_ready(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda _, x: _json_ready(x, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(
            *[_json_ready(col[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return col


def json_ready(schema: T.StructType, id_cols: tuple[str, ...] = ()) -> list[Column]:
    """Columns of a schema with times as ISO text, bytes as base64 and ids as strings."""
    return [(F.col(f"`{f.name}`").cast("string") if f.name in id_cols
             else _json_ready(F.col(f"`{f.name}`"), f.dataType)).alias(f.name)
            for f in schema.fields]


def elided(col: Column, kind: T.DataType, keep: int) -> Column:
    """Strings longer than ``keep`` cut to ``keep + 1`` characters, at every depth."""
    if isinstance(kind, T.StringType):
        return F.when(F.length(col) > keep, F.substring(col, 1, keep + 1)).otherwise(col)
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: elided(x, kind.elementType, keep))
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda _, x: elided(x, kind.valueType, keep))
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(
            *[elided(col[f.name], f.dataType, keep).alias(f.name) for f in kind.fields]))
    return col
