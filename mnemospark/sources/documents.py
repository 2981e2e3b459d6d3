"""Loading tables as documents, JSON-safe rows and table profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mnemospark.functions.filters import as_predicate
from mnemospark.functions.values import elided, json_ready

SAMPLE_LENGTH = 20


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def load_documents(df: DataFrame, *, filter: Column | Mapping[str, Any] | None = None,
                   field_names: Sequence[str] | None = None, metadata_names: Sequence[str] = (),
                   source_cols: Mapping[str, str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``page_content`` from (dotted) fields joined by one space, plus metadata columns.

    Missing values are ``''``; a dot in a metadata name becomes ``_``; ``source_cols`` adds
    constants such as database and collection names. Without fields the whole row is the content,
    as JSON. Only the named columns are read.
    """
    predicate = as_predicate(filter)
    if predicate is not None:
        df = df.filter(predicate)
    content = (F.concat_ws(" ", *[_text(f) for f in field_names]) if field_names
               else F.to_json(F.struct(*json_ready(df.schema))))
    return df.select(*keep, content.alias("page_content"),
                     *[_text(m).alias(m.replace(".", "_")) for m in metadata_names],
                     *[F.lit(v).alias(c) for c, v in (source_cols or {}).items()])


def to_json_rows(df: DataFrame, id_cols: Sequence[str] = (), *, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row: ids as strings, times as ISO text, at every depth."""
    return df.select(*keep, F.to_json(F.struct(*json_ready(df.schema, tuple(id_cols)))).alias("json"))


def _paths(schema: T.StructType, prefix: str = "", column: str = "") -> list[tuple[str, str, str]]:
    out = []
    for f in schema.fields:
        name, ref = prefix + f.name, column + f"`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            out.extend(_paths(f.dataType, name + ".", ref + "."))
        else:
            out.append((name, ref, f.dataType.simpleString()))
    return out


def profile_table(df: DataFrame) -> DataFrame:
    """``(field, type, rows, non_null)`` of every field, nested ones by dotted path; one pass."""
    fields = _paths(df.schema)
    counted = df.agg(F.count("*").alias("_n"), *[
        F.count(F.col(ref)).alias(f"_c{i}") for i, (_, ref, _) in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(name).alias("field"), F.lit(kind).alias("type"),
                              F.col("_n").alias("rows"), F.col(f"_c{i}").alias("non_null"))
                     for i, (name, _, kind) in enumerate(fields)])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def variant_schema(df: DataFrame, col: str) -> DataFrame:
    """Merged schema of a VARIANT column over all rows."""
    return df.agg(F.schema_of_variant_agg(F.col(col)).alias("schema"))


def elide(df: DataFrame, max_len: int = SAMPLE_LENGTH) -> DataFrame:
    """Long strings cut to ``max_len + 1`` characters, through structs, arrays and maps."""
    return df.select(*[elided(F.col(f"`{f.name}`"), f.dataType, max_len).alias(f.name) for f in df.schema.fields])


def sample_rows(df: DataFrame, n: int, order_by: Sequence[str], max_len: int = SAMPLE_LENGTH) -> DataFrame:
    """First ``n`` rows in key order, elided."""
    return elide(df.orderBy(*order_by).limit(n), max_len)
