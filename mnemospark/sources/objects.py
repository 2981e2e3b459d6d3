"""Objects as rows ``(path, etag, length, content)``: listing, text, line windows, edits, bulk IO."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mnemospark.functions.paths import extension
from mnemospark.functions.text import occurrences, replace_first
from mnemospark.operators.tables import narrowed

MAX_NAMED = 10_000  # most files that are read by name

# Extensions read as UTF-8 text, and those needing a caller's parser.
TEXT_EXTENSIONS = (".txt", ".md", ".rst", ".csv")
PARSER_EXTENSIONS = (".pdf", ".docx", ".doc", ".xlsx", ".xls", ".pptx", ".ppt")


def scan_objects(spark: SparkSession, root: str, prefix: str = "", *, with_content: bool = True,
                 stat_etag: bool = False, paths: list[str] | None = None) -> DataFrame:
    """``(path, etag, length, content)`` of all files below ``root``, or of ``paths``; relative to it.

    The ETag is the MD5 of the content, or with ``stat_etag`` (and without content) made of length
    and modification time, so that a listing opens no file.
    """
    base = root.rstrip("/")
    reader = spark.read.format("binaryFile")
    if paths is None:
        files = reader.option("recursiveFileLookup", "true").load(base)
    else:
        files = reader.load([f"{base}/" + re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths])
    full = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    path = F.substring(full, F.instr(full, base) + F.lit(len(base) + 1), F.lit(2**31 - 1))
    stat = F.md5(F.concat_ws(":", F.col("length").cast("string"), F.col("modificationTime").cast("string")))
    etag = F.md5("content") if with_content and not stat_etag else stat
    out = files.select(path.alias("path"), etag.alias("etag"), "length", *(["content"] if with_content else []))
    return out.filter(F.col("path").startswith(prefix)) if prefix else out


def load_objects(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """Objects of the ``wanted(path)`` rows: read by name if they are few, else picked from a scan."""
    named = [r["path"] for r in wanted.limit(MAX_NAMED + 1).collect()]
    if 0 < len(named) <= MAX_NAMED:
        return scan_objects(spark, root, stat_etag=True, paths=named)
    return scan_objects(spark, root, stat_etag=True).join(wanted, "path", "left_semi")


def too_large(max_bytes: int | None) -> Column:
    """Whether an object exceeds the caller's cap; never without one."""
    return F.lit(False) if max_bytes is None else F.col("length") > max_bytes


def within_size(objects: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Objects that may be read, and those that are too large (to be counted as failed)."""
    return objects.filter(~too_large(max_bytes)), objects.filter(too_large(max_bytes))


def utf8(content: Column | str) -> Column:
    """Bytes as text; invalid sequences become the replacement character."""
    c = F.col(content) if isinstance(content, str) else content
    return F.make_valid_utf8(c.cast("string"))


def text_from_objects(objects: DataFrame) -> DataFrame:
    """``(path, page_number, text)`` for text formats and, as a fallback, unknown ones.

    Formats that need a parser are left out; callers supply their pages themselves.
    """
    kept = objects.filter(~extension("path").isin(*PARSER_EXTENSIONS))
    others = [c for c in objects.columns if c not in ("path", "content")]
    return kept.select("path", *others, F.lit(None).cast("int").alias("page_number"), utf8("content").alias("text"))


def read_lines(texts: DataFrame, offset: int = 0, limit: int = 2000, *, key: str = "path",
               text_col: str = "text") -> DataFrame:
    """``(key, line, content)`` of lines ``offset .. offset+limit-1``, counted from 0.

    A negative limit reads to the end. A final line break starts no further line.
    """
    lines = F.split(F.regexp_replace(F.col(text_col), r"\r?\n\z", ""), r"\r?\n")
    wanted = (F.slice(lines, offset + 1, limit) if limit >= 0
              else F.when(F.size(lines) > offset, F.slice(lines, F.lit(offset + 1), F.greatest(F.size(lines) - offset, F.lit(0)))))
    return (texts.filter(F.col(text_col) != "")
            .select(key, F.posexplode(wanted).alias("_at", "content"))
            .select(key, (F.col("_at") + offset).alias("line"), "content"))


def bulk_replace_text(df: DataFrame, old: str, new: str, replace_all: bool = False, *,
                      text_col: str = "text") -> DataFrame:
    """Literal replacement of the first or all occurrences; ``replaced`` counts them."""
    found = occurrences(text_col, old)
    text = (F.replace(F.col(text_col), F.lit(old), F.lit(new)) if replace_all
            else replace_first(text_col, old, new))
    count = found if replace_all else F.least(found, F.lit(1).cast("bigint"))
    return df.withColumn("replaced", count).withColumn(text_col, text)


def read_objects(asked: DataFrame, objects: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``(pos, path, content, error)`` in asked order; missing and too large paths carry an error."""
    joined = asked.join(narrowed(objects, asked, ["path"]).select("path", "length", "content"), "path", "left")
    error = (F.when(F.col("length").isNull(), "file_not_found")
             .when(too_large(max_bytes), "too_large"))
    return joined.select("pos", "path", F.when(error.isNull(), F.col("content")).alias("content"), error.alias("error"))


def write_objects(objects: DataFrame, root: str, *, mode: str = "overwrite") -> None:
    """Write objects as a table partitioned by top folder, for pruned reads by path."""
    folder = F.when(F.col("path").contains("/"), F.element_at(F.split("path", "/"), 1)).otherwise("")
    objects.withColumn("folder", folder).write.mode(mode).partitionBy("folder").parquet(root)
