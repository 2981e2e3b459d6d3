"""Text expressions: tokens, pieces, lines and literal replacement."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(col: Column | str) -> Column:
    """Lower-cased letter/digit runs, in text order."""
    return F.array_remove(F.split(F.lower(_c(col)), r"[^\p{L}\p{N}]+"), "")


def distinct_tokens(col: Column | str) -> Column:
    return F.array_distinct(tokens(col))


def term_counts(toks: Column) -> Column:
    """``array<struct<term, tf, doc_len>>`` of a token array: run lengths of the sorted tokens, null if there are none.

    All inside the row, so that counting words moves nothing.
    """
    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)))
        # An array of one binds a value, which would otherwise be computed again for every element.
        return F.get(F.transform(F.array(starts), lambda at: F.transform(at, lambda i, j: F.struct(
            F.get(ordered, i - 1).alias("term"), (F.coalesce(F.get(at, j + 1), n + 1) - i).cast("bigint").alias("tf"), n.alias("doc_len")))), F.lit(0))

    return F.get(F.transform(F.array(F.sort_array(toks)), lambda ordered: F.when(F.size(ordered) > 0, runs(ordered))), F.lit(0))


def pieces(col: Column | str) -> Column:
    """Whitespace-led words whose concatenation is the text.

    Trailing whitespace belongs to the last piece; text of whitespace only is one piece.
    """
    c = _c(col)
    return F.regexp_extract_all(c, F.lit(r"\s*\S+\s*\z|\s*\S+|\A\s+\z"), F.lit(0))


def newline_count(col: Column | str) -> Column:
    c = _c(col)
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))


def line_at(text: Column | str, offset: Column) -> Column:
    """Number of newlines before the 0-based character ``offset``."""
    return newline_count(F.substring(_c(text), F.lit(1), offset))


def occurrences(text: Column | str, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    if not needle:
        raise ValueError("the text to look for must not be empty")
    c = _c(text)
    removed = F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))
    return (removed / F.lit(len(needle))).cast("bigint")


def replace_first(text: Column | str, old: str, new: str) -> Column:
    c = _c(text)
    at = F.instr(c, old)
    return F.when(at > 0, F.overlay(c, F.lit(new), at, F.lit(len(old)))).otherwise(c)


def contains_ignore_case(text: Column | str, literal: str) -> Column:
    return F.lower(_c(text)).contains(literal.lower())


def strip_code_fence(col: Column | str) -> Column:
    """Drop one surrounding Markdown code fence, with or without a language tag."""
    c = F.trim(_c(col))
    opened = F.regexp_replace(c, r"^```[A-Za-z]*\s*", "")
    return F.trim(F.regexp_replace(opened, r"\s*```$", ""))


def strip_nulls(col: Column | str) -> Column:
    """Remove the null character."""
    return F.replace(_c(col), F.lit("\u0000"), F.lit(""))
