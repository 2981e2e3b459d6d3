"""Path expressions: segments, parents and glob matching."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def basename(col: Column | str) -> Column:
    return F.element_at(F.split(_c(col), "/"), -1)


def extension(col: Column | str) -> Column:
    """Lower-cased suffix with its dot, or ``''``; a leading dot is no suffix."""
    return F.lower(F.regexp_extract(basename(col), r"^.+(\.[^.]+)$", 1))


def folder_prefix(path: str) -> str:
    """``'docs'`` and ``'docs/'`` both mean the folder ``docs/``."""
    trimmed = path.rstrip("/")
    return trimmed + "/" if trimmed else ""


def under(col: Column | str, prefix: str) -> Column:
    """Literal prefix test; reaches the Parquet scan as ``StringStartsWith``."""
    return _c(col).startswith(prefix) if prefix else F.lit(True)


def relative(col: Column | str, prefix: str) -> Column:
    c = _c(col)
    return F.substring(c, len(prefix) + 1, 2**31 - 1) if prefix else c


def first_segment(col: Column | str) -> Column:
    return F.element_at(F.split(_c(col), "/"), 1)


def parents(parts: Column | str, sep: str = "/") -> Column:
    """``[a, b, c]`` -> ``[a, a/b, a/b/c]``."""
    p = _c(parts)
    return F.when(F.size(p) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(p)),
                    lambda i: F.array_join(F.slice(p, F.lit(1), i), sep)))


def _expand_braces(pattern: str) -> list[str]:
    """Patterns without braces that together mean ``pattern``."""
    depth, start, commas = 0, -1, []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            i += 2
            continue
        if ch == "{":
            if depth == 0:
                start, commas = i, []
            depth += 1
        elif ch == "," and depth == 1:
            commas.append(i)
        elif ch == "}" and depth:
            depth -= 1
            if depth == 0:
                span = re.fullmatch(r"(-?\d+)\.\.(-?\d+)", pattern[start + 1:i])
                if commas:
                    cuts = [start, *commas, i]
                    options = [pattern[a + 1:b] for a, b in zip(cuts, cuts[1:])]
                elif span:
                    lo, hi = int(span[1]), int(span[2])
                    step = 1 if hi >= lo else -1
                    options = [str(n) for n in range(lo, hi + step, step)]
                else:
                    i += 1
                    continue
                return [full for option in options
                        for full in _expand_braces(pattern[:start] + option + pattern[i + 1:])]
        i += 1
    return [pattern]


def _segment_regex(segment: str, dotfiles: bool) -> str:
    """One path segment; wildcards never cross ``/`` nor hide a leading dot."""
    out, i = [], 0
    if segment[:1] in ("*", "?", "[") and not dotfiles:
        out.append(r"(?!\.)")
    while i < len(segment):
        ch = segment[i]
        if ch == "*":
            out.append("[^/]*")
            while i + 1 < len(segment) and segment[i + 1] == "*":
                i += 1
        elif ch == "?":
            out.append("[^/]")
        elif ch == "[" and "]" in segment[i + 2:]:
            close = segment.index("]", i + 2)
            body = segment[i + 1:close]
            negate = body[0] in "!^"
            body = re.sub(r"([\\\[\]^&])", r"\\\1", body[1:] if negate else body)
            out.append(f"(?!/)[{'^' if negate else ''}{body}]")
            i = close
        elif ch == "\\" and i + 1 < len(segment):
            i += 1
            out.append(re.escape(segment[i]))
        else:
            out.append(re.escape(ch))
        i += 1
    return "".join(out)


def glob_regex(pattern: str, dotfiles: bool = False) -> str:
    """Java regex for a glob: ``*`` ``?`` stay in a segment, ``**`` recurses, ``[abc]``, ``{a,b}``."""
    hidden = "" if dotfiles else r"(?!\.)"
    alternatives = []
    for plain in _expand_braces(pattern.lstrip("/")):
        parts = plain.split("/")
        out = []
        for n, part in enumerate(parts):
            last = n == len(parts) - 1
            if part == "**":
                if last:
                    out.append(f"(?:{hidden}[^/]+(?:/{hidden}[^/]+)*)?")
                else:
                    out.append(f"(?:{hidden}[^/]+/)*")
            else:
                out.append(_segment_regex(part, dotfiles) + ("" if last else "/"))
        alternatives.append("".join(out))
    return r"\A(?:" + "|".join(alternatives) + r")\z"


def matches_glob(col: Column | str, pattern: str, dotfiles: bool = False) -> Column:
    return _c(col).rlike(glob_regex(pattern, dotfiles))
