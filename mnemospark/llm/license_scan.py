"""Licence scans by templates with optional and replaceable regions.

A template is compiled into an automaton over words: mandatory words are single steps, an optional region has a way
around it, a replaceable region takes any words within its bounds, or one of several wordings. A place is accepted if
the automaton reads it whole, so the mandatory wording must match exactly. A text meets an automaton only if it holds
the template's longest unbroken mandatory wording, found by plain search over the joined words.

Texts: null and empty ones have no words and no places. Equal rows give equal results, an empty table an empty one.
The result columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.llm.license_templates import TEMPLATES

#: Phrases that name a licence, and their labels.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
PLACES = "array<struct<label:string,start:int,end:int,base:boolean,wording:int>>"
SCAN = f"struct<n_words:bigint,places:{PLACES}>"
# Upper-case letters become lower case; all other ASCII but letters and digits is blank. Bytes from 128 on are letters.
LETTERS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(128)).lower() + bytes(range(128, 256))
MARK = re.compile(r"(\[\[|\]\]|\{\{[^}]*\}\})")
ANY = None  # the step that takes any word


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: letters, digits and all that is not ASCII, A to Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


def parse(template: str) -> list:
    """Parts of a template: words, ``("optional", parts)`` and ``("choice", [parts, ...])``; ``("any", m, n)`` in a choice."""
    stack: list[list] = [[]]
    for piece in MARK.split(template):
        if piece == "[[":
            stack.append([])
        elif piece == "]]":
            if len(stack) == 1:
                raise ValueError("an optional region ends that did not begin")
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif piece.startswith("{{"):
            choices = []
            for way in piece[2:-2].split("|"):
                bounds = re.fullmatch(r"\s*(\d+)-(\d+)\s*", way)
                choices.append([("any", int(bounds[1]), int(bounds[2]))] if bounds else words_of(way))
            stack[-1].append(("choice", choices))
        else:
            stack[-1] += words_of(piece)
    if len(stack) != 1:
        raise ValueError("an optional region does not end")
    return stack[0]


class Automaton:
    """Steps by word and free moves; state 0 is the start, ``last`` accepts."""

    def __init__(self, template: str):
        self.parts = parse(template)
        self.steps: list[dict] = []  # word (or ANY) to the next state
        self.free: list[list[int]] = []
        self.last = self.build(self.parts, self.state())
        self.closed = [self.closure(s) for s in range(len(self.steps))]
        if self.last in self.closed[0]:
            raise ValueError("the template accepts no words at all")
        runs, run = [], []
        for part in [*self.parts, ("end",)]:
            if isinstance(part, bytes):
                run.append(part)
            else:
                runs.append(run)
                run = []
        #: Wording that every accepted place holds, and the number of mandatory words.
        self.needed = spaced(max(runs, key=lambda r: len(b" ".join(r))))
        self.wording = sum(map(len, runs))

    def state(self) -> int:
        self.steps.append({})
        self.free.append([])
        return len(self.steps) - 1

    def build(self, parts: list, at: int) -> int:
        for part in parts:
            if isinstance(part, bytes):
                after = self.steps[at][part] = self.state()
            elif part[0] == "optional":
                after = self.build(part[1], at_inner := self.state())
                self.free[at] += [at_inner, after]
            elif part[0] == "choice":
                after = self.state()
                for way in part[1]:
                    self.free[at].append(first := self.state())
                    self.free[self.build(way, first)].append(after)
            else:
                after = at
                ends = [at] if part[1] == 0 else []
                for k in range(part[2]):
                    self.steps[after][ANY] = new = self.state()
                    after = new
                    if k + 1 >= part[1]:
                        ends.append(after)
                out = self.state()
                for end in ends:
                    self.free[end].append(out)
                after = out
            at = after
        return at

    def closure(self, state: int) -> tuple[int, ...]:
        found, todo = {state}, [state]
        while todo:
            for s in self.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return tuple(sorted(found))

    def places(self, words: Sequence[bytes]) -> list[tuple[int, int]]:
        """Accepted places, leftmost and then longest first, none overlapping; one pass over the words."""
        ends: dict[int, int] = {}
        threads: dict[int, int] = {}  # state to the first word of the earliest way into it
        for i, word in enumerate(words):
            for s in self.closed[0]:
                threads.setdefault(s, i)
            stepped: dict[int, int] = {}
            for s, start in threads.items():
                for to in {self.steps[s].get(word), self.steps[s].get(ANY)} - {None}:
                    for t in self.closed[to]:
                        if stepped.get(t, i + 1) > start:
                            stepped[t] = start
            if self.last in stepped:
                ends[stepped[self.last]] = i + 1
            threads = stepped
        out, free = [], 0
        for start, end in sorted(ends.items()):
            if start >= free:
                out.append((start, end))
                free = end
        return out


def spaced(words: Sequence[bytes]) -> bytes:
    """Words with a space on each side of each, so that a wording is found at whole words only."""
    return b" " + b"  ".join(words) + b" " if words else b""


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]):
        self.automata = [(label, Automaton(t)) for label, t in templates]
        self.phrases = [(label, spaced(words_of(p)), len(words_of(p))) for p, label in phrases]

    def scan(self, text: str | None) -> dict:
        words = words_of(text)
        joined = spaced(words)
        found = []
        for label, phrase, size in self.phrases:
            at = joined.find(phrase)
            passed = begin = 0
            while at >= 0:
                passed += joined.count(b"  ", begin, at + 1)
                begin = at
                found.append({"label": label, "start": passed, "end": passed + size, "base": True, "wording": size})
                at = joined.find(phrase, at + 1)
        for label, automaton in self.automata:
            if automaton.needed in joined:
                found += [{"label": label, "start": a, "end": b, "base": False, "wording": automaton.wording} for a, b in automaton.places(words)]
        return {"n_words": len(words), "places": found}


def scanned(text: Column | str, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES) -> Column:
    """Number of words and all places of a text, each with label, first word, word after the last, whether a phrase
    (``base``) or a template found it, and how many mandatory words it holds."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(templates, phrases)
        kind = pa.struct([("n_words", pa.int64()), ("places", pa.list_(pa.struct([
            ("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("wording", pa.int32())])))])
        for batch in batches:
            yield pa.array([scanner.scan(text.as_py()) for text in batch], kind)

    return F.arrow_udf(run, SCAN, F.ArrowUDFType.SCALAR_ITER)(text)


def scan(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``n_words``, ``places``, ``labels`` (distinct, sorted) and ``score``.

    The score is ``1 - 1 / (1 + w)`` where ``w`` is the largest number of mandatory words that a place holds; 0 without places.
    """
    kept = [c for c in docs.columns if c not in {"n_words", "places", "labels", "score"}]
    found = docs.withColumn("places", scanned(F.col(text_col), **options)).select(*[f"`{c}`" for c in kept], "places.n_words", "places.places")
    wording = F.coalesce(F.array_max(F.transform("places", lambda p: p["wording"])), F.lit(0))
    return found.withColumn("labels", labels_of("places")).withColumn("score", 1 - 1 / (1 + wording.cast("double")))


def labels_of(places: Column | str) -> Column:
    return F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"])))


def as_regex(template: str) -> str:
    """The same template as a regular expression over words that each stand between two spaces."""

    def of(parts: list) -> str:
        out = ""
        for part in parts:
            if isinstance(part, bytes):
                out += f" {part.decode()} "
            elif part[0] == "optional":
                out += f"(?:{of(part[1])})?"
            elif part[0] == "choice":
                out += "(?:" + "|".join(map(of, part[1])) + ")"
            else:
                out += f"(?: [^ ]+ ){{{part[1]},{part[2]}}}"
        return out

    return of(parse(template))


def sql(templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES) -> str:
    """The result of ``op13_license_scan`` in DuckDB, with regular expressions in place of the automata."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    lists, base, other = [], [], []
    for phrase, label in phrases:
        words = [w.decode() for w in words_of(phrase)]
        lists.append("list_filter(range(len(w)), lambda i: " + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words)) + ")")
        base.append((f"s LIKE '%{spaced(words_of(phrase)).decode()}%'", label, len(words)))
    for label, template in templates:
        other.append((f"regexp_matches(s, '{as_regex(template)}')", label, Automaton(template).wording))
    named = lambda found: "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{label}' END" for c, label, _ in found) + "], lambda x: x IS NOT NULL))), ',')"
    wording = ", ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, _, n in base + other)
    return rf"""
WITH cut AS (SELECT doc_id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
held AS (SELECT doc_id, w, CASE WHEN len(w) = 0 THEN '' ELSE ' ' || array_to_string(w, '  ') || ' ' END AS s, {' || '.join(lists)} AS found FROM cut)
SELECT doc_id, len(w)::BIGINT AS n_words, len(found)::BIGINT AS n_base, list_min(found)::BIGINT AS first_word, list_max(found)::BIGINT AS last_word,
  {named(base)} AS base_labels, {named(base + other)} AS labels, 1 - 1 / (1 + greatest({wording})::DOUBLE) AS score FROM held"""
