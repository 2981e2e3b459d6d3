"""Licence scans against regular expressions made from the same templates."""

import random
import re

import pytest

from mnemospark.llm import license_scan
from mnemospark.llm.license_scan import Automaton, Scanner, as_regex, spaced, words_of
from mnemospark.llm.license_templates import TEMPLATES

FILLERS = ["of", "the", "is", "permission", "software", "license", "a", "b"]


def drawn(parts, rng):
    """One text that a template accepts."""
    out = []
    for part in parts:
        if isinstance(part, bytes):
            out.append(part.decode())
        elif part[0] == "optional":
            out += drawn(part[1], rng) if rng.random() < 0.5 else []
        elif part[0] == "choice":
            out += drawn(rng.choice(part[1]), rng)
        else:
            out += rng.choices(FILLERS, k=rng.randint(part[1], part[2]))
    return out


@pytest.mark.parametrize("number", range(len(TEMPLATES)))
def test_templates_accept_their_texts_and_no_changed_wording(number):
    rng = random.Random(number)
    automaton = Automaton(TEMPLATES[number][1])
    regex = re.compile(as_regex(TEMPLATES[number][1]))
    for _ in range(30):
        words = drawn(automaton.parts, rng)
        text = ["before"] * rng.randint(0, 3) + words + ["after"] * rng.randint(0, 3)
        found = automaton.places([w.encode() for w in text])
        assert found and regex.search(spaced([w.encode() for w in text]).decode())
        assert automaton.needed in spaced([w.encode() for w in text])
        changed = list(text)
        changed[rng.randrange(len(changed))] = rng.choice(["zzz", "of", ""])
        coded = [w.encode() for w in changed if w]
        assert bool(automaton.places(coded)) == bool(regex.search(spaced(coded).decode()))


def test_places_equal_all_windows():
    rng = random.Random(1)
    templates = ["a [[b]] {{1-2}} c", "a {{b|c a|0-0}} [[c [[a]]]] b", "{{0-2}} a b", "a a"]
    for template in templates:
        automaton, whole = Automaton(template), re.compile(as_regex(template))
        for _ in range(300):
            words = [w.encode() for w in rng.choices("abc", k=rng.randint(0, 9))]
            accepted = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words) + 1) if whole.fullmatch(spaced(words[i:j]).decode())}
            got = automaton.places(words)
            assert set(got) <= accepted and bool(got) == bool(accepted)
            assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
            if accepted:  # the leftmost start is found
                assert got[0][0] == min(i for i, _ in accepted)


def test_bad_templates_are_refused():
    for bad in ["[[a", "a]]", "[[a]]", "{{0-3}}"]:
        with pytest.raises(ValueError):
            Automaton(bad)


def test_phrases_are_found_at_whole_words():
    scan = Scanner([], license_scan.PHRASES).scan
    assert [(p["start"], p["end"]) for p in scan("CC-BY-NC cc by nc, CC by\nNC!")["places"]] == [(0, 3), (3, 6), (6, 9)]
    assert scan("xcc by nc cc by ncé")["places"] == [] and scan(None) == {"n_words": 0, "places": []}
    assert words_of("Ünder @ THE_mit\x00Licénse") == ["Ünder".encode(), b"the", b"mit", "licénse".encode()]


def test_scan_of_rough_rows(docs, rough):
    rows = rough + [(90, "Released under the MIT License. CC BY-NC", "en", "s"), (91, "distributed under the terms of the GNU General Public License (GPL), Version 3", None, None)]
    extra = docs(rows).selectExpr("*", "1 AS score", "2 AS places", "3 AS n_words", "4 AS labels")
    got = license_scan.scan(extra).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[90].labels == ["cc-by-nc", "mit"] and by_id[90].n_words == 8 and by_id[91].labels == ["gpl-3"]
    assert all(r.labels == [] and r.score == 0 for r in got if r.doc_id not in (90, 91))
    assert by_id[5].n_words == 40_000 and 0.8 < by_id[91].score < 1
    assert license_scan.scan(docs([])).count() == 0
