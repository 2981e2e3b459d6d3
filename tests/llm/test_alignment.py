"""Alignment of two tokenizers against a plain version that compares all byte ranges."""

import random
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from mnemospark.llm import alignment
from mnemospark.llm.bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


def plain(texts):
    """Rows of counts and groups; the groups come from the cuts alone, without windows."""
    first, second = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    byte = {c: b for b, c in enumerate(byte_letters())}
    spell_a = lambda t: bytes(byte[c] for c in first.id_to_token(t)) if all(c in byte for c in first.id_to_token(t)) else first.id_to_token(t).encode()
    spell_b = lambda t: bytes([int(second.id_to_piece(t)[3:5], 16)]) if second.is_byte(t) else second.id_to_piece(t).replace("▁", " ").encode()
    aligned = []
    for text in texts:
        groups = []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            raw = (" " + text).encode()
            if b"".join(map(spell_a, a)) == raw == b"".join(map(spell_b, b)):
                ends_a, ends_b, at = {}, {}, 0
                for i, t in enumerate(a):
                    ends_a[at := at + len(spell_a(t))] = i + 1
                at = 0
                for i, t in enumerate(b):
                    ends_b[at := at + len(spell_b(t))] = i + 1
                i = j = 0
                for end in sorted(ends_a.keys() & ends_b.keys()):
                    groups.append((a[i:ends_a[end]], b[j:ends_b[end]]))
                    i, j = ends_a[end], ends_b[end]
        aligned.append(groups)
    counts = Counter(p for groups in aligned for p in {(x, y) for left, right in groups for x in left for y in right})
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for groups in aligned:
        links = [(x, y) for left, right in groups for x in left for y in right]
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links),
                    sum(counts[p] for p in links), ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_the_plain_version(spark, docs, rough, monkeypatch, small):
    if small:  # many blocks and pieces, and a memory that is full at once
        for name, value in {"BLOCK_BYTES": 3000, "PIECE_CHARS": 500, "WINDOWS_AT_ONCE": 40, "CELLS_AT_ONCE": 900, "LONG_TEXT": 200}.items():
            monkeypatch.setattr(alignment, name, value)
    rng = random.Random(2)
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").limit(60).collect()]
    texts += ["a  b", " a", "a ", "\ttab\n\nnew  line ", "<|endoftext|> <s>x</s> <0x41>", "日本語 ١٢ ²½Ⅷ ﬁ", "▁a ▁", "a\x00b", "don't 12345 I'll", "é é", "　x"]
    texts += ["".join(rng.choices("ab \n1é日.😀", k=rng.randint(1, 30))) for _ in range(80)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(i, t, "en", "s") for i, t, _, _ in rough]
    df = docs(rows).withColumnsRenamed({"words": "code", "class": "groups", "size": "n_a"}).repartition(3)
    got = alignment.align(df, A, B).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()
    want = [(r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows]))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 100 and any(w[1] == 0 and r[1] for w, r in zip(want, rows))


def test_link_counts_and_empty_tables(spark, docs):
    aligned = alignment.blocks(docs([(1, "one word", "en", "s"), (2, "one one", "en", "s"), (2, None, "en", "s")]), A, B)
    counts = alignment.link_counts(aligned).collect()
    assert sorted(c.documents for c in counts) == [1, 2] and all(c.best and c.code == c.a_id << 32 | c.b_id for c in counts)
    assert alignment.align(docs([]), A, B).count() == 0
    only = alignment.align(docs([(1, None, "en", "s"), (None, "", "en", "s")]), A, B).collect()
    assert all(r.n_links == 0 and r.groups == "" for r in only) and len(only) == 2


def test_equal_windows_are_aligned_once():
    aligner = alignment.load(A, B)
    block = alignment.Block(aligner)
    for _ in range(3):
        block.add(["the cat saw the dog and the bird"] * 5)
    got = block.finish()
    assert len(got["size_a"]) == 6 and len(got["row"]) == 15 * 8  # the, cat, saw, dog, and, bird
    assert got["documents"].tolist() == [15] * len(got["codes"])


def test_both_libraries_agree_on_all_letters():
    a = alignment.load(A, B).a
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for start in range(0, len(points), 50_000):
        texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1{chr(c)}  {chr(c)} '{chr(c)} x .{chr(c)}" for c in points[start:start + 50_000]]
        ids, sizes = a.encode(texts)
        slow = a.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)
        assert sizes.tolist() == [len(e.ids) for e in slow] and ids.tolist() == [i for e in slow for i in e.ids]


def test_white_space_of_any_length():
    block = alignment.Block(alignment.load(A, B))
    block.add([" " * 1_000_000 + "a", "x" * 200_000])
    assert (block.counts[0][1] > 0).all()


def test_a_block_is_finished_in_little_memory():
    import tracemalloc

    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    block = alignment.Block(alignment.load(A, B))
    for _ in range(10):
        block.add([" ".join(rng.choices(words, k=40)) for _ in range(1000)])
    tracemalloc.start()
    try:
        block.finish()
        assert tracemalloc.get_traced_memory()[1] < 45_000_000
    finally:
        tracemalloc.stop()
