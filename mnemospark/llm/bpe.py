"""BPE with word ends: encoding and decoding of whole texts.

Encoding speculates and verifies. Greedy longest match proposes tokens for every distinct word of a
batch. A proposal is the merge result exactly if each token and each pair of neighbours merge to
themselves, so all pairs are looked up at once in a table of known pairs; unknown pairs are merged
once and remembered. Only words with an incompatible pair go through exact merging, many at a time:
every step takes the best pair of each word that still has one.

Texts: null and empty ones have no tokens and decode to the empty string. The file's special
tokens are recognised in the text, as the file demands. Equal rows give equal results; a result
column replaces one of the same name; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

WORD_CACHE = 100_000  # recent words whose ids a Python worker remembers, besides as many or more from before them
PAIR_CACHE = 2_000_000  # judged pairs a Python worker remembers; it starts anew when full
ROWS_PER_PIECE = 256  # texts encoded or decoded at a time, so that results stay small
WORDS_PER_STEP = 4096  # words merged at a time
LEARN = 16_384  # words learnt at a time
# White space and the word pattern of the tokenizer file.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"
END = "</w>"
SHORT, NONE = 24, (1 << 40, -1)  # symbols up to which words are scanned, many at a time, and longer ones go to a heap; the rank of no merge


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else the next from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A tokenizer file of kind BPE with ``</w>`` word ends and byte letters."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[left], self.vocab[right]] = (rank, self.vocab[left + right])
        self.tokens = token_texts(spec)
        # The merges by the code of their pair, for many lookups at once; the last row stands for no merge.
        merges = sorted((left << 20 | right, rank, new) for (left, right), (rank, new) in self.merges.items())
        self.pair_codes, self.pair_ranks, self.pair_makes = np.array([*merges, (np.iinfo(np.int64).max, NONE[0], -1)], dtype=np.int64).T.copy()
        self.letters = byte_letters()
        # Beginnings of tokens are numbered; a number and the next byte give the next number. Word ends are
        # kept out of the bytes that greedy matching cuts from a word.
        byte = {letter: b for b, letter in enumerate(self.letters)}
        step: dict[int, int] = {}
        inner, final = [-1], [-1]
        for token, i in self.vocab.items():
            ends = token.endswith(END) and token != END
            at = 0
            for c in token[:-len(END)] if ends else token:
                if (key := at << 8 | byte[c]) not in step:
                    step[key] = len(inner)
                    inner.append(-1)
                    final.append(-1)
                at = step[key]
            (final if ends else inner)[at] = i
        self.inner, self.final = np.array(inner, dtype=np.int32), np.array(final, dtype=np.int32)
        self.step_codes, self.step_to = np.array([*sorted(step.items()), (np.iinfo(np.int64).max, 0)], dtype=np.int64).T.copy()
        self.first = np.array([step[b] for b in range(256)], dtype=np.int64)
        self.second = np.array([step.get(a << 8 | b, 0) for a in self.first.tolist() for b in range(256)], dtype=np.int64)
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pieces = regex.compile(PIECES)
        self.split_space, self.odd_space = re.compile(f"[{SPACE}]+"), re.compile("[\x1c-\x1f]")  # str.split takes these for space
        self.known = np.empty(0, dtype=np.int64)  # sorted codes of judged pairs
        self.fits = np.empty(0, dtype=bool)
        self.stable: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # ---- one word ----

    def symbols(self, word: str) -> list[int]:
        raw = np.frombuffer(word.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        return self.spell(raw, np.array([len(raw)])).tolist()

    def merge(self, ids: list[int]) -> list[int]:
        """Exact merging: lowest rank first, leftmost among equals."""
        n, merges = len(ids), self.merges
        ids = list(ids)
        if n <= SHORT:
            while n > 1:
                ranks = [merges.get(p, NONE) for p in zip(ids, ids[1:])]
                best = min(ranks)
                if best is NONE:
                    break
                i = ranks.index(best)
                ids[i:i + 2] = [best[1]]
                n -= 1
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, new, i, (left, right) = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != left or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (pair := (new, ids[k])) in merges:
                    heapq.heappush(heap, (*merges[pair], i, pair))
            if (h := before[i]) >= 0 and (pair := (ids[h], new)) in merges:
                heapq.heappush(heap, (*merges[pair], h, pair))
        return [t for t in ids if t >= 0]

    def spelled(self, token: int) -> list[int]:
        text = self.tokens[token]
        if text.endswith(END) and text != END:
            text = text[:-len(END)]
            return [self.vocab[c] for c in text[:-1]] + [self.vocab[text[-1] + END]]
        return [self.vocab[c] for c in text]

    # ---- many words ----

    def spell(self, raw: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """One symbol for each byte of words that lie side by side and end before ``stops``."""
        ids = self.inner[self.first[raw]]
        ids[stops - 1] = self.final[self.first[raw[stops - 1]]]
        return ids

    def longest(self, raw: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each byte on the longest token within its word, which ends before ``stop``, and where it ends."""
        end = np.arange(1, len(raw) + 1)
        node = self.first[raw]
        token = np.where(end == stop, self.final[node], self.inner[node])
        at = np.flatnonzero(end < stop)
        node, i = self.second[raw[at].astype(np.int64) << 8 | raw[at + 1]], at + 2
        hit = node > 0
        while True:
            at, node, i = at[hit], node[hit], i[hit]
            if not len(at):
                return token, end
            over = i == stop[at]
            found = np.where(over, self.final[node], self.inner[node])
            good = found >= 0
            token[at[good]], end[at[good]] = found[good], i[good]
            at, node, i = at[~over], node[~over], i[~over]
            codes = node << 8 | raw[i]
            rows = np.searchsorted(self.step_codes, codes)
            hit, node, i = self.step_codes[rows] == codes, self.step_to[rows], i + 1

    def propose(self, raw: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest match from the left, for words that lie side by side: all tokens, and the tokens of each word."""
        sizes = np.diff(stops, prepend=0)
        stop = np.repeat(stops, sizes)
        token, end = self.longest(raw, stop)
        starts = stops - sizes
        taken, at = np.zeros(len(raw), dtype=bool), starts
        while len(at):
            taken[at] = True
            after = end[at]
            at = after[after < stop[at]]
        return token[taken], np.add.reduceat(taken, starts, dtype=np.int64)

    def pair_rows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair its row in the table of merges, by code; the last one if there is no merge."""
        codes = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.pair_codes, codes)
        return np.where(self.pair_codes[at] == codes, at, len(self.pair_codes) - 1)

    def merge_all(self, flat: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Exact merging of many words that lie side by side, ids as bytes."""
        out, starts = [b""] * len(sizes), np.cumsum(sizes) - sizes
        for i in np.flatnonzero(sizes > SHORT).tolist():
            out[i] = np.array(self.merge(flat[starts[i]:starts[i] + sizes[i]].tolist()), dtype=np.int32).tobytes()
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] <= SHORT]
        for start in range(0, len(order), WORDS_PER_STEP):
            owner = order[start:start + WORDS_PER_STEP]
            cells = np.arange(sizes[owner].max() + 1)
            spots = np.minimum(starts[owner][:, None] + cells, len(flat) - 1)
            self.merge_alike(np.where(cells < sizes[owner][:, None], flat[spots], np.int32(-1)), owner, out)
        return out

    def merge_alike(self, ids: np.ndarray, owner: np.ndarray, out: list[bytes]) -> None:
        """Merges words of few, similar numbers of symbols: a row each, -1 behind its end."""
        cells = np.arange(ids.shape[1])
        none = len(self.pair_codes) - 1
        ranks = self.pair_ranks[self.pair_rows(ids[:, :-1], ids[:, 1:])]
        while len(owner):
            at = ranks.argmin(1)  # the leftmost among equals
            line = np.arange(len(owner))
            found = self.pair_rows(ids[line, at], ids[line, at + 1])
            live = found != none
            if not live.all():
                done = ids[~live]
                ends = np.cumsum((done >= 0).sum(1) * 4).tolist()
                flat = done[done >= 0].tobytes()
                for i, a, b in zip(owner[~live].tolist(), [0, *ends], ends):
                    out[i] = flat[a:b]
                owner, ids, ranks, at, found = owner[live], ids[live], ranks[live], at[live], found[live]
                if not len(owner):
                    break
                line = line[:len(owner)]
            stay = cells[:ids.shape[1] - 1] <= at[:, None]  # what follows the pair moves up
            ids = np.where(stay, ids[:, :-1], ids[:, 1:])
            ids[line, at] = self.pair_makes[found]
            ranks = np.where(stay[:, :-1], ranks[:, :-1], ranks[:, 1:])
            ranks[line, at] = self.pair_ranks[self.pair_rows(ids[line, at], ids[line, at + 1])]
            line, at = line[at > 0], at[at > 0]
            ranks[line, at - 1] = self.pair_ranks[self.pair_rows(ids[line, at - 1], ids[line, at])]

    def judge_tokens(self, tokens: list[int]) -> None:
        """Whether each token's letters merge to it, into ``stable``."""
        fresh = list(set(tokens) - self.stable.keys())
        for token, ids in zip(fresh, self.merge_all(*side_by_side(map(self.spelled, fresh)))):
            self.stable[token] = ids == np.int32(token).tobytes()

    def pairs_fit(self, codes: np.ndarray) -> np.ndarray:
        """For each pair code whether its two tokens stand side by side after merging."""
        distinct, back = np.unique(codes, return_inverse=True)
        if len(self.known) > PAIR_CACHE:
            self.known, self.fits = self.known[:0], self.fits[:0]
        at = np.searchsorted(self.known, distinct)
        there = at < len(self.known)
        there[there] = self.known[at[there]] == distinct[there]
        fresh = distinct[~there]
        if len(fresh):
            pairs = list(zip((fresh >> 20).tolist(), (fresh & 0xFFFFF).tolist()))
            self.judge_tokens([t for pair in pairs for t in pair])
            both = np.stack([fresh >> 20, fresh & 0xFFFFF], axis=1).astype(np.int32).tobytes()
            merged = self.merge_all(*side_by_side(self.spelled(a) + self.spelled(b) for a, b in pairs))
            judged = np.array([merged[i] == both[8 * i:8 * i + 8] and self.stable[a] and self.stable[b] for i, (a, b) in enumerate(pairs)], dtype=bool)
            known = np.concatenate([self.known, fresh])
            order = np.argsort(known, kind="stable")
            self.known, self.fits = known[order], np.concatenate([self.fits, judged])[order]
            at = np.searchsorted(self.known, distinct)
        return self.fits[at][back]

    def learn(self, words: list[str]) -> None:
        """Ids of distinct words, into the cache."""
        letters = [w.encode("utf-8", "surrogatepass") for w in words]
        raw, stops = np.frombuffer(b"".join(letters), dtype=np.uint8), np.cumsum(list(map(len, letters)))
        flat, sizes = self.propose(raw, stops)
        owner = np.repeat(np.arange(len(words)), sizes)
        inside = owner[1:] == owner[:-1]
        codes = (flat[:-1].astype(np.int64) << 20 | flat[1:])[inside]
        wrong = np.zeros(len(words), dtype=bool)
        if len(codes):
            wrong[owner[1:][inside][~self.pairs_fit(codes)]] = True
        alone, single = np.flatnonzero(sizes == 1), flat[(np.cumsum(sizes) - sizes)[sizes == 1]].tolist()
        self.judge_tokens(single)
        wrong[alone] = [not self.stable[t] for t in single]
        ids, ends, cache = flat.tobytes(), np.cumsum(sizes * 4).tolist(), self.words
        for word, a, b in zip(words, [0, *ends], ends):
            cache[word] = ids[a:b]
        again, lengths = np.flatnonzero(wrong), np.diff(stops, prepend=0)
        merged = self.merge_all(self.spell(raw, stops)[np.repeat(wrong, lengths)], lengths[wrong])
        cache.update(zip(map(words.__getitem__, again.tolist()), merged))

    def chunks(self, text: str) -> list[str]:
        """A text after normalisation, cut at white space, over which no word reaches."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma
        text = text.lower()
        return self.split_space.split(text) if self.odd_space.search(text) else text.split()

    def unknown(self, words: set[str]) -> set[str]:
        """Words that are not in the cache; those that had dropped out of it come back."""
        words, older = words.difference(self.words), self.older
        back = {w: older[w] for w in words if w in older}
        self.words.update(back)
        return words.difference(back)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        parts = []  # for each text, lists of chunks and ids of special tokens
        for text in texts:
            if not text:
                parts.append([])
            elif self.split is not None and self.split.search(text):
                parts.append([self.special[s] if k % 2 else self.chunks(s) for k, s in enumerate(self.split.split(text))])
            else:
                parts.append([self.chunks(text)])
        if len(self.words) > WORD_CACHE:
            self.words, self.older = {}, self.words
        cache = self.words
        fresh = self.unknown(set().union(*(chunks for part in parts for chunks in part if isinstance(chunks, list))))
        if fresh:
            cut = {chunk: [chunk] if chunk.isascii() and chunk.isalpha() else self.pieces.findall(chunk) for chunk in fresh}
            words = list(self.unknown({w for words in cut.values() for w in words}))
            for start in range(0, len(words), LEARN):
                self.learn(words[start:start + LEARN])
            for chunk, words in cut.items():
                if len(words) != 1:
                    cache[chunk] = b"".join(map(cache.__getitem__, words))
        get = cache.__getitem__
        return [b"".join(np.int32(p).tobytes() if isinstance(p, int) else b"".join(map(get, p)) for p in part) for part in parts]


def side_by_side(words: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words, and how many each has."""
    words = list(words)
    return np.array([t for w in words for t in w], dtype=np.int32), np.array(list(map(len, words)), dtype=np.int64)


def token_texts(spec: dict) -> list[str]:
    """The tokens of a tokenizer file by id, special ones included."""
    ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (1 + max(ids.values()))
    for token, i in ids.items():
        tokens[i] = token
    return tokens


@lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    return WordBpe(path)


@lru_cache(maxsize=4)
def load_tokens(path: str) -> pa.Array:
    with open(path, encoding="utf-8") as file:
        return pa.array(token_texts(json.load(file)))


def encoded(text: Column | str, path: str) -> Column:
    """``array<int>``: ids of a text by the tokenizer file at ``path`` (on every executor)."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for batch in batches:
            for start in range(0, len(batch), ROWS_PER_PIECE):  # a batch's ids are never held as a whole
                rows = bpe.encode(batch.slice(start, ROWS_PER_PIECE).to_pylist())
                ends = np.cumsum(np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)) // 4)
                yield pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(np.frombuffer(b"".join(rows), dtype=np.int32)))

    return F.arrow_udf(run, "array<int>", F.ArrowUDFType.SCALAR_ITER)(text)


def decoded(ids: Column | str, path: str) -> Column:
    """Text of an id array: its tokens, special ones included; the file names no decoder, so a space stands between.
    Null and empty arrays give the empty string."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = load_tokens(path)
        for batch in batches:
            for start in range(0, len(batch), ROWS_PER_PIECE):  # nor are its tokens
                rows = batch.slice(start, ROWS_PER_PIECE)
                first, last = rows.offsets[0].as_py(), rows.offsets[-1].as_py()
                spelled = tokens.take(rows.values.slice(first, last - first))
                joined = pc.binary_join(pa.ListArray.from_arrays(pc.subtract(rows.offsets, rows.offsets[0]), spelled), " ")
                yield pc.if_else(rows.is_valid(), joined, "")

    return F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR_ITER)(ids)


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts."""
    return docs.withColumn(ids_col, encoded(F.coalesce(F.col(text_col), F.lit("")), path))


def decode(docs: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the texts of its ids."""
    return docs.withColumn(text_col, decoded(F.col(ids_col), path))
