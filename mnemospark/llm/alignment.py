"""Alignment of the tokens of two tokenizers, and how many documents link two token ids.

Both tokenizers encode the whole text. Byte offsets at which a token of each ends are shared ends; they cut the tokens
into groups, and the tokens of a group are linked. Shared ends before tokens that both begin with a space split the text
into windows of token ids. Equal windows align alike, so a block remembers them by their ids and aligns each once.

Texts are worked through in blocks of about ``BLOCK_BYTES``. A block keeps each distinct window once and each text as a
row of window numbers; the number of documents that link a pair of ids is summed inside the block before it is shuffled,
and comes back to the block once per pair. A very long text is a block of its own.

Null and empty texts, and texts whose tokens do not spell the text, have no tokens: their numbers are 0 and ``groups`` is
empty. Every row is a document of its own, also if ids are repeated; an empty table gives an empty one. Only the columns
of ``carry`` go along, under their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from mnemospark.llm.bpe import byte_letters
from mnemospark.llm.staging import stage

BLOCK_BYTES = 5_000_000  # of text, after which a block ends
PIECE_CHARS = 250_000  # of text, encoded at a time
WINDOWS_AT_ONCE, CELLS_AT_ONCE = 150_000, 16_000_000  # windows, and documents times pairs, that are counted at a time
LONG_TEXT = 100_000  # letters from which a text goes to the slower library, which bears any run of white space
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
# Fixed value: how the byte-letter tokenizer cuts texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokens:
    """What the alignment needs to know about the ids of a tokenizer."""

    def __init__(self, spelled: list[bytes]):
        self.sizes = np.array(list(map(len, spelled)), np.int64)
        self.spaced = np.array([s[:1] == b" " for s in spelled], bool)
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)
        self.places = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of tokens side by side."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.letters[np.repeat(self.places[ids] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]


class BytePair(Tokens):
    """A tokenizer file with byte letters; a space is put before the text.

    Two libraries that give the same ids share the work: the ranks of the file's tokens are handed to the faster one.
    """

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        spelled = [b""] * (1 + max(vocabulary.values()))
        ranks = {}
        for token, i in vocabulary.items():
            spelled[i] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            ranks[spelled[i]] = i
        for token in self.tokenizer.get_added_tokens_decoder().values():
            ranks.pop(token.content.encode(), None)
        self.fast = Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        super().__init__(spelled)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        nothing = frozenset()
        ids = [self.fast.encode_to_numpy(" " + t, allowed_special=nothing, disallowed_special=nothing) if len(t) < LONG_TEXT
               else np.array(self.tokenizer.encode(" " + t, add_special_tokens=False).ids, np.uint32) for t in texts]
        return np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int32), np.fromiter(map(len, ids), np.int64, len(ids))


class Pieces(Tokens):
    """A model of pieces with byte fallback; it puts the space before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        piece = self.model.id_to_piece
        super().__init__([bytes([int(piece(i)[3:-1], 16)]) if self.model.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self.model.get_piece_size())])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.model.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes


def totals(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.cumsum(sizes)], prepend=0)


class Aligner:
    def __init__(self, a: Tokens, b: Tokens):
        self.a, self.b = a, b
        most = max(len(a.sizes), len(b.sizes))
        #: How ids are packed in a window's key; the largest value is no id and stands between the two sides.
        self.kind = np.dtype("<u2" if most < 1 << 16 else "<u4")
        self.cut = b"\xff" * self.kind.itemsize
        names = list(map(str, range(most)))
        self.names = [n + mark for n in names for mark in ",|;"]
        self.name_sizes = np.array(list(map(len, self.names)), np.int64)

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both and the number of ids of each text, without those that do not spell the text."""
        given = [t or "" for t in texts]
        live = np.fromiter(map(bool, given), bool, len(given))
        raw = [b" " + t.encode() for t in given]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        sides = [side.encode(given) for side in (self.a, self.b)]
        good = live.copy()
        for side, (ids, sizes) in zip((self.a, self.b), sides):
            good &= totals(side.sizes[ids], sizes) == length
        want = np.frombuffer(b"".join([r for r, ok in zip(raw, good) if ok]), np.uint8)
        ends, wrong = np.cumsum(length[good]), np.zeros(int(good.sum()), bool)
        for side, (ids, sizes) in zip((self.a, self.b), sides):
            off = np.flatnonzero(side.decode(ids[np.repeat(good, sizes)]) != want)
            wrong[np.searchsorted(ends, off, "right")] = True
        good[good] = ~wrong
        (a, n_a), (b, n_b) = sides
        return a[np.repeat(good, n_a)], np.where(good, n_a, 0), b[np.repeat(good, n_b)], np.where(good, n_b, 0)

    def shared(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens of both end at a shared end; both spell the same bytes."""
        end_a, end_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        there = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, bool)
        there[end_a] = True
        shared_b = np.flatnonzero(there[end_b])
        there[:] = False
        there[end_b] = True
        return np.flatnonzero(there[end_a]), shared_b

    def links(self, a: np.ndarray, size_a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all links of some windows, and how many each window has."""
        shared_a, shared_b = self.shared(a, b)
        p, q = np.diff(shared_a, prepend=-1), np.diff(shared_b, prepend=-1)
        partners = np.repeat(q, p)  # of each token of a
        firsts = np.repeat(shared_b + 1 - q, p)
        number = int(partners.sum())
        right = np.repeat(firsts - (np.cumsum(partners) - partners), partners) + np.arange(number)
        codes = np.repeat(a.astype(np.int64), partners) << 32 | b[right]
        return codes, totals(partners, size_a)

    def spell(self, a: np.ndarray, size_a: np.ndarray, b: np.ndarray) -> list[str]:
        """Groups of each window as ``a1,a2|b1;``."""
        shared_a, shared_b = self.shared(a, b)
        p, q = np.diff(shared_a, prepend=-1), np.diff(shared_b, prepend=-1)
        place_a = np.arange(len(a)) + np.repeat(np.cumsum(q) - q, p)
        place_b = np.arange(len(b)) + np.repeat(np.cumsum(p), q)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[shared_a], mark_b[shared_b] = 1, 2
        order = np.empty(len(a) + len(b), np.int64)
        order[place_a], order[place_b] = 3 * a.astype(np.int64) + mark_a, 3 * b.astype(np.int64) + mark_b
        whole = "".join(map(self.names.__getitem__, order.tolist()))
        # The last token of b of a window stands where the window's text ends.
        last_a = np.cumsum(size_a) - 1
        group = np.searchsorted(shared_a, last_a)
        ends = np.cumsum(self.name_sizes[order])[place_b[shared_b[group]]].tolist() if len(a) else []
        return [whole[i:j] for i, j in zip([0, *ends], ends)]


class Block:
    """Texts of a block as rows of windows."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.windows: dict[bytes, int] = {}  # ids of a window to its number in the block
        self.size_a: list[int] = []
        self.rows: list[np.ndarray] = []  # windows of the texts, one array per piece
        self.sizes: list[np.ndarray] = []  # number of windows of each text
        self.counts: list[np.ndarray] = []  # COUNTS of each text

    def add(self, texts: list[str | None]) -> None:
        a, n_a, b, n_b = self.aligner.tokens(texts)
        shared_a, shared_b = self.aligner.shared(a, b)
        # Every text begins with a space, so that its end is an anchor as well.
        opens_a, opens_b = np.append(self.aligner.a.spaced[a[1:]], True), np.append(self.aligner.b.spaced[b[1:]], True)
        anchor = opens_a[shared_a] & opens_b[shared_b]
        cut_a, cut_b = shared_a[anchor] + 1, shared_b[anchor] + 1
        links = np.cumsum(np.concatenate([[0], np.diff(shared_a, prepend=-1) * np.diff(shared_b, prepend=-1)]))
        last_a = np.cumsum(n_a)
        groups = np.searchsorted(shared_a, last_a)  # groups up to the end of each text
        self.counts.append(np.stack([n_a, n_b, np.diff(groups, prepend=0), np.diff(links[groups], prepend=0)], axis=1))
        self.sizes.append(np.diff(np.searchsorted(cut_a, last_a, "right"), prepend=0))
        self.rows.append(self.number(a, b, cut_a, cut_b))

    def number(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
        """Numbers of the windows that end at the cuts; new ones are remembered by their ids."""
        kind, cut, known = self.aligner.kind, self.aligner.cut, self.windows
        raw_a, raw_b = a.astype(kind).tobytes(), b.astype(kind).tobytes()
        ends_a, ends_b = (kind.itemsize * cut_a).tolist(), (kind.itemsize * cut_b).tolist()
        keys = [raw_a[i:j] + cut + raw_b[k:m] for i, j, k, m in zip([0, *ends_a], ends_a, [0, *ends_b], ends_b)]
        found = list(map(known.get, keys))
        if None in found:
            sizes = np.diff(cut_a, prepend=0).tolist()
            for at, n in enumerate(found):
                if n is None:
                    n = found[at] = known.setdefault(keys[at], len(known))
                    if n == len(self.size_a):
                        self.size_a.append(sizes[at])
        return np.array(found, np.int32)

    def finish(self) -> dict:
        """The distinct windows, their pairs of ids, and in how many documents each pair is linked."""
        unit = self.aligner.kind.itemsize
        raw_a = b"".join([k[:unit * n] for k, n in zip(self.windows, self.size_a)])
        raw_b = b"".join([k[unit * n + unit:] for k, n in zip(self.windows, self.size_a)])
        size_a = np.array(self.size_a, np.int64)
        links, held = self.aligner.links(np.frombuffer(raw_a, self.aligner.kind), size_a, np.frombuffer(raw_b, self.aligner.kind))
        codes, pair = np.unique(links, return_inverse=True)
        firsts = np.cumsum(held) - held
        row, sizes = np.concatenate(self.rows), np.concatenate(self.sizes)
        documents = np.zeros(len(codes), np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):  # whole documents at a time
            done = int(ends[start - 1]) if start else 0
            most = max(1, CELLS_AT_ONCE // max(1, len(codes)))
            stop = min(start + most, max(start + 1, int(np.searchsorted(ends, done + WINDOWS_AT_ONCE, "right"))))
            window = row[done:int(ends[stop - 1])]
            times = held[window]
            at = np.repeat(firsts[window] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
            linked = np.zeros((stop - start, len(codes)), bool)
            linked[np.repeat(np.repeat(np.arange(stop - start), sizes[start:stop]), times), pair[at]] = True
            documents += linked.sum(axis=0)
            start = stop
        return {"row": row, "sizes": sizes, "counts": np.concatenate(self.counts), "a": raw_a, "b": raw_b, "size_a": size_a, "codes": codes, "documents": documents}


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Aligner:
    return Aligner(BytePair(path_a), Pieces(path_b))


def _lists(values, sizes, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def blocks(docs: DataFrame, path_a: str, path_b: str, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Texts in blocks: a row per document with its windows, and a row per block with what they are.

    The tokenizer files are at these paths on every executor.
    """
    own = docs.select(*carry, F.col(text).cast("string").alias("_text"))
    extra = [("_block", LongType()), *[(c, LongType()) for c in COUNTS], ("_windows", ArrayType(IntegerType())), ("_a", BinaryType()), ("_b", BinaryType()),
             ("_size_a", ArrayType(IntegerType())), ("_codes", ArrayType(LongType())), ("_documents", ArrayType(LongType()))]
    schema = StructType([*own.schema.fields[:-1], *[StructField(*f) for f in extra]])
    names = schema.names
    lists = {"_size_a": pa.int32(), "_codes": pa.int64(), "_documents": pa.int64()}

    def out(block: Block, carried: list[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
        got = block.finish()
        rows, at, done = pa.Table.from_batches(carried), 0, 0
        while at < rows.num_rows:
            n = min(1000, rows.num_rows - at)
            sizes = got["sizes"][at:at + n]
            total = int(sizes.sum())
            yield pa.record_batch([*(pa.concat_arrays(c.chunks) for c in rows.slice(at, n).columns), pa.array(np.full(n, number, np.int64)),
                                   *(pa.array(got["counts"][at:at + n, i]) for i in range(4)), _lists(got["row"][done:done + total], sizes, pa.int32()),
                                   *[pa.nulls(n, pa.binary())] * 2, *(pa.nulls(n, pa.list_(k)) for k in lists.values())], names)
            at, done = at + n, done + total
        yield pa.record_batch([*(pa.nulls(1, f.type) for f in rows.schema), pa.array([number]), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.list_(pa.int32())),
                               pa.array([got["a"]], pa.binary()), pa.array([got["b"]], pa.binary()), *(_lists(got[c[1:]], [len(got[c[1:]])], k) for c, k in lists.items())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        block, carried, size = Block(aligner), [], 0
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            lengths = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            start = 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and chars < PIECE_CHARS:
                    chars += lengths[stop]
                    stop += 1
                block.add(texts.slice(start, stop - start).to_pylist())
                carried.append(pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).slice(start, stop - start))
                size += chars
                start = stop
                if size >= BLOCK_BYTES:
                    yield from out(block, carried, number)
                    block, carried, size, number = Block(aligner), [], 0, number + 1
        if carried:
            yield from out(block, carried, number)

    return stage(own.mapInArrow(run, schema), "aligned")


def link_counts(aligned: DataFrame) -> DataFrame:
    """``(code, a_id, b_id, documents, best)`` over all blocks; ``best`` marks the most frequent partners of an ``a_id``."""
    each = aligned.where("_codes IS NOT NULL").select(F.explode(F.arrays_zip("_codes", "_documents")).alias("p"))
    counts = each.groupBy(F.col("p._codes").alias("code")).agg(F.sum("p._documents").alias("documents")).withColumn("a_id", F.shiftright("code", 32).cast("int"))
    # One row per token id of a vocabulary, whatever the corpus.
    most = F.broadcast(counts.groupBy("a_id").agg(F.max("documents").alias("most")))
    return counts.join(most, "a_id").select("code", "a_id", F.col("code").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"), "documents", (F.col("documents") == F.col("most")).alias("best"))


def documents(aligned: DataFrame, counts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The carried columns, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups`` of each document.

    ``groups`` spells the alignment as ``a1,a2|b1;a3|b2,b3``.
    """
    carry = aligned.columns[:aligned.columns.index("_block")]
    out = StructType([*aligned.schema.fields[:len(carry)], *[StructField(c, LongType()) for c in (*COUNTS, "n_best", "count_sum")], StructField("groups", StringType())])
    asked = aligned.where("_codes IS NOT NULL").select(F.col("_block").alias("_of"), F.explode("_codes").alias("code")).join(counts.select("code", "documents", "best"), "code")

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        aligner = load(path_a, path_b)
        what = block.column("_a").is_valid()
        told_of = {c: block.column(c).filter(what)[0] for c in ("_a", "_b", "_size_a", "_codes")}
        a, b = (np.frombuffer(told_of[c].as_py(), aligner.kind) for c in ("_a", "_b"))
        size_a, codes = (told_of[c].values.to_numpy(zero_copy_only=False) for c in ("_size_a", "_codes"))
        at = np.searchsorted(codes, told.column("code").to_numpy())
        n, best = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        n[at], best[at] = told.column("documents").to_numpy(), told.column("best").to_numpy()
        links, held = aligner.links(a, size_a, b)
        pair = np.searchsorted(codes, links)
        rows = block.filter(pc.invert(what))
        windows = rows.column("_windows").combine_chunks()
        row, sizes = windows.flatten().to_numpy(zero_copy_only=False), windows.value_lengths().to_numpy(zero_copy_only=False)
        sums = [totals(totals(value[pair], held)[row], sizes) for value in (best, n)]
        spelled, start, text = [], 0, aligner.spell(a, size_a, b).__getitem__
        for end in np.cumsum(sizes, dtype=np.int64).tolist():
            spelled.append("".join(map(text, row[start:end].tolist()))[:-1])
            start = end
        columns = [*(rows.column(c) for c in (*carry, *COUNTS)), *map(pa.array, sums), pa.array(spelled, pa.string())]
        return pa.Table.from_arrays(columns, names=out.names)

    return aligned.groupBy("_block").cogroup(asked.groupBy("_of")).applyInArrow(run, out)


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Alignment of all texts, with corpus-wide counts of links."""
    aligned = blocks(docs, path_a, path_b, text, carry)
    return documents(aligned, link_counts(aligned), path_a, path_b)
