"""Batch embedding with a user model, and an offline default that any engine can recompute."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from mnemospark.functions.text import tokens

RETRY_SECONDS = (1, 2, 4, 8, 16)  # fixed waits after a rate limit
Embedder = Callable[[list[str]], Sequence[Sequence[float]]]


class RateLimited(Exception):
    """Raised by an embedder to ask for a later retry."""


class QuotaExhausted(Exception):
    """Raised by an embedder when retrying cannot help."""


def with_retry(embedder: Embedder, texts: list[str], sleep: Callable[[float], None] = time.sleep):
    for wait in RETRY_SECONDS:
        try:
            return embedder(texts)
        except RateLimited:
            sleep(wait)
    return embedder(texts)


def _features(words: pa.Array, dims: int) -> np.ndarray:
    """Feature number of each word: the first 8 hex digits of its MD5, modulo ``dims``.

    Each distinct word of the batch is hashed once.
    """
    coded = words.dictionary_encode()
    known = np.array([int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dims
                      for w in coded.dictionary.to_pylist()], dtype=np.int64)
    return known[coded.indices.to_numpy(zero_copy_only=False)]


def hashed_embedding(text: Column | str, dims: int = 64) -> Column:
    """Token counts hashed to ``dims`` features, at unit length; empty text is the zero vector.

    Text is cut into tokens in the JVM; one ``bincount`` per Arrow batch makes the vectors.
    """
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for toks in batches:
            n = len(toks)
            rows = np.repeat(np.arange(n), np.diff(toks.offsets.to_numpy()))
            flat = _features(toks.flatten(), dims)
            m = np.bincount(rows * dims + flat, minlength=n * dims).reshape(n, dims).astype(np.float64)
            length = np.linalg.norm(m, axis=1, keepdims=True)
            m = np.divide(m, length, out=m, where=length > 0)
            yield pa.ListArray.from_arrays(np.arange(0, n * dims + 1, dims, dtype=np.int32),
                                           pa.array(m.ravel(), pa.float64()))

    counts.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(counts, "array<double>")(F.coalesce(tokens(text), F.array().cast("array<string>")))


def embed(df: DataFrame, text_col: str, embedder: Embedder | None = None, dims: int = 64, *,
          output: str = "embedding", batch: int = 100, error: str | None = None) -> DataFrame:
    """Add an embedding column; a wrong width raises.

    ``embedder(list of texts)`` is called with at most ``batch`` texts. A rate limit is retried
    with growing waits; an exhausted quota fails at once. With ``error``, a text that the embedder cannot
    take gets a null vector and the message in that column, and the others of its batch are embedded without it.
    """
    if embedder is None:
        made = df.withColumn(output, hashed_embedding(text_col, dims))
        return made if error is None else made.withColumn(error, F.lit(None).cast("string"))

    def checked(texts: list[str]) -> list[list[float]]:
        out = [[float(x) for x in v] for v in with_retry(embedder, texts)]
        if len(out) != len(texts) or any(len(v) != dims for v in out):
            raise ValueError(f"the embedder must return {dims} numbers for each text")
        return out

    def isolated(texts: list[str]) -> Iterator[tuple[list[float] | None, str | None]]:
        try:
            yield from ((v, None) for v in checked(texts))
        except (RateLimited, QuotaExhausted):
            raise
        except Exception as broken:  # whatever the caller's model raises
            if len(texts) == 1:
                yield None, f"{type(broken).__name__}: {broken}"
            else:
                for text in texts:
                    yield from isolated([text])

    kind = pa.list_(pa.float64()) if error is None else pa.struct([("vector", pa.list_(pa.float64())), ("error", pa.string())])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values, out = [v or "" for v in texts.to_pylist()], []
            for lo in range(0, len(values), batch):
                part = values[lo:lo + batch]
                out += checked(part) if error is None else [{"vector": v, "error": e} for v, e in isolated(part)]
            yield pa.array(out, kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    if error is None:
        return df.withColumn(output, arrow_udf(run, "array<double>")(F.col(text_col)))
    made = df.withColumn("_made", arrow_udf(run, "struct<vector:array<double>,error:string>")(F.col(text_col)))
    return made.withColumn(output, F.col("_made.vector")).withColumn(error, F.col("_made.error")).drop("_made")


def add_texts(texts: DataFrame, embedder: Embedder | None = None, dims: int = 64, *,
              text_col: str = "text", id_col: str = "id") -> DataFrame:
    """Rows ready for the vector table: ids filled from the text hash where missing, vectors added."""
    made = F.sha2(F.concat_ws("\u0001", *[F.col(f"`{c}`").cast("string") for c in texts.columns]), 256)
    ident = F.coalesce(F.col(id_col).cast("string"), made) if id_col in texts.columns else made
    return embed(texts.withColumn(id_col, ident), text_col, embedder, dims)
