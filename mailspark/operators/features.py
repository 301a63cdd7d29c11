"""Texts to vectors: tokens, masked mean pooling, subject and body side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from mailspark.functions import text, vectors

# Tokens read of each text.
SUBJECT_TOKENS = 20
BODY_TOKENS = 512
# rows of a batch whose words are counted at a time
ROWS = 256


def masked_mean(
    df: DataFrame, id_col: str, vector_col: str, mask_col: str, dim: int, out_col: str = "pooled"
) -> DataFrame:
    """Mean of the vectors of an id over the rows whose mask is 1.

    One aggregate of whole vectors, with partial sums in the JVM before the shuffle, whatever the
    dimension; so it does not matter how many rows one id has. Masked elements count as 0 in a mean
    over all rows, which is then scaled to the rows of the mask. A missing element is 0.
    """
    mask = F.coalesce(F.col(mask_col).cast("double"), F.lit(0.0))
    places = F.sequence(F.lit(0), F.lit(dim - 1))
    masked = F.transform(
        places,
        lambda i: F.coalesce(F.get(F.col(vector_col), i).cast("double"), F.lit(0.0)) * mask,
    )
    pooled = df.groupBy(id_col).agg(
        Summarizer.mean(array_to_vector(masked)).alias("_mean"),
        F.count(F.lit(1)).alias("_rows"),
        F.greatest(F.sum(mask), F.lit(vectors.MASK_FLOOR)).alias("_weight"),
    )
    scale = F.col("_rows") / F.col("_weight")
    mean = F.transform(vector_to_array("_mean"), lambda x: x * scale)
    return pooled.select(id_col, mean.alias(out_col))


def _mean_of_codes(flat: np.ndarray, offsets: pa.Array, dim: int) -> pa.Array:
    """The mean vector of each row's codes. Codes are in [0, 2 * dim): below dim counts +1, from
    dim on -1."""
    rows, ends = len(offsets) - 1, np.asarray(offsets)
    lengths = np.diff(ends)
    mean = np.empty((rows, dim))
    for top in range(0, rows, ROWS):  # what a batch needs beside its vectors is bounded
        some = lengths[top : top + ROWS]
        n = len(some)
        codes = flat[ends[top] - ends[0] : ends[top + n] - ends[0]]
        cell = np.repeat(np.arange(n), some) * dim + codes % dim
        signs = np.where(codes < dim, 1.0, -1.0)
        total = np.bincount(cell, weights=signs, minlength=n * dim).reshape(n, dim)
        np.divide(total, np.maximum(some, vectors.MASK_FLOOR)[:, None], out=mean[top : top + n])
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(mean.reshape(-1)))


def _pooler(dim: int):
    """Signed bucket codes of each row to their mean vector, a whole Arrow batch at a time."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def pool(codes: pa.Array) -> pa.Array:
        return _mean_of_codes(np.asarray(codes.flatten()), codes.offsets, dim)

    return pool


def _word_pooler(dim: int):
    """The same from the words themselves: each distinct word of a batch is hashed by md5 once."""

    def code(word: bytes) -> int:
        digest = md5(word, usedforsecurity=False).digest()
        # the first 8 and the 16th of the hexadecimal digits
        return int.from_bytes(digest[:4]) % dim + dim * (digest[7] & 1)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def pool(tokens: pa.Array) -> pa.Array:
        words = tokens.flatten().dictionary_encode()
        known = words.dictionary.cast(pa.binary()).to_pylist()
        codes = np.fromiter(map(code, known), dtype=np.int32, count=len(known))
        return _mean_of_codes(codes[np.asarray(words.indices)], tokens.offsets, dim)

    return pool


@dataclass(frozen=True)
class HashingEncoder:
    """Feature hashing of words. md5 is the hash any engine can repeat; xxhash64 is the
    faster one."""

    dim: int = 64
    hash_name: str = "md5"

    @property
    def name(self) -> str:
        return f"hashing-{self.hash_name}"

    def __call__(self, c: Column, limit: int) -> Column:
        tokens = text.tokens(c, limit)
        if self.hash_name == "xxhash64":
            return _pooler(self.dim)(F.transform(
                tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(2 * self.dim)).cast("int")
            ))
        return _word_pooler(self.dim)(tokens)


@dataclass(frozen=True)
class ModelEncoder:
    """A sentence model of one's own, loaded once per Python worker.

    `load()` returns a function from a list of texts and a token limit to a 2-D array.
    """

    name: str
    dim: int
    load: Callable[[], Callable[[list[str], int], np.ndarray]]

    def __call__(self, c: Column, limit: int) -> Column:
        load = self.load

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                vectors_of = model(batch.tolist(), limit) if len(batch) else []
                yield pd.Series([np.asarray(v, dtype=float) for v in vectors_of], dtype=object)

        return encode(c)


def embed(
    df: DataFrame,
    subject: str = "subject",
    body: str = "body",
    encoder=HashingEncoder(),
    out_col: str = "features",
) -> DataFrame:
    """Adds the vector of each message: subject and body halves, each of length one.
    Row-local: nothing is shuffled."""
    return (
        df.withColumn("_subject_mean", encoder(F.col(subject), SUBJECT_TOKENS))
        .withColumn("_body_mean", encoder(F.col(body), BODY_TOKENS))
        .withColumn(
            out_col,
            F.concat(
                vectors.l2_normalise(F.col("_subject_mean")),
                vectors.l2_normalise(F.col("_body_mean")),
            ),
        )
        .drop("_subject_mean", "_body_mean")
    )
