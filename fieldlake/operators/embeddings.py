"""Text to vector.

Tokens are hashed to signed buckets in the JVM; adding them up per row and scaling to unit
length is array arithmetic on Arrow batches. No shuffle: a text becomes a vector where it is.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.numeric import hex_to_long
from fieldlake.functions.text import tokens

# Fixed value: default width of an embedding.
DIMENSION = 1536
_ROWS_AT_ONCE = 512


def signed_buckets(text: Column, dimension: int) -> Column:
    """One number per token: its bucket, or ``-1 - bucket`` for a negative sign."""

    def placed(token: Column) -> Column:
        number = hex_to_long(F.substring(F.md5(token), 1, 8))
        bucket = number % dimension
        negative = F.floor(number / dimension) % 2 == 1
        return F.when(negative, -1 - bucket).otherwise(bucket).cast("int")

    return F.transform(tokens(text), placed)


def unit_vectors(buckets: list[np.ndarray], dimension: int) -> np.ndarray:
    """Sum of signs per bucket, one row per text, scaled to length 1 (zero if no token)."""
    lengths = np.fromiter((len(b) for b in buckets), dtype=np.int64, count=len(buckets))
    flat = np.concatenate([np.asarray(b, dtype=np.int64) for b in buckets]) if len(buckets) else None
    sums = np.zeros((len(buckets), dimension))
    if flat is not None and flat.size:
        row = np.repeat(np.arange(len(buckets)), lengths)
        slot = row * dimension + np.where(flat < 0, -1 - flat, flat)
        signs = np.where(flat < 0, -1.0, 1.0)
        sums = np.bincount(slot, weights=signs, minlength=sums.size).reshape(sums.shape)
    norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return (sums / np.where(norms == 0, 1.0, norms)).astype(np.float32)


def embed_text(
    df: DataFrame, text: str = "text", dimension: int = DIMENSION, out: str = "embedding"
) -> DataFrame:
    """Add a unit-length hashed bag-of-words vector of a text column."""

    @F.pandas_udf("array<float>")
    def to_vectors(buckets: pd.Series) -> pd.Series:
        vectors: list[np.ndarray] = []
        for start in range(0, len(buckets), _ROWS_AT_ONCE):
            vectors += list(unit_vectors(buckets.iloc[start : start + _ROWS_AT_ONCE].tolist(), dimension))
        return pd.Series(vectors, index=buckets.index)

    known = F.coalesce(F.col(text), F.lit(""))
    return df.withColumn(out, to_vectors(signed_buckets(known, dimension)))


def embed_with(
    df: DataFrame,
    embedder: Callable[[list[str]], np.ndarray],
    text: str = "text",
    out: str = "embedding",
) -> DataFrame:
    """Add vectors of a model: ``embedder`` gets a batch of texts and returns one row each."""

    @F.pandas_udf("array<float>")
    def to_vectors(texts: pd.Series) -> pd.Series:
        vectors = np.asarray(embedder(texts.fillna("").tolist()), dtype=np.float32)
        return pd.Series(list(vectors), index=texts.index)

    return df.withColumn(out, to_vectors(text))
