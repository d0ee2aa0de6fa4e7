"""Token counts under a pluggable tokenizer.

``bytes_v1`` (the default) has one token for each UTF-8 byte, so counts are ``octet_length`` and stay in the JVM. Any
vocabulary of byte pairs as ranks (one file, base64 and rank on a line) is counted in Arrow batches.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The published pre-tokenisation pattern of the byte-pair vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer of a vocabulary file, once a worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(c: Column, vocabulary: str | None = None) -> Column:
    """Tokens of a text; null stays null. ``vocabulary`` is a path that every executor has; without one bytes are counted."""
    if vocabulary is None:
        return F.octet_length(c).cast("long")

    @F.pandas_udf(T.LongType())
    def run(s: pd.Series) -> pd.Series:
        known = encoding(vocabulary)
        counts = iter(map(len, known.encode_ordinary_batch([t for t in s if t is not None], num_threads=1)))
        return pd.Series([None if t is None else next(counts) for t in s], dtype="Int64")

    return run(c)


def token_report(pre: Column, post: Column) -> Column:
    """struct(delta, pct) of two counts; pct is 0 without a count before."""
    return F.struct((post - pre).alias("delta"), F.when(pre == 0, 0.0).otherwise(100.0 * (post - pre) / pre).alias("pct"))
