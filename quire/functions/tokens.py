"""Token counters: a function from a text column to a count."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.whitespace import count_ws_tokens

TokenCounter = Callable[[Column], Column]


def words(c: Column) -> Column:
    """Runs without white space; JVM only, null counts 0."""
    return F.coalesce(count_ws_tokens(c), F.lit(0))


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer of a rank file, once per worker."""
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe(path: str) -> TokenCounter:
    """Byte pair tokens of a rank file; the encoder is built once per Python worker, null counts 0."""

    @F.pandas_udf("int")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path).encode_ordinary
        for part in parts:
            yield part.map(lambda t: len(encode(t)) if t else 0).astype("int32")

    return count
