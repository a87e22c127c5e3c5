"""Tokenizing documents with ``bpe.Tokenizer`` on Spark (operator 5)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.bpe import Tokenizer, read_ranks

_TOKENIZERS: dict[tuple[bytes, str], Tokenizer] = {}


def load_ranks(path: str) -> bytes:
    """The rank file, under a megabyte, read by the driver, which sends it to
    the executors: they need no such path."""
    with open(path, "rb") as file:
        return file.read()


def _tokenizer(ranks: bytes, pattern: str) -> Tokenizer:
    """One per worker process and vocabulary."""
    key = (hashlib.sha256(ranks).digest(), pattern)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = Tokenizer(read_ranks(ranks.splitlines()), pattern)
    return _TOKENIZERS[key]


def encode_documents(
    docs: DataFrame, ranks: bytes, pattern: str, text_col: str = "text", out: str = "tokens",
    keep_ids: bool = True, keep_text: bool = True,
) -> DataFrame:
    """``docs`` with a struct column ``out``: ids (array; null without
    ``keep_ids``), n_tokens, ids_sha256 (of the decimal ids joined by blanks),
    decoded (the text the ids decode to; null without ``keep_text``) and
    decoded_sha256. Null texts count as empty. An input column of that name is
    replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = (
        "struct<ids: array<int>, n_tokens: bigint, ids_sha256: string, "
        "decoded: string, decoded_sha256: string>"
    )

    @F.pandas_udf(kind)
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(shared.value, pattern)
        for texts in parts:
            rows = []
            for text in texts:
                ids, n, decoded = tokenizer.encoded(text if isinstance(text, str) else None)
                rows.append(
                    (
                        np.fromstring(ids, np.int32, sep=" ") if keep_ids else None,
                        n,
                        hashlib.sha256(ids.encode()).hexdigest(),
                        decoded.decode("utf-8", "replace") if keep_text else None,
                        hashlib.sha256(decoded).hexdigest(),
                    )
                )
            yield pd.DataFrame(
                rows, columns=["ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"]
            )

    return docs.withColumn(out, encode(F.col(text_col)))
