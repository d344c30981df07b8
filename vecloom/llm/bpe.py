"""Operator 1: BPE encoding and decoding by forced-boundary splitting (see encoder.py).

Narrow: no shuffle, one Arrow pass. A null text is the empty text, which has no ids and
decodes to the empty text; null ids decode to the empty text. Texts of any length are
taken whole. Repeated rows are kept; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.encoder import tokenizer_file, worker_encoder


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int32)))


def _texts(encoder, arrays) -> pa.Array:
    return pa.array([encoder.decode_bytes(ids).tobytes().decode("utf-8", "replace") for ids in arrays], pa.string())


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df and the ids of its texts, as the tokenizers library gives them."""
    spec = tokenizer_file(tokenizer)

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return _lists(list(worker_encoder(spec).encode_column(texts)))

    return df.withColumn(ids, encoded(F.col(text)))


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df and the texts of its ids; bytes that are no UTF-8 become U+FFFD."""
    spec = tokenizer_file(tokenizer)

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        arrays = [np.array(x if x is not None else [], np.int64) for x in lists.to_pylist()]
        return _texts(worker_encoder(spec), arrays)

    return df.withColumn(text, decoded(F.col(ids)))


def round_trip(tokenizer: str) -> Callable[[Column], Column]:
    """A column function text -> (ids, decoded): both directions in one pass."""
    spec = tokenizer_file(tokenizer)

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        encoder = worker_encoder(spec)
        arrays = list(encoder.encode_column(texts))
        return pa.StructArray.from_arrays([_lists(arrays), _texts(encoder, arrays)], ["ids", "decoded"])

    def column(text: Column) -> Column:
        return both(text)

    return column
