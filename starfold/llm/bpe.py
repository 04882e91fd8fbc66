"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

``encode`` gives the ids of a text column, ``decode`` the bytes of an id column.
Both are Arrow functions over whole texts: Spark deals out the rows, each Python
worker loads the rank file once.

Defined cases: null text has no ids (null in, null out: coalesce before, if it
should count as empty); the empty text has the empty list; null ids give null bytes;
repeated rows are encoded each; other columns are untouched.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Longest piece handed to the library at once, where a safe boundary exists.
PIECE_CHARS = 1 << 16
#: Between an ASCII letter or digit and a blank or line end no match of the pattern
#: runs on, and no match that starts later looks back, so cutting there changes nothing.
_SAFE = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])")


@lru_cache(maxsize=4)
def _encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, chars: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` cut at safe boundaries; a stretch without one stays whole."""
    start = 0
    while len(text) - start > chars:
        cut = _SAFE.search(text, start + chars)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str, ranks_path: str, pattern: str, chars: int = PIECE_CHARS) -> list[int]:
    encode_piece = _encoding(ranks_path, pattern).encode_ordinary
    if len(text) <= chars:
        return encode_piece(text)
    return [i for piece in pieces(text, chars) for i in encode_piece(piece)]


def encode(text: Column, ranks_path: str, pattern: str) -> Column:
    """Ids (array of int) of each text, special tokens being ordinary text."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        found, ends, absent = [], [0], []
        for text in texts:
            text = text.as_py()
            own = [] if text is None else encode_text(text, ranks_path, pattern)
            found.append(np.array(own, dtype=np.int32))
            ends.append(ends[-1] + len(own))
            absent.append(text is None)
        values = np.concatenate(found) if found else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values), mask=pa.array(absent, pa.bool_()))

    return ids(text)


def decode(ids: Column, ranks_path: str, pattern: str) -> Column:
    """Raw bytes of each id list; they need not be UTF-8 when a list was cut."""

    @F.arrow_udf("binary")
    def raw(lists: pa.Array) -> pa.Array:
        to_bytes = _encoding(ranks_path, pattern).decode_bytes
        return pa.array([to_bytes(own.values.to_pylist()) if own.is_valid else None for own in lists], pa.binary())

    return raw(ids)
