"""Adding up counts of hashed keys as a round trip of arrays: blocks of rows ask, parts of
the key space answer. Both sides hold sorted keys; a key that fills a block is one
number of it."""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame

#: Keys that a part sorts at once, about.
SLICE_KEYS = 1 << 19


def pack(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 3)


def unpack(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(bytes(raw)), kind)


def small(values: np.ndarray) -> np.ndarray:
    """Counts in the narrowest unsigned type."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins and ends in sorted 64-bit ``keys``."""
    limits = [(i << 64) // parts for i in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(limits, np.uint64)), [len(keys)]]).astype(np.int64)


def six_bytes(keys: np.ndarray, parts: int) -> np.ndarray:
    """The 48 bits by which sorted 64-bit ``keys`` are told apart within their part, the
    highest ones that vary there, each key less the one before in its part; a row of bytes
    each."""
    starts = np.array([(i << 64) // parts for i in range(parts)], np.uint64)
    shift = max(0, ((1 << 64) // parts).bit_length() - 48)
    edges = parts_of(keys, parts)
    within = (keys - np.repeat(starts, np.diff(edges))) >> np.uint64(shift)
    steps = np.diff(within, prepend=np.uint64(0))
    first = edges[:-1][np.diff(edges) > 0]
    steps[first] = within[first]
    return steps.view(np.uint8).reshape(-1, 8)[:, :6]


def added(rows: pd.DataFrame, width: int, levels: int, slice_keys: int = SLICE_KEYS) -> pd.DataFrame:
    """What one part answers to the requests in ``rows``, which are let go; see ``answered``."""
    # A part is as large as memory allows: it lies there as keys and narrow counts, and is
    # sorted slice by slice, a slice being the keys that end in the same bits.
    sizes = [zstandard.frame_content_size(bytes(k)) // width for k in rows["keys"]]
    ends = np.cumsum(sizes)
    wide = np.zeros((ends[-1], 8), np.uint8)
    keys, last = wide.view(np.uint64).ravel(), wide[:, 0]
    for n, e, k in zip(sizes, ends, rows.pop("keys"), strict=True):
        raw = unpack(k, "uint8")
        if width == 8:
            wide[e - n:e] = raw.reshape(-1, 8)
        else:
            wide[e - n:e, :width] = raw.reshape(width, -1).T
            np.cumsum(keys[e - n:e], out=keys[e - n:e])
    plain = [zstandard.decompress(bytes(c)) for c in rows.pop("counts")]
    counts = np.concatenate([np.frombuffer(c, f"u{len(c) // n}") for n, c in zip(sizes, plain, strict=True)])
    del plain
    found = np.empty(len(keys), np.min_scalar_type(int(counts.sum(dtype=np.uint64))))
    owner = np.zeros(len(keys), bool)
    of_counts, seen, sum_of_all = np.zeros(levels + 2, np.int64), 0, 0
    slices = min(1 << (len(keys) // slice_keys).bit_length(), 256)
    for s in range(slices):
        at = np.flatnonzero((last & np.uint8(slices - 1)) == s)
        if not len(at):
            continue
        own = keys[at]
        order = np.argsort(own, kind="stable")
        at, own = at[order], own[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        totals = np.add.reduceat(counts[at], first, dtype=np.uint64)
        owner[at[first]] = True
        found[at] = np.repeat(totals.astype(found.dtype), np.diff(np.append(first, len(at))))
        of_counts += np.bincount(np.minimum(totals, levels + 1).astype(np.int64), minlength=levels + 2)
        seen += int((totals > 0).sum())
        sum_of_all += int(totals.sum())
    del keys, last, wide, counts
    out = [
        {"block": b, "part": int(p), "totals": pack(small(found[e - n:e])), "owned": pack(np.packbits(owner[e - n:e])), "stats": None}
        for b, p, n, e in zip(rows["block"], rows["part"], sizes, ends, strict=True)
    ]
    stats = [*of_counts[1:levels + 1].tolist(), seen, sum_of_all]
    out.append({"block": None, "part": int(rows["part"].iloc[0]), "totals": b"", "owned": b"", "stats": stats})
    return pd.DataFrame(out)


def answered(requests: DataFrame, width: int, levels: int) -> DataFrame:
    """Totals for every request (part, block, keys of ``width`` bytes, counts), aligned with
    its keys, and which keys it owns; in the rows without a block, the number of keys
    with each total up to ``levels``, of all keys with one, and the sum, of the part. Keys
    of six bytes come as ``six_bytes`` makes them, first all lowest bytes, then all next ones."""
    return requests.groupBy("part").applyInPandas(lambda rows: added(rows, width, levels), "block string, part int, totals binary, owned binary, stats array<long>")
