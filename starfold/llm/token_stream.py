"""Token ids of documents as entropy-coded binary files.

A folder holds ``blocks`` (files of records), ``tables`` (the frequencies all blocks share)
and ``pieces`` (how many ids lie before each file). Documents are sorted by id over range
partitions; one partition is one file, so files and their records are in ascending order.
A record is a block of up to ``block_tokens`` ids, coded on its own by the shared table
with interleaved lanes and checkpoints (``rans.Coder``). It holds:

    file number 4, ids of the file before it 8, ids 4, checksum of the table 4 bytes,
    then, each byte xor a mask byte that comes first: checksum of the rest 4, checksum of
    the ids 4, parts 4, checkpoints 4, words 4, lanes 2, every 2, per part the document's
    id 8, whether it is null 1, its ids in earlier records 8, its ids here 4 and whether it
    ends here 1, per checkpoint the place in the words 4 and the states 8 a lane, words 4

all little-endian but for the first 20 bytes, which are big-endian. Records are parted by a
marker; the mask is chosen so that the marker does not occur in a record. Spark's
text writer commits the files, so a lost executor leaves none behind, and its reader may
cut a file at any byte: every task decodes the records that begin in its share.

Texts are encoded once, to compressed ids in the shared folder, with a vocabulary's worth of
counts per task for the table; a second pass sorts, codes and writes.

Defined cases: a null text is empty and has the end id alone; a null id sorts first; rows
that repeat an id are ordered by a hash of their text (equal rows are interchangeable) and
each keeps its own place; texts of any length are encoded whole, slice by slice, and may
span records; extra columns are ignored; an empty table gives no records; an id beyond the
table or a broken checksum raises.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.rans import Coder, frequencies
from starfold.llm.word_ids import word_ids
from starfold.session import durable

MARKER = "\x01token-block\x02\x03"
_HEAD = struct.Struct(">IQII")
_BODY = struct.Struct("<IIIIHH")
_PART = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("before", "<i8"), ("count", "<u4"), ("ends", "u1")])


#: Bytes of text that are encoded at once.
TOGETHER = 8 << 20
_TOKENS = "doc_id long, hash long, row long, part int, ends boolean, ids binary"


def tokens(docs: DataFrame, tokenizer: str, end: int, row_tokens: int = 1 << 20) -> DataFrame:
    """Compressed ids of ``docs`` (doc_id, text), a row for every ``row_tokens`` or so of a
    document; and per task a row with part -1 that counts the ids it has met."""
    names = ["doc_id", "hash", "row", "part", "ends", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, out, size, met = word_ids(tokenizer), [], 0, np.zeros(end + 1, np.int64)
        press = zstandard.ZstdCompressor(level=1).compress
        kind = "<u2" if max(words.tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else "<u4"
        mark = bytes([int(kind[2])])

        def count(ids: np.ndarray) -> None:
            nonlocal met
            found = np.bincount(ids, minlength=len(met))
            found[:len(met)] += met
            met = found

        def put(at: tuple, part: int, ends: bool, ids: np.ndarray) -> None:
            nonlocal size
            kept = mark + press(ids)
            out.append((*at, part, ends, kept))
            size += len(kept)

        def made() -> pa.RecordBatch:
            nonlocal out, size
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            ready = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            out, size = [], 0
            return ready

        def long_text(at: tuple, text: str) -> None:
            some, n, part = [], 0, 0
            for ids in words.encoded(text):
                some.append(ids.astype(kind))
                count(ids)
                n += len(ids)
                if n >= row_tokens:
                    put(at, part, False, np.concatenate(some))
                    some, n, part = [], 0, part + 1
            put(at, part, True, np.concatenate([*some, np.array([end], kind)]))
            met[end] += 1

        for batch in batches:
            places = list(zip(*[batch.column(i).to_pylist() for i in (0, 2, 3)], strict=True))
            texts = pc.fill_null(batch.column(1), "")
            lengths = pc.binary_length(texts).to_numpy()
            low = 0
            while low < len(texts):
                # Neighbours up to some megabytes are encoded together, a longer text alone.
                high = low + max(1, int(np.searchsorted(np.cumsum(lengths[low:]), TOGETHER, "right")))
                if not words.by_word or lengths[low] > TOGETHER:
                    for i in range(low, high):
                        long_text(places[i], texts[i].as_py())
                else:
                    ids, counts = words.of_texts(texts.slice(low, high - low))
                    count(ids)
                    met[end] += len(counts)
                    ids, ends = np.insert(ids.astype(kind), np.cumsum(counts), end), np.cumsum(counts + 1)
                    for at, a, b in zip(places[low:high], (ends - counts - 1).tolist(), ends.tolist(), strict=True):
                        put(at, 0, True, ids[a:b])
                low = high
                if size > 8 << 20:
                    yield made()
        out.append((None, None, None, -1, True, b"\x08" + press(met)))
        yield made()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(encode, _TOKENS)


def _plain(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw[1:]), f"<u{raw[0]}")


def histogram(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs; as long as the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                met = _plain(raw.as_py())
                ids = np.flatnonzero(met)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(met[ids], pa.int64())], names=["id", "n"])

    rows = encoded.where("part < 0").select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:  # one row per id of the vocabulary
        counts[r["id"]] = r["n"]
    return counts


def record(coder: Coder, table: int, piece: int, start: int, ids: np.ndarray, parts: np.ndarray) -> bytes:
    states, read, words = coder.encode(ids)
    rest = struct.pack("<I", zlib.crc32(ids.astype("<u4").tobytes())) + _BODY.pack(len(parts), len(states), len(words), 0, coder.lanes, coder.every)
    rest += parts.tobytes() + read.astype("<u4").tobytes() + states.astype("<u8").tobytes() + words.astype("<u4").tobytes()
    body = np.frombuffer(struct.pack("<I", zlib.crc32(rest)) + rest, np.uint8)
    head = _HEAD.pack(piece, start, len(ids), table)
    for mask in range(256):
        raw = head + bytes([mask]) + (body ^ np.uint8(mask)).tobytes()
        if MARKER.encode() not in raw + MARKER.encode()[:-1]:
            return raw
    raise ValueError("no mask keeps the marker out")


def opened(raw: bytes, coder: Coder, table: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """File number, ids before the record, ids and parts of one record."""
    piece, start, n, by = _HEAD.unpack_from(raw)
    body = (np.frombuffer(raw, np.uint8, offset=_HEAD.size + 1) ^ np.uint8(raw[_HEAD.size])).tobytes()
    if by != table or struct.unpack_from("<I", body)[0] != zlib.crc32(body[4:]):
        raise ValueError("a record is damaged or belongs to another table")
    parts, checkpoints, size, _, lanes, every = _BODY.unpack_from(body, 8)
    at = 8 + _BODY.size

    def take(kind, count):
        nonlocal at
        found = np.frombuffer(body, kind, count, at)
        at += found.nbytes
        return found

    listed, read, states, words = take(_PART, parts), take("<u4", checkpoints), take("<u8", checkpoints * lanes), take("<u4", size)
    if (lanes, every) != (coder.lanes, coder.every):
        coder = Coder(coder.scaled, int(coder.bits), lanes, every)
    ids = coder.decode(states.reshape(checkpoints, lanes).copy(), read, words, n).astype("<u4")
    if struct.unpack_from("<I", body, 4)[0] != zlib.crc32(ids.tobytes()):
        raise ValueError("decoded ids differ from those written")
    return piece, start, ids, listed


def write(docs: DataFrame, folder: str, tokenizer: str, *, end: int = 1, block_tokens: int = 1 << 20, lanes: int = 2048, every: int = 128) -> None:
    """Write the ids of ``docs`` (doc_id, text), each followed by ``end``, in the new ``folder``."""
    spark = docs.sparkSession
    encoded = durable(tokens(docs, tokenizer, end))
    scaled, bits = frequencies(histogram(encoded))
    table = zlib.crc32(scaled.astype("<u8").tobytes())
    spark.createDataFrame([(bits, table, scaled.astype("<u8").tobytes())], "bits int, checksum long, frequencies binary").coalesce(1).write.parquet(f"{folder}/tables")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, piece = Coder(scaled, bits, lanes, every), TaskContext.get().partitionId()
        ids, parts, start = bytearray(), [], 0

        def add(doc: int | None, before: int, count: int, ends: bool) -> None:
            if parts and not parts[-1][3]:  # the same document goes on
                parts[-1] = (doc, parts[-1][1], parts[-1][2] + count, ends)
            else:
                parts.append((doc, before, count, ends))

        def full(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal ids, parts, start
            while len(ids) // 4 >= least and ids:
                n, listed, left = min(block_tokens, len(ids) // 4), [], []
                room = n
                for doc, before, count, ends in parts:
                    here = min(count, room)
                    if here:
                        listed.append((doc or 0, doc is None, before, here, ends and here == count))
                        room -= here
                    if here < count:
                        left.append((doc, before + here, count - here, ends))
                raw = record(coder, table, piece, start, np.frombuffer(bytes(ids[:4 * n]), "<u4"), np.array(listed, _PART))
                yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["value"])
                ids, parts, start = ids[4 * n:], left, start + n

        before = 0
        for batch in batches:
            for doc, ends, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                some = _plain(raw.as_py()).astype("<u4").tobytes()
                ids += some
                add(doc, before, len(some) // 4, ends)
                before = 0 if ends else before + len(some) // 4
                yield from full(block_tokens)
        yield from full(0)

    order = ["doc_id", "hash", "row"]
    pieces = max(spark.sparkContext.defaultParallelism, docs.rdd.getNumPartitions())
    sorted_rows = encoded.where("part >= 0").repartitionByRange(pieces, *order).sortWithinPartitions(*order, "part").select("doc_id", "ends", "ids")
    sorted_rows.mapInArrow(pack, "value binary").select(F.col("value").cast("string")).write.option("lineSep", MARKER).text(f"{folder}/blocks")

    sizes = _records(spark, folder).select(_number(1, 4).alias("piece"), _number(13, 4).alias("n")).groupBy("piece").agg(F.sum("n").alias("n"))
    before, starts = 0, []
    for r in sizes.orderBy("piece").collect():  # one row per file
        starts.append((r["piece"], before))
        before += r["n"]
    spark.createDataFrame(starts, "piece long, before long").coalesce(1).write.parquet(f"{folder}/pieces")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("lineSep", MARKER).schema("value string").text(f"{folder}/blocks").select(F.col("value").cast("binary").alias("value"))


def _number(at: int, size: int) -> Column:
    return F.conv(F.hex(F.substring("value", at, size)), 16, 10).cast("long")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of documents as they lie in the records: ``doc_id``, ``start`` (ids of all
    documents before this one), ``before`` (its ids in earlier records), ``ends`` and
    ``ids`` as little-endian 32-bit integers."""
    shared = spark.read.parquet(f"{folder}/tables").first()
    scaled, bits, table = np.frombuffer(bytes(shared["frequencies"]), "<u8"), shared["bits"], shared["checksum"]
    # One row per file, so its size is bounded by the number of tasks that wrote.
    before = {r["piece"]: r["before"] for r in spark.read.parquet(f"{folder}/pieces").collect()}
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("before", pa.int64()), ("ends", pa.bool_()), ("ids", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(scaled, bits)
        for batch in batches:
            for raw in batch.column(0):
                piece, start, ids, parts = opened(raw.as_py(), coder, table)
                at = np.cumsum(parts["count"]) - parts["count"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(parts["doc_id"], pa.int64(), mask=parts["null"].astype(bool)), pa.array(before[piece] + start + at - parts["before"], pa.int64()),
                    pa.array(parts["before"], pa.int64()), pa.array(parts["ends"].astype(bool)),
                    pa.array([ids[a:a + n].tobytes() for a, n in zip(at, parts["count"], strict=True)], pa.binary()),
                ], schema=schema)

    return _records(spark, folder).mapInArrow(decode, "doc_id long, start long, before long, ends boolean, ids binary")


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of the checksum, bits reversed."""
    total = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            total ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return total


def joined_crc(first: int, second: int, size: int) -> int:
    """Checksum of two stretches from theirs and the bytes of the second."""
    shift, square, n = 1 << 31, 1 << 23, size  # one, and a shift by a byte
    while n:
        if n & 1:
            shift = _times(shift, square)
        square, n = _times(square, square), n >> 1
    return _times(shift, first) ^ second


def digests(parts: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document in ``parts``.
    Documents inside one record need no shuffle; of the others only checksums are moved."""
    sized = durable(parts.select("doc_id", "start", "before", "ends", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")))
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows, crc = rows.sort_values("before"), 0
        for n, c in zip(rows["n_tokens"], rows["ids_crc32"], strict=True):
            crc = joined_crc(crc, int(c), 4 * int(n))
        first = rows.iloc[:1]
        return pd.DataFrame({"doc_id": first["doc_id"].astype("Int64"), "start": first["start"], "n_tokens": int(rows["n_tokens"].sum()), "ids_crc32": crc})

    whole = (F.col("before") == 0) & F.col("ends")
    spanning = sized.where(~whole).groupBy("start").applyInPandas(join, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return sized.where(whole).select(columns).unionByName(spanning)
