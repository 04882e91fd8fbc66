"""Web archives of Zstandard frames with a shared dictionary, and their reader.

An archive is a leading skippable frame (magic 0x184D2A5D) that holds a dictionary
trained on a bounded sample of the records, then one frame per WARC record. Spark's
text writer puts the frames out, so files are committed like any other output and a
task that is tried again leaves nothing behind; the separator it puts after each
frame is itself an empty skippable frame, which every reader skips.

Of records with equal payloads of at least ``least`` bytes, the one with the smallest
id is a response and the others are revisits of it; smaller ones are all responses.
The decision is made on ids and digests alone; payloads are shuffled once, by id,
which also deals them out to the archives, and a revisit carries no payload.

Defined cases: null payload is empty; rows that repeat an id and payload have the same
verdict (all responses when the id is the smallest); a null id loses against any other
id and is a response if its equals have none; null url: no target header; an empty
table gives no archive and no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Magic numbers of the formats.
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
FRAME_MAGIC = (0xFD2FB528).to_bytes(4, "little")
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
#: An empty skippable frame: all ASCII, so it can serve as a line separator.
SEPARATOR = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
SUFFIX = ".warc.zst"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, kind: str, refers_to: int | None, digest: str, size: int, payload: bytes, date: str) -> bytes:
    """One WARC record; ``payload`` is empty for a revisit, ``size`` is that of the full payload."""
    def urn(i: int | None) -> str:
        return f"<{uuid.uuid5(uuid.NAMESPACE_OID, f'page {i}').urn}>"

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {date}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def payloads(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Narrow input: id, url, payload bytes, their number and digest, and a join key."""
    raw = F.coalesce(F.col(html), F.lit("")).cast("binary")
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), raw.alias("payload")).select(
        "page_id", "url", "payload", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("key"),
    )


def verdicts(records: DataFrame, least: int = 100) -> DataFrame:
    """Per id and digest: the kind of record, and which id a revisit refers to."""
    narrow = records.select("key", "page_id", "digest", "size").distinct()
    first = narrow.where(F.col("size") >= least).groupBy(F.col("digest").alias("digest")).agg(F.min("page_id").alias("first_id"))
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return narrow.join(first, "digest", "left").select(
        "key", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def dictionary(records: DataFrame, date: str, samples: int, sample_bytes: int, size: int) -> bytes:
    """A dictionary trained on at most ``samples`` records of at most ``sample_bytes``
    bytes each, those with the smallest hashes: the only rows that reach the driver."""
    chosen = records.where(F.col("size") <= sample_bytes).orderBy(F.xxhash64("digest", "key")).limit(samples)
    texts = [record(r.page_id, r.url, "response", None, r.digest, r.size, bytes(r.payload), date) for r in chosen.collect()]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:  # too few records to train on: their bytes themselves serve as history
        return b"".join(texts)[:size]


def write_archives(
    pages: DataFrame, folder: str, *, least: int = 100, archive_bytes: int = 64 << 20, samples: int = 400, sample_bytes: int = 32 << 10,
    dictionary_bytes: int = 64 << 10, level: int = 3, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write ``pages`` (page_id, url, html) as archives of about ``archive_bytes`` bytes
    of payload each into the new folder ``folder``."""
    records = payloads(pages)
    shared = dictionary(records, date, samples, sample_bytes, dictionary_bytes)
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    archives = max(pages.sparkSession.sparkContext.defaultParallelism, -(-total // archive_bytes))

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compress = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(shared)).compress
        leading = [DICTIONARY_MAGIC + len(shared).to_bytes(4, "little") + shared]
        for batch in batches:
            out = [
                compress(record(None if pd.isna(i) else int(i), u, k, None if pd.isna(r) else int(r), d, s, b"" if k == "revisit" else bytes(p), date))
                for i, u, k, r, d, s, p in batch[["page_id", "url", "kind", "refers_to", "digest", "size", "payload"]].itertuples(index=False)
            ]
            if out:
                yield pd.DataFrame({"value": leading + out})
                leading = []

    dealt = records.repartition(archives, "key").join(verdicts(records, least), ["key", "digest"])
    texts = dealt.select("page_id", "url", "kind", "refers_to", "digest", "size", F.when(F.col("kind") == "response", F.col("payload")).alias("payload"))
    framed = texts.mapInPandas(frames, "value binary").select(F.col("value").cast("string"))
    framed.write.option("lineSep", SEPARATOR).text(folder)
    _rename(pages.sparkSession, folder)


def _rename(spark: SparkSession, folder: str) -> None:
    """Give the files Spark has committed the usual suffix."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("part-"):
            store.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(path, name.removesuffix(".txt") + SUFFIX))


def frame_end(data: memoryview, start: int) -> int:
    """Where the Zstandard frame that begins at ``start`` ends, from its block headers."""
    at = start + zstandard.frame_header_size(data[start:start + 18])
    while True:
        head = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + 4 * zstandard.get_frame_parameters(data[start:start + 18]).has_checksum


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of one archive, in order."""
    data, at, shared = memoryview(archive), 0, None
    decompress = None
    while at < len(data):
        magic = int.from_bytes(data[at:at + 4], "little")
        if magic in SKIPPABLE:
            size = int.from_bytes(data[at + 4:at + 8], "little")
            if bytes(data[at:at + 4]) == DICTIONARY_MAGIC and at == 0:
                shared = zstandard.ZstdCompressionDict(bytes(data[8:8 + size]))
            at += 8 + size
            continue
        if decompress is None:
            decompress = zstandard.ZstdDecompressor(dict_data=shared).decompress
        end = frame_end(data, at)
        yield decompress(data[at:end])
        at = end


def parse(raw: bytes) -> dict:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": int(fields["WARC-Page-ID"]) if "WARC-Page-ID" in fields else None, "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"], "payload": None if revisit else payload, "payload_bytes": size if revisit else len(payload),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest(),
        "refers_to": int(fields["WARC-Refers-To-Page"]) if revisit else None,
    }


_SCHEMA = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """One row per record; without ``payload`` only its size and digest. An archive is
    opened as a whole by one task, so its size bounds that task's memory."""
    names = [f for f in (c.split()[0] for c in _SCHEMA.split(", ")) if payload or f != "payload"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                found, size = [], 0
                for raw in records_of(content):
                    found.append({k: v for k, v in parse(raw).items() if k in names})
                    size += len(raw)
                    if size > 8 << 20:
                        yield pd.DataFrame(found, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                        found, size = [], 0
                yield pd.DataFrame(found, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = ", ".join(c for c in _SCHEMA.split(", ") if c.split()[0] in names)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*" + SUFFIX).load(folder)
    return files.select("content").mapInPandas(rows, schema)
