"""Files of token ids: exact round trips, and the query against the tokenizers library."""

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starfold.llm import rans, token_stream
from starfold.llm.queries import QUERIES, TOKENIZER
from starfold.llm.word_ids import WordIds

FOLDER = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(TOKENIZER)
WORDS = WordIds(TOKENIZER)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = st.lists(st.sampled_from(list("aBZéÉßİıſΣσς'sLl109²½.,!?|<>“…́̈​ \u0085 \x1c\x00\t\n\r  \x0b日本🙂한") + ["<|endoftext|>", "'S", "'re", "ﬁ"]), max_size=40).map("".join)


@settings(max_examples=1500, deadline=None)
@given(ODD)
def test_words_as_the_library_has_them(text):
    assert np.concatenate(list(WORDS.encoded(text))).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_slices_and_forgetting():
    words = WordIds(TOKENIZER, words=5, pieces=5)
    text = " ".join(f"word{i % 37}, Été" for i in range(200_000))
    assert len(text) > 2 << 20 and len(list(words.encoded(text))) > 2 and len(words.words) <= 5
    assert np.concatenate(list(words.encoded(text))).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.concatenate(list(words.encoded("x" * 3_000_000))).tobytes() == words.library("x" * 3_000_000)


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, max_size=6), st.integers(0, 3))
def test_many_texts_at_once(texts, skipped):
    array = pa.array(["skipped"] * skipped + texts, pa.string()).slice(skipped)
    ids, counts = WORDS.of_texts(array)
    wanted = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(wanted, []) and counts.tolist() == list(map(len, wanted))


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000, 20_000])
@pytest.mark.parametrize("symbols", [1, 3, 900])
def test_coder_round_trip(n, symbols):
    ids = np.minimum(np.random.default_rng(n).zipf(1.2, n), symbols) - 1
    coder = rans.Coder(*rans.frequencies(np.bincount(ids, minlength=symbols)), lanes=8, every=16)
    states, read, words = coder.encode(ids)
    assert coder.decode(states, read, words, n).tolist() == ids.tolist()
    for i in range(len(states)):  # from any checkpoint on
        rest = n - i * 8 * 16
        assert coder.decode(states[i:], read[i:], words, rest).tolist() == ids[i * 8 * 16:].tolist()


def test_size_is_near_the_entropy():
    ids = np.minimum(np.random.default_rng(1).zipf(1.3, 200_000), 5_000) - 1
    share = np.bincount(ids) / len(ids)
    share = share[share > 0]
    states, _, words = rans.Coder(*rans.frequencies(np.bincount(ids))).encode(ids)
    assert 4 * len(words) < 1.01 * len(ids) * -(share * np.log2(share)).sum() / 8


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("value", F.lit("clash")).withColumn("ids", F.lit(3)).repartition(3)


def written(spark, docs, **options):
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}"
    token_stream.write(docs, folder, TOKENIZER, **options)
    return folder


def plain(rows):
    """(doc_id, start, n_tokens, crc) of rows with distinct ids, and of equal rows."""
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(text)
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def digests(spark, folder):
    return sorted((tuple(r) for r in token_stream.digests(token_stream.read(spark, folder)).collect()), key=lambda r: r[1])


def test_query_equals_plain_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_token_stream"](spark, FOLDER)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[1]) == plain(docs)


def test_nulls_repeats_and_documents_over_many_records(spark):
    rows = [(None, "no id"), (3, None), (2, ""), (9, "Long text, " * 700), (-5, "a"), *[(7, "Copy of a row.")] * 40, (8, "naïve café \x00  ")]
    folder = written(spark, frame(spark, rows), block_tokens=64, lanes=4, every=3)
    assert digests(spark, folder) == plain(rows)
    ids = {}
    for r in sorted(token_stream.read(spark, folder).collect(), key=lambda r: r.start + r.before):
        ids.setdefault(r.start, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert sum((ids[s] for s in sorted(ids)), []) == sum((ids_of(t) for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))), [])
    files = spark.read.format("binaryFile").load(f"{folder}/blocks").where("length > 0").collect()
    places = [token_stream._HEAD.unpack_from(raw)[:2] for f in sorted(files, key=lambda f: f.path) for raw in f.content.split(token_stream.MARKER.encode())[:-1]]
    assert places == sorted(places) and len(files) > 1


def test_long_texts_lie_in_several_rows(spark, monkeypatch):
    rows = [(1, "short"), (2, "Some long text. " * 400), (3, ""), (4, "tail")]
    text = rows[1][1]
    monkeypatch.setattr(token_stream, "TOGETHER", 100)
    monkeypatch.setattr(token_stream.tokens, "__defaults__", (50,))
    encoded = token_stream.tokens(frame(spark, rows), TOKENIZER, 1, 50)
    assert encoded.where("doc_id = 2").count() > 1 and len(ids_of(text)) > 1000
    assert digests(spark, written(spark, frame(spark, rows), block_tokens=64, lanes=4, every=3)) == plain(rows)


def test_files_cut_anywhere(spark):
    rows = [(i, f"Document {i}. " * (i % 50)) for i in range(300)]
    folder = written(spark, frame(spark, rows), block_tokens=100, lanes=4, every=3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert token_stream.read(spark, folder).rdd.getNumPartitions() > 20
        assert digests(spark, folder) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_that_share_an_id(spark):
    rows = [(1, f"text {i % 5}") for i in range(60)] + [(0, "first"), (2, "last")]
    found = digests(spark, written(spark, frame(spark, rows), block_tokens=16, lanes=4, every=3))
    assert [r[0] for r in found] == [0] + [1] * 60 + [2]
    assert sorted((d, n, c) for d, _, n, c in found) == sorted((d, len(ids_of(t)), crc(ids_of(t))) for d, t in rows)
    assert [r[1] for r in found] == np.cumsum([0] + [r[2] for r in found[:-1]]).tolist()


def test_empty_table(spark):
    assert digests(spark, written(spark, frame(spark, []))) == []


def test_damage_is_noticed():
    ids = np.array([1, 2, 3, 1, 1], "<u4")
    coder = rans.Coder(*rans.frequencies(np.bincount(ids)), lanes=4, every=2)
    raw = token_stream.record(coder, 5, 0, 0, ids, np.array([(4, 0, 0, 5, 1)], token_stream._PART))
    assert token_stream.opened(raw, coder, 5)[2].tolist() == ids.tolist()
    with pytest.raises(ValueError):
        token_stream.opened(raw[:-1] + bytes([raw[-1] ^ 1]), coder, 5)
    with pytest.raises(ValueError):
        token_stream.opened(raw, coder, 6)


@given(st.binary(max_size=300), st.binary(max_size=300))
def test_joined_checksums(a, b):
    assert token_stream.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
