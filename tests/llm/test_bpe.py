"""Ids as the library gives them, on whole texts, and bytes back."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starfold.llm import bpe
from starfold.llm.queries import QUERIES, RANKS

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab1 \n\t.'äßé中  s", max_size=80), st.integers(1, 12))
def test_cuts_change_nothing(library, text, chars):
    assert "".join(bpe.pieces(text, chars)) == text
    assert bpe.encode_text(text, RANKS, PATTERN, chars) == library.encode_ordinary(text)


def test_columns(spark, library):
    texts = ["Hello world", "", None, "Hello world", "<|endoftext|> ünï 中文\n\n x", "word " * 60_000, "a" * 3000]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    ids = docs.select("doc_id", "text", bpe.encode(F.col("text"), RANKS, PATTERN).alias("own")).select("*", bpe.decode(F.col("own"), RANKS, PATTERN).alias("raw"))
    for r in ids.collect():
        assert r.own == (None if r.text is None else library.encode_ordinary(r.text))
        assert r.raw is None if r.text is None else bytes(r.raw).decode() == r.text


def test_query_over_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op8_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
