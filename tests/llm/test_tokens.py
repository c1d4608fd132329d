"""Operators 3 and 5 against the tokenizer libraries on random and planted texts."""
import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import byte_bpe, queries, token_counts
from ledgerline.llm.common import text_bytes

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


def samples():
    rng = random.Random(5)
    signs = "abcdeé ßü\n\t  \x1c\x1f\x85\xa0 　'sreveTHE0123½٣中文字😀!?.,<|endoftext|>"
    out = ["", " ", "a" * 3000, "ab" * 1000, "\n\n\n   x", "   " * 300, "it's I'll we've 's 'x ''s", "'re", "<|endoftext|>",
           "a<|endoftext|>b  <|endoftext|>  c", "<|endof", "text|>x"]
    out += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 120))) for _ in range(600)]
    out += ["".join(rng.choice(" '\nsrevlltmd") for _ in range(rng.randint(0, 40))) for _ in range(600)]
    return out + ["".join(rng.choice("abcdefghijkl") for _ in range(700)) for _ in range(5)]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library_and_round_trips(library):
    texts, bpe = samples(), byte_bpe.bpe_of(RANKS)
    got = bpe.encode(*text_bytes(pa.array(texts)))
    for text, ids in zip(texts, got):
        assert ids == np.array(library.encode_ordinary(text), "<u4").tobytes(), text[:80]
        assert bpe.decode(ids) == text.encode()


def test_counts_equal_the_library():
    texts, lib = samples(), Tokenizer.from_file(JSON)
    got = token_counts.merger_of(JSON).count(*text_bytes(pa.array(texts)))
    assert got.tolist() == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_nulls_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, "x", 7), (2, "", "y", 8), (3, "the the", None, 9), (3, "the the", None, 9)],
                               "doc_id long, text string, ids string, n_tokens int")
    rows = byte_bpe.decode(byte_bpe.encode(df, RANKS), RANKS).orderBy("doc_id").collect()
    assert [bytes(r.decoded) for r in rows] == [b"", b"", b"the the", b"the the"]
    assert [r.n_tokens for r in rows] == [7, 8, 9, 9] and rows[0].ids == b""
    counted = token_counts.count_tokens(df, JSON).orderBy("doc_id").collect()
    assert [r.n_tokens for r in counted] == [0, 0, 2, 2] and [r.ids for r in counted] == ["x", "y", None, None]
    assert byte_bpe.encode(df.limit(0), RANKS).count() == 0 == token_counts.count_tokens(df.limit(0), JSON).count()


def test_queries_over_whole_tables(spark, library):
    sf, lib = "/root/testdata/sf0.001", Tokenizer.from_file(JSON)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op3_byte_bpe(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    for r in queries.op5_token_counts(spark, sf).collect():
        n = len(lib.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)
    assert queries.op5_token_counts(spark, sf).filter(F.col("n_tokens").isNull()).count() == 0
