"""Byte-pair encoding against the tiktoken library and exact round trips."""

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from auditloom.llm import byte_pairs
from auditloom.llm.common import ready

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return byte_pairs.read_ranks(file.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_and_texts_equal_the_library(ranks, library):
    picked = random.Random(3)
    odd = [chr(c) for c in [*range(128), 0x85, 0xA0, 0x200B, 0x2003, 0x3000, 0x301, 0x661, 0x4F60, 0x1F600, 0xE9]]
    texts = ["", None, "<|endoftext|> it's  a\n\n test ", "straßenbahn 你好世界 😀"]
    texts += ["".join(picked.choice(odd) for _ in range(picked.randrange(60))) for _ in range(400)]
    encoder, decoder = byte_pairs.WordEncoder(ranks, PATTERN), byte_pairs.ByteDecoder(ranks)
    ids = encoder.encode(texts)
    assert ids.to_pylist() == [library.encode_ordinary(t or "") for t in texts]
    assert decoder.decode(ids).to_pylist() == [(t or "").encode() for t in texts]


def test_long_words_equal_the_library(ranks, library):
    """Words beyond the reach of a merge, many of them periodic."""
    picked = random.Random(5)
    words = ["a" * 5000, "ab" * 2000, "the" * 1000, "你" * 500, " \n" * 800]
    for i in range(150):
        letters = picked.sample("etaoinshrdlucmfwyp", picked.choice([1, 2, 3, 8]))
        if i % 3:
            words.append("".join(picked.choice(letters) for _ in range(picked.choice([40, 100, 300]))))
        else:
            words.append("".join(picked.choice(letters) for _ in range(picked.randint(1, 7))) * 40)
    got = byte_pairs.WordEncoder(ranks, PATTERN).encode(words).to_pylist()
    assert got == [library.encode_ordinary(w) for w in words]


def test_small_vocabulary_and_forgetting(monkeypatch):
    """A table in which a merge makes a pair of lower rank, texts in many batches with little memory."""
    ranks = {bytes([b]): b + 10 for b in range(256)}
    ranks |= {b"ab": 900, b"abc": 5, b"bc": 901, b"abab": 800, b"aa": 400, b"aaa": 300}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    picked = random.Random(9)
    texts = ["".join(picked.choice("abc ") for _ in range(picked.randrange(40))) for _ in range(600)]
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 20)
    monkeypatch.setattr(byte_pairs, "QUERY_BYTES", 30)
    monkeypatch.setattr(byte_pairs, "QUERY_TOKENS", 50)
    encoder, decoder = byte_pairs.WordEncoder(ranks, PATTERN), byte_pairs.ByteDecoder(ranks)
    for start in range(0, 600, 50):
        some = texts[start : start + 50]
        ids = encoder.encode(some)
        assert ids.to_pylist() == [library.encode_ordinary(t) for t in some]
        assert decoder.decode(ids).to_pylist() == [t.encode() for t in some]


def test_a_step_handles_a_word_as_one_row(ranks, library, monkeypatch):
    """Words of a text that are pieces ask no query; others are one row each, with their pairs ranked."""
    asked, real = [], byte_pairs._asked
    monkeypatch.setattr(byte_pairs, "_asked", lambda con, name, rows, sql: asked.append(rows) or real(con, name, rows, sql))
    encoder = byte_pairs.WordEncoder(ranks, PATTERN)
    pieces = [p.decode() for p in list(ranks)[300:900] if p.strip().isalpha() and p.isascii()][:20]
    for piece in pieces:
        assert encoder.encode([piece]).to_pylist() == [[ranks[piece.encode()]]]
    assert len(pieces) == 20 and not asked
    words = ["xqzvtheing", "aaaaaaaaaaaaaaa", "ßunger", "xqzvtheing"]
    assert encoder.encode(words).to_pylist() == [library.encode_ordinary(w) for w in words]
    (rows,) = asked
    assert len(rows) == 3 and rows.column("toks").to_pylist()[0] == [byte_pairs.MARK, *[ranks[bytes([b])] for b in b"xqzvtheing"]]
    assert encoder.encode(words).to_pylist()[2] == library.encode_ordinary("ßunger") and len(asked) == 1


def test_decoding_in_pieces_of_queries(ranks, library, monkeypatch):
    """Texts that begin and end inside queries, with empty, null and unknown ones between."""
    import pyarrow as pa

    monkeypatch.setattr(byte_pairs, "QUERY_TOKENS", 3)
    texts = ["", "a cat sat there", None, "b", "", "你好 world again", "c"]
    lists = [None if t is None else library.encode_ordinary(t) for t in texts]
    lists[3] = [*lists[3], 60_000]
    got = byte_pairs.ByteDecoder(ranks).decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist()
    assert got == [b"", b"a cat sat there", None, None, b"", "你好 world again".encode(), b"c"]


def test_rows_stay_one_to_one(spark, ranks, library):
    """Nulls, repeated rows, clashing names, an empty table and lists that hold no piece."""
    ready(spark)
    rows = [(1, "a cat", "x"), (1, "a cat", "x"), (None, None, None), (2, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("key", F.lit(0))
    coded = byte_pairs.encode(docs, ranks, PATTERN)
    got = sorted((r.doc_id or 0, list(r.ids)) for r in coded.collect())
    cat = library.encode_ordinary("a cat")
    assert got == [(0, []), (1, cat), (1, cat), (2, [])]
    assert byte_pairs.encode(docs.limit(0), ranks, PATTERN).isEmpty()
    lists = spark.createDataFrame([(1, [cat[0]]), (2, [60_000]), (3, None), (4, [None]), (5, [])], "doc_id int, ids array<int>")
    decoded = {r.doc_id: r.decoded for r in byte_pairs.decode(lists, ranks).collect()}
    assert {k: v and bytes(v) for k, v in decoded.items()} == {1: b"a", 2: None, 3: None, 4: None, 5: b""}


def test_incomplete_vocabulary_is_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="single bytes"):
        byte_pairs.encode(docs, {b"a": 0}, PATTERN)
