"""Operators on single texts against plain Python, with odd texts and columns."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from auditloom.llm import chat_format, model_file, quality_rules, sentence_pieces, token_counts

ODD = [
    None,
    "",
    " ",
    "a",
    "a  b",
    "  lead and trail ",
    "tab\tand\nline\n\n",
    "é ｆｕｌｌ ① ﬁ",
    "<s> not special </s>",
    "😀 emoji ​ zero",
    "x" * 5000,
    "one two three " * 400,
    "▁ marker▁inside ▁",
    "\x00 nul",
    "word" + " " * 37 + "far",
]


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.public_model()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, -1, "clash") for i, t in enumerate(ODD + ODD[:3])]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, key string")


def test_token_counts(odd, model, library):
    rows = token_counts.count_tokens(odd, model).collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        text = (ODD + ODD[:3])[r.doc_id] or ""
        assert (r.n_tokens, r.n_bytes) == (len(library.encode(text)), len(text.encode()))


def test_token_counts_of_nothing(spark, model):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(empty, model).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abthe ▁é\n<>😀", max_size=60))
def test_merging_as_the_library(text):
    model = model_file.parse(sentence_pieces.public_model())
    merger = _ONCE.setdefault("merger", token_counts.PairMerger(model))
    library = _ONCE.setdefault(
        "library", sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    )
    assert merger.count(text) == len(library.encode(text))


_ONCE = {}


def test_encoding(odd, model, library):
    for r in sentence_pieces.encode(odd, model).collect():
        text = (ODD + ODD[:3])[r.doc_id] or ""
        assert r.ids == library.encode(text) and r.parity
        assert r.round_trip == (library.decode(r.ids) == text)


def test_decoding(odd, model, library):
    encoded = sentence_pieces.encode(odd, model)
    for r in sentence_pieces.decode(encoded, model).collect():
        assert r.text == library.decode(library.encode((ODD + ODD[:3])[r.doc_id] or ""))


def test_disagreement_takes_the_library(model, library):
    codec = sentence_pieces.Codec(model)

    class Wrong:
        def encode_batch_fast(self, texts, add_special_tokens):
            return [type("E", (), {"ids": [5]}) for _ in texts]

        def encode(self, text, add_special_tokens):
            return type("E", (), {"ids": [5]})

        def decode_batch(self, ids, skip_special_tokens):
            return library.decode(ids)

        def decode(self, ids, skip_special_tokens):
            return library.decode(ids)

    codec.tokenizer = Wrong()
    ((ids, parity, round_trip),) = codec.encode(["two words"])
    assert sentence_pieces.unpacked(ids) == library.encode("two words") and not parity and round_trip


def test_unigram_models_are_rebuilt():
    model = model_file.Model(
        pieces=["<unk>", "▁a", "b", "▁", "a"], scores=[0.0, -1.0, -2.0, -3.0, -3.5], types=[2, 1, 1, 1, 1], trim=False
    )
    tokenizer = sentence_pieces.rebuild(model)
    assert tokenizer.encode("ab a").tokens == ["▁a", "b", "▁a"]
    assert tokenizer.decode(tokenizer.encode("ab a").ids) == "ab a"


def brute_repeats(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(hit)


def test_quality_rules(spark):
    texts = ODD + ["a a a a a b", "a b c x a b c", "l\nl\n \n \nm", "Fine line here is long enough.\nHome | About | More"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kept", F.lit("clash"))
    for r in quality_rules.clean(df).collect():
        text = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == brute_repeats(words)
        assert r.base_failed == (len(words) < 50 or 100 * r.n_repeat_words > 50 * len(words))
        assert (r.cleaned is None) == (texts[r.doc_id] is None)
    last = quality_rules.clean(df).filter("doc_id = 18").first()
    assert last.cleaned == "Fine line here is long enough."


def test_lines_lost_reject_a_document(spark):
    good = "\n".join(f"Line {i} has{i} its{i} own{i} words{i} and ends{i}." for i in range(20))
    shouted = "\n".join("WORDS!! ARE!! SHOUTED!! HERE!! AGAIN!! " + chr(97 + i) for i in range(20))
    df = spark.createDataFrame([(1, good), (2, good + "\n" + shouted), (3, good + "\nAll rights reserved.")], "doc_id int, text string")
    kept = {r.doc_id: r.kept for r in quality_rules.clean(df).collect()}
    assert kept == {1: True, 2: False, 3: True}


def test_chat_round_trip(spark):
    texts = ["", None, r"\b \p \\ <|end|>", "<|turn:user|>", "<", "|>", "\\", r"\### Assistant: </turn> ok", "é😀\n"]
    roles = ["user", "assistant", None, "a|b\\", "assistant", "assistant", "tool", "assistant", "user"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(roles, texts))] + [(None, 0, "assistant", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    made = chat_format.read_chats(chat_format.format_chats(df.withColumn("parts", chat_format.text_part(F.col("text")))))
    got = {r.conv_id: r.turns for r in made.collect()}
    assert [(t.role, t.text) for t in got[1]] == [(r or "", t or "") for r, t in zip(roles, texts)]
    assert [t.loss_text for t in got[1] if t.loss_text is not None] == [
        t or "" for r, t in zip(roles, texts) if r == "assistant"
    ]
    assert [t.text for t in got[None]] == ["alone"]


def test_chat_parts(spark):
    parts = [
        ("text", "see ", None, None, None, None, None),
        ("image", None, "s3://i", 28, 15, None, None),
        ("audio", None, "a.wav", None, None, 1.5, None),
        ("text", "<|image:0.1|>", None, None, None, None, None),
        ("odd", None, "d.pdf", None, None, None, 3),
    ]
    schema = f"conv_id int, turn int, role string, parts array<{chat_format.PART}>"
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], schema)
    formatted = chat_format.format_chats(df)
    row = formatted.first()
    assert row.formatted == (
        r"<|turn:user|>see <|image:0.1|><|audio:0.2|><\pimage:0.1|><|document:0.4|><|end|>" + "\n<|turn:assistant|><|end|>\n"
    )
    assert [(a.part, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (1, "image", "s3://i", 4),
        (2, "audio", "a.wav", 38),
        (4, "document", "d.pdf", 3072),
    ]
    assert row.attachment_tokens == 4 + 38 + 3072
    assert sum(r.chars for r in row.loss_runs) == len(row.formatted)
    assert chat_format.read_chats(formatted).first().turns[0].text == "see <|image:0.1|>"


def test_digest_column_is_of_the_ids(spark, model, library):
    df = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    ids = ",".join(map(str, library.encode("some words")))
    assert sentence_pieces.encoded_digest(df).first().ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
