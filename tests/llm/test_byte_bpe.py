"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from estate.llm import byte_bpe, queries

SMALL = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def vocab():
    v = byte_bpe.Vocabulary(PATH, byte_bpe.prepare(PATH))
    v.encode("")
    return v


def test_pattern_is_the_public_one():
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN


def test_perfect_hash_is_minimal(vocab):
    h = vocab.hash
    assert sorted(h.slot(k) for k in vocab.ranks) == list(range(len(vocab.ranks)))
    assert h.find(b"surely not an entry") == -1 and vocab.ids[h.find(b"a")] == vocab.ranks[b"a"]


def test_odd_texts(library, vocab):
    rng = random.Random(3)
    texts = ["", " ", "a" * 5000, "x y  z\n\n q \t", "it's we'll I'd 'sx", "\x1c\x1d a\x85b᠎ c", "é" * 777, "ß 中文字 \U0001f600‍",
             "".join(rng.choice("abc ") for _ in range(9000)), "w" * 300 + " ", "՘࢏ \U0001e950x \U00011de1"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x3000), rng.randrange(0x10000, 0x32000)])) for _ in range(60)) for _ in range(400)]
    texts += ["".join(rng.choice(" \n\t'stre09é.,") for _ in range(80)) for _ in range(400)]
    for t in texts:
        assert list(vocab.encode(t)) == library.encode_ordinary(t), repr(t[:60])


def test_long_text_in_segments(library, vocab, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SEGMENT_CHARS", 50)
    t = "It's the  ndea éreaux, 12 34\n\n of' a' tions. " * 200
    assert list(vocab.encode(t)) == library.encode_ordinary(t)


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op2_byte_bpe(spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = library.encode_ordinary(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "ab", 5), (3, "ab", 5), (None, "é", None)], "doc_id long, text string, ids int")
    enc = byte_bpe.encode(df, PATH)
    rows = byte_bpe.decode(enc, PATH).collect()
    assert [bytes(r.decoded).decode() for r in rows] == ["", "", "ab", "ab", "é"]
    assert [r.ids for r in rows][:2] == [[], []]
    assert byte_bpe.decode(byte_bpe.encode(df.limit(0), PATH), PATH).collect() == []
    ids = spark.createDataFrame([(None,), ([-1, 50256, None],)], "ids array<int>")
    assert [r.decoded and bytes(r.decoded).decode() for r in byte_bpe.decode(ids, PATH).collect()] == [None, "�" * 3]
