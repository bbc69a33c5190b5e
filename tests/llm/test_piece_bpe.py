"""SentencePiece encoding, spans and decoding against the library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from estate.llm import piece_bpe, queries

SMALL = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("piece_bpe_32k.model")
CHARS = list(" " * 12 + "\n\t abcdefeeentinthe ABé漢字ｶﾞ①ＡÅﬁ…😀¨​́ñ▁.,'0123456789 　\x01﻿ﷺ")
WORDS = ["the", "New York", "ab ", "ciónllta", "  ", "hello", "<s>", "<0x41>", "▁", "ｶﾞｶﾞ", "ﬁne", "​", " ​ ", "é"]


def model(rule=None, squeeze=False, user=False, prefix=True) -> bytes:
    """The public model with one of the library's own character maps."""
    m = proto.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    if rule:
        spec = proto.NormalizerSpec()
        spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
        m.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
    m.normalizer_spec.remove_extra_whitespaces = squeeze
    m.normalizer_spec.add_dummy_prefix = prefix
    if user:                                               # user-defined pieces, no byte fallback
        for i, p in ((31000, "New▁York"), (30000, "ab▁")):
            m.pieces[i].type, m.pieces[i].piece = piece_bpe.USER, p
        m.trainer_spec.byte_fallback = False
        for p in m.pieces:
            if p.type == piece_bpe.BYTE:
                p.type = piece_bpe.NORMAL
    return m.SerializeToString()


def texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        if rng.random() < 0.5:
            yield "".join(rng.choice(CHARS) for _ in range(rng.randint(0, 30)))
        else:
            yield " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 12)))


@pytest.mark.parametrize("part", [8, 256 * 1024])
@pytest.mark.parametrize("kind", [{}, {"rule": "nmt_nfkc"}, {"rule": "nmt_nfkc", "squeeze": True}, {"rule": "nfkc_cf", "squeeze": True},
                                  {"user": True}, {"rule": "nfkc_cf", "user": True, "prefix": False}, {"squeeze": True, "prefix": False}])
def test_equals_library(kind, part, monkeypatch):
    monkeypatch.setattr(piece_bpe, "SEGMENT_CHARS", part)
    raw = model(**kind)
    theirs, ours = sentencepiece.SentencePieceProcessor(model_proto=raw), piece_bpe.Model(raw)
    rng = random.Random(3)
    for t in texts(600, part):
        ids, cuts = ours.encode(t) if t else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        pieces = theirs.encode(t, return_type="proto").pieces
        assert (ids.tolist(), list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))) == ([p.id for p in pieces], [(p.begin, p.end) for p in pieces]), t
        some = [rng.choice([rng.randint(0, 31999), rng.randint(0, 260), 28705, 259, 260]) for _ in range(rng.randint(0, 8))]
        for want in (ids.tolist(), some):
            assert ours.decode(np.array(want, np.int64), np.array([0, len(want)])) == [theirs.decode(want)]


def test_character_map_is_read_whole():
    raw = model("nmt_nfkc")
    m, rules = piece_bpe.Model(raw).map, sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    assert m.longest("ﬁx".encode(), 0) == (3, b"fi") and m.longest(b"x", 0) is None
    for c in "Ａ\u212b①ｶ":
        assert m.longest(c.encode(), 0)[1].decode() == rules.normalize(c).lstrip(piece_bpe.MARK)


def test_refuses_other_models():
    m = proto.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    with pytest.raises(ValueError):
        piece_bpe.Model(m.SerializeToString())


def test_frame(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    long = "word " * 120_000 + "é" * 30_000 + "漢" * 100 + " " * 50
    rows = [(1, "Hello  world", 5), (1, "Hello  world", 5), (2, None, 6), (3, "", 7), (4, long, 8), (None, " 漢鼟 ", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(2)
    coded = piece_bpe.encode(df, PATH)
    assert coded.columns == ["doc_id", "text", "ids", "cuts"]
    out = piece_bpe.decode(coded, PATH).collect()
    assert sorted(map(str, out)) == sorted(map(str, piece_bpe.encode(df, PATH, decoded_col="decoded").collect()))
    assert len(out) == len(rows)
    for r in out:
        want = sp.encode(r.text or "")
        assert r.ids == want and r.decoded == sp.decode(want)
        raw = (r.text or "").encode()
        assert b"".join(raw[a:b] for a, b in zip(r.cuts, r.cuts[1:])) == raw
    assert piece_bpe.encode(df.limit(0), PATH).collect() == []
    odd = spark.createDataFrame([(None,), ([0, 1, 2, None, 99999, 300],), ([],)], "ids array<int>")
    assert [r.decoded for r in piece_bpe.decode(odd, PATH).collect()] == [None, " ⁇ \ufffd\ufffd" + sp.id_to_piece(300).replace("▁", " "), ""]


def test_query_equals_library(spark):
    import hashlib
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts_by_id = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op12_sentencepiece(spark, SMALL).collect()
    assert len(got) == len(texts_by_id)
    for r in got:
        ids = sp.encode(texts_by_id[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
