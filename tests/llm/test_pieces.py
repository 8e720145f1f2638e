"""SentencePiece coding against the sentencepiece library, BPE and a small handmade unigram model."""

import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st

from retentia.llm.op9_pieces import ModelFile, PieceCoder, digest_documents, encode_documents
from retentia.llm.pretokens import shared

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "  a   b  ", "Hello, World!\n\n  new\tline ", "Èleou ouêen Straße", "▁ marker ▁▁x", "<s> </s> <unk> <0x0A>",
    "日本語🙂 ok", "\x00\x01", "x" * 3000, "the of and " * 500, " " * 40 + "end",
]
DOC = "doc_id long, text string, ids string, lossless int"


def test_bpe_as_sentencepiece():
    coder = shared(PieceCoder, PATH)
    assert coder.by_word
    want = coder.reference.encode(TEXTS)
    assert [i.tolist() for i in coder.encode(TEXTS)] == want
    assert [e.ids for e in coder.library.encode_batch(TEXTS, add_special_tokens=False)] == want
    assert coder.decode([np.array(w) for w in want]) == coder.reference.decode(want)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" abethoninr.\n▁<>0x"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_random_texts(text):
    coder = shared(PieceCoder, PATH)
    ids = coder.encode([text])
    assert ids[0].tolist() == coder.reference.encode(text)
    if "▁" not in text:
        assert coder.decode(ids) == [text]
    assert coder.encode_checked([text])[1] == [0] and coder.decode_checked(ids, [text]) == (coder.decode(ids), [0])


def field(number, value):
    if isinstance(value, int):
        return bytes([number << 3 & 0x7F | 0x80 * (number > 15)]) + (bytes([number >> 4]) if number > 15 else b"") + bytes([value])
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    size = len(value)
    return bytes([number << 3 | 2]) + (bytes([size]) if size < 128 else bytes([size & 0x7F | 0x80, size >> 7])) + value


def unigram_model(tmp_path):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    for k, p in enumerate(["▁", "a", "b", "c", "ab", "▁a", "bc", "▁ab", "abc", "▁c", "ca"]):
        pieces.append((p, -1.0 - 0.37 * k, 1))
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, t)) for p, s, t in pieces)
    data += field(2, field(3, 1)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 1) + field(5, 1))
    path = tmp_path / "unigram.model"
    path.write_bytes(data)
    return str(path)


def test_unigram_as_sentencepiece(tmp_path):
    coder = PieceCoder(unigram_model(tmp_path))
    assert not coder.by_word
    texts = ["abc", "ab c", " abcab  ca ", "aabbcc", "xyz a", "cab abc bca"]
    ids, differ = coder.encode_checked(texts)
    assert [i.tolist() for i in ids] == coder.reference.encode(texts)
    assert differ == [0] * len(texts) and coder.decode_checked(ids, texts) == (coder.reference.decode(coder.reference.encode(texts)), [0] * len(texts))


def test_decode_as_the_pipeline():
    """Any ids: plain pieces, bytes that do not form characters, control pieces."""
    coder, rng = shared(PieceCoder, PATH), np.random.default_rng(6)
    ids = [rng.integers(0, 32000, n) for n in (1, 5, 300)] + [rng.integers(0, 260, 40) for _ in range(30)] + [np.array([29871, 29871, 13]), np.zeros(0, int)]
    assert coder.decode(ids) == [coder.library.decode(i.tolist(), skip_special_tokens=False) for i in ids]


def test_protobuf_settings():
    model = ModelFile(open(PATH, "rb").read())
    assert len(model.pieces) == 32000 and model.byte_fallback and model.dummy_prefix and not model.squeeze and model.unk == 0


def test_documents(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, None, None, None), (3, "dup", None, 0), (3, "dup", None, 0)]
    frame = spark.createDataFrame(rows, DOC)
    coder = shared(PieceCoder, PATH)

    def key(r):
        return (r[0] is not None, r[0] or 0, r[1])

    want = []
    for i, t, *_ in rows:
        ids = coder.reference.encode(t or "")
        back = coder.reference.decode(ids)
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), hashlib.sha256(back.encode()).hexdigest(), back == (t or ""), 0))
    assert sorted((tuple(r) for r in digest_documents(frame, PATH).collect()), key=key) == sorted(want, key=key)
    full = encode_documents(frame, PATH).collect()
    assert sum(r["differ"] for r in full) == 0 and sorted(len(r["ids"]) for r in full) == sorted(w[1] for w in want)
    assert digest_documents(spark.createDataFrame([], DOC), PATH).collect() == []


def test_a_wrong_pipeline_is_seen():
    """Merges lost from the rebuilt model, and a decoder that spells wrongly: counted, and sentencepiece's results are given."""
    from tokenizers import decoders, models

    coder = PieceCoder(PATH)
    texts = ["hello world", "", "the other"]
    fine = coder.encode_checked(texts)
    assert fine[1] == [0, 0, 0]
    broken = PieceCoder(PATH)
    pieces = broken.model.pieces
    broken.library.model = models.BPE(vocab={p: i for i, p in enumerate(pieces)}, merges=[], unk_token=pieces[broken.model.unk], byte_fallback=True, fuse_unk=True)
    broken.inner.decoder = decoders.Sequence([decoders.Replace("▁", "_"), decoders.ByteFallback(), decoders.Fuse()])
    ids, differ = broken.encode_checked(texts)
    assert differ == [2, 0, 2] and [i.tolist() for i in ids] == [i.tolist() for i in fine[0]]
    back, odd = broken.decode_checked(ids, texts)
    assert back == texts and odd == [1, 0, 1]
    assert broken.decode(ids) == ["_hello_world", "", "_the_other"]


def test_small_tables(monkeypatch):
    """Tables that start anew with every call give the same."""
    from retentia.llm import op9_pieces

    want = shared(PieceCoder, PATH).reference.encode(TEXTS)
    monkeypatch.setattr(op9_pieces, "TABLE_BYTES", 1000)
    coder = PieceCoder(PATH)
    for _ in range(2):
        ids = coder.encode(TEXTS)
        assert [i.tolist() for i in ids] == want and coder.decode(ids) == coder.reference.decode(want)


def test_each_word_once(monkeypatch):
    """Words of all calls go to the libraries once each, and only texts with the marker are decoded stretch by stretch."""
    coder, asked = PieceCoder(PATH), []
    encoded = coder._encoded
    monkeypatch.setattr(coder, "_encoded", lambda words: asked.extend(words) or encoded(words))
    ids, back, differ = coder.coded(TEXTS)
    again = coder.coded(TEXTS[::-1])
    want = coder.reference.encode(TEXTS)
    assert [i.tolist() for i in ids] == want == [i.tolist() for i in again[0]][::-1]
    assert back == coder.reference.decode(want) == again[1][::-1] and differ == again[2] == [0] * len(TEXTS)
    words = [w for t in TEXTS if t for w in PieceCoder.words(t) if w]
    long = [w for w in words if len(w) > 256]
    assert sorted(asked) == sorted([*set(words), *long])
    assert set(coder.texts.young) == {s for k, t in enumerate(TEXTS) if "▁" in t for s in coder._stretches(ids[k])}


def test_words_that_decode_otherwise(monkeypatch):
    """A decoder that loses a word: texts with it, and only those, are not lossless by the pipeline and take sentencepiece's text."""
    coder = PieceCoder(PATH)
    inner = coder.inner

    class Losing:
        def decode_batch(self, ids, skip_special_tokens):
            return [t.replace("other", "") for t in inner.decode_batch(ids, skip_special_tokens=skip_special_tokens)]

    coder.inner = Losing()
    texts = ["hello world", "the other", "", "  other  one ", "one"]
    for _ in range(2):
        ids, back, differ = coder.coded(texts)
        assert back == texts and differ == [0, 1, 0, 1, 0]
