"""Token counts, wavelet shards and SentencePiece: against the libraries themselves and exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from retentia.llm.op1_wavelet import WaveletShard, read_documents, write_shards
from retentia.llm.op8_token_counts import count_tokens
from retentia.llm.pretokens import PretokenCounter, PretokenEncoder, byte_groups, shared
from retentia.session import scratch

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "Hello, World!! it's 1234 ok", "don't  you'll\tI'M they'RE ''s 's's", "Èleou ouêen Straße ÄÖÜ ñandú ciónÓRR", "İstanbul ŉ ſ",
    "a<|endoftext|>b <|startoftext|>", "<| endoftext |>", "日本語テスト 1２3", "é ö x́", "🙂🙂 ok​zero﻿", "\x00\x01\x1c\x1d\x85\xa0x",
    "***###$$$ %%% !! _a_b_ __", "ﬁ ﬂ ½ ² ³ ª º µ", "x" * 5000, "a b " * 3000, "’s – “q” …", "²a2b½", "ΑΣ ΣΑΣ",
]
DOC = "doc_id long, text string, extra int, n_tokens string"


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_every_character_as_the_library():
    encoder, lib = shared(PretokenEncoder, PATH), library()
    chars = [c for c in map(chr, range(0x3000)) if encoder.plain(c)]
    assert len(chars) > 350
    texts = [f"a{c}b {c}{c} {c}1 '{c}s x{c}'ll" for c in chars]
    want = [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.id_bytes(texts) == want


def test_whole_tokens_are_single():
    counter, lib = shared(PretokenCounter, PATH), library()
    assert len(counter.whole) > 20_000
    for token in random.Random(1).sample(sorted(counter.whole), 500):
        assert len(lib.encode(token, add_special_tokens=False).ids) == 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x17F, exclude_categories=["Cs"]), st.sampled_from("'<|>lrsvdtme \n’—")), max_size=40), max_size=4))
def test_random_texts_as_the_library(texts):
    lib = library() if not hasattr(test_random_texts_as_the_library, "lib") else test_random_texts_as_the_library.lib
    test_random_texts_as_the_library.lib = lib
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert shared(PretokenCounter, PATH).counts(texts) == [len(w) for w in want]
    assert shared(PretokenEncoder, PATH).id_bytes(texts) == [np.array(w, "<u4").tobytes() for w in want]


def test_small_cache_gives_the_same():
    encoder = PretokenEncoder(PATH)
    encoder.cache.limit = 3
    assert encoder.id_bytes(TEXTS) == shared(PretokenEncoder, PATH).id_bytes(TEXTS)


def test_new_words_are_merged_together():
    encoder, lib = PretokenEncoder(PATH), library()
    encoder.merge = None  # one pre-token at a time
    words = ["".join(random.Random(i).choices("abcdeéñöß'.,$17ÀZ", k=12)) for i in range(5000)]
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 40)] + ["", "a\x0bb\x0cc\rd\te\nf g\x1fh\x85i\xa0j\u2003k", "\n\n x \t"]
    want = [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.id_bytes(pa.array(texts)) == want
    assert encoder.id_bytes(pa.array(["x", *texts]).slice(1)) == want


def test_one_odd_word_takes_its_texts_whole():
    encoder, lib = PretokenEncoder(PATH), library()
    texts = ["one two", "two 日本 one", "one", "İ one", "日本 two", "two<|endoftext|>", "", "Σ two ΑΣ", "e\u0301 one", "one two"]
    for _ in range(2):
        assert encoder.id_bytes(texts) == [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_byte_groups_hold_every_row_once():
    texts = ["", "é" * 3, "abc", "", "x" * 50, "y", "", ""]
    for limit in (1, 6, 9, 1000):
        groups = list(byte_groups(pa.array(texts), limit))
        assert [t for _, g in groups for t in g.to_pylist()] == texts
        assert [first for first, _ in groups] == np.cumsum([0, *(len(g) for _, g in groups)])[:-1].tolist()
        assert all(len(g) == 1 or sum(len(t.encode()) for t in g.to_pylist()) <= limit for _, g in groups)
    assert list(byte_groups(pa.array([], pa.string()))) == []


def test_counts(spark):
    rows = [(i, t, i, "x") for i, t in enumerate(TEXTS)] + [(None, "a b", 1, None), (3, None, None, None), (3, None, None, None)]
    got = count_tokens(spark.createDataFrame(rows, DOC), PATH, 5).collect()
    lib = library()
    want = sorted(
        (-1 if i is None else i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 5) for i, t, *_ in rows
    )
    assert sorted((-1 if r[0] is None else r[0], r[1], r[2], r[3]) for r in got) == want
    assert count_tokens(spark.createDataFrame([], DOC), PATH).collect() == []


def test_wavelet_rank_select():
    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 1), (5, 2), (200_000, 49_408), (70_000, 3), (1000, 1 << 20)):
        ids = rng.integers(0, top, n).astype("<u4")
        ids[: n // 3] = 1 if top > 1 else 0
        shard = WaveletShard(WaveletShard.build([1], [n], ids))
        assert (shard.decode() == ids).all()
        for i in rng.integers(0, n, 20).tolist() if n else []:
            assert shard.access(i) == ids[i]
            token = int(ids[i])
            assert shard.count(token) == (ids == token).sum() and shard.count(token, i) == (ids[:i] == token).sum()
            if (ids == token).sum() < 50:
                assert shard.locate(token) == np.flatnonzero(ids == token).tolist()
        assert shard.count(top + 5) == 0 and shard.locate(top + 5) == []


@pytest.mark.parametrize("limit", [7, 1 << 20])
def test_shards(spark, limit):
    rows = [(i * 7 % 23, t, i, "x") for i, t in enumerate(TEXTS)] + [(None, "a b", 1, None), (3, None, None, None), (3, "b", 1, ""), (3, "b", 2, "")]
    path = scratch(spark, "test-shards")
    write_shards(spark.createDataFrame(rows, DOC).repartition(3), path, PATH, shard_tokens=limit)
    lib, start, want = library(), 0, []
    for i, t in sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = lib.encode(t, add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = read_documents(spark, path).orderBy("start").collect()
    assert [tuple(r) for r in got] == want


def test_no_documents(spark):
    path = scratch(spark, "test-shards")
    write_shards(spark.createDataFrame([], DOC), path, PATH)
    assert read_documents(spark, path).collect() == []
