"""Collocations against plain counting; chunks against their definition."""

import re
from collections import Counter

import numpy as np
import pytest

from retentia.llm import op12_collocations as mine

DOC = "doc_id long, text string, lang string, phrase string, f long, n int, rank string"
REPEATED = "alpha beta gamma delta. Alpha  Beta\tgamma, delta alpha beta; x"
ROWS = [
    (1, REPEATED, "en"), (1, REPEATED, "en"), (2, None, "en"), (3, "", None), (4, " .,;\t \n", "fr"), (5, "alpha beta gamma delta " * 40, "en"),
    (6, "one " * 500, None), (7, "one one one", "und"), (None, "Éa Éa Éa\x00 b\x85c \x0b Éa Éa", "fr"), (8, "ÉA éa Éa Éa. Éa Éa", "fr"), (9, "a b c d e f g h. " * 9, "de"), (10, "b c d. " * 3, "de"),
]


def brute(rows, min_count, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", *w[i : i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    chosen = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    out = []
    for (lang, *w), a in chosen.items():
        score, k, l, r = min((2_000_000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w)))
        longer = [b for (g, *v), b in chosen.items() if g == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if not any(100 * b >= 80 * a for b in longer):
            out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    out.sort()
    ranks, rows = Counter(), []
    for lang, score, a, phrase, l, r in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            rows.append((lang, ranks[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, "r") for r in rows], DOC)


@pytest.mark.parametrize("min_count, top", [(1, 2000), (2, 3), (9, 2000), (30, 2000)])
def test_counts(spark, min_count, top):
    got = mine.mine_collocations(frame(spark, ROWS), min_count, top)
    assert sorted(map(tuple, got.collect())) == sorted(brute(ROWS, min_count, top))


def test_small_groups(spark, monkeypatch):
    """Tasks that hand on after every text, and a map so small that most places are taken."""
    monkeypatch.setattr(mine, "GROUP_BYTES", 1)
    chunks = mine.dictionary(frame(spark, ROWS), trigger=3, longest=5)
    got = mine.frequent_phrases(chunks, 2, 15).select("lang", "n_words", "phrase", "f").collect()
    want = Counter()
    for _, text, lang in ROWS:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang or "und", m, " ".join(w[i : i + m])) for m in range(1, 5) for i in range(len(w) - m + 1))
    assert sorted(map(tuple, got)) == sorted((*k, v) for k, v in want.items() if v >= 2)


def test_empty_table(spark):
    assert mine.mine_collocations(frame(spark, ROWS).limit(0)).collect() == []


def test_chunks_own_every_start_once():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 2, 3, 4, 700, 5, 1, 90, 3, 64, 67, 68, 69])
    same = np.full(int(sizes.sum()), 7, np.uint64)
    for hashes in (rng.integers(0, 2**63, int(sizes.sum())).astype(np.uint64), same):
        for trigger in (1, 3, 12, 10**9):
            starts, ends, owned = mine.chunk_bounds(sizes, hashes, trigger)
            assert (np.concatenate([np.arange(a, a + o) for a, o in zip(starts, owned)]) == np.arange(sizes.sum())).all()
            last = np.repeat(np.cumsum(sizes), sizes)
            for a, b, o in zip(starts, ends, owned):
                assert b <= last[a] and b - a <= max(mine.LONGEST + 2 * mine.OVERLAP, 0) + mine.LONGEST
                assert all(min(i + mine.MAX_WORDS, last[i]) <= b for i in range(a, a + o))
