"""Collocations by prefix-free parsing.

Texts are cut into pieces at punctuation, and pieces into chunks that overlap by `OVERLAP` words, wherever the hash of
a window of `OVERLAP` words says so (and every `LONGEST` words in a stretch without such a window). Equal text gives
equal chunks, so the dictionary of distinct chunks with their frequencies is what is counted, not the corpus. A chunk
owns the phrases that start before its closing overlap, and holds them whole, since phrases have at most
`OVERLAP` + 1 words: every occurrence is counted in one chunk, once, times the chunk's frequency.

Lengths are counted one after the other. A phrase can reach `min_count` only if both phrases of one word less inside
it do; those are marked in a bitmap of a fixed number of bits, which is all that is sent to the tasks. A false mark
lets a phrase be counted in vain and changes no count. Counts are exact: equal phrases are found by their words.

Defined results: a null text is empty and counts nothing; a null lang is `und`; rows that repeat count as often as
they are there; ties are ordered by phrase; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from retentia.llm.common import table, written

OVERLAP = 3
MAX_WORDS = OVERLAP + 1
TRIGGER = 12
LONGEST = 64
MIN_COUNT = 30
TOP = 2000
INSIDE_PERCENT = 80
SCALE = 2_000_000
# Bits of the map of frequent phrases: 8 MB at any size of the corpus.
MAP_BITS = 26
# Bits of one row of Spark's bitmap functions.
ROW_BITS = 32_768
PIECE = re.compile(rb"[.,;:!?\x0A-\x0D]")
# Bytes of distinct pieces after which a task hands on their chunks; it counts four times as many at once.
GROUP_BYTES = 4_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, apart for each lang."""
    import xxhash

    seed, digest = xxhash.xxh32_intdigest(lang.encode()), xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def phrase_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on; the last n - 1 places are left out."""
    size = max(0, len(words) - n + 1)
    out = words[:size].copy()
    for k in range(1, n):
        out *= _ODD
        out ^= out >> np.uint64(31)
        out += words[k : k + size]
    return out * _ODD


def chunk_bounds(sizes: np.ndarray, hashes: np.ndarray, trigger: int = TRIGGER, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, owned) of the chunks of pieces of these sizes that follow one another, from their word hashes."""
    ends = np.cumsum(sizes)
    first = ends - sizes
    marks = np.zeros(len(hashes), bool)
    windows = phrase_hashes(hashes, OVERLAP)
    marks[: len(windows)] = (windows >> np.uint64(17)) % np.uint64(trigger) == 0
    # The window lies in the piece.
    for k in range(1, OVERLAP):
        marks[np.maximum(ends - k, first)] = False
    marks[first] = True
    starts = np.flatnonzero(marks)
    if not len(starts):
        return starts, starts, starts

    def stops():
        return np.repeat(ends, np.add.reduceat(marks.astype(np.int64), first))

    stop = stops()
    after = np.append(starts[1:], len(hashes))
    far = np.flatnonzero(np.minimum(after, stop - OVERLAP) - starts > longest)
    if len(far):
        more = [np.arange(starts[k] + longest, min(after[k], stop[k] - OVERLAP + 1), longest) for k in far.tolist()]
        marks[np.concatenate(more)] = True
        starts = np.flatnonzero(marks)
        stop = stops()
        after = np.append(starts[1:], len(hashes))
    closing = after >= stop
    end = np.where(closing, stop, after + OVERLAP)
    return starts, end, np.where(closing, end - starts, end - starts - OVERLAP)


def dictionary(documents: DataFrame, trigger: int = TRIGGER, longest: int = LONGEST) -> DataFrame:
    """lang, chunk (words joined by one space), owned (phrase starts it counts), freq of every distinct chunk."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        held = 0

        def handed():
            names, tokens, hashes, sizes, weights, of_lang = list(counts), [], [], [], [], []
            for k, counter in enumerate(counts.values()):
                before = len(tokens)
                for piece, n in counter.items():
                    own = piece.split()
                    if own:
                        tokens += own
                        sizes.append(len(own))
                        weights.append(n)
                        of_lang.append(k)
                known = pa.array(tokens[before:], pa.binary()).dictionary_encode()
                hashes.append(word_hashes(names[k], known.dictionary.to_pylist())[known.indices.to_numpy()])
            starts, ends, owned = chunk_bounds(np.array(sizes, np.int64), np.concatenate(hashes), trigger, longest)
            of = np.searchsorted(np.cumsum(sizes), starts, side="right").tolist()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([names[of_lang[k]] for k in of], pa.string()),
                    pa.array([b" ".join(tokens[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
                    pa.array(owned, pa.int32()), pa.array([weights[k] for k in of], pa.int64()),
                ],
                ["lang", "chunk", "owned", "freq"],
            )

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                counter = counts.setdefault(lang, Counter())
                before = len(counter)
                value = text.as_py()
                counter.update(PIECE.split(value.lower()))
                held += len(value) if len(counter) > before else 0
                if held > GROUP_BYTES:
                    yield handed()
                    counts, held = {}, 0
        if counts:
            yield handed()

    rows = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(parsed, "lang string, chunk binary, owned int, freq long").groupBy("lang", "chunk", "owned").agg(F.sum("freq").alias("freq"))


@dataclass(frozen=True)
class Count:
    """Phrases of n words to count: by their words, or by their hash; those in the map, or whose parts of n - 1 words are."""

    n: int
    spelled: bool = True
    known: str | None = None  # None, "own" or "parts"


def count_block(lang: str, chunks: pa.Array, owned: np.ndarray, freq: np.ndarray, wanted: list[Count], bits: np.ndarray | None, shift: np.uint64) -> Iterator[pa.RecordBatch]:
    """Counts of one lang's chunks: lang, n, phrase (null where it is not spelled), hash, f."""
    split = pc.split_pattern(chunks, " ")
    sizes = np.diff(split.offsets.to_numpy())
    words = split.flatten().dictionary_encode()
    ids = words.indices.to_numpy().astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(ids)) - np.repeat(starts, sizes)
    left, own, weight = np.repeat(sizes, sizes) - place, place < np.repeat(owned, sizes), np.repeat(freq, sizes)
    hashes = word_hashes(lang, words.dictionary.to_pylist())[ids]

    def marked(n):
        places = (phrase_hashes(hashes, n) >> shift).astype(np.int64)
        return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1

    for count in wanted:
        n = count.n
        size = max(0, len(ids) - n + 1)
        at = own[:size] & (left[:size] >= n)
        if count.known == "own":
            at &= marked(n)
        elif count.known == "parts":
            parts = marked(n - 1)
            at &= parts[:size] & parts[1 : 1 + size]
        at = np.flatnonzero(at)
        hashed = phrase_hashes(hashes, n)[at]
        if count.spelled:
            key = ids[at]
            for k in range(1, n):
                key = (np.unique(key, return_inverse=True)[1] if k > 1 else key) << 32 | ids[at + k]
        else:
            key = hashed
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        total = np.add.reduceat(weight[at][order], first) if len(first) else np.zeros(0, np.int64)
        one = order[first]
        phrase = pa.nulls(len(one), pa.binary())
        if count.spelled:
            parts = [words.dictionary.take(pa.array(ids[at[one] + k])) for k in range(n)]
            phrase = pc.binary_join_element_wise(*parts, b" ") if n > 1 else parts[0]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang], pa.string()).take(pa.array(np.zeros(len(one), np.int64))), pa.array(np.full(len(one), n, np.int32)), phrase,
                pa.array(hashed[one].view(np.int64)), pa.array(total),
            ],
            ["lang", "n_words", "phrase", "hash", "f"],
        )


def count_phrases(chunks: DataFrame, wanted: list[Count], frequent: bytes | None = None, map_bits: int = MAP_BITS) -> DataFrame:
    """lang, n_words, phrase, hash, f of the wanted phrases; `frequent` is the map that `known` asks."""
    sent = None if frequent is None else chunks.sparkSession.sparkContext.broadcast(frequent)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if sent is None else np.frombuffer(sent.value, np.uint8)
        held, size = [], 0

        def handed():
            block = pa.Table.from_batches(held).combine_chunks()
            langs = block.column("lang").combine_chunks().dictionary_encode()
            codes = langs.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            edges = np.searchsorted(codes[order], np.arange(len(langs.dictionary) + 1)).tolist()
            for lang, low, high in zip(langs.dictionary.to_pylist(), edges, edges[1:]):
                part = block.take(pa.array(order[low:high]))
                chunk, owned, freq = (part.column(c).combine_chunks() for c in ("chunk", "owned", "freq"))
                yield from count_block(lang, chunk, owned.to_numpy(), freq.to_numpy(), wanted, bits, np.uint64(64 - map_bits))

        for batch in batches:
            held.append(batch)
            size += batch.column("chunk").nbytes
            if size > GROUP_BYTES * 4:
                yield from handed()
                held, size = [], 0
        if held:
            yield from handed()

    found = chunks.mapInArrow(counted, "lang string, n_words int, phrase binary, hash long, f long")
    return found.groupBy("lang", "n_words", "phrase", "hash").agg(F.sum("f").alias("f"))


def marks(counts: DataFrame, map_bits: int = MAP_BITS) -> bytes:
    """The map of the phrases in `counts`: 2^map_bits bits, joined from rows of ROW_BITS bits."""
    place = F.shiftrightunsigned("hash", 64 - map_bits)
    rows = counts.groupBy(F.floor(place / ROW_BITS).cast("int").alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits"))
    out = bytearray((1 << map_bits) // 8)
    for row in rows.collect():  # at most 2^map_bits / ROW_BITS rows of 4 KB
        out[row["row"] * ROW_BITS // 8 : (row["row"] + 1) * ROW_BITS // 8] = row["bits"]
    return bytes(out)


def frequent_phrases(chunks: DataFrame, min_count: int = MIN_COUNT, map_bits: int = MAP_BITS) -> DataFrame:
    """lang, n_words, phrase, f of all phrases of 1 to 4 words that occur at least `min_count` times."""
    known, found = None, []
    # Pairs of frequent words are many: they are counted by hash first, and spelled where that count is high enough.
    for k, wanted in enumerate(([Count(1)], [Count(2, False, "parts")], [Count(2, True, "own"), Count(3, True, "parts")], [Count(4, True, "parts")])):
        level = written(count_phrases(chunks, wanted, known, map_bits).where(F.col("f") >= min_count), f"op12-phrases{k}")
        found.append(level.where("phrase IS NOT NULL").select("lang", "n_words", F.col("phrase").cast("string").alias("phrase"), "f"))
        known = marks(level.where(F.col("n_words") == k + 1), map_bits) if k < 3 else None
    return reduce(DataFrame.unionByName, found)


def exact(value: str | int) -> Column:
    return F.lit(value).cast("decimal(38,0)") if isinstance(value, int) else F.col(value).cast("decimal(38,0)")


def mine_collocations(documents: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, salts: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` collocations of every lang."""
    chunks = written(dictionary(documents), "op12-chunks")
    phrases = written(frequent_phrases(chunks, min_count), "op12-phrases")
    parts = phrases.select("lang", "phrase", "f")
    of_lang = chunks.groupBy("lang").agg(F.sum(F.col("owned") * F.col("freq")).alias("n"))
    longer = phrases.where("n_words > 1").select("lang", "n_words", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cut = longer.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, n_words - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"), F.expr("array_join(slice(w, k + 1, size(w)), ' ')").alias("right")
    )
    lefts = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # Floored quotient of exact decimals: quotients are below 2,000,000.
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(38,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = (
        cut.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )
    within = longer.where("n_words > 2").select(
        "lang", "a", F.explode(F.expr("flatten(transform(sequence(2, n_words - 1), n -> transform(sequence(1, n_words - n + 1), i -> array_join(slice(w, i, n), ' '))))")).alias("phrase")
    )
    covered = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(covered, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (exact(100) * exact("longer") < exact(INSIDE_PERCENT) * exact("a"))
    )
    # The best of every salt first, so that no lang meets in one task.
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(of_lang, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score").withColumn("rank", F.col("rank").cast("long"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, unnest(w) AS w1, unnest(w[2:]) AS w2, unnest(w[3:]) AS w3, unnest(w[4:]) AS w4 FROM p),
f AS (SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS m, w1 AS phrase FROM g WHERE w1 IS NOT NULL
    UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM g WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM g WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM g WHERE w4 IS NOT NULL) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
cut AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp FROM c, range(1, 4) x(k) WHERE k < m),
s AS (SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r,
    CAST(CAST(2000000 AS HUGEINT) * a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.lp JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rp),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM s) WHERE o = 1),
sub AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(a) AS longer
  FROM c, range(1, 4) x(i), range(2, 4) y(n) WHERE n < m AND i + n - 1 <= m GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN sub USING (lang, phrase) WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
JOIN (SELECT lang, count(w1) AS n FROM g GROUP BY lang) USING (lang) WHERE rank <= 2000
"""

QUERIES = {"op12_collocations": op12_collocations}
ORACLES = {"op12_collocations": ORACLE}
