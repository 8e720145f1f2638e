"""Near-duplicate groups against all pairs of exact shingle sets."""

import random

import numpy as np
import pytest

from retentia.llm import op5_near_dedup as dedup

DOC = "doc_id long, text string, lang string, digest int, key string"


def brute(rows, percent=85, size=3):
    """Row -> (set size, component) by union-find over all pairs; nodes are doc_ids."""
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset([tuple(w)] if 0 < len(w) < size else zip(*[w[i:] for i in range(size)])))
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                parent[y] = x
    return sorted(
        ((d, len(s), find(d) if d is not None else None, find(d) == d if d is not None else True) for (d, *_), s in zip(rows, sets)), key=str
    )


def got(frame, *args):
    return sorted((tuple(r) for r in dedup.near_duplicates(frame, *args).collect()), key=str)


def corpus(seed, n, words, edits):
    """Chains and groups of near copies around the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, base = [], None
    for k in range(n):
        if base is None or rng.random() < 0.25:
            base = [rng.choice(vocabulary) for _ in range(rng.randint(*words))]
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            base = text
        rows.append((k * 13 % 1009, rng.choice([" ".join, "\n".join])(text).replace("w1", rng.choice(["w1", "W1"])), "en", k, None))
    return rows


@pytest.mark.parametrize("seed, words, edits", [(1, (30, 120), 4), (2, (5, 25), 1)])
def test_components(spark, seed, words, edits):
    rows = corpus(seed, 260, words, edits)
    assert got(spark.createDataFrame(rows, DOC)) == brute(rows)


def test_other_shingles(spark):
    rows = corpus(3, 150, (30, 120), 3)
    assert got(spark.createDataFrame(rows, DOC), 80, 5) == brute(rows, 80, 5)


def test_defined_results(spark):
    long = " ".join(f"x{k}" for k in range(20_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", 1, "k"), (3, " \n\t", "en", 1, "k"), (4, "one", "", 1, ""), (5, "One", "", 1, ""), (6, "one two", "", 1, ""), (7, "one  two", "", 1, ""),
        (8, "one two three", "", 1, ""), (None, "one", "", 1, ""), (None, None, "", 1, ""), (9, long, "", 1, ""), (10, long + " y", "", 1, ""), (10, long + " y", "", 1, ""),
        # A repeated id joins the groups of its texts.
        (20, "a b c d e f", "", 1, ""), (21, "a b c d e f", "", 1, ""), (20, "p q r s t u", "", 1, ""), (22, "p q r s t u", "", 1, ""), (11, "é É a", "", 1, ""), (12, "É É a", "", 1, ""),
    ]
    frame = spark.createDataFrame(rows, DOC)
    assert got(frame) == brute(rows)
    kept = dedup.deduplicate(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 6, 8, 9, 11, 12, 20, 20]
    assert dedup.near_duplicates(frame.limit(0)).collect() == []


def hot_group(n=130):
    """Copies of one text with several words changed: some link, some do not, all share buckets."""
    rng = random.Random(12)
    base = [f"t{k}" for k in range(120)]
    rows = []
    for k in range(n):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6])):
            text[rng.randrange(len(text))] = f"n{rng.randrange(10_000)}"
        rows.append((k * 7 % 131, " ".join(text), "en", k, None))
    return rows


@pytest.mark.parametrize("small", [0, 8, 1000])
def test_hot_group(spark, small):
    rows = hot_group()
    want = brute(rows)
    assert 10 < len({w[2] for w in want}) < 120
    got_rows = dedup.near_duplicates(spark.createDataFrame(rows, DOC), small_bucket=small).collect()
    assert sorted((tuple(r) for r in got_rows), key=str) == want


def test_cells_join_all_linked_components(spark):
    """Blocks of any size leave the components that all pairs of the bucket give; few links leave them."""
    rows = hot_group(90)
    sets = {d: dedup.shingle_set(t) for d, t, *_ in rows}
    nodes = sorted(sets)
    signatures = {d: dedup.signature(x) for d, x in sets.items()}
    label = {d: d for d in nodes} | {d: nodes[0] for d in nodes[:30]}
    classes = spark.createDataFrame([(d, bytearray(signatures[d].tobytes())) for d in nodes], "rep long, signature binary")
    hashes = spark.createDataFrame([(d, bytearray(sets[d].tobytes())) for d in nodes], "node long, shingles binary")
    labels = spark.createDataFrame(list(label.items()), "node long, label long")
    # One bucket per band holds all nodes: every pair with a common band is tested once.
    members = spark.createDataFrame([(b, b, d) for b in range(dedup.BANDS) for d in nodes], "key long, band int, node long")
    mixed = dedup.mixed_buckets(members, labels)
    parent = dict(label)

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for i in nodes:
        for j in nodes:
            if i < j and dedup.first_band(signatures[i][None], signatures[j][None])[0] >= 0 and dedup.similar(sets[i], [sets[j]], 85)[0]:
                x, y = sorted((find(label[i]), find(label[j])))
                parent[y] = x
    want = {d: find(label[d]) for d in nodes}
    for block in (7, 40, 256):
        links = dedup.large_bucket_links(mixed, classes, hashes, 85, block)
        assert {r["node"]: r["label"] for r in dedup.relabel(labels, links).collect()} == want
    pairs = {(r["a"], r["b"]) for r in dedup.small_bucket_pairs(mixed, classes, 85).collect()}
    assert all(label[a] != label[b] for a, b in pairs) and {(a, b) for a, b in pairs if dedup.similar(sets[a], [sets[b]], 85)[0]}


def test_sequential_test_keeps_similar_pairs():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 1 << 32, (4000, dedup.HASHES)).astype("<u4")
    for similarity, least, most in ((0.85, 0.999, 1.0), (0.95, 1.0, 1.0), (0.3, 0.0, 0.0), (0.5, 0.0, 0.01)):
        b = np.where(rng.random(a.shape) < similarity, a, a + 1)
        share = (dedup.surviving(a, b, 85) >= 0).mean()
        assert least <= share <= most, similarity


def test_relabel(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(250, k) for k in range(201, 300)]
    labels = spark.createDataFrame([(k, k) for k in range(300)], "node long, label long")
    found = {r["node"]: r["label"] for r in dedup.relabel(labels, spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = list(range(300))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert found == {k: find(k) for k in range(300)}


@pytest.mark.parametrize("edges_a_task, most", [(50_000, 1), (16, 8)])
def test_rounds_take_as_many_tasks_as_their_edges_need(spark, monkeypatch, edges_a_task, most):
    """A small label graph is not dealt over every shuffle partition, round by round."""
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    tasks = []

    def written(df, label):
        if label in ("op5-roots", "op5-moved"):
            tasks.append(df.rdd.getNumPartitions())
        return keep(df, label)

    keep = dedup.written
    monkeypatch.setattr(dedup, "written", written)
    monkeypatch.setattr(dedup, "EDGES_A_TASK", edges_a_task, raising=False)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        labels = spark.createDataFrame([(k, k) for k in range(70)], "node long, label long")
        links = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] * 2, "a long, b long")
        found = {r["node"]: r["label"] for r in dedup.relabel(labels, links).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {k: 0 if k <= 60 else k for k in range(70)}
    assert len(tasks) > 2 and max(tasks) <= most


def test_likeliest(spark):
    """Most matches first, then the smaller partner; ids may be any long."""
    low = -(1 << 63)
    pairs = spark.createDataFrame([(1, 2, 90), (1, 3, 95), (2, 3, 95), (low, 4, 80), (4, 5, 80)], "a long, b long, matches long")
    assert sorted(tuple(r) for r in dedup.likeliest(pairs).collect()) == [(low, 4), (1, 3), (2, 3), (4, 5)]
