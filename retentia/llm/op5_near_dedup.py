"""Near-duplicate groups: MinHash bands, sequential Bayesian verification, exact confirmation.

1. One scan gives each text its shingle set's size, digest and MinHash signature. Equal sets are one class, so
   exact copies, however many, go on as one row.
2. Classes meet in band buckets. A bucket is first compared as a star around one member chosen by hash (another in
   each bucket), so its cost is linear in its size.
3. Signatures of a candidate pair are compared batch by batch; a pair is dropped once the posterior probability that
   its similarity reaches the threshold is below MISS (uniform prior). Survivors are confirmed on full shingle sets:
   first each class's likeliest partner, then what still crosses components.
4. Buckets whose members are still in different components are compared completely, members of the bucket's largest
   component only with the others, each pair only in its first common band. Small buckets give their surviving pairs to
   step 3; large ones are cut into blocks and confirmed inside tasks, and only links that join components leave a task.

A link of similarity t is missed only if no band of both signatures agrees ((1 - t^5)^26, 3e-7 at 0.85) or with
probability MISS. Links join components whose label is the smallest doc_id.

Defined results: null or wordless texts have an empty set and link with nothing. Rows that repeat a doc_id are one
document: their components are one, and all stay or all go. Null doc_ids link with nothing, have a null component
and are kept. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia.llm.common import Made, held, table, without, written
from retentia.llm.pretokens import text_groups

SHINGLE = 3
PERCENT = 85
BANDS = 26
ROWS = 5
HASHES = BANDS * ROWS
MISS = 1e-6
BATCH = 26
# Buckets up to this size give their pairs to the join that confirms; larger ones are confirmed where they are compared.
SMALL_BUCKET = 32
# Members of one side of a cell of a large bucket.
BLOCK = 256
TESTED_AT_ONCE = 64
HELD_SHINGLES = 1_000_000
# Ids take 16 bytes each in a broadcast relation; more are joined by shuffle.
MAX_BROADCAST_IDS = 1_000_000
# Edges of the label graph that one task of a round takes; the graph is counted first, so that a small one is not dealt
# over every shuffle partition, round by round.
EDGES_A_TASK = 50_000
# Bytes of a worker's table of word hashes.
WORD_BYTES = 48_000_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
_RNG = np.random.default_rng(20250)
_A = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z lower-cased, words split at ASCII white space."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = held("op5-words", lambda: Made(xxhash.xxh3_64_intdigest, WORD_BYTES))
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    length = min(size, len(words))
    mixed = np.full(len(words) - length + 1, length, np.uint64)
    for k in range(length):
        mixed = (mixed ^ ids[k : len(ids) - length + 1 + k]) * _MIX[0]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MIX[1]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """uint32 minima of HASHES hash functions."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 1024):
        np.minimum(low, (shingles[k : k + 1024, None] * _A + _B).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def features(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, digest, signature of every row."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for first, texts in text_groups(batch.column("text")):
                sets = [shingle_set(t, size) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([signature(s).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "digest", "signature"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(scanned, "doc_id long, n_shingles long, digest binary, signature binary")


def least_matches(percent: int, miss: float = MISS) -> dict[int, int]:
    """Hashes compared -> fewest matches at which the similarity may still reach the threshold.

    With a uniform prior, P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, {}
    for n in [*range(BATCH, HASHES, BATCH), HASHES]:
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out[n] = m
    return out


def surviving(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Matches of each row pair of signatures, -1 for pairs pruned after some batch."""
    matches = np.zeros(len(left), np.int64)
    alive = np.arange(len(left))
    start = 0
    for n, least in least_matches(percent).items():
        matches[alive] += (left[alive, start:n] == right[alive, start:n]).sum(axis=1)
        start = n
        gone = matches[alive] < least
        matches[alive[gone]] = -1
        alive = alive[~gone]
    return matches


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)


def compare_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b, matches of the (a, b) that survive the sequential test."""

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matches = surviving(_signatures(batch.column("left")), _signatures(batch.column("right")), percent)
                keep = np.flatnonzero(matches >= 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(pa.array(keep)), batch.column("b").take(pa.array(keep)), pa.array(matches[keep])], ["a", "b", "matches"]
                )

    left = classes.select(F.col("rep").alias("a"), F.col("signature").alias("left"))
    right = classes.select(F.col("rep").alias("b"), F.col("signature").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(tested, "a long, b long, matches long")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The (a, b) whose full shingle sets reach the threshold."""

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of one text come one after the other; a few sets of at most HELD_SHINGLES together are kept.
        sets: dict = {}

        def of(name, text):
            key = (name, len(text), hash(text))
            if key not in sets:
                if sum(map(len, sets.values())) > HELD_SHINGLES or len(sets) == 64:
                    sets.clear()
                sets[key] = shingle_set(text, size)
            return sets[key]

        for batch in batches:
            keep = []
            ids = list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()))
            for k, (a, b) in enumerate(ids):
                one, two = of(a, batch.column("left")[k].as_py()), of(b, batch.column("right")[k].as_py())
                common = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * common >= percent * (len(one) + len(two) - common):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in "ab"], ["a", "b"])

    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(confirmed, "a long, b long")


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` (node, label) after joining the components that `links` (a, b) connect; a label is the smallest node.

    Works on the labels that the links touch: each takes the smallest root among its neighbours, then its root's
    root, until no root moves. Every round is one small job whose result is written, in as many tasks as its edges need.
    `links` may repeat.
    """
    named = labels.withColumnRenamed("node", "a").withColumnRenamed("label", "x")
    other = labels.withColumnRenamed("node", "b").withColumnRenamed("label", "y")
    once = links.join(named, "a").join(other, "b").where("x != y").select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("e"))
    edges = written(once.select("e.x", "e.y").distinct(), "op5-edges")
    width = math.ceil(edges.count() / EDGES_A_TASK)
    if not width:
        return labels
    roots = edges.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("root"))
    roots = written(roots.coalesce(width), "op5-roots")
    while True:
        lower = edges.join(roots.select(F.col("x").alias("y"), F.col("root").alias("r")), "y").groupBy("x").agg(F.min("r").alias("r"))
        met = roots.join(lower, "x").select("x", "root", F.least("root", "r").alias("up"))
        above = roots.select(F.col("x").alias("up"), F.col("root").alias("top"))
        moved = met.join(above, "up").select("x", F.least("up", "top").alias("root"), (F.least("up", "top") < F.col("root")).alias("moved"))
        moved = written(moved.coalesce(width), "op5-moved")
        roots = moved.select("x", "root")
        if not moved.where("moved").take(1):
            break
    return written(labels.join(roots.withColumnRenamed("x", "label"), "label", "left").select("node", F.coalesce("root", "label").alias("label")), "op5-labels")


def crossing(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends have different labels."""
    one = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
    two = labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    return pairs.join(one, "a").join(two, "b").where("x != y").drop("x", "y")


def likeliest(pairs: DataFrame) -> DataFrame:
    """Of each node the pair with most matches (ties: the smaller partner)."""
    ends = pairs.select(F.col("a").alias("n"), F.col("b").alias("o"), "matches").unionByName(pairs.select(F.col("b").alias("n"), F.col("a").alias("o"), "matches"))
    top = ends.groupBy("n").agg(F.max_by("o", F.struct("matches", F.bitwise_not("o"))).alias("o"))
    return top.select(F.least("n", "o").alias("a"), F.greatest("n", "o").alias("b")).distinct()


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows of equal keys, put together across batches."""
    held: list[pa.RecordBatch] = []
    now: tuple = ()
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys], 1)
        cuts = (np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(values)]):
            key = tuple(values[a].tolist())
            if held and key != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def first_band(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The first band in which each pair of signatures agrees: the one bucket that compares it."""
    same = (left == right).reshape(-1, BANDS, ROWS).all(axis=2)
    return np.where(same.any(axis=1), same.argmax(axis=1), -1)


def mixed_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (key, band, node, label) of buckets of three or more that hold several components.

    minor: not of the bucket's largest component; size and minors count the bucket's members.
    """
    placed = members.join(labels, "node").select("key", "band", "node", "label")
    shares = placed.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = (
        shares.groupBy("key")
        .agg(F.sum("n").alias("size"), F.max("n").alias("largest"), F.max_by("label", F.struct("n", "label")).alias("major"), F.count("*").alias("kinds"))
        .where("kinds > 1 AND size > 2")
        .select("key", "major", "size", (F.col("size") - F.col("largest")).alias("minors"))
    )
    return placed.join(mixed, "key").withColumn("minor", F.col("label") != F.col("major")).drop("major")


def small_bucket_pairs(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Surviving (a, b, matches) between components of small mixed buckets, each pair from its first common band."""

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, band), run in key_runs(batches, ["key", "band"]):
            node, label = run["node"].to_numpy(), run["label"].to_numpy()
            sig = _signatures(run["signature"])
            i, j = np.triu_indices(len(node), 1)
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            mine = first_band(sig[i], sig[j]) == band
            i, j = i[mine], j[mine]
            matches = surviving(sig[i], sig[j], percent)
            ok = matches >= 0
            a, b = node[i[ok]], node[j[ok]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(matches[ok])], ["a", "b", "matches"])

    cells = rows.select("key", "band", "node", "label").join(classes.select(F.col("rep").alias("node"), "signature"), "node")
    ordered = cells.repartition("key").sortWithinPartitions("key")
    return ordered.select("key", "band", "node", "label", "signature").mapInArrow(tested, "a long, b long, matches long")


def large_bucket_links(rows: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """(a, b) confirmed links between components of large mixed buckets, compared in blocks of bounded size.

    Minor members meet every block of their bucket. A cell tests pairs against full shingle sets, likeliest first, and
    leaves out pairs whose components it has already joined, so it emits fewer links than it has components.
    """
    own = F.xxhash64("node")
    sized = rows.withColumns({"across": F.ceil(F.col("size") / block), "down": F.ceil(F.col("minors") / block)})

    def steps(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    left = sized.where("minor").select("key", "band", F.pmod(own, "down").alias("row"), steps("across").alias("col"), "node", "label", F.lit(True).alias("left"), "minor")
    right = sized.select("key", "band", steps("down").alias("row"), F.pmod(own, "across").alias("col"), "node", "label", F.lit(False).alias("left"), "minor")
    cells = left.unionByName(right).join(classes.select(F.col("rep").alias("node"), "signature"), "node").join(sets, "node")

    def cell_links(band: int, run: pa.Table) -> list[tuple[int, int]]:
        node, label = run["node"].to_numpy(), run["label"].to_numpy()
        is_left, minor = run["left"].to_numpy(), run["minor"].to_numpy()
        sig = _signatures(run["signature"])
        shingles = [np.frombuffer(x.as_buffer(), "<u8") for x in run["shingles"]]
        parent = {x: x for x in label.tolist()}

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found = []
        cols = np.flatnonzero(~is_left)
        for i in np.flatnonzero(is_left):
            # A pair of minor members is tested from one side, one of minor and major always.
            js = cols[(label[cols] != label[i]) & (~minor[cols] | (node[cols] > node[i]))]
            js = js[first_band(np.broadcast_to(sig[i], (len(js), HASHES)), sig[js]) == band] if len(js) else js
            matches = surviving(np.broadcast_to(sig[i], (len(js), HASHES)), sig[js], percent)
            js = js[np.argsort(-matches, kind="stable")][: int((matches >= 0).sum())]
            while len(js):
                apart = np.array([find(x) != find(label[i]) for x in label[js].tolist()])
                js = js[apart]
                now, js = js[:TESTED_AT_ONCE], js[TESTED_AT_ONCE:]
                for j in now[similar(shingles[i], [shingles[j] for j in now], percent)] if len(now) else ():
                    x, y = find(label[i]), find(label[j])
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        found.append((int(min(node[i], node[j])), int(max(node[i], node[j]))))
        return found

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, band, _, _), run in key_runs(batches, ["key", "band", "row", "col"]):
            found = cell_links(band, run)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    columns = ["key", "band", "row", "col", "node", "label", "left", "minor", "signature", "shingles"]
    ordered = cells.select(*columns).repartition("key", "row", "col").sortWithinPartitions("key", "row", "col")
    return ordered.mapInArrow(tested, "a long, b long")


def similar(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the (non-empty, sorted) sets reach the threshold with `one`."""
    sizes = np.array([len(o) for o in others])
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, every), len(one) - 1)
    common = np.add.reduceat((one[at] == every).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return 100 * common >= percent * (len(one) + sizes - common)


def texts_of(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the listed ids; the list is broadcast only up to a counted size."""
    ids = written(ids.distinct(), "op5-ids")
    ids = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    source = documents.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(source.join(ids, "doc_id", "left_semi"), "op5-texts")


def shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles): the sorted 64-bit hashes as bytes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in text_groups(batch.column("text")):
                sets = pa.array([shingle_set(t, size).astype("<u8").tobytes() for t in group], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(group)), sets], ["node", "shingles"])

    return written(texts.mapInArrow(made, "node long, shingles binary").where("length(shingles) > 0"), "op5-sets")


def near_duplicates(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `documents`."""
    rows = written(features(documents, size), "op5-features")
    linked = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(linked.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "op5-classes")
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("signature", 1 + 4 * ROWS * b, 4 * ROWS)) for b in range(BANDS)])
    banded = classes.select(F.col("rep").alias("node"), F.posexplode(keys).alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min_by("node", F.xxhash64("key", "node")).alias("center"), F.min("node").alias("low"), F.max("node").alias("high"))
    members = written(banded.join(buckets.where("low < high").drop("low", "high"), "key"), "op5-members")
    stars = members.where("node != center").select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()
    survivors = written(compare_pairs(stars, classes, percent), "op5-survivors")

    # Rows that repeat a doc_id with different texts join their classes.
    repeated = linked.groupBy("doc_id").agg(F.min("digest").alias("one"), F.max("digest").alias("two")).where("one != two").select("doc_id")
    again = written(linked.join(repeated, "doc_id").join(classes.select("digest", "rep"), "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "op5-repeated")
    nodes = members.select("node").unionByName(again.select(F.col("a").alias("node"))).unionByName(again.select(F.col("b").alias("node"))).distinct()
    labels = relabel(written(nodes.select("node", F.col("node").alias("label")), "op5-labels"), again)

    def settle(labels: DataFrame, pairs: DataFrame) -> DataFrame:
        """Labels after confirming what is needed of `pairs`: each node's likeliest partner, then what still crosses."""
        texts = texts_of(documents, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
        first = written(likeliest(pairs), "op5-first")
        labels = relabel(labels, confirm(first, texts, percent, size))
        second = crossing(pairs.join(first, ["a", "b"], "left_anti"), labels).select("a", "b")
        return relabel(labels, confirm(second, texts, percent, size))

    labels = settle(labels, survivors)
    mixed = written(mixed_buckets(members, labels), "op5-mixed")
    more = written(small_bucket_pairs(mixed.where(F.col("size") <= small_bucket), classes, percent).join(survivors.select("a", "b"), ["a", "b"], "left_anti"), "op5-small")
    if more.take(1):
        labels = settle(labels, more)
    large = mixed.where(F.col("size") > small_bucket)
    if large.take(1):
        sets = shingle_sets(texts_of(documents, large.select(F.col("node").alias("doc_id"))), size)
        labels = relabel(labels, large_bucket_links(large, classes, sets, percent))
    by_class = classes.select("digest", "rep")
    named = rows.select("doc_id", "n_shingles", "digest").join(by_class, "digest", "left").withColumn("node", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("rep")))
    final = named.join(labels, "node", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "node", "doc_id")))
    return final.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicate(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """`documents` with one document of each group, all columns as they are."""
    gone = near_duplicates(documents, percent, size).where("NOT kept").select(F.col("doc_id").alias("id"))
    return without(documents, gone, "op5-gone")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS sh FROM w),
c AS (SELECT list_sort(sh) AS sh, min(doc_id) AS rep, len(any_value(sh)) AS n FROM s WHERE len(sh) > 0 GROUP BY 1),
x AS (SELECT rep, n, unnest(sh) AS h FROM c),
p AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS nc
      FROM x a JOIN x b ON a.h = b.h AND a.rep < b.rep GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * nc >= 85 * (na + nb - nc)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rep AS node, rep AS low FROM c UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.node WHERE r.low < e.b),
m AS (SELECT node, min(low) AS low FROM r GROUP BY node)
SELECT doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(m.low, doc_id) AS component_id,
       doc_id = coalesce(m.low, doc_id) AS kept
FROM s LEFT JOIN c ON c.sh = list_sort(s.sh) LEFT JOIN m ON m.node = c.rep
"""

QUERIES = {"op5_near_dedup": op5_near_dedup}
ORACLES = {"op5_near_dedup": ORACLE}
