"""Benchmark decontamination with DataFrame functions only.

Normalised windows of the benchmark items form a hash set. Every word of a document is hashed once; the hashes of
the first and last word of each window are looked up in a map of 2^18 bits, a constant of the plan, and only windows
that are marked there probe the set. A hit counts only after its words equal the item's. No document text is
shuffled: only window hits and one small row per document are.

Defined results: null or wordless texts have no words and no hits. Items without words or id are ignored,
repeated items count once. Rows repeating a doc_id each get their own result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retentia.llm.common import ascii_lower, table, without, written

WINDOW = 10
# ASCII characters between the words of a lower-cased text, and of one as it stands.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bits of the map of first and last words.
MAP_BITS = 18
# A window row and each item id in it take about 300 bytes: beyond this many the set is joined by shuffle instead.
MAX_BROADCAST_WINDOWS = 200_000


def words(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), SEPARATORS), ""), F.array().cast("array<string>"))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """len, hash, words and the item_ids of every distinct window."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("item_id IS NOT NULL AND size(w) > 0")
    n = F.least(F.size("w"), F.lit(window))
    each = items.select("item_id", "w", n.alias("len"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("at"))
    return (
        each.select("item_id", "len", F.expr("slice(w, at, len)").alias("window"))
        .groupBy("len", "window")
        .agg(F.collect_set("item_id").alias("items"))
        .select("len", F.xxhash64("window").alias("hash"), "window", "items")
    )


def _place(hashes: str, first: str, last: str) -> str:
    """SQL: where the map marks a window, from the hashes of its first and last word."""
    return f"CAST(shiftrightunsigned({hashes}[{first}] ^ shiftleft({hashes}[{last}], 1), {64 - MAP_BITS}) AS int)"


def window_map(known: DataFrame) -> str:
    """SQL: the map as a constant array of longs; at most 2^MAP_BITS / 64 of them reach the driver."""
    place = known.select("len", F.expr("transform(window, x -> xxhash64(x))").alias("h")).select(F.expr(_place("h", "0", "len - 1")).alias("p"))
    rows = place.groupBy(F.expr("p div 64").alias("i")).agg(F.expr("bit_or(shiftleft(1L, p % 64))").alias("bits")).collect()
    bits = [0] * ((1 << MAP_BITS) // 64)
    for r in rows:
        bits[r["i"]] = r["bits"]
    return f"from_json('{bits}', 'array<bigint>')"


def hits(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, text_hash, at, len, items: verified occurrences, `at` counted in words from 1."""
    known = written(windows, "op4-windows")
    lens = sorted(r["len"] for r in known.select("len").distinct().collect())  # at most WINDOW values
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    docs = docs.withColumn("h", F.expr("transform(w, x -> xxhash64(x))"))
    marks = window_map(known) if lens else ""

    def marked(n):
        place = _place("h", "i - 1", f"i + {n - 2}")
        return f"shiftright({marks}[{place} div 64], {place} % 64) & 1 = 1"

    of_len = [
        F.expr(
            f"if(size(w) < {n}, array(), transform(filter(sequence(1, size(w) - {n - 1}), i -> {marked(n)}),"
            f" i -> struct({n} AS len, i AS at, xxhash64(slice(w, i, {n})) AS hash)))"
        )
        for n in lens
    ]
    if not of_len:
        none = docs.where("false").select("doc_id", "text_hash", F.lit(0).alias("at"), F.lit(0).alias("len"))
        return none.withColumn("items", F.lit(None).cast(known.schema["items"].dataType))
    probes = docs.select("doc_id", "text_hash", "w", F.inline(F.concat(*of_len) if len(of_len) > 1 else of_len[0]))
    if known.agg(F.sum(F.size("items") + 1)).first()[0] <= MAX_BROADCAST_WINDOWS:
        known = F.broadcast(known)
    return probes.join(known, ["len", "hash"]).where("slice(w, at, len) = window").select("doc_id", "text_hash", "at", "len", "items")


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of `documents`."""
    found = (
        hits(documents, item_windows(benchmark, window))
        .groupBy("doc_id", "text_hash")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set(F.expr("sequence(at, at + len - 1)"))))).cast("long").alias("n_hit"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .select("n_hit", "items", F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    )
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    named = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(named, F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def remove_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of `documents` without any hit; all their columns."""
    found = hits(documents, item_windows(benchmark, window)).select(F.col("doc_id").alias("id"), "text_hash")
    return without(documents, found, "op4-hit")


def remove_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`documents` with every hit word cut from the text; texts without hits stay as they are.

    The text is taken apart into words with the separators after them; a hit word goes with its separators.
    """
    found = (
        hits(documents, item_windows(benchmark, window))
        .groupBy("doc_id", "text_hash")
        .agg(F.array_distinct(F.flatten(F.collect_set(F.expr("sequence(at, at + len - 1)")))).alias("__cut"))
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__cut")
    )
    word = GAP.replace("[", "[^")
    joined = documents.join(found, documents["doc_id"].eqNullSafe(found["__id"]) & (F.xxhash64(documents["text"]) == found["__hash"]), "left")
    parts = F.expr(f"regexp_extract_all(text, r'(?:^{GAP})|{word}(?:{GAP})?', 0)")
    lead = F.when(documents["text"].rlike(f"^{GAP}"), 1).otherwise(0)
    cut = F.array_join(
        F.filter(parts, lambda _, i: ~F.array_contains("__cut", (i + 1 - lead).cast("int"))), ""
    )
    text = F.when(F.col("__cut").isNull(), documents["text"]).otherwise(cut)
    return joined.select(*[text.alias("text") if c == "text" else documents[c] for c in documents.columns])


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, w[p:p + n - 1] AS x FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
lens AS (SELECT DISTINCT n FROM win),
probe AS (SELECT rid, n, p, w[p:p + n - 1] AS x FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d CROSS JOIN lens WHERE len(w) >= n)),
hit AS (SELECT rid, probe.n, p, item_id FROM probe JOIN win ON probe.n = win.n AND probe.x = win.x),
cov AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""

QUERIES = {"op4_decontaminate": op4_decontaminate}
ORACLES = {"op4_decontaminate": ORACLE}
