"""Splits, folds, samples and class weights, by a hash of the row key.

The same key and seed always give the same assignment, on any partitioning and in any engine
that has md5. The key must identify a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.functions.expr import named
from retentia.operators.ranks import numbered
from retentia.session import lookup


def hash_key(key: str, seed: int) -> Column:
    """Hex text, uniform over the keys."""
    return F.md5(F.concat(F.lit(f"{seed}-"), named(key).cast("string")).cast("binary"))


def rank_cutoffs(df: DataFrame, key: str, target: str, places: DataFrame, seed: int) -> DataFrame:
    """(y, place, h, k): hash and key at each wanted rank, for `places` (y, place, rank), in a class's seeded order.

    Counts per class and hash bucket say which bucket holds a rank; only those few buckets are sorted. The rows
    themselves are then told apart by comparing with the cutoffs. Any number of classes.
    """
    order = df.select(named(key).alias("k"), named(target).alias("y"), hash_key(key, seed).alias("h"))
    # 65,536 even hash buckets per class.
    order = order.withColumn("b", F.substring("h", 1, 4))
    upto = Window.partitionBy("y").orderBy("b")
    ends = order.groupBy("y", "b").agg(F.count(F.lit(1)).alias("n")).withColumn("end", F.sum("n").over(upto))
    wanted = places.select(F.col("y").alias("py"), "place", "rank")
    inside = F.col("y").eqNullSafe(F.col("py")) & (F.col("rank") > F.col("end") - F.col("n")) & (F.col("rank") <= F.col("end"))
    spots = lookup(ends.join(wanted, inside).select(F.col("py"), F.col("b").alias("pb"), "place", (F.col("rank") - F.col("end") + F.col("n")).alias("inner")))
    rows = order.join(spots, F.col("y").eqNullSafe(F.col("py")) & (F.col("b") == F.col("pb")))
    at = F.row_number().over(Window.partitionBy("y", "b", "place").orderBy("h", "k"))
    return rows.withColumn("i", at).where(F.col("i") == F.col("inner")).select("y", "place", "h", "k")


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """(y, n) per class."""
    return df.groupBy(named(target).alias("y")).agg(F.count(F.lit(1)).alias("n"))


def class_quotas(counts: DataFrame, share: float) -> DataFrame:
    """(y, n, quota): rows to hold out, proportional, largest remainders first, ceil(share * n) in all."""
    total = counts.agg(F.sum("n")).scalar()
    wanted = counts.withColumn("total", total).withColumn("want", F.ceil(F.lit(float(share)) * F.col("total")))
    exact = wanted.withColumn("exact", F.col("n") * F.col("want") / F.col("total"))
    floored = exact.withColumn("quota", F.floor("exact"))
    # Tables of one row per class from here on.
    by_rest = Window.orderBy(F.desc(F.col("exact") - F.col("quota")), F.coalesce(F.col("y").cast("string"), F.lit("None")))
    left = F.col("want") - F.sum("quota").over(Window.partitionBy(F.lit(1)))
    return floored.withColumn("extra", (F.row_number().over(by_rest) <= left).cast("long")).select("y", "n", (F.col("quota") + F.col("extra")).alias("quota"))


def _with_cutoffs(df: DataFrame, target: str, cutoffs: DataFrame) -> DataFrame:
    """Rows with their class's `__cuts`, an array of (place, h, k); null where it has none."""
    cuts = cutoffs.groupBy("y").agg(F.array_sort(F.collect_list(F.struct("place", "h", "k"))).alias("__cuts")).withColumnRenamed("y", "__y")
    return df.join(lookup(cuts), named(target).eqNullSafe(F.col("__y")), "left")


def _after(key: str, seed: int, cut) -> Column:
    """Whether the row comes after the cutoff."""
    h = hash_key(key, seed)
    return (cut["h"] < h) | ((cut["h"] == h) & (cut["k"] < named(key)))


def stratified_split(df: DataFrame, key: str, target: str, test_size: float = 0.20, seed: int = 42, into: str = "split") -> DataFrame:
    """Adds 'holdout' or 'train' with exact class shares; the rows stay where they are."""
    places = class_quotas(class_counts(df, target), test_size).where("quota > 0").select("y", F.lit(0).alias("place"), F.col("quota").alias("rank"))
    cut = _with_cutoffs(df, target, rank_cutoffs(df, key, target, places, seed))
    held = F.col("__cuts").isNotNull() & ~_after(key, seed, F.get("__cuts", F.lit(0)))
    return cut.withColumn(into, F.when(held, "holdout").otherwise("train")).drop("__cuts", "__y")


def stratified_folds(df: DataFrame, key: str, target: str, k: int = 5, seed: int = 42, into: str = "fold") -> DataFrame:
    """Adds a fold number 0..k-1: equal stretches of each class's seeded order, larger ones first."""
    if k < 2:
        return df.withColumn(into, F.lit(0))
    i = F.col("place") + 1
    ends = F.floor(F.col("n") / k) * i + F.least(i, F.col("n") % k)
    places = class_counts(df, target).withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(k - 2)))).select("y", "place", ends.alias("rank"))
    cut = _with_cutoffs(df, target, rank_cutoffs(df, key, target, places, seed))
    # The fold is the number of fold ends before the row.
    fold = F.size(F.filter("__cuts", lambda c: _after(key, seed, c)))
    return cut.withColumn(into, fold.cast("int")).drop("__cuts", "__y")


def first_of(df: DataFrame, key: str, n: int, seed: int) -> Column:
    """Condition that holds for exactly n rows, the first of the seeded order."""
    whole = df.select(named(key), F.lit(0).alias("_all"))
    places = df.sparkSession.createDataFrame([(0, 0, int(n))], "y int, place int, rank long")
    cut = rank_cutoffs(whole, key, "_all", places, seed).select("h", "k").first()
    if cut is None:
        return F.lit(False) if n <= 0 else F.lit(True)
    h = hash_key(key, seed)
    return (h < cut.h) | ((h == cut.h) & (named(key) <= F.lit(cut.k)))


def positional_halves(df: DataFrame, order: str, names=("first", "second"), into: str = "half") -> DataFrame:
    """The first half of the rows in the order of a unique numeric key, and the rest.

    Only the key column is ordered, to find its middle value.
    """
    placed = numbered(df.select(named(order)), [order], into="_rn")
    middle = placed.where(F.col("_rn") == F.floor(F.col("_rn_total") / 2)).select(order).scalar()
    first = F.coalesce(named(order) <= middle, F.lit(False))
    return df.withColumn(into, F.when(first, names[0]).otherwise(names[1]))


def random_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the first of the seeded order; rows are compared with a cutoff where they lie."""
    return df.where(first_of(df, key, n, seed))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """(class, n, balanced weight n_all / (classes * n), positive scale neg / pos)."""
    counts = df.groupBy(named(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    every = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.when(F.col("class") == 1, F.col("n"))).alias("pos"))).scalar()
    return counts.select(
        "class", "n",
        (every["n"] / (every["k"] * F.col("n"))).alias("balanced_weight"),
        ((every["n"] - every["pos"]) / every["pos"]).alias("scale_pos_weight"),
    )


def with_class_weight(df: DataFrame, target: str, into: str = "weight", positive: float | None = None) -> DataFrame:
    """Adds the balanced class weight, or `positive` for the positives and 1 for the others."""
    if positive is not None:
        return df.withColumn(into, F.when(named(target) == 1, F.lit(float(positive))).otherwise(1.0))
    counts = class_counts(df, target)
    every = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes"))).scalar()
    table = lookup(counts.select(F.col("y").alias("__y"), (every["n"] / (every["classes"] * F.col("n"))).alias("__weight")))
    return df.join(table, named(target).eqNullSafe(F.col("__y")), "left").withColumn(into, F.col("__weight")).drop("__y", "__weight")
