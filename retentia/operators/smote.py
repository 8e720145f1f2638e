"""Synthetic minority rows between a row and one of its nearest minority neighbours."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.expr import named
from retentia.operators.knn import BLOCK_ROWS, nearest
from retentia.operators.sampling import first_of, hash_key, rank_cutoffs
from retentia.session import cut_lineage


def _unit(*parts: Column) -> Column:
    """Uniform in [0, 1), fixed by its parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def smote(
    df: DataFrame, key: str, features: str, target: str, k: int = 5, seed: int = 42, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(features, target, synthetic): the rows and as many synthetic positives as balance needs.

    `key` is a unique long, `features` a vector. Every minority row is a base equally often, one
    more for the first of a seeded order. Draws depend on key and seed only, so a lost task
    repeats the same rows.
    """
    counts = {r[0]: r[1] for r in df.groupBy(named(target)).count().where(named(target).isin(0, 1)).collect()}
    minority = min(counts, key=lambda c: (counts[c], -c))
    n, wanted = counts[minority], max(counts.values()) - counts[minority]
    real = df.select(named(features).alias("features"), named(target).cast("double").alias(target), F.lit(False).alias("synthetic"))
    if len(counts) < 2 or wanted == 0:
        return real
    if n <= k:
        raise ValueError(f"{n} minority rows cannot have {k} neighbours each")
    points = df.where(named(target) == minority).select(
        named(key).cast("long").alias("id"), vector_to_array(named(features)).alias("x")
    )
    each, rest = divmod(wanted, n)
    copies = F.lit(each) + F.when(first_of(points, "id", rest, seed), 1).otherwise(0)
    bases = points.where(copies > 0).select("id", "x", F.explode(F.sequence(F.lit(1), copies)).alias("j"))
    drawn = bases.withColumns(
        {
            "rank": (F.floor(_unit(F.col("id"), F.col("j"), F.lit(seed)) * k) + 1).cast("int"),
            "u": _unit(F.col("j"), F.col("id"), F.lit(seed + 1)),
        }
    )
    neighbours = nearest(points, k, block_rows).select("id", "rank", "nn")
    ends = points.select(F.col("id").alias("nn"), F.col("x").alias("y"))
    mixed = F.zip_with("x", "y", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    # u is a column outside the lambda: one fraction for all features of a row.
    at = F.transform(mixed, lambda s: s["a"] + F.col("u") * (s["b"] - s["a"]))
    made = drawn.join(neighbours, ["id", "rank"]).join(ends, "nn").select(
        array_to_vector(at).alias("features"), F.lit(float(minority)).alias(target), F.lit(True).alias("synthetic")
    )
    return real.unionByName(made)


def smote_groups(rows: DataFrame, group: str, key: str, k: int = 5, seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(group, x, y): the rows of every group and its synthetic rows, as `smote` makes them of each group alone.

    `rows` has a small number of groups 0, 1, 2, ..., a unique long `key` inside a group, x (array<double>) and y. One
    neighbour search serves all groups: a further coordinate keeps them farther apart than any two points of one group.
    """
    counts: dict[int, dict[int, int]] = {}
    for r in rows.where(F.col("y").isin(0, 1)).groupBy(group, F.col("y").cast("int").alias("y")).count().collect():
        counts.setdefault(r[group], {})[r["y"]] = r["count"]
    plan = {}
    for t, c in counts.items():
        if len(c) == 2 and c[0] != c[1]:
            minority = min(c, key=lambda y: (c[y], -y))
            if c[minority] <= k:
                raise ValueError(f"{c[minority]} minority rows cannot have {k} neighbours each")
            plan[t] = (minority, *divmod(max(c.values()) - c[minority], c[minority]))
    real = rows.select(group, "x", F.col("y").cast("double").alias("y"))
    if not plan:
        return real
    spark, n = rows.sparkSession, max(counts) + 1
    table = spark.createDataFrame([(t, *p) for t, p in plan.items()], f"{group} int, minority int, each long, rest long")
    points = rows.join(F.broadcast(table), group).where(F.col("y") == F.col("minority")).select(group, named(key).cast("long").alias("id"), "x", "minority", "each", "rest")
    points = points.persist()
    try:
        top, width = points.agg(F.max(F.array_max(F.transform("x", F.abs))), F.max(F.size("x"))).first()
        gap = 4.0 * (top + 1) * max(width, 1) ** 0.5
        apart = points.select((F.col("id") * n + F.col(group)).alias("id"), F.concat("x", F.array(F.col(group) * F.lit(gap))).alias("x"))
        near = nearest(apart, k, block_rows).select(
            F.pmod("id", F.lit(n)).cast("int").alias(group), F.expr(f"(id - pmod(id, {n})) div {n}").alias("id"), "rank", F.expr(f"(nn - pmod(nn, {n})) div {n}").alias("nn")
        )
        wanted = spark.createDataFrame([(t, 0, rest) for t, (_, _, rest) in plan.items() if rest], "y int, place int, rank long")
        # At most one cutoff a group.
        cuts = [(r["y"], r["h"], r["k"]) for r in rank_cutoffs(points, "id", group, wanted, seed).collect()]
        cut = F.broadcast(spark.createDataFrame(cuts, f"{group} int, h string, cut_id long"))
        own = hash_key("id", seed)
        first = F.coalesce((own < F.col("h")) | ((own == F.col("h")) & (F.col("id") <= F.col("cut_id"))), F.lit(False))
        bases = points.join(cut, group, "left").withColumn("copies", F.col("each") + first.cast("long")).where("copies > 0")
        drawn = bases.select(group, "id", "x", "minority", F.explode(F.expr("sequence(1, CAST(copies AS INT))")).alias("j")).withColumns(
            {
                "rank": (F.floor(_unit(F.col("id"), F.col("j"), F.lit(seed)) * k) + 1).cast("int"),
                "u": _unit(F.col("j"), F.col("id"), F.lit(seed + 1)),
            }
        )
        ends = points.select(group, F.col("id").alias("nn"), F.col("x").alias("z"))
        mixed = F.zip_with("x", "z", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        at = F.transform(mixed, lambda s: s["a"] + F.col("u") * (s["b"] - s["a"]))
        made = drawn.join(near, [group, "id", "rank"]).join(ends, [group, "nn"]).select(group, at.alias("x"), F.col("minority").cast("double").alias("y"))
        return real.unionByName(cut_lineage(made))
    finally:
        points.unpersist()


def class_distribution(df: DataFrame, target: str, phase: str) -> DataFrame:
    """(phase, class, n)."""
    return df.groupBy(named(target).cast("int").alias("class")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(phase).alias("phase"), "class", "n")
