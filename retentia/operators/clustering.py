"""KMeans segmentation: elbow, silhouette, best k and cluster profiles."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from retentia.functions.expr import named
from retentia.operators.stages import population_zscores
from retentia.session import fit_width

# Rows compared at a time inside a task: their distances to all centers stay a few MB.
PASS_ROWS = 2048

def standardised(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Complete rows with z-scored features as a vector, raw columns alongside."""
    rows = df.select(*keep, *columns).na.drop(subset=list(columns))
    z = population_zscores(rows.withColumns({f"_z_{c}": named(c).cast("double") for c in columns}), [f"_z_{c}" for c in columns])
    return VectorAssembler(inputCols=[f"_z_{c}" for c in columns], outputCol="features").transform(z).drop(*[f"_z_{c}" for c in columns])


class Centers:
    """The cluster centers of one fit; rows belong to the nearest, the first on ties."""

    def __init__(self, centers: np.ndarray):
        self.centers = centers

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 (name given by Spark ML)
        return list(self.centers)

    def transform(self, data: DataFrame) -> DataFrame:
        centers = self.centers

        @pandas_udf("int")
        def nearest(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="int32")
            return pd.Series(_squares(np.stack(x.to_numpy()), centers).argmin(axis=1).astype("int32"))

        return data.withColumn("cluster", nearest(vector_to_array("features")))


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centers."""
    return np.maximum((x * x).sum(1)[:, None] + (centers * centers).sum(1)[None] - 2 * (x @ centers.T), 0)


def _packed(data: DataFrame) -> DataFrame:
    """The vectors, a few thousand a row, as bytes that passes read without a copy."""

    def pack(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"n": [len(pdf)], "x": [np.stack(pdf["x"].to_numpy()).tobytes()]})

    return data.select(vector_to_array("features").alias("x")).mapInPandas(pack, "n int, x binary")


def _summed(blocks: DataFrame, parts: list[np.ndarray], outcome) -> np.ndarray:
    """One pass for all fits: per center of `parts`, one after the other, the sum of outcome(x, squares, sizes) lines."""
    centers, sizes = np.vstack(parts), [len(p) for p in parts]

    def partial(batches):
        total = 0
        for pdf in batches:
            for n, data in zip(pdf["n"], pdf["x"]):
                whole = np.frombuffer(data).reshape(n, -1)
                for lo in range(0, n, PASS_ROWS):
                    x = whole[lo : lo + PASS_ROWS]
                    total = total + outcome(x, _squares(x, centers), sizes)
        if not np.isscalar(total):
            yield pd.DataFrame({"i": np.arange(len(total), dtype="int32"), "s": list(total)})

    cells = blocks.mapInPandas(partial, "i int, s array<double>").select("i", F.posexplode("s").alias("j", "v"))
    out: dict = {}
    # Rows of the number of centers times columns, whatever the data.
    for r in cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r.i, {})[r.j] = r.v
    return np.array([[out[i][j] for j in sorted(out[i])] for i in sorted(out)])


def _assigned(x: np.ndarray, squares: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Per center: rows, cost and sum of the rows that are nearest to it."""
    own, lines, at = np.zeros(squares.shape), np.arange(len(x)), 0
    cost = np.zeros(squares.shape[1])
    for k in sizes:
        near = squares[:, at : at + k].argmin(axis=1)
        own[lines, at + near] = 1
        cost[at : at + k] = np.bincount(near, squares[lines, at + near], k)
        at += k
    return np.hstack([own.sum(0)[:, None], cost[:, None], own.T @ x])


def fit_all(data: DataFrame, blocks: DataFrame, starts: Sequence[tuple[int, int]], parallelism: int, max_iter: int = 20, tol: float = 1e-4) -> list:
    """[(centers, cost)] of the (k, seed) fits: Spark's starts (k-means||), then Lloyd steps of all fits in one pass each.

    A fit rests once no center moves by more than `tol`. The cost is that of the last step's assignment, as in Spark.
    """

    def start(one):
        k, seed = one
        model = KMeans(k=k, seed=seed, maxIter=0, solver="row", featuresCol="features", predictionCol="cluster").fit(data)
        return np.array(model.clusterCenters())

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(inheritable_thread_target(data.sparkSession)(start), starts))
    costs, active = [0.0] * len(found), list(range(len(found)))
    for _ in range(max_iter):
        if not active:
            break
        sums, at, moving = _summed(blocks, [found[f] for f in active], _assigned), 0, []
        for f in active:
            n, cost, own = np.split(sums[at : at + len(found[f])], [1, 2], axis=1)
            at += len(found[f])
            moved = np.where(n > 0, own / np.maximum(n, 1), found[f])
            if (((moved - found[f]) ** 2).sum(1) > tol * tol).any():
                moving.append(f)
            found[f], costs[f] = moved, float(cost.sum())
        active = moving
    return list(zip(found, costs))


def silhouettes(blocks: DataFrame, models: Sequence[np.ndarray]) -> list[float]:
    """The mean silhouette (squared distances) of each model, from two passes."""

    def moments(x, squares, sizes):
        sums = _assigned(x, squares, sizes)
        sums[:, 1] = _assigned((x * x).sum(1)[:, None], squares, sizes)[:, 2]
        return sums

    sums = _summed(blocks, list(models), moments)
    n, square, own = np.split(sums, [1, 2], axis=1)
    n, square = n[:, 0], square[:, 0]
    sizes, at = np.maximum(n, 1), 0
    for m in models:
        if (n[at : at + len(m)] > 0).sum() < 2:
            raise ValueError("a silhouette needs more than one cluster")
        at += len(m)

    def shares(x, squares, ks):
        # Mean squared distance of each row to the rows of each cluster; empty clusters are no neighbours.
        far = (x * x).sum(1)[:, None] + square / sizes - 2 * (x @ (own / sizes[:, None]).T)
        far = np.where(n > 0, np.maximum(far, 0), np.inf)
        out, lines, at = np.zeros((len(n), 1)), np.arange(len(x)), 0
        for k in ks:
            near = squares[:, at : at + k].argmin(axis=1)
            mine, some = n[at : at + k][near], far[:, at : at + k].copy()
            inside = some[lines, near] * mine / np.maximum(mine - 1, 1)
            some[lines, near] = np.inf
            outside = some.min(axis=1)
            top = np.maximum(inside, outside)
            out[at, 0] = np.where((mine > 1) & (top > 0), (outside - inside) / np.where(top > 0, top, 1), 0.0).sum()
            at += k
        return out

    totals, at, scores = _summed(blocks, list(models), shares)[:, 0], 0, []
    for m in models:
        scores.append(float(totals[at] / n[at : at + len(m)].sum()))
        at += len(m)
    return scores


def sweep(data: DataFrame, ks: Sequence[int] = range(2, 11), n_init: int = 10, seed: int = 42, parallelism: int = 8):
    """{k: (model, inertia, silhouette)}: of n_init seeds the fit of smallest cost; silhouettes use squared distances (linear time).

    All fits share their passes over the rows: a Lloyd step of all of them is one job.
    """
    ks = list(ks)
    blocks = _packed(data).persist()
    try:
        fits = fit_all(data, blocks, [(k, seed + i) for k in ks for i in range(n_init)], parallelism)
        best = [min(fits[i * n_init : (i + 1) * n_init], key=lambda f: f[1]) for i in range(len(ks))]
        scores = silhouettes(blocks, [centers for centers, _ in best])
    finally:
        blocks.unpersist()
    return {k: (Centers(centers), cost, score) for k, (centers, cost), score in zip(ks, best, scores)}


def segment(df: DataFrame, columns: Sequence[str], target: str, ks: Sequence[int] = range(2, 11), n_init: int = 10, seed: int = 42):
    """(elbow table, best k, profile table): per cluster its size, target rate and means."""
    data = standardised(df, columns, [target]).persist()
    try:
        fits = sweep(fit_width(data), ks, n_init, seed)
        best = max(fits, key=lambda k: (fits[k][2], -k))
        spark = df.sparkSession
        elbow = spark.createDataFrame([(k, float(f[1]), float(f[2])) for k, f in sorted(fits.items())], "k int, inertia double, silhouette double")
        profile = fits[best][0].transform(data).groupBy("cluster").agg(
            F.count(F.lit(1)).alias("size"), (F.avg(named(target)) * 100).alias("rate_pct"),
            *[F.avg(named(c)).alias(f"mean_{c}") for c in columns],
        )
        rows = profile.collect()  # one row per cluster, k at most
        return elbow, best, spark.createDataFrame(rows, profile.schema)
    finally:
        data.unpersist()
