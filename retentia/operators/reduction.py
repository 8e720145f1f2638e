"""Feature reduction on assembled vectors: none, RFE, PCA, kernel PCA, discriminant analysis.

The data stay distributed; only matrices of feature (or landmark) size reach the driver.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from retentia.functions.expr import named
from retentia.operators.stages import _Settings
from retentia.session import cut_lineage, fit_width

log = logging.getLogger(__name__)

METHODS = ("none", "rfe", "pca", "kpca", "lda")
# Rows that may become landmarks of kernel PCA in one round.
KERNEL_BATCH = 512


class LinearProjection(_Settings, Transformer):
    """settings: {input, output, center, rows}; output is rows x (input - center)."""

    def _transform(self, df):
        s = self.value
        x = vector_to_array(named(s["input"]))
        moved = F.zip_with(x, F.array(*[F.lit(float(c)) for c in s["center"]]), lambda a, b: a - b)

        def dot(row):
            weights = F.array(*[F.lit(float(w)) for w in row])
            return F.aggregate(F.zip_with("_moved", weights, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)

        out = df.withColumn("_moved", moved)
        return out.withColumn(s["output"], array_to_vector(F.array(*[dot(r) for r in s["rows"]]))).drop("_moved")


class KernelMap(_Settings, Transformer):
    """settings: {input, output, kernel, gamma, degree, coef0, landmarks, basis, offset}; output is kernel x basis - offset."""

    def _transform(self, df):
        s = self.value
        landmarks, basis, offset = np.array(s["landmarks"]), np.array(s["basis"]), np.array(s["offset"])

        @pandas_udf(ArrayType(DoubleType()))
        def mapped(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            k = kernel_matrix(np.stack(x.to_numpy()), landmarks, s["kernel"], s["gamma"], s["degree"], s["coef0"])
            return pd.Series(list(k @ basis - offset))

        return df.withColumn(s["output"], array_to_vector(mapped(vector_to_array(named(s["input"])))))


def kernel_matrix(a, b, kernel: str, gamma: float, degree: int, coef0: float) -> np.ndarray:
    if kernel == "rbf":
        square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
        return np.exp(-gamma * np.maximum(square, 0))
    if kernel == "poly":
        return (gamma * a @ b.T + coef0) ** degree
    if kernel == "cosine":
        na, nb = np.linalg.norm(a, axis=1, keepdims=True), np.linalg.norm(b, axis=1, keepdims=True)
        return (a / np.where(na == 0, 1, na)) @ (b / np.where(nb == 0, 1, nb)).T
    raise ValueError(f"unknown kernel {kernel!r}")


def kernel_diagonal(x, kernel: str, gamma: float, degree: int, coef0: float) -> np.ndarray:
    """The kernel of each row with itself."""
    square = (x * x).sum(1)
    if kernel == "rbf":
        return np.ones(len(x))
    return (gamma * square + coef0) ** degree if kernel == "poly" else (square > 0).astype(float)


def _width(df: DataFrame, col: str) -> int:
    return df.select(F.size(vector_to_array(named(col)))).first()[0]


def fit_pca(df: DataFrame, col: str, n: int, out: str = "reduced") -> PipelineModel:
    """Centre, then project on the leading components."""
    center = StandardScaler(withMean=True, withStd=False, inputCol=col, outputCol=f"{out}_c").fit(df)
    pca = PCA(k=n, inputCol=f"{out}_c", outputCol=out).fit(center.transform(df))
    return PipelineModel([center, pca])


def class_moments(df: DataFrame, col: str, target: str) -> tuple[np.ndarray, dict]:
    """(overall mean, {class: (n, sum, outer sum)}) of the centred vectors.

    Tasks send one partial matrix per class, which a shuffle adds up cell by cell.
    """
    mean = np.array(df.select(Summarizer.mean(named(col)).alias("m")).first().m.toArray())
    p = len(mean)

    def partial(batches):
        sums: dict = {}
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()) - mean if len(pdf) else np.zeros((0, p))
            x1 = np.hstack([np.ones((len(x), 1)), x])
            for y in np.unique(pdf["y"]):
                part = x1[pdf["y"].to_numpy() == y]
                sums[y] = sums.get(y, 0) + part.T @ part
        for y, m in sums.items():
            i, j = np.triu_indices(p + 1)
            yield pd.DataFrame({"y": y, "i": i.astype("int32"), "j": j.astype("int32"), "s": m[i, j]})

    cells = df.select(named(target).cast("double").alias("y"), vector_to_array(named(col)).alias("x")).mapInPandas(
        partial, "y double, i int, j int, s double"
    )
    full: dict = {}
    for r in cells.groupBy("y", "i", "j").agg(F.sum("s").alias("s")).collect():
        m = full.setdefault(r.y, np.zeros((p + 1, p + 1)))
        m[r.i, r.j] = m[r.j, r.i] = r.s
    return mean, {y: (m[0, 0], m[0, 1:], m[1:, 1:]) for y, m in full.items()}


def fit_lda(df: DataFrame, col: str, target: str, n: int, out: str = "reduced") -> PipelineModel:
    """Directions that separate the classes, scaled to unit within-class variance."""
    mean, classes = class_moments(df, col, target)
    total = sum(c[0] for c in classes.values())
    k = len(classes)
    within = sum(o - np.outer(s, s) / m for m, s, o in classes.values()) / (total - k)
    between = sum(np.outer(s, s) / m for m, s, _ in classes.values()) / max(k - 1, 1)
    # Features differ by orders of magnitude: bring them to unit spread before judging the rank.
    spread = np.sqrt(np.diag(within))
    scale = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0)
    values, vectors = np.linalg.eigh(within * np.outer(scale, scale))
    kept = values > values.max() * 1e-9
    white = (scale[:, None] * vectors[:, kept]) / np.sqrt(values[kept])
    strength, directions = np.linalg.eigh(white.T @ between @ white)
    order = np.argsort(strength)[::-1][: min(n, k - 1)]
    rows = (white @ directions[:, order]).T
    # A direction's sign is free; fix it by its largest weight.
    rows = np.array([r * (1 if r[np.argmax(np.abs(r))] > 0 else -1) for r in rows])
    settings = {"input": col, "output": out, "center": mean.tolist(), "rows": rows.tolist()}
    return PipelineModel([LinearProjection(settings)])


def _whitening(marks: np.ndarray, options: tuple) -> np.ndarray:
    """Kernel values against the landmarks times this have the kernel as their inner product."""
    values, vectors = np.linalg.eigh(kernel_matrix(marks, marks, *options))
    kept = values > max(values.max(), 0) * 1e-10
    return vectors[:, kept] / np.sqrt(values[kept])


def _left_out(rows: DataFrame, marks: np.ndarray, white: np.ndarray, options: tuple, floor: float) -> tuple[list, DataFrame]:
    """(the rows (x, r) that the landmarks represent worst, the rows that they do not represent yet).

    r is the part of k(x, x) that the landmarks miss. It never grows with more landmarks, so that rows at or below
    `floor` need not be asked again.
    """

    def missed(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["x"].to_numpy())
            r = kernel_diagonal(x, *options)
            if len(marks):
                r = r - ((kernel_matrix(x, marks, *options) @ white) ** 2).sum(1)
            yield pdf.assign(r=r)[r > floor]

    left = cut_lineage(rows.select("x", "h").mapInPandas(missed, "x array<double>, h long, r double"))
    return left.orderBy(F.desc("r"), "h").limit(KERNEL_BATCH).collect(), left


def _independent(x: np.ndarray, marks: np.ndarray, white: np.ndarray, options: tuple, floor: float, most: float) -> np.ndarray:
    """Those of the rows x that add to the span of the landmarks, by pivoted Cholesky steps, `most` at most."""
    left = kernel_matrix(x, x, *options)
    if len(marks):
        part = kernel_matrix(x, marks, *options) @ white
        left = left - part @ part.T
    taken = []
    while len(taken) < min(len(x), most):
        i = int(np.argmax(np.diag(left)))
        if left[i, i] <= floor:
            break
        taken.append(i)
        left = left - np.outer(left[:, i], left[i]) / left[i, i]
    return x[taken]


def _mapped_moments(rows: DataFrame, marks: np.ndarray, white: np.ndarray, options: tuple) -> np.ndarray:
    """Sum over all rows of (1, z) (1, z)', z being the mapped row; one line of it per Spark row."""

    def partial(batches):
        total = 0
        for pdf in batches:
            if len(pdf):
                z = kernel_matrix(np.stack(pdf["x"].to_numpy()), marks, *options) @ white
                z = np.hstack([np.ones((len(z), 1)), z])
                total = total + z.T @ z
        if not np.isscalar(total):
            yield pd.DataFrame({"i": np.arange(len(total), dtype="int32"), "line": [r.tobytes() for r in total]})

    def added(batches):
        lines: dict = {}
        for pdf in batches:
            for i, line in zip(pdf["i"], pdf["line"]):
                lines[i] = lines.get(i, 0) + np.frombuffer(line)
        yield pd.DataFrame({"i": np.array(list(lines), "int32"), "line": [v.tobytes() for v in lines.values()]})

    schema = "i int, line binary"
    lines = rows.mapInPandas(partial, schema).repartition("i").mapInPandas(added, schema).collect()
    return np.array([np.frombuffer(r.line) for r in sorted(lines, key=lambda r: r.i)])


def fit_kpca(
    df: DataFrame, col: str, n: int, kernel: str = "rbf", gamma: float | None = None, degree: int = 3,
    coef0: float = 1.0, landmarks: int | None = None, key: str | None = None, out: str = "reduced", tolerance: float = 1e-4,
) -> PipelineModel:
    """Kernel PCA of all rows, on a kernel basis grown until it represents every row.

    Each round asks all rows which the landmarks represent worst, and makes those that are independent
    landmarks too, until no row misses more than `tolerance` of the mean k(x, x) (or, if `landmarks` is given,
    there are so many). What the basis leaves of the kernel matrix then has at most that share of its trace. Kernels
    of finite rank (poly, cosine) are exact, and so is any kernel when all rows become landmarks. The covariance of
    the mapped rows is summed over all rows; matrices of landmarks squared are on the driver.
    """
    order = F.xxhash64(named(key)) if key else F.xxhash64(vector_to_array(named(col)))
    width = _width(df, col)
    options = (kernel, float(1.0 / width if gamma is None else gamma), int(degree), float(coef0))
    most = float("inf") if landmarks is None else landmarks
    marks, white = np.zeros((0, width)), np.zeros((0, 0))
    rows = df.select(vector_to_array(named(col)).alias("x"), order.alias("h")).persist()

    def diagonal(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"d": kernel_diagonal(np.stack(pdf["x"].to_numpy()), *options)})

    try:
        mean, top = rows.mapInPandas(diagonal, "d double").agg(F.avg("d"), F.max("d")).first()
        left = rows
        while len(marks) < most:
            worst, left = _left_out(left, marks, white, options, tolerance * mean)
            more = _independent(np.array([r.x for r in worst]).reshape(-1, width), marks, white, options, top * 1e-10, most - len(marks))
            if not len(more):
                break
            marks = np.vstack([marks, more])
            white = _whitening(marks, options)
        log.info("kernel PCA: %d landmarks", len(marks))
        moments = _mapped_moments(rows, marks, white, options)
    finally:
        rows.unpersist()
    total, sums = moments[0, 0], moments[0, 1:]
    covariance = moments[1:, 1:] / total - np.outer(sums, sums) / total**2
    _, vectors = np.linalg.eigh(covariance)
    directions = vectors[:, ::-1][:, :n]
    basis = white @ directions
    # A component's sign is free; fix it by its largest weight.
    sign = np.where(basis[np.abs(basis).argmax(0), np.arange(basis.shape[1])] > 0, 1, -1)
    return PipelineModel([KernelMap(
        {
            "input": col, "output": out, "kernel": kernel, "gamma": options[1], "degree": options[2], "coef0": options[3],
            "landmarks": marks.tolist(), "basis": (basis * sign).tolist(), "offset": (sums / total @ directions * sign).tolist(),
        }
    )])


def elimination(
    df: DataFrame, col: str, target: str, n: int, estimator: str = "random_forest", seed: int = 42, max_depth: int = 30, penalty: float = 1.0
) -> list[int]:
    """Positions of the features in the order in which they are dropped: the weakest, refit, the next, until n are left.

    Trees grow to Spark's deepest level unless `max_depth` says less; logistic regression has the L2 `penalty`
    (1 / C) on unscaled features.
    """
    left, dropped = list(range(_width(df, col))), []
    data = df.select(named(col).alias("_all"), named(target).cast("double").alias("_y")).persist()
    narrow = fit_width(data)
    try:
        rows = max(1, data.count())
        while len(left) > n:
            cut = VectorSlicer(inputCol="_all", outputCol="_x", indices=left).transform(narrow)
            if estimator == "random_forest":
                model = RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=50, maxDepth=max_depth, seed=seed).fit(cut)
                weight = model.featureImportances.toArray()
            else:
                model = LogisticRegression(featuresCol="_x", labelCol="_y", maxIter=1000, regParam=penalty / rows, standardization=False).fit(cut)
                weight = np.abs(model.coefficients.toArray())
            dropped.append(left.pop(int(np.argmin(weight))))
    finally:
        data.unpersist()
    return dropped


def fit_rfe(
    df: DataFrame, col: str, target: str, n: int, estimator: str = "random_forest", seed: int = 42, out: str = "reduced",
    max_depth: int = 30, penalty: float = 1.0,
) -> tuple[PipelineModel, list[int]]:
    """Drop the weakest feature and refit until n are left; returns the kept positions too."""
    dropped = elimination(df, col, target, n, estimator, seed, max_depth, penalty)
    left = sorted(set(range(_width(df, col))) - set(dropped))
    return PipelineModel([VectorSlicer(inputCol=col, outputCol=out, indices=left)]), left


def fit_reducer(df: DataFrame, spec: dict, col: str, target: str, names: list[str], key: str | None = None, seed: int = 42):
    """(stages, output column, output names) for a reducer spec {"method": ..., options}."""
    method = spec.get("method", "none")
    if method not in METHODS:
        raise ValueError(f"reduction method must be one of {METHODS}, not {method!r}")
    if method == "none":
        return [], col, names
    if method == "rfe":
        model, kept = fit_rfe(df, col, target, min(spec.get("n_features_to_select", 15), len(names)), spec.get("rfe_estimator", "random_forest"), seed)
        return model.stages, "reduced", [names[i] for i in kept]
    if method == "pca":
        n = min(spec.get("n_components", 15), len(names))
        return fit_pca(df, col, n).stages, "reduced", [f"pc_{i}" for i in range(n)]
    if method == "kpca":
        n = min(spec.get("n_components", 12), len(names))
        options = {k: spec[k] for k in ("kernel", "gamma", "degree", "coef0", "landmarks") if k in spec}
        model = fit_kpca(df, col, n, key=key, **options)
        return model.stages, "reduced", [f"kpc_{i}" for i in range(len(model.stages[-1].value["offset"]))]
    model = fit_lda(df, col, target, spec.get("n_components", 15))
    return model.stages, "reduced", [f"lda_{i}" for i in range(len(model.stages[0].value["rows"]))]
