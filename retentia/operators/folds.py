"""What the fits of one cross-validation share.

Statistics of all training sets come at once: values are counted per fold, and a training set is all folds minus its
own. Prepared, reduced and oversampled rows of all training sets are one table each, with the held-out fold as column
`t`, made once and used by every trial that asks for them.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from threading import Lock

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.functions.expr import named
from retentia.operators.newton import fit_logistic_groups, logistic_scores
from retentia.operators.ranks import melt, quantiles, quantiles_of
from retentia.operators.reduction import class_moments, elimination, fit_reducer
from retentia.operators.sampling import stratified_folds
from retentia.operators.smote import smote_groups
from retentia.operators.stages import DataImputer, DataImputerModel, ScalerModel
from retentia.session import cut_lineage, fit_width


def without_own(counts: DataFrame, keys: list[str], fold: str, k: int) -> DataFrame:
    """(keys, t, n): counts (keys, fold, n) summed over all folds but t, for every fold t; rows of none left out."""
    own = F.map_from_entries(F.collect_list(F.struct(fold, "n")))
    total = counts.groupBy(*keys).agg(F.sum("n").alias("total"), own.alias("own"))
    each = total.select(*keys, "total", "own", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("t"))
    n = F.col("total") - F.coalesce(F.try_element_at("own", F.col("t")), F.lit(0))
    return each.select(*keys, "t", n.alias("n")).where("n > 0")


def fold_frequencies(df: DataFrame, columns: list[str], fold: str, k: int, by: list[str] = []) -> DataFrame:  # noqa: B006
    """(feature, by, t, value, n): distinct values of every training set, from one count per fold."""
    long = melt(df, columns, [*by, fold])
    for b in by:
        long = long.where(named(b).isNotNull())
    counts = long.groupBy("feature", *by, "value", fold).agg(F.count(F.lit(1)).alias("n"))
    return without_own(counts, ["feature", *by, "value"], fold, k)


def fold_modes(df: DataFrame, columns: list[str], fold: str, k: int) -> dict[int, dict]:
    """{t: {column: most frequent value, the smallest on ties}}."""
    types, out = dict(df.dtypes), {t: {} for t in range(k)}
    for is_text in (True, False):
        names = [c for c in columns if (types[c] == "string") == is_text]
        if names:
            cast = "string" if is_text else "double"
            pairs = F.array(*[F.struct(F.lit(c).alias("c"), named(c).cast(cast).alias("v")) for c in names])
            counts = df.select(fold, F.inline(pairs)).where("v IS NOT NULL").groupBy("c", "v", fold).agg(F.count(F.lit(1)).alias("n"))
            best = without_own(counts, ["c", "v"], fold, k).groupBy("c", "t").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"))
            for r in best.collect():
                out[r["t"]][r["c"]] = r["v"]
    return out


def fit_imputers(df: DataFrame, settings: list[dict], fold: str, k: int) -> list[DataImputerModel]:
    """The imputer of every training set: medians, modes and group medians of all of them in one job each."""
    imputer = DataImputer(settings)
    specs = imputer.specs(df.columns)
    median_of = sorted({s["column"] for s in specs if s["strategy"].startswith("median")})
    mode_of = sorted({s["column"] for s in specs if s["strategy"] == "mode"})
    medians: dict[int, dict] = {t: {} for t in range(k)}
    if median_of:
        for r in quantiles_of(fold_frequencies(df, median_of, fold, k), [0.5], ["t"]).collect():
            medians[r["t"]][r["feature"]] = {0.5: r["quantile"]}
    most = fold_modes(df, mode_of, fold, k) if mode_of else {t: {} for t in range(k)}
    tables: list[dict] = [{} for _ in range(k)]
    for by in sorted({s["by"] for s in specs if s["strategy"] == "median_by_group" and s["by"]}):
        targets = sorted({s["column"] for s in specs if s["strategy"] == "median_by_group" and s["by"] == by})
        rows = quantiles_of(fold_frequencies(df, targets, fold, k, [by]), [0.5], [by, "t"])
        wide = cut_lineage(rows.groupBy(named(by), "t").agg(*[F.max(F.when(F.col("feature") == c, F.col("quantile"))).alias(c) for c in targets]))
        for t in range(k):
            tables[t][by] = wide.where(F.col("t") == t).drop("t")
    return [DataImputerModel(imputer.learned(specs, medians[t], most[t]), tables[t]) for t in range(k)]


def fit_scalers(df: DataFrame, standard: list[str], robust: list[str], logs: list[str], k: int) -> list[list[ScalerModel]]:
    """Standard and robust scalers of every training set; `df` holds the training rows of all of them with their t."""
    out: list[list[ScalerModel]] = [[] for _ in range(k)]
    if standard:
        aggs = [a for i, c in enumerate(standard) for a in (F.avg(named(c)).alias(f"m{i}"), F.stddev_samp(named(c)).alias(f"s{i}"))]
        for r in df.groupBy("t").agg(*aggs).collect():
            out[r["t"]].append(ScalerModel([{"column": c, "center": r[f"m{i}"], "spread": r[f"s{i}"]} for i, c in enumerate(standard)]))
    if robust:
        moved = df.select("t", *[(F.log1p(named(c)) if c in logs else named(c).cast("double")).alias(c) for c in robust])
        q = {(r["t"], r["feature"], r["prob"]): r["quantile"] for r in quantiles(moved, robust, [0.25, 0.5, 0.75], ["t"]).collect()}
        for t in range(k):
            out[t].append(ScalerModel([
                {"column": c, "center": q.get((t, c, 0.5)), "spread": q[t, c, 0.75] - q[t, c, 0.25] if (t, c, 0.5) in q else None, "log": c in logs}
                for c in robust
            ]))
    return out


class Folds:
    """Cross-validation of pipelines that differ in parameters and reducer over the same folds."""

    def __init__(self, df: DataFrame, key: str, target: str, spec, k: int = 5, seed: int = 42, linear: bool = True, parallelism: int = 5):
        self.key, self.spec, self.k, self.parallelism, self.spark = key, spec, k, parallelism, df.sparkSession
        # Trials may run side by side: what one is making, the others wait for.
        self._made: dict = {}
        self._locks: defaultdict = defaultdict(Lock)
        base = stratified_folds(df, key, target, k, seed, "fold").withColumnRenamed(target, "__y")
        base = cut_lineage(base)
        imputers = fit_imputers(base, [dict(s) for s in spec.imputation], "fold", k) if spec.imputation else []

        def frame(t, stages):
            rows = reduce(lambda d, s: s.transform(d), stages, base)
            return rows.select(named(key).alias("id"), *map(named, spec.features), F.col("__y").cast("double").alias("y"), (F.col("fold") == t).alias("valid"), F.lit(t).alias("t"))

        stages = [[imputers[t]] if imputers else [] for t in range(k)]
        if linear and (spec.standard or spec.robust):
            filled = reduce(DataFrame.unionByName, [frame(t, stages[t]) for t in range(k)]).where("NOT valid")
            own = [[c for c in cols if c in spec.features] for cols in (spec.standard, spec.robust)]
            stages = [a + b for a, b in zip(stages, fit_scalers(filled, *own, list(spec.log_first), k))]
        rows = reduce(DataFrame.unionByName, [frame(t, stages[t]) for t in range(k)])
        assembled = VectorAssembler(inputCols=list(spec.features), outputCol="x_", handleInvalid="error").transform(rows)
        self.rows = cut_lineage(fit_width(assembled.select("t", "valid", "id", vector_to_array("x_").alias("x"), "y")))

    def _each(self, make) -> list:
        """`make` for every t, side by side."""
        with ThreadPoolExecutor(self.parallelism) as pool:
            return list(pool.map(inheritable_thread_target(self.spark)(make), range(self.k)))

    def reduced(self, reducer: dict) -> DataFrame:
        """(t, valid, id, x, y) with every training set's own reducer applied."""
        method = reducer.get("method", "none")
        names = list(self.spec.features)
        if method == "none":
            return self.rows
        if method == "rfe":
            # The order in which features go does not depend on how many are to be left.
            n = min(reducer.get("n_features_to_select", 15), len(names))
            kept = [sorted(set(range(len(names))) - set(order[: len(names) - n])) for order in self.elimination_orders(n, reducer.get("rfe_estimator", "random_forest"))]
            places = F.array(*[F.array(*map(F.lit, own)) for own in kept])
            return self.rows.withColumn("x", F.transform(places[F.col("t")], lambda i: F.col("x")[i]))
        if method == "pca":
            return self._projected(min(reducer.get("n_components", 15), len(names)))
        vectors = self.rows.withColumn("features", array_to_vector("x"))

        def one(t):
            own = vectors.where(F.col("t") == t)
            made, column, _ = fit_reducer(own.where("NOT valid"), reducer, "features", "y", names, "id", self.spec.seed)
            return PipelineModel(made).transform(own).select("t", "valid", "id", vector_to_array(column).alias("x"), "y")

        return reduce(DataFrame.unionByName, self._each(one))

    def elimination_orders(self, n: int, estimator: str = "random_forest") -> list[list[int]]:
        """Positions in the order in which they are dropped, down to n (or fewer, if that was asked for before)."""
        with self._locks["orders", estimator]:
            known = self._made.get(("orders", estimator))
            if known is None or len(self.spec.features) - len(known[0]) > n:
                vectors = self.rows.where("NOT valid").withColumn("features", array_to_vector("x"))
                known = self._each(lambda t: elimination(vectors.where(F.col("t") == t), "features", "y", n, estimator, self.spec.seed))
                self._made["orders", estimator] = known
            return known

    def _projected(self, n: int) -> DataFrame:
        """Principal components of every training set from one job's moments."""
        with self._locks["moments"]:
            if "moments" not in self._made:
                vectors = self.rows.where("NOT valid").withColumn("features", array_to_vector("x"))
                self._made["moments"] = class_moments(vectors, "features", "t")
        centre, sums = self._made["moments"]
        maps = {}
        for t, (m, s, o) in sums.items():
            _, directions = np.linalg.eigh((o - np.outer(s, s) / m) / (m - 1))
            maps[int(t)] = (centre + s / m, directions[:, ::-1][:, :n])

        def projected(batches):
            for pdf in batches:
                x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, len(centre)))
                z = np.zeros((len(pdf), n))
                for t in pdf["t"].unique():
                    at = (pdf["t"] == t).to_numpy()
                    z[at] = (x[at] - maps[t][0]) @ maps[t][1]
                yield pdf.assign(x=list(z))

        return self.rows.mapInPandas(projected, self.rows.schema)

    def training(self, reducer: dict) -> tuple[DataFrame, DataFrame]:
        """(oversampled training rows (t, x, y, w), held-out rows (t, x, y)) of a reducer; both are kept for later trials.

        Kernel components depend on drawn kernels and are not asked for again: theirs are made anew.
        """
        name = tuple(sorted(reducer.items()))
        with self._locks[name]:
            if name in self._made:
                return self._made[name]
            rows = cut_lineage(self.reduced(reducer)) if reducer.get("method", "none") not in ("none", "rfe") else self.reduced(reducer)
            train = rows.where("NOT valid")
            made = smote_groups(train, "t", "id", self.spec.k_neighbours, self.spec.seed) if self.spec.oversample else train.select("t", "x", "y")
            made = (cut_lineage(fit_width(made)), rows.where("valid").select("t", "x", "y"))
            if reducer.get("method") == "kpca":
                return made
            self._made[name] = made
            return made

    def _weighted(self, train: DataFrame, positive: float | None) -> DataFrame:
        if positive is not None:
            return train.withColumn("w", F.when(F.col("y") == 1, F.lit(float(positive))).otherwise(1.0))
        counts = train.groupBy("t", "y").agg(F.count(F.lit(1)).alias("n"))
        every = counts.groupBy("t").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("classes"))
        # One row per training set and class.
        table = counts.join(every, "t").select("t", "y", (F.col("all") / (F.col("classes") * F.col("n"))).alias("w"))
        rows = {(r["t"], r["y"]): r["w"] for r in table.collect()}
        w = F.lit(1.0)
        for (t, y), value in rows.items():
            w = F.when((F.col("t") == t) & (F.col("y") == y), F.lit(value)).otherwise(w)
        return train.withColumn("w", w)

    def scores(self, spec, params: dict) -> DataFrame:
        """(fold, y, p) of every held-out row; `params` are the model's parameters, defaults filled in."""
        from retentia.operators.models import WEIGHT, build_estimator

        train, valid = self.training(dict(spec.reducer))
        if spec.model == "logistic_regression":
            extra = set(params) - {"C", "penalty", "class_weight", "max_iter", "tol"}
            if extra:
                raise ValueError(f"{spec.model} has no counterpart for {sorted(extra)}")
            width = train.select(F.size("x")).first()[0]
            weighted = self._weighted(train, params.get("scale_pos_weight"))
            betas = fit_logistic_groups(weighted, range(self.k), width, params["C"], params["penalty"], params["max_iter"])
            return logistic_scores(valid, betas, ["t", "y"]).withColumnRenamed("t", "fold")
        weighted = self._weighted(train, params.get("scale_pos_weight")).withColumn("x", array_to_vector("x")).withColumnRenamed("w", WEIGHT)

        def one(t):
            own = fit_width(weighted.where(F.col("t") == t))
            fitted = build_estimator(spec.model, spec.params, "x", "y", own.count(), spec.seed).fit(own)
            held = valid.where(F.col("t") == t).withColumn("x", array_to_vector("x"))
            return fitted.transform(held).select(F.col("t").alias("fold"), "y", vector_to_array("probability")[1].alias("p"))

        return reduce(DataFrame.unionByName, self._each(one))
