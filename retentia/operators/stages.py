"""Stateful preparation as Spark ML estimators: statistics are learned on the fitted rows only."""

from __future__ import annotations

import logging

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.functions.expr import named
from retentia.operators.features import drop_columns, select_features
from retentia.operators.ranks import quantile_map, quantiles
from retentia.session import cut_lineage

log = logging.getLogger(__name__)


class _Settings(Params, DefaultParamsReadable, DefaultParamsWritable):
    """One JSON-able value per stage: its settings, or what it has learned."""

    settings = Param(Params._dummy(), "settings", "JSON-able settings", TypeConverters.identity)

    def __init__(self, settings=None):
        super().__init__()
        if settings is not None:
            self._set(settings=settings)

    @property
    def value(self):
        return self.getOrDefault(self.settings)


class ColumnDropper(_Settings, Transformer):
    """settings: list of columns to drop."""

    def _transform(self, df):
        return drop_columns(df, self.value)


class FeatureSelector(_Settings, Transformer):
    """settings: ordered list of columns to keep."""

    def _transform(self, df):
        return select_features(df, self.value)


def modes(df: DataFrame, columns) -> dict:
    """Most frequent value per column, the smallest on ties; one job for each value kind."""
    kinds: dict[bool, list[str]] = {}
    types = dict(df.dtypes)
    for c in columns:
        kinds.setdefault(types[c] == "string", []).append(c)
    out = {}
    for is_text, names in kinds.items():
        cast = "string" if is_text else "double"
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), named(c).cast(cast).alias("v")) for c in names])
        counts = df.select(F.inline(pairs)).where("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        for r in counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v")).collect():
            out[r.c] = r.v
    return out


def group_medians(df: DataFrame, target: str, group: str) -> DataFrame:
    """(group, median) of a column, nulls left out."""
    q = quantiles(df, [target], [0.5], [group])
    return q.select(named(group), F.col("quantile").alias("_median"))


def fill_group_median(df: DataFrame, target: str, group: str) -> DataFrame:
    """Fill nulls with the median of the row's group, else the overall median; any number of groups."""
    overall = quantiles(df, [target], [0.5]).select("quantile").scalar()
    filled = F.coalesce(named(target).cast("double"), F.col("_median"), overall)
    return (
        df.join(group_medians(df, target, group), group, "left")
        .withColumn(target, filled)
        .select([named(c) for c in df.columns])
    )


class DataImputer(_Settings, Estimator):
    """settings: list of {column, strategy, fill_value, fallback_value, group_column | group_by}.

    Strategies: median, constant, mode, median_by_group. Unknown columns and strategies are
    skipped with a warning. All medians come from one job, one more per grouping column.
    """

    def specs(self, columns) -> list[dict]:
        """The settings that apply to these columns, each with its grouping column as `by`."""
        specs = []
        for spec in self.value:
            if spec["column"] not in columns:
                log.warning("imputer: column %s not found", spec["column"])
            elif spec["strategy"] not in ("median", "constant", "mode", "median_by_group"):
                log.warning("imputer: unknown strategy %s", spec["strategy"])
            else:
                by = spec.get("group_column", spec.get("group_by"))
                specs.append({**spec, "by": by if by in columns else None})
        return specs

    @staticmethod
    def learned(specs: list[dict], medians: dict, most: dict) -> list[dict]:
        """A model's settings from medians {column: {0.5: value}} and modes {column: value}."""
        learned = []
        for s in specs:
            column, fallback = s["column"], s.get("fallback_value")
            if s["strategy"] == "constant":
                fill = s.get("fill_value", fallback)
            elif s["strategy"] == "mode":
                fill = most.get(column)
            else:
                fill = medians.get(column, {}).get(0.5)
            entry = {"column": column, "fill": fallback if fill is None else fill}
            if s["strategy"] == "median_by_group" and s["by"]:
                entry["by"] = s["by"]
            learned.append(entry)
        return learned

    def _fit(self, df):
        specs = self.specs(df.columns)
        median_of = [s["column"] for s in specs if s["strategy"].startswith("median")]
        mode_of = [s["column"] for s in specs if s["strategy"] == "mode"]
        medians = quantile_map(df, median_of, [0.5]) if median_of else {}
        most = modes(df, mode_of) if mode_of else {}
        tables = {}
        for by in sorted({s["by"] for s in specs if s["strategy"] == "median_by_group" and s["by"]}):
            targets = sorted({s["column"] for s in specs if s["strategy"] == "median_by_group" and s["by"] == by})
            rows = quantiles(df, targets, [0.5], [by])
            wide = rows.groupBy(named(by)).agg(*[F.max(F.when(F.col("feature") == t, F.col("quantile"))).alias(t) for t in targets])
            tables[by] = cut_lineage(wide)
        return DataImputerModel(self.learned(specs, medians, most), tables)


class _ImputerWriter(DefaultParamsWriter):
    def saveImpl(self, path):  # noqa: N802 (name given by Spark ML)
        super().saveImpl(path)
        for i, by in enumerate(self.instance.groupings()):
            self.instance.tables[by].write.parquet(f"{path}/groups/{i}")


class _ImputerReader(DefaultParamsReader):
    def load(self, path):
        model = super().load(path)
        spark = SparkSession.active()
        model.tables = {by: spark.read.parquet(f"{path}/groups/{i}") for i, by in enumerate(model.groupings())}
        return model


class DataImputerModel(_Settings, Model):
    """Fill values as settings; medians of groups as one table per grouping column, of any size."""

    def __init__(self, settings=None, tables=None):
        super().__init__(settings)
        self.tables = tables or {}

    def groupings(self) -> list[str]:
        return sorted({e["by"] for e in self.value if "by" in e})

    def write(self):
        return _ImputerWriter(self)

    @classmethod
    def read(cls):
        return _ImputerReader(cls)

    def _transform(self, df):
        columns = df.columns
        for i, by in enumerate(self.groupings()):
            if by in columns:
                table = self.tables[by]
                renamed = table.toDF(*[f"__group{i}" if c == by else f"__median{i}_{c}" for c in table.columns])
                df = df.join(renamed, named(by) == F.col(f"__group{i}"), "left")
        new = self._filled(df)
        return df.select([new.get(c, named(c)).alias(c) for c in columns]) if new else df

    def _filled(self, df):
        types = dict(df.dtypes)
        groupings = self.groupings()
        new = {}
        for e in self.value:
            if e["column"] not in df.columns:
                continue
            text = types[e["column"]] == "string"
            # Fractional medians must not be cut to the integer type of the column.
            x = named(e["column"]) if text else named(e["column"]).cast("double")
            options = [x if text else F.nanvl(x, F.lit(None))]
            if "by" in e and e["by"] in df.columns:
                options.append(named(f"__median{groupings.index(e['by'])}_{e['column']}"))
            if e["fill"] is not None:
                options.append(F.lit(e["fill"]) if text else F.lit(float(e["fill"])))
            new[e["column"]] = F.coalesce(*options)
        return new


class GroupMedianImputer(_Settings, Estimator):
    """settings: {group_col, target_col}; both must exist."""

    def _fit(self, df):
        s = self.value
        missing = [c for c in (s["group_col"], s["target_col"]) if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
        spec = {"column": s["target_col"], "strategy": "median_by_group", "group_column": s["group_col"]}
        return DataImputer([spec])._fit(df)


class StandardScalerTransformer(_Settings, Estimator):
    """settings: list of columns; (x - mean) / sample deviation, constant columns untouched."""

    def _fit(self, df):
        cols = [c for c in self.value if c in df.columns]
        aggs = []
        for i, c in enumerate(cols):
            aggs += [F.avg(named(c)).alias(f"m{i}"), F.stddev_samp(named(c)).alias(f"s{i}")]
        row = df.agg(*aggs).first() if aggs else {}
        return ScalerModel([{"column": c, "center": row[f"m{i}"], "spread": row[f"s{i}"]} for i, c in enumerate(cols)])


class RobustScalerTransformer(_Settings, Estimator):
    """settings: {columns, log_columns}; (x - median) / IQR, after log1p for the log columns."""

    def _fit(self, df):
        logs = set(self.value.get("log_columns") or ())
        cols = [c for c in self.value["columns"] if c in df.columns]
        moved = df.select([(F.log1p(named(c)) if c in logs else named(c).cast("double")).alias(c) for c in cols])
        q = quantile_map(moved, cols, [0.25, 0.5, 0.75])
        return ScalerModel(
            [
                {
                    "column": c,
                    "center": q[c].get(0.5),
                    "spread": q[c][0.75] - q[c][0.25] if q[c] else None,
                    "log": c in logs,
                }
                for c in cols
            ]
        )


class ScalerModel(_Settings, Model):
    def _transform(self, df):
        new = {}
        for e in self.value:
            if e["column"] in df.columns:
                x = F.log1p(named(e["column"])) if e.get("log") else named(e["column"]).cast("double")
                new[e["column"]] = (x - F.lit(e["center"])) / F.lit(e["spread"]) if e["spread"] else x
        return df.withColumns(new) if new else df

    def scale_params(self, spark) -> DataFrame:
        """Audit table of the learned centre and spread."""
        rows = [(e["column"], e["center"], e["spread"]) for e in self.value]
        return spark.createDataFrame(rows, "feature string, center double, spread double")


def standard_params(df: DataFrame, columns, population: bool = False) -> DataFrame:
    """(feature, mean, std) in one pass, long form."""
    spread = F.stddev_pop if population else F.stddev_samp
    one = df.agg(*[F.struct(F.avg(named(c)).alias("mean"), spread(named(c)).alias("std")).alias(c) for c in columns])
    return one.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("feature"), named(c)["mean"].alias("mean"), named(c)["std"].alias("std")) for c in columns]
            )
        )
    )


def population_zscores(df: DataFrame, columns) -> DataFrame:
    """Columns replaced by (x - mean) / population deviation."""
    row = df.agg(
        *[F.avg(named(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(named(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return df.withColumns(
        {
            c: (named(c) - F.lit(row[f"m{i}"])) / F.lit(row[f"s{i}"] or 1.0)
            for i, c in enumerate(columns)
            if row[f"m{i}"] is not None
        }
    )
