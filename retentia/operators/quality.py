"""Declarative data-quality rules, all compiled into one aggregation pass."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.functions.expr import named
from retentia.operators.ranks import quantiles


class QualityError(RuntimeError):
    """A suite run with fail_on_error has failed rules."""


@dataclass(frozen=True)
class Rule:
    """`type` in snake or Pascal case; table rules have no column."""

    type: str
    column: str | None = None
    kwargs: dict = field(default_factory=dict)

    @property
    def kind(self) -> str:
        name = self.type
        if "_" not in name:
            name = "".join(f"_{c.lower()}" if c.isupper() else c for c in name).lstrip("_")
        if name not in _COMPILERS:
            raise AttributeError(f"unknown expectation {self.type!r}")
        return name


def suite(table_rules: Sequence[dict], column_rules: dict[str, Sequence[dict]]) -> list[Rule]:
    """Rules from the two sections of a quality configuration."""
    rules = [Rule(r["type"], None, r.get("kwargs", {})) for r in table_rules]
    return rules + [Rule(r["type"], c, r.get("kwargs", {})) for c, rs in column_rules.items() for r in rs]


def _between(x: Column, kwargs: dict) -> Column:
    lo, hi = kwargs.get("min_value"), kwargs.get("max_value")
    test = F.lit(True)
    if lo is not None:
        test = test & (x >= F.lit(lo))
    if hi is not None:
        test = test & (x <= F.lit(hi))
    return test


def violation(rule: Rule) -> Column | None:
    """Row test of a value rule: true where the row breaks it; None for table and aggregate rules."""
    if rule.column is None:
        return None
    x = named(rule.column)
    if rule.kind == "expect_column_values_to_not_be_null":
        return x.isNull()
    if rule.kind == "expect_column_values_to_be_in_set":
        return F.coalesce(~x.isin(list(rule.kwargs["value_set"])), F.lit(False))
    if rule.kind == "expect_column_values_to_be_between":
        return F.coalesce(~_between(x, rule.kwargs), F.lit(False))
    return None


def _values(rule: Rule, df: DataFrame) -> dict[str, Column]:
    rows = F.count(F.lit(1))
    present = F.count(named(rule.column))
    bad = F.count_if(violation(rule))
    base = rows if rule.kind.endswith("not_be_null") else present
    mostly = float(rule.kwargs.get("mostly", 1.0))
    kept = F.when(base > 0, 1 - bad / base).otherwise(1.0)
    return {
        "success": kept >= mostly,
        "element_count": rows,
        "missing_count": rows - present,
        "unexpected_count": bad,
        "unexpected_percent": F.when(base > 0, bad / base * 100),
    }


def _statistic(make):
    def compile_rule(rule: Rule, df: DataFrame) -> dict[str, Column]:
        value = make(named(rule.column))
        return {"success": F.coalesce(_between(value, rule.kwargs), F.lit(False)), "observed_value": value.cast("double")}

    return compile_rule


def _row_count(rule: Rule, df: DataFrame) -> dict[str, Column]:
    rows = F.count(F.lit(1))
    return {"success": _between(rows, rule.kwargs), "observed_value": rows.cast("double")}


def _column_set(rule: Rule, df: DataFrame) -> dict[str, Column]:
    wanted, have = set(rule.kwargs["column_set"]), set(df.columns)
    missing, extra = sorted(wanted - have), sorted(have - wanted)
    good = not missing and (not extra or not rule.kwargs.get("exact_match", True))
    return {"success": F.lit(good), "unexpected_count": F.lit(len(missing) + len(extra)), "details": F.lit(",".join(missing + extra))}


_COMPILERS = {
    "expect_table_row_count_to_be_between": _row_count,
    "expect_table_columns_to_match_set": _column_set,
    "expect_column_values_to_not_be_null": _values,
    "expect_column_values_to_be_in_set": _values,
    "expect_column_values_to_be_between": _values,
    "expect_column_mean_to_be_between": _statistic(F.avg),
    "expect_column_stdev_to_be_between": _statistic(F.stddev_samp),
}
_FIELDS = {
    "success": "boolean", "element_count": "bigint", "missing_count": "bigint", "unexpected_count": "bigint",
    "unexpected_percent": "double", "observed_value": "double", "details": "string",
}


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One result row per rule, from a single scan of df whatever the number of rules."""
    results = []
    for i, rule in enumerate(rules):
        if rule.column is not None and rule.column not in df.columns:
            made = {"success": F.lit(False), "details": F.lit("column not found")}
        else:
            made = _COMPILERS[rule.kind](rule, df)
        results.append(
            F.struct(
                F.lit(i).alias("rule"), F.lit(rule.kind).alias("type"), F.lit(rule.column).cast("string").alias("column"),
                F.lit(json.dumps(rule.kwargs, sort_keys=True)).alias("kwargs"),
                *[made.get(f, F.lit(None)).cast(t).alias(f) for f, t in _FIELDS.items()],
            ).alias(f"r{i}")
        )
    # The row count keeps the query an aggregate even when all rules are about the schema.
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[r for r in results])
    return one.select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(results))])))


def summarise(results: DataFrame) -> DataFrame:
    passed = F.count_if("success")
    total = F.count(F.lit(1))
    return results.agg((passed == total).alias("success"), total.alias("total"), passed.alias("passed"), (total - passed).alias("failed"))


def check(df: DataFrame, rules: Sequence[Rule], fail_on_error: bool = False) -> tuple[DataFrame, dict]:
    """Results and summary; raises after the run when asked to and any rule failed."""
    results = run_suite(df, rules)
    rows = results.collect()
    failed = [r for r in rows if not r["success"]]
    if failed and fail_on_error:
        named_rules = ", ".join(f"{r['type']}({r['column'] or 'table'})" for r in failed)
        raise QualityError(f"{len(failed)} of {len(rows)} rules failed: {named_rules}")
    report = df.sparkSession.createDataFrame(rows, results.schema)
    return report, {"success": not failed, "total": len(rows), "passed": len(rows) - len(failed), "failed": len(failed)}


def _row_tests(df: DataFrame, rules: Sequence[Rule]) -> list[tuple[Rule, Column]]:
    tests = [(r, violation(r)) for r in rules if r.column is None or r.column in df.columns]
    return [(r, t) for r, t in tests if t is not None]


def split_rows(df: DataFrame, rules: Sequence[Rule], into: str = "violated") -> DataFrame:
    """Adds column and type of the value rules each row breaks, as an array."""
    said = [F.when(t, F.lit(f"{r.column}:{r.kind}")) for r, t in _row_tests(df, rules)]
    if not said:
        return df.withColumn(into, F.array().cast("array<string>"))
    return df.withColumn(into, F.array_compact(F.array(*said)))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Only the rows that break a value rule, with the rules they break."""
    # The plain condition is tested first, so good rows never build the array.
    broken = F.lit(False)
    for _, t in _row_tests(df, rules):
        broken = broken | t
    return split_rows(df.where(broken), rules)


def suggest(df: DataFrame, numeric: Sequence[str], discrete: Sequence[str], tolerance: float = 0.2) -> DataFrame:
    """Rules that describe the data: row count, columns, nulls, 1%-99% ranges, value sets.

    (type, column, min_value, max_value, value_set); value sets are sorted JSON arrays.
    """
    n = F.count(F.lit(1))
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    columns = json.dumps(sorted(df.columns))
    table = df.agg(
        F.floor(n * (1 - tolerance)).cast("double").alias("lo"), F.floor(n * (1 + tolerance)).cast("double").alias("hi")
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("expect_table_row_count_to_be_between").alias("type"), none_s.alias("column"), F.col("lo").alias("min_value"), F.col("hi").alias("max_value"), none_s.alias("value_set")),
                F.struct(F.lit("expect_table_columns_to_match_set").alias("type"), none_s.alias("column"), none_d.alias("min_value"), none_d.alias("max_value"), F.lit(columns).alias("value_set")),
            )
        )
    )
    q = quantiles(df, numeric, [0.01, 0.99]).groupBy("feature").agg(
        F.max(F.when(F.col("prob") == 0.01, F.col("quantile"))).alias("min_value"),
        F.max(F.when(F.col("prob") == 0.99, F.col("quantile"))).alias("max_value"),
    )
    ranges = q.select(F.lit("expect_column_values_to_be_between").alias("type"), F.col("feature").alias("column"), "min_value", "max_value", none_s.alias("value_set"))
    # One row per numeric column.
    nulls = q.select(F.lit("expect_column_values_to_not_be_null").alias("type"), F.col("feature").alias("column"), none_d.alias("min_value"), none_d.alias("max_value"), none_s.alias("value_set"))
    types = dict(df.dtypes)
    sets = None
    whole = ("tinyint", "smallint", "int", "bigint", "boolean")
    kind_of = {c: "string" if types[c] == "string" else "bigint" if types[c] in whole else "double" for c in discrete}
    for kind in ("string", "bigint", "double"):
        cols = [c for c in discrete if kind_of[c] == kind]
        if cols:
            cells = F.array(*[F.struct(F.lit(c).alias("column"), named(c).cast(kind).alias("v")) for c in cols])
            # collect_set over already distinct cells: the set itself is the wanted result.
            found = df.select(F.inline(cells)).where("v is not null").distinct().groupBy("column").agg(F.to_json(F.sort_array(F.collect_list("v"))).alias("value_set"))
            part = found.select(F.lit("expect_column_values_to_be_in_set").alias("type"), "column", none_d.alias("min_value"), none_d.alias("max_value"), "value_set")
            sets = part if sets is None else sets.unionByName(part)
    out = table.unionByName(nulls).unionByName(ranges)
    return out.unionByName(sets) if sets is not None else out


def tolerances(stats: DataFrame) -> DataFrame:
    """Mean within two deviations, deviation within half to one and a half of itself."""
    return stats.select(
        "feature",
        (F.col("mean") - 2 * F.col("std")).alias("mean_min"), (F.col("mean") + 2 * F.col("std")).alias("mean_max"),
        (F.col("std") * 0.5).alias("std_min"), (F.col("std") * 1.5).alias("std_max"),
    )


def size_gate(df: DataFrame, minimum: int = 1000) -> DataFrame:
    """(n, passed): more rows than the minimum."""
    return df.agg(F.count(F.lit(1)).alias("n")).withColumn("passed", F.col("n") > minimum)
