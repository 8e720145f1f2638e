"""Stateless feature steps: every step is a projection, so a chain of them runs as one.

Steps are functions DataFrame -> DataFrame for `df.transform`; `FeaturePlan` runs a list of
specs in order.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.functions.expr import cut, flag, map_codes, named, ratio

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Flag:
    column: str
    operator: str
    value: float
    new_column: str


@dataclass(frozen=True)
class Interaction:
    name: str
    kind: str  # product_complement | engagement_composite
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Ratio:
    name: str
    numerator: str
    denominator: str
    denominator_offset: float = 0.0


@dataclass(frozen=True)
class Bins:
    column: str
    new_column: str
    edges: tuple[float, ...]
    labels: tuple[str, ...]
    ordinal: dict | None = None


@dataclass(frozen=True)
class Encoding:
    column: str
    method: str  # one_hot | one_hot_vector | binary | label
    prefix: str | None = None
    drop_first: bool = False
    mapping: dict = field(default_factory=dict)
    new_column: str | None = None
    vocabulary: tuple[str, ...] | None = None


# The two flags used when none are given.
DEFAULT_FLAGS = (
    Flag("Balance", "==", 0, "HasZeroBalance"),
    Flag("NumOfProducts", ">=", 3, "HighRiskProducts"),
)


def _present(df: DataFrame, needed, step: str) -> bool:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        log.warning("%s skipped, columns missing: %s", step, missing)
    return not missing


def drop_columns(df: DataFrame, columns) -> DataFrame:
    """Drop the columns that exist; warn about the others."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        log.warning("columns to drop not found: %s", missing)
    return df.drop(*columns)


def select_features(df: DataFrame, keep) -> DataFrame:
    """Columns in the given order, leaving out those that do not exist."""
    missing = [c for c in keep if c not in df.columns]
    if missing:
        log.warning("features not found: %s", missing)
    return df.select([named(c) for c in keep if c in df.columns])


def add_flags(df: DataFrame, flags=DEFAULT_FLAGS) -> DataFrame:
    new = {}
    for f in flags:
        if not _present(df, [f.column], f.new_column):
            continue
        expression = flag(f.column, f.operator, f.value)
        if expression is None:
            log.warning("flag %s has unknown operator %r", f.new_column, f.operator)
        else:
            new[f.new_column] = expression
    return df.withColumns(new) if new else df


def interaction(spec: Interaction):
    """product_complement: a*(1-b). engagement_composite: active + (products = 2) + card - zero."""
    c = [named(x) for x in spec.columns]
    if spec.kind == "product_complement":
        return c[0] * (1 - c[1])
    if spec.kind == "engagement_composite":
        two = F.coalesce(c[1] == 2, F.lit(False)).cast("int")
        return c[0] + two + c[2] - c[3]
    return None


def add_interactions(df: DataFrame, specs) -> DataFrame:
    for spec in specs:
        if not _present(df, spec.columns, spec.name):
            continue
        expression = interaction(spec)
        if expression is None:
            log.warning("interaction %s has unknown kind %r", spec.name, spec.kind)
        else:
            df = df.withColumn(spec.name, expression)
    return df


def add_ratios(df: DataFrame, specs) -> DataFrame:
    new = {
        s.name: ratio(s.numerator, s.denominator, s.denominator_offset)
        for s in specs
        if _present(df, [s.numerator, s.denominator], s.name)
    }
    return df.withColumns(new) if new else df


def add_bins(df: DataFrame, spec: Bins) -> DataFrame:
    """Right-closed bins, as label or (with `ordinal`) as the label's code."""
    if not _present(df, [spec.column], spec.new_column):
        return df
    values = [spec.ordinal[x] for x in spec.labels] if spec.ordinal else list(spec.labels)
    return df.withColumn(spec.new_column, cut(named(spec.column), list(spec.edges), values))


def learn_vocabulary(df: DataFrame, column: str) -> tuple[str, ...]:
    """The distinct categories in order; one-hot makes a column (or a vector place) of each."""
    return tuple(r.v for r in df.select(named(column).cast("string").alias("v")).where("v is not null").distinct().orderBy("v").collect())


def learn_encodings(df: DataFrame, specs) -> tuple[Encoding, ...]:
    """The specs with the vocabularies of `df` where they have none yet."""
    return tuple(
        replace(e, vocabulary=learn_vocabulary(df, e.column))
        if e.method in ("one_hot", "one_hot_vector") and e.vocabulary is None and e.column in df.columns
        else e
        for e in specs
    )


def one_hot_vector(df: DataFrame, spec: Encoding) -> DataFrame:
    """The source replaced by one sparse vector, for wide vocabularies; unseen and null give all zeros."""
    words = list(spec.vocabulary[1:] if spec.drop_first else spec.vocabulary)
    into = spec.new_column or f"{spec.prefix or spec.column.lower()}_vector"
    place = StringIndexerModel.from_labels(words, inputCol="__text", outputCol="__place", handleInvalid="keep")
    # The last place is that of unseen categories and is dropped.
    placed = place.transform(df.withColumn("__text", named(spec.column).cast("string")))
    coded = OneHotEncoder(inputCols=["__place"], outputCols=[into], dropLast=True).fit(placed).transform(placed)
    return coded.drop("__text", "__place", spec.column)


def encode(df: DataFrame, specs) -> DataFrame:
    """One-hot (source dropped, null gives all zeros) and code maps (source kept).

    Vocabularies are never learned here, so training and serving rows get the same columns.
    """
    new, done, vectors = {}, [], []
    for s in specs:
        if not _present(df, [s.column], f"encoding {s.method}"):
            continue
        if s.method in ("one_hot", "one_hot_vector"):
            if s.vocabulary is None:
                raise ValueError(f"the vocabulary of {s.column} has not been learned; fit the plan first")
            if s.method == "one_hot_vector":
                vectors.append(s)
                continue
            prefix = s.prefix or s.column.lower()
            new.update({f"{prefix}_{w}": flag(s.column, "==", w) for w in (s.vocabulary[1:] if s.drop_first else s.vocabulary)})
            done.append(s.column)
        elif s.method in ("binary", "label"):
            new[s.new_column or f"{s.column}_encoded"] = map_codes(s.column, s.mapping)
        else:
            log.warning("unknown encoding %r for %s", s.method, s.column)
    out = df.withColumns(new).drop(*done) if new else df
    for s in vectors:
        out = one_hot_vector(out, s)
    return out


def sanitise_names(df: DataFrame) -> DataFrame:
    """Names safe for model libraries: `<` becomes `lt_`, square brackets become round."""
    return df.toDF(*[c.replace("<", "lt_").replace("[", "(").replace("]", ")") for c in df.columns])


@dataclass(frozen=True)
class FeaturePlan:
    """The feature table as one declared plan; `fit` freezes one-hot vocabularies."""

    drop: tuple[str, ...] = ()
    flags: tuple[Flag, ...] = DEFAULT_FLAGS
    interactions: tuple[Interaction, ...] = ()
    ratios: tuple[Ratio, ...] = ()
    bins: tuple[Bins, ...] = ()
    encodings: tuple[Encoding, ...] = ()
    keep: tuple[str, ...] = ()

    def fit(self, df: DataFrame) -> "FeaturePlan":
        return replace(self, encodings=learn_encodings(df, self.encodings))

    def transform(self, df: DataFrame) -> DataFrame:
        df = drop_columns(df, self.drop) if self.drop else df
        df = add_flags(df, self.flags)
        df = add_interactions(df, self.interactions)
        df = add_ratios(df, self.ratios)
        for b in self.bins:
            df = add_bins(df, b)
        df = encode(df, self.encodings)
        return select_features(df, self.keep) if self.keep else df


def serving_features(df: DataFrame, countries, genders, age_edges=(30, 55)) -> DataFrame:
    """Twenty serving columns from raw serving fields (names as in the request record)."""
    young, senior = age_edges
    c = {x: named(x) for x in df.columns}
    active, card = c["is_active"].cast("int"), c["has_cr_card"].cast("int")

    def one(x):
        return F.coalesce(x, F.lit(False)).cast("int")

    return df.select(
        *[c[x] for x in df.columns if x not in SERVING_FIELDS],
        c["credit_score"].cast("double").alias("CreditScore"),
        c["age"].cast("double").alias("Age"),
        c["tenure"].cast("double").alias("Tenure"),
        c["balance"].cast("double").alias("Balance"),
        c["num_products"].cast("double").alias("NumOfProducts"),
        card.alias("HasCrCard"),
        active.alias("IsActiveMember"),
        c["salary"].cast("double").alias("EstimatedSalary"),
        *[one(c["geography"] == g).alias(f"Geography_{g}") for g in countries],
        *[one(c["gender"] == g).alias(f"Gender_{g}") for g in genders],
        one((c["age"] >= young) & (c["age"] < senior)).alias("AgeGroup_Middle"),
        one(c["age"] >= senior).alias("AgeGroup_Senior"),
        one(c["age"] < young).alias("AgeGroup_Young"),
        (c["age"] * (1 - active)).cast("double").alias("AgeInactivity"),
        (active + card + F.least(c["num_products"], F.lit(2)) - 1).cast("double").alias("EngagementScore"),
        F.round(c["balance"] / F.greatest(c["salary"], F.lit(1)), 4).alias("BalanceSalaryRatio"),
        F.round(c["num_products"] / F.greatest(c["tenure"], F.lit(1)), 4).alias("ProductsPerYear"),
    )


# Raw serving record.
SERVING_FIELDS = (
    "credit_score", "age", "tenure", "balance", "num_products", "has_cr_card", "is_active",
    "salary", "geography", "gender",
)


def risk_factors(df: DataFrame, rules: list[tuple[str, object]], into: str = "factor") -> DataFrame:
    """Per row the messages of the rules that hold, as an array in rule order."""
    said = F.array(*[F.when(rule, F.lit(message)) for message, rule in rules])
    return df.withColumn(into, F.filter(said, lambda x: x.isNotNull()))
