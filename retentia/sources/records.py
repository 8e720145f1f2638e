"""Records held in text columns: CSV boxes, JSON batches, and the scoring request contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def csv_text_rows(df: DataFrame, text: str, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One row per data line of a CSV text column whose first line is the header.

    Texts whose header does not name the schema's columns in order give no rows.
    """
    lines = F.filter(F.split(F.col(text), "\r?\n"), lambda x: F.trim(x) != "")
    header = F.transform(F.split(F.get(lines, F.lit(0)), ","), lambda x: F.trim(x))
    matching = df.where(header == F.array(*[F.lit(f.name) for f in schema.fields]))
    exploded = matching.select(*keep, F.posexplode(lines).alias("_i", "_line")).where("_i > 0")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = exploded.select(*keep, F.from_csv(F.trim("_line"), ddl, {"quote": '"', "escape": '"'}).alias("_r"))
    return parsed.select(*keep, "_r.*")


def json_batch_rows(df: DataFrame, text: str, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One row per object of a JSON array column."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return df.select(*keep, F.inline(F.from_json(F.col(text), f"array<struct<{ddl.replace('` ', '`: ')}>>")))


# The request's required fields and the defaults of the others.
REQUIRED_FIELDS = [
    "CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember", "EstimatedSalary",
]
DEFAULT_FIELDS = {
    "Geography_France": 0.0, "Geography_Germany": 0.0, "Geography_Spain": 0.0, "Gender_Female": 0.0,
    "Gender_Male": 1.0, "AgeGroup_Middle": 0.0, "AgeGroup_Senior": 0.0, "AgeGroup_Young": 0.0,
    "AgeInactivity": 0.0, "EngagementScore": 0.0, "BalanceSalaryRatio": 0.0, "ProductsPerYear": 0.0,
}


def parse_requests(
    df: DataFrame, text: str, keep: Sequence[str] = (), required: Sequence[str] = REQUIRED_FIELDS, defaults: dict[str, float] = DEFAULT_FIELDS
) -> DataFrame:
    """Request objects as typed columns with defaults, plus `errors`: what breaks the contract.

    Required fields must be numbers, optional ones may be absent, others are forbidden.
    """
    known = [*required, *defaults]
    fields = F.from_json(F.col(text), "map<string,string>")
    rows = df.select(*keep, fields.alias("_m"))
    m = F.col("_m")
    numbers = {c: F.try_element_at(m, F.lit(c)).try_cast("double") for c in known}
    unknown = F.array_except(F.map_keys(m), F.array(*[F.lit(c) for c in known]))
    errors = F.concat(
        F.filter(
            F.array(
                *[F.when(~F.map_contains_key(m, c), F.lit(f"missing {c}")) for c in required],
                *[F.when(F.map_contains_key(m, c) & numbers[c].isNull(), F.lit(f"not a number {c}")) for c in known],
            ),
            lambda x: x.isNotNull(),
        ),
        F.transform(F.array_sort(unknown), lambda x: F.concat(F.lit("unknown "), x)),
    )
    return rows.select(
        *keep,
        *[numbers[c].alias(c) for c in required],
        *[F.coalesce(numbers[c], F.lit(d)).alias(c) for c, d in defaults.items()],
        F.when(m.isNull(), F.array(F.lit("not a JSON object"))).otherwise(errors).alias("errors"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.size("errors") == 0).drop("errors")


def rejected(parsed: DataFrame, keep: Sequence[str]) -> DataFrame:
    return parsed.where(F.size("errors") > 0).select(*keep, "errors")
