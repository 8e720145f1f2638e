"""Parquet tables: schema listing, feature sink with verification, report sinks."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def schema_listing(df: DataFrame) -> DataFrame:
    """(position, name, type), from metadata."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def file_schema(spark: SparkSession, path: str) -> DataFrame:
    """(position, name, type) as the Parquet files at `path` say."""
    return schema_listing(spark.read.parquet(path))


def write_features(df: DataFrame, path: str, compression: str = "snappy") -> dict:
    """Write a feature table, read it back, and compare row count and schema."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    back = df.sparkSession.read.parquet(path)
    same = [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    return {"n_rows": back.count(), "n_columns": len(back.columns), "schema_ok": same}


def write_report(df: DataFrame, root: str, name: str, fmt: str = "json") -> str:
    """Write a result table under a UTC-stamped name; returns the path."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    path = f"{root.rstrip('/')}/{name}_{stamp}"
    # JSON has no NaN or infinity: they become null.
    clean = df.select(
        [
            F.when(~F.isnan(c) & (F.abs(F.col(c)) != float("inf")), F.col(c)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )
    writer = clean.write.mode("errorifexists")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", "false").json(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")
    return path


def read_report(spark: SparkSession, path: str, fmt: str, schema) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", "true").csv(path) if fmt == "csv" else reader.format(fmt).load(path)
