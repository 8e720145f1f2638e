"""CSV folders to Parquet, with a schema contract and an ingest summary."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

CODECS = ("snappy", "gzip", "brotli", "zstd", "none")
# No line breaks inside values, so large files stay splittable.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "multiLine": "false"}


class SchemaError(ValueError):
    """Required columns are absent."""


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def csv_files(spark: SparkSession, raw_dir: str) -> list[str]:
    """The folder's *.csv files in name order."""
    p, fs = _path(spark, f"{raw_dir.rstrip('/')}/*.csv")
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size below a path; 0 when it does not exist."""
    p, fs = _path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def read_csv(spark: SparkSession, raw_dir: str, schema: StructType | str | None = None) -> DataFrame:
    """All files as one table. Without a schema the first file's inferred types hold for all.

    Every file's header must name the same columns.
    """
    files = csv_files(spark, raw_dir)
    if not files:
        raise FileNotFoundError(f"no CSV files in {raw_dir}")
    if schema is None:
        # Types that hold for all files, whichever comes first.
        schema = spark.read.options(**CSV_OPTIONS, inferSchema="true").csv(files).schema
    return spark.read.options(**CSV_OPTIONS, enforceSchema="false", mode="FAILFAST").schema(schema).csv(files)


def require_columns(columns: Sequence[str], required: Sequence[str]) -> None:
    missing = [c for c in required if c not in columns]
    if missing:
        raise SchemaError(f"missing required columns {missing}; found {sorted(columns)}")


def schema_contract(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(required, present) from the schema alone."""
    rows = [(c, c in df.columns) for c in required]
    return df.sparkSession.createDataFrame(rows, "required string, present boolean")


def ingest_csv_to_parquet(
    spark: SparkSession,
    raw_dir: str,
    output_path: str,
    compression: str = "snappy",
    required_columns: Sequence[str] = (),
    schema: StructType | str | None = None,
    skip_if_exists: bool = True,
    force: bool = False,
) -> str:
    """Write the folder's CSV files as one Parquet table; existing output is kept unless forced.

    The contract is checked on the schema before any row is read.
    """
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}")
    if skip_if_exists and not force and stored_bytes(spark, output_path) > 0:
        log.info("%s exists, ingest skipped", output_path)
        return output_path
    df = read_csv(spark, raw_dir, schema)
    require_columns(df.columns, required_columns)
    df.write.mode("overwrite").option("compression", compression).parquet(output_path)
    return output_path


def ingest_summary(spark: SparkSession, raw_dir: str, output_path: str, schema: StructType | str | None = None) -> DataFrame:
    """Rows and bytes per source file beside the table's totals and the compression ratio."""
    df = read_csv(spark, raw_dir, schema)
    size = stored_bytes(spark, output_path)
    per_file = df.groupBy(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.file_size").alias("csv_bytes")
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    totals = per_file.agg(F.struct(F.sum("n_rows").alias("n"), F.sum("csv_bytes").alias("b"))).scalar()
    return per_file.select(
        "file", "n_rows", "csv_bytes", totals["n"].alias("total_rows"), F.lit(size).alias("parquet_bytes"),
        F.try_divide(totals["b"].cast("double"), F.lit(size)).alias("compression_ratio"),
    )


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Same-schema tables one after the other, matched by column name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=False)
    return out
