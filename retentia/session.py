"""Session helpers: a tuned local builder and the shared folder jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.functions import broadcast


def local_session(app: str = "retentia", cpus: str = "8", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus if str(cpus).isdigit() else 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config(FIT_TASKS, "1")
        # Call sites of columns are only for error messages, and cost most of a plan's build time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local master falls back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="retentia-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Materialise on reliable shared storage, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def bucket_count(spark: SparkSession) -> int:
    """Buckets per ordered key for prefix sums; follows the session's shuffle width."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


# Setting for the tasks that iterative fits read their input in; a session without it takes as many as it has cores.
FIT_TASKS = "spark.retentia.fitTasks"


def fit_width(df):
    """Input of an iterative fit, in as many tasks as the session says and never by its size.

    A fit is thousands of short jobs, and a level of a forest sends its statistics once per task: more tasks than cores
    only add to both. Partitions are joined, never split.
    """
    tasks = df.sparkSession.conf.get(FIT_TASKS, None)
    return df.coalesce(int(tasks) if tasks else max(2, df.sparkSession.sparkContext.defaultParallelism))


# Rows up to which a lookup table is broadcast; a larger one is joined by shuffle, with the same result.
MAX_BROADCAST_ROWS = 100_000


def lookup(df):
    """A small table, materialised and counted, with a broadcast hint if the count allows it."""
    table = cut_lineage(df)
    return broadcast(table) if table.count() <= MAX_BROADCAST_ROWS else table
