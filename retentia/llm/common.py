"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retentia.session import scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: cuts the lineage, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


# Rows of a drop list that may be broadcast: ids and hashes take about 100 bytes each as a hashed relation.
MAX_BROADCAST_DROPS = 500_000


def without(documents: DataFrame, drops: DataFrame, label: str) -> DataFrame:
    """Rows of `documents` not named by `drops` (id, and text_hash if it has one), all their columns.

    The drop list is written first and broadcast only up to a known size; beyond it, the join shuffles.
    """
    listed = written(drops.distinct(), label)
    listed = listed.select(*[F.col(c).alias(f"__drop_{c}") for c in listed.columns])
    same = documents["doc_id"].eqNullSafe(F.col("__drop_id"))
    if "__drop_text_hash" in listed.columns:
        same = same & (F.xxhash64(documents["text"]) == F.col("__drop_text_hash"))
    listed = F.broadcast(listed) if listed.count() <= MAX_BROADCAST_DROPS else listed
    return documents.join(listed, same, "left_anti")


# What a dictionary entry takes besides the characters of its key and value.
ENTRY_BYTES = 200


class Made(dict):
    """Values made when first asked for, in two generations of at most half of `limit` bytes each.

    When the younger is full it becomes the older, and the older goes: what is asked for again and again stays. Long
    keys are not kept.
    """

    LONGEST_KEY = 256

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.half, self.size, self.old = make, limit // 2, 0, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.LONGEST_KEY:
            self.size += ENTRY_BYTES + len(key)
            if self.size > self.half:
                self.old, self.size = dict(self), ENTRY_BYTES + len(key)
                self.clear()
            self[key] = value
        return value


class Generations:
    """The same for keys that are looked up many at once, and made many at once."""

    def __init__(self, limit: int):
        self.half, self.size, self.young, self.old = limit // 2, 0, {}, {}

    def values(self, keys: list, make) -> list:
        """Values of distinct keys; `make` gives those of a list of keys that neither generation has."""
        if self.size > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        places = [k for k, value in enumerate(found) if value is None]
        added = [keys[k] for k in places]
        values = list(map(old.get, added)) if old else [None] * len(added)
        new = [key for key, value in zip(added, values) if value is None]
        made = iter(make(new))
        for k, key, value in zip(places, added, values):
            found[k] = value = next(made) if value is None else value
            if len(key) <= Made.LONGEST_KEY:
                self.size += ENTRY_BYTES + len(key)
                young[key] = value
        return found


_HELD: dict = {}


def held(key, make):
    """One object per process, the one asked for last: a worker that goes on to another operator gives the memory back."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]
