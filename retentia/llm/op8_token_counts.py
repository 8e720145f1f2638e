"""Token counts with the whole-token shortcut.

When a worker starts, it proves which vocabulary strings the library encodes alone as one token; pre-tokens
among them count one each, and only the others are merged (through a bounded cache). Texts outside the proven
characters are encoded whole. One scan, no shuffle.

Defined results: a null text is empty (0 bytes, 0 tokens); rows may repeat; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia.llm.common import table
from retentia.llm.pretokens import PretokenCounter, shared, text_groups

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048


def count_tokens(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; `path` is the tokenizer file on every executor."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared(PretokenCounter, path)
        for batch in batches:
            n = [c for _, texts in text_groups(batch.column("text")) for c in counter.counts(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


QUERIES = {"op8_token_counts": op8_token_counts}
ORACLES: dict[str, str] = {}
