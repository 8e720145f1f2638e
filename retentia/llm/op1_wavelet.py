"""Token ids as one wavelet matrix per shard.

A shard is a self-contained byte string: document table, then one bit-plane per bit of the largest id, each in
compressed blocks with the number of ones before every block. Rank and select on the planes give token access,
counts and occurrence lookup while only the touched blocks are decompressed. Shards are rows of a Parquet table
in ascending document order, so that Spark's writers commit them on whatever store is shared: reading one token
loads its shard's bytes (a few MB) and decompresses only the blocks on its way.

Defined results: a null text is empty and has the end id alone; null doc_ids sort first; rows that repeat a
doc_id are ordered by text; an empty table writes no shard. Other columns are not read. A document is never
split: one longer than a shard has its own.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from retentia.llm.common import table
from retentia.llm.pretokens import PretokenEncoder, byte_groups, shared
from retentia.session import scratch

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SHARD_TOKENS = 1 << 20
BLOCK_BYTES = 8192
BLOCK_BITS = BLOCK_BYTES * 8
FORMAT = b"RWM1"


def _squeeze(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def _expand(data) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


class Plane:
    """One level: bits in compressed blocks, ones before each block."""

    def __init__(self, data: memoryview, n: int):
        self.n = n
        blocks = -(-n // BLOCK_BITS)
        (self.zeros,) = struct.unpack_from("<Q", data, 0)
        self.ones = np.frombuffer(data, "<u8", blocks, 8)
        self.at = np.frombuffer(data, "<u4", blocks + 1, 8 + 8 * blocks)
        self.body = data[8 + 8 * blocks + 4 * (blocks + 1) :]
        self._last: tuple[int, np.ndarray] | None = None

    @staticmethod
    def pack(bits: np.ndarray) -> bytes:
        packed = np.packbits(bits, bitorder="little")
        starts = np.arange(0, len(packed), BLOCK_BYTES)
        blocks = [_squeeze(packed[i : i + BLOCK_BYTES]) for i in starts]
        # Bits behind the last one are zero.
        ones = np.add.reduceat(np.bitwise_count(packed), starts, dtype=np.uint64) if len(bits) else np.zeros(0, np.uint64)
        before = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(bits) else ones
        at = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
        head = struct.pack("<Q", len(bits) - int(ones.sum())) + before.astype("<u8").tobytes() + at.astype("<u4").tobytes()
        return head + b"".join(blocks)

    def block(self, k: int) -> np.ndarray:
        if self._last is None or self._last[0] != k:
            raw = _expand(self.body[int(self.at[k]) : int(self.at[k + 1])])
            self._last = (k, np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: min(BLOCK_BITS, self.n - k * BLOCK_BITS)])
        return self._last[1]

    def all(self) -> np.ndarray:
        raw = b"".join(_expand(self.body[int(a) : int(b)]) for a, b in zip(self.at[:-1], self.at[1:]))
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n, bitorder="little").view(bool)

    def bit(self, i: int) -> int:
        return int(self.block(i // BLOCK_BITS)[i % BLOCK_BITS])

    def rank1(self, i: int) -> int:
        """Ones among the first i bits."""
        if i >= self.n:
            return self.n - self.zeros
        k = i // BLOCK_BITS
        return int(self.ones[k]) + int(self.block(k)[: i % BLOCK_BITS].sum())

    def select(self, bit: int, nth: int) -> int:
        """Position of the nth (from 0) bit of that value."""
        before = self.ones if bit else np.arange(len(self.ones), dtype=np.int64) * BLOCK_BITS - self.ones.astype(np.int64)
        k = int(np.searchsorted(before, nth, side="right")) - 1
        return k * BLOCK_BITS + int(np.flatnonzero(self.block(k) == bit)[nth - int(before[k])])


class WaveletShard:
    """Read side of a shard."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if bytes(view[:4]) != FORMAT:
            raise ValueError("not a wavelet shard")
        self.bits, self.n_docs, self.n = struct.unpack_from("<IQQ", view, 4)
        lengths = struct.unpack_from(f"<{3 + self.bits}Q", view, 24)
        at = 24 + 8 * len(lengths)
        parts = []
        for length in lengths:
            parts.append(view[at : at + length])
            at += length
        self.doc_ids = np.frombuffer(_expand(parts[0]), "<i8")
        self.id_null = np.frombuffer(_expand(parts[1]), np.uint8).astype(bool)
        self.lengths = np.frombuffer(_expand(parts[2]), "<u8")
        self.planes = [Plane(p, self.n) for p in parts[3:]]

    @staticmethod
    def build(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
        top = int(ids.max()) if len(ids) else 0
        bits = max(1, top.bit_length())
        row = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes = []
        for k in range(bits - 1, -1, -1):
            bit = ((row >> row.dtype.type(k)) & row.dtype.type(1)).view(row.dtype).astype(bool)
            planes.append(Plane.pack(bit))
            row = np.concatenate([row.take(np.flatnonzero(~bit)), row.take(np.flatnonzero(bit))])
        parts = [
            _squeeze(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()),
            _squeeze(np.array([d is None for d in doc_ids], np.uint8).tobytes()),
            _squeeze(np.array(lengths, "<u8").tobytes()),
            *planes,
        ]
        head = FORMAT + struct.pack("<IQQ", bits, len(doc_ids), len(ids)) + struct.pack(f"<{len(parts)}Q", *map(len, parts))
        return head + b"".join(parts)

    def decode(self) -> np.ndarray:
        """All ids: the stable partitions undone from the last plane up."""
        row = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for k, plane in enumerate(reversed(self.planes)):
            bit = plane.all()
            out = np.empty_like(row)
            out[np.flatnonzero(~bit)] = row[: plane.zeros]
            out[np.flatnonzero(bit)] = row[plane.zeros :] | row.dtype.type(1 << k)
            row = out
        return row

    def access(self, i: int) -> int:
        value = 0
        for plane in self.planes:
            bit, ones = plane.bit(i), plane.rank1(i)
            value = value << 1 | bit
            i = plane.zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """The token's range in the last order, for occurrences among the first i."""
        if token >> self.bits:
            return 0, 0
        low, high = 0, min(i, self.n)
        for k, plane in enumerate(self.planes):
            a, b = plane.rank1(low), plane.rank1(high)
            low, high = (plane.zeros + a, plane.zeros + b) if token >> (self.bits - 1 - k) & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int, i: int | None = None) -> int:
        """Occurrences among the first i ids (default all)."""
        low, high = self._range(token, self.n if i is None else i)
        return high - low

    def locate(self, token: int) -> list[int]:
        """Positions of all occurrences, ascending."""
        low, high = self._range(token, self.n)
        found = []
        for p in range(low, high):
            for k, plane in enumerate(reversed(self.planes)):
                bit = token >> k & 1
                p = plane.select(bit, p - plane.zeros if bit else p)
            found.append(p)
        return found


def write_shards(documents: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Table (part, shard, n_docs, n_tokens, data) at `path`, ascending by (part, shard) as by doc_id."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared(PretokenEncoder, tokenizer)
        part, shard = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        ids, coded, held = [], [], 0

        def close():
            nonlocal shard, ids, coded, held
            lengths = [len(c) // 4 for c in coded]
            data = WaveletShard.build(ids, lengths, np.frombuffer(b"".join(coded), "<u4"))
            row = [[part], [shard], [len(ids)], [held], [data]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            shard, ids, coded, held = shard + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["part", "shard", "n_docs", "n_tokens", "data"])

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, texts in byte_groups(batch.column("text")):
                for k, own in enumerate(encoder.id_bytes(texts)):
                    own += end
                    if ids and held + len(own) // 4 > shard_tokens:
                        yield close()
                    ids.append(names[first + k])
                    coded.append(own)
                    held += len(own) // 4
        if ids:
            yield close()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(packed, "part int, shard int, n_docs long, n_tokens long, data binary").write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the shards at `path`."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = WaveletShard(batch.column("data")[k].as_py())
                ids = shard.decode().astype("<u4")
                ends = np.cumsum(shard.lengths.astype(np.int64))
                starts = ends - shard.lengths.astype(np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                same = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("part")[k].as_py()] * same, pa.int32()), pa.array([batch.column("shard")[k].as_py()] * same, pa.int32()),
                        pa.array(shard.doc_ids, pa.int64(), mask=shard.id_null), pa.array(starts, pa.int64()),
                        pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    ["part", "shard", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.parquet(path)
    documents = shards.select("part", "shard", "data").mapInArrow(unpacked, "part int, shard int, doc_id long, within long, n_tokens long, ids_crc32 long")
    # Ids before a shard: those of the parts before (one row a part), then of the part's shards before.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    in_part = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)).alias("inner"))
        .join(parts.select("part", "base"), "part")
        .select("part", "shard", (F.col("base") + F.col("inner")).alias("first"))
    )
    return documents.join(starts, ["part", "shard"]).select("doc_id", (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "op1-shards")
    write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return read_documents(spark, path)


QUERIES = {"op1_wavelet": op1_wavelet}
ORACLES: dict[str, str] = {}
