"""SentencePiece models on the tokenizers library: encoding, decoding and parity.

The model protobuf is read field by field; normaliser, white-space marker, piece scores (unigram) or merges (BPE)
and byte fallback are rebuilt as a tokenizers pipeline that encodes and decodes batches on several threads. Ids and
texts are the pipeline's. The sentencepiece library encodes the same input beside it, and decodes what the pipeline
does not decode to the text again; where the two differ, its result replaces the pipeline's, and `differ` says in how
many words and texts that happened.

When no piece has the marker behind another character, no piece crosses the start of a word, and words encode
independently: then each distinct word is encoded once per worker, and its ids, which start with a marker, are decoded;
a text all of whose words come back is what its ids decode to. Of other texts each distinct stretch of ids from a marker
on is decoded once per worker (tables bounded by bytes). Other models encode and decode whole texts.

Defined results: a null text is empty and has no ids; rows may repeat; other columns are not read. A text holding
the marker character itself, or characters a normaliser changes, encodes as in sentencepiece but is not `lossless`.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia.llm.common import Generations, table
from retentia.llm.pretokens import GROUP_CHARS, as_bytes, gathered, shared, text_groups

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
# Bytes of a worker's two tables: three quarters for words, the rest for stretches.
TABLE_BYTES = 160_000_000
# Texts are worked on in groups of about so many characters where only digests are made: the larger the group, the fewer
# words are looked up. Where ids or texts go out, groups are small beside them.
DIGEST_GROUP_CHARS = 2_000_000
# What a word's entry says in its last number, behind the ids.
DIFFERS, ALTERED = 1, 2
# A space and the word behind it with the spaces before that; the spaces at the end.
WORD = re.compile(" ( *[^ ]+| *$)")
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_SURFACE = " \u2047 "


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def proto_fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one message; nested messages stay bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        number, kind = key >> 3, key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield number, value


class ModelFile:
    """Pieces, scores, types and settings of a SentencePiece model."""

    def __init__(self, data: bytes):
        self.data = data
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        trainer, normal = {}, {}
        for number, value in proto_fields(data):
            if number == 1:
                piece = dict(proto_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(proto_fields(value))
            elif number == 3:
                normal = dict(proto_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unk_surface = trainer.get(44, UNKNOWN_SURFACE.encode()).decode()
        self.unk = self.types.index(UNKNOWN)
        self.charsmap = normal.get(2, b"")
        self.dummy_prefix = bool(normal.get(3, 1))
        self.squeeze = bool(normal.get(4, 1))
        self.escape = bool(normal.get(5, 1))

    def tokenizer(self, strip_prefix: bool = True):
        """The tokenizers pipeline that encodes and decodes like the model."""
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        if not self.escape:
            raise ValueError("models without white-space markers are not supported")
        if self.kind == UNIGRAM:
            low = min(self.scores) - 10.0
            usable = [(p, s if t in (NORMAL, USER, UNKNOWN) else low) for p, s, t in zip(self.pieces, self.scores, self.types)]
            core = models.Unigram(usable, unk_id=self.unk, byte_fallback=self.byte_fallback)
        elif self.kind == BPE:
            score = {p: s for p, s, t in zip(self.pieces, self.scores, self.types) if t in (NORMAL, USER)}
            merges = [
                (-score[p], len(p[:i]), p[:i], p[i:]) for p in score for i in range(1, len(p)) if p[:i] in score and p[i:] in score
            ]
            core = models.BPE(
                vocab={p: i for i, p in enumerate(self.pieces)}, merges=[(a, b) for _, _, a, b in sorted(merges)],
                unk_token=self.pieces[self.unk], byte_fallback=self.byte_fallback, fuse_unk=True,
            )
        else:
            raise ValueError(f"model type {self.kind} is not supported")
        made = Tokenizer(core)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        steps.append(normalizers.Replace(" ", MARKER))
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARKER))
        made.normalizer = normalizers.Sequence(steps)
        back = [decoders.Replace(self.pieces[self.unk], self.unk_surface), decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
        made.decoder = decoders.Sequence(back + [decoders.Strip(" ", 1, 0)] * (self.dummy_prefix and strip_prefix))
        return made


class PieceCoder:
    def __init__(self, path: str, threads: int | None = None):
        """`threads` of the library: by default as many as Spark gives a task (spark.task.cpus)."""
        task = TaskContext.get()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads or (task.cpus() if task else 1)))
        import sentencepiece

        with open(path, "rb") as file:
            self.model = ModelFile(file.read())
        self.library = self.model.tokenizer()
        # The same decoder without its last step, which takes the prefix off the front of a text.
        self.inner = self.model.tokenizer(strip_prefix=False)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=self.model.data)
        # Words are independent if pieces hold the marker only in front, and no normaliser looks across words.
        usable = [p for p, t in zip(self.model.pieces, self.model.types) if t in (NORMAL, USER)]
        self.by_word = (
            self.model.dummy_prefix and not self.model.charsmap and not self.model.squeeze and USER not in self.model.types
            and not any(MARKER in p.lstrip(MARKER) for p in usable)
        )
        self.starts = np.array([p.startswith(MARKER) for p in self.model.pieces])
        self.marked = frozenset(np.flatnonzero(self.starts).tolist())
        # Ids and flags by word, texts by stretch of ids.
        self.ids, self.texts = Generations(TABLE_BYTES * 3 // 4), Generations(TABLE_BYTES // 4)

    def _encoded(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """(ids, whether the libraries differ) of whole texts."""
        ours = [own.ids for own in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        theirs = self.reference.encode(texts, num_threads=1)
        if ours == theirs:
            return ours, [False] * len(texts)
        return theirs, [a != b for a, b in zip(ours, theirs)]

    @staticmethod
    def words(text: str) -> list[str]:
        """Words with the spaces before them; the text starts with the space of the prefix, spaces at its end are a word."""
        return WORD.findall(" " + text.replace(MARKER, " "))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        return self.encode_checked(texts)[0]

    def encode_checked(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """(uint32 ids, words that differed) of each text."""
        if not self.by_word:
            coded, odd = self._encoded(texts)
            return [np.array(ids, "<u4") for ids in coded], list(map(int, odd))
        return self._by_word(texts)[:2]

    def _by_word(self, texts: list[str]) -> tuple[list[np.ndarray], list[int], list[bool]]:
        """(uint32 ids, words that differed, whether the ids of every word decode to it) of each text."""
        # Words with one space between each two are split in Arrow.
        single = [t[:1] not in ("", " ") and t[-1] != " " and "  " not in t and MARKER not in t for t in texts]
        split = pc.split_pattern(pa.array([t for t, s in zip(texts, single) if s], pa.string()), " ")
        others = [self.words(t) if t else [] for t, s in zip(texts, single) if not s]
        words = pa.concat_arrays([split.values, pa.array(list(chain.from_iterable(others)), pa.string())]).dictionary_encode()
        values = self.ids.values(words.dictionary.to_numpy(zero_copy_only=False).tolist(), self._entries)
        codes = words.indices.to_numpy()
        ids, edges = gathered([v[:-4] for v in values], codes)
        flags = np.fromiter((v[-4] for v in values), np.int64, len(values))
        odd, altered = (np.concatenate([[0], np.cumsum((flags & f != 0)[codes])]) for f in (DIFFERS, ALTERED))
        # Where each text's words start and end, in the order of the texts.
        ends = split.offsets.to_numpy().astype(np.int64)
        more = ends[-1] + np.cumsum([0, *map(len, others)])
        place = np.concatenate([ends[:-1], more[:-1]]), np.concatenate([ends[1:], more[1:]])
        order = np.argsort(np.argsort(~np.array(single, bool), kind="stable"))
        low, high = (p[order] for p in place)
        found = [ids[a:b] for a, b in zip(edges[low].tolist(), edges[high].tolist())]
        return found, (odd[high] - odd[low]).tolist(), (altered[high] == altered[low]).tolist()

    def _entries(self, words: list[str]) -> list[bytes]:
        """Ids of each word and a number of flags; a word's prefix marker stands for the space before it, the empty word is that marker alone."""
        coded, odd = self._encoded([w for w in words if w])
        if "" in words:
            at = words.index("")
            coded.insert(at, [self.model.pieces.index(MARKER)]), odd.insert(at, False)
        back = self.inner.decode_batch(coded, skip_special_tokens=False)
        starts = self.marked
        return as_bytes([
            [*ids, DIFFERS * differs | ALTERED * (text != " " + word or ids[0] not in starts)] for ids, differs, text, word in zip(coded, odd, back, words)
        ])

    def coded(self, texts: list[str]) -> tuple[list[np.ndarray], list[str], list[int]]:
        """(uint32 ids, text decoded from them, how often the libraries differed) of each text."""
        if not self.by_word:
            ids, differ = self.encode_checked(texts)
            rest = range(len(texts))
        else:
            ids, differ, same = self._by_word(texts)
            rest = [k for k, (t, s) in enumerate(zip(texts, same)) if not s or MARKER in t]
        back = list(texts)
        for k, text, odd in zip(rest, *self.decode_checked([ids[k] for k in rest], [texts[k] for k in rest])):
            back[k] = text
            differ[k] += odd
        return ids, back, differ

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts as the pipeline decodes them, of any ids."""
        if not self.by_word:
            return self.library.decode_batch([i.tolist() for i in ids], skip_special_tokens=False)
        cut = [self._stretches(own) for own in ids]
        distinct = list(set().union(*cut))
        get = dict(zip(distinct, self.texts.values(distinct, self._spelled))).__getitem__
        out = ["".join(map(get, stretches)) for stretches in cut]
        # The prefix of a text is taken off, as the pipeline's last step does.
        return [t[1:] if t[:1] == " " else t for t in out]

    def _spelled(self, stretches: list[bytes]) -> list[str]:
        return self.inner.decode_batch([np.frombuffer(s, "<u4").tolist() for s in stretches], skip_special_tokens=False)

    def decode_checked(self, ids: list[np.ndarray], texts: list[str]) -> tuple[list[str], list[int]]:
        """(text, whether it had to be replaced) of the ids of each text: what is not the text again, sentencepiece decodes too."""
        back, odd = self.decode(ids), [0] * len(ids)
        for k, (own, text) in enumerate(zip(back, texts)):
            if own != text:
                known = self.reference.decode(ids[k].tolist())
                back[k], odd[k] = known, int(own != known)
        return back, odd

    def _stretches(self, ids: np.ndarray) -> list[bytes]:
        """The ids from each piece with a marker up to the next, as bytes."""
        ids = np.asarray(ids).astype("<u4")
        edges = (np.flatnonzero(self.starts[ids]) * 4).tolist()
        edges = [0, *edges] if len(ids) and (not edges or edges[0]) else edges
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(edges, [*edges[1:], len(data)])]


def _coded(documents: DataFrame, path: str, schema: str, columns, group_chars: int = GROUP_CHARS) -> DataFrame:
    """doc_id and what `columns` makes of (texts, ids, decoded texts) of every row, and how often the libraries differed."""
    names = [f.split()[0] for f in schema.split(", ")]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared(PieceCoder, path)
        for batch in batches:
            for first, texts in text_groups(batch.column("text"), group_chars):
                ids, back, differ = coder.coded(texts)
                lossless = pa.array([a == b for a, b in zip(texts, back)], pa.bool_())
                own = [batch.column("doc_id").slice(first, len(texts)), *columns(ids, back), lossless, pa.array(differ, pa.int64())]
                yield pa.RecordBatch.from_arrays(own, names)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(coded, schema)


def encode_documents(documents: DataFrame, path: str, decoded: bool = True) -> DataFrame:
    """doc_id, ids (array<int>), decoded (if wanted), lossless, differ of every row."""

    def columns(ids, back):
        listed = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
        return [listed, pa.array(back, pa.string())] if decoded else [listed]

    text = "decoded string, " if decoded else ""
    return _coded(documents, path, f"doc_id long, ids array<int>, {text}lossless boolean, differ long", columns)


def digest_documents(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32, decoded_sha256, lossless, differ: what `encode_documents` gives, without the ids themselves."""

    def columns(ids, back):
        return [
            pa.array([len(i) for i in ids], pa.int64()), pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
            pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back], pa.string()),
        ]

    return _coded(documents, path, "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, lossless boolean, differ long", columns, DIGEST_GROUP_CHARS)


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))


QUERIES = {"op9_pieces": op9_pieces}
ORACLES: dict[str, str] = {}
