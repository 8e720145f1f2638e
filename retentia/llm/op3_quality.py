"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words. Each passage is encoded from counts over its words (shapes,
marks, repetition, hashed word ends); gated attention, learned from document labels alone, weighs the passages, and
a logistic layer scores the weighted representation. Training, in numpy on the driver, sees a bounded sample: at most
SAMPLE documents of a label and TRAIN_PASSAGES passages of each, spread over the whole text. Scoring runs over all
passages of whole texts in tasks. One scan of the documents besides the sample; no shuffle of texts.

Defined results: a null or wordless text is one empty passage, so it has a score too. Without labels of both kinds
every score is 0.5. Labels of a repeated doc_id count as their minimum. Rows may repeat; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia.llm.common import table
from retentia.llm.pretokens import text_groups
from retentia.llm.sampling import held_out, sample_ids

PASSAGE_WORDS = 64
SAMPLE = 1200
TRAIN_PASSAGES = 24
HASHED = 16
MARKS = ".,;:!?*#$%&|\"'()-_=@/<>"
WORD_FEATURES = 6 + len(MARKS) + HASHED
FEATURES = WORD_FEATURES + 4
HIDDEN = 12
ATTENTION = 8
EPOCHS = 30
BATCH = 64
RATE = 0.01
DECAY = 1e-4
CUT = 0.7
CACHE_WORDS = 150_000


def word_features(word: str) -> np.ndarray:
    """Letters, capitals, digits, other characters, length and its square, marks, and a signed hash of the word's end."""
    out = np.zeros(WORD_FEATURES, np.float32)
    letters = sum(map(str.isalpha, word))
    digits = sum(map(str.isdigit, word))
    out[:6] = letters, sum(map(str.isupper, word)), digits, len(word) - letters - digits, min(len(word), 50), min(len(word), 50) ** 2 / 10
    for k, mark in enumerate(MARKS):
        out[6 + k] = word.count(mark)
    code = zlib.crc32(word[-4:].lower().encode())
    out[6 + len(MARKS) + code % HASHED] = 1 if code >> 16 & 1 else -1
    return out


class Encoder:
    """Passage features of whole texts; word features in a bounded table."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.table = np.zeros((CACHE_WORDS, WORD_FEATURES), np.float32)

    def _known(self, found: list[str]) -> np.ndarray:
        place = self.place
        new = {w for w in found if w not in place}
        if len(place) + len(new) > len(self.table):
            place.clear()
            new = set(found)
        for word in new:
            at = place[word] = len(place)
            self.table[at] = word_features(word)
        return np.fromiter(map(place.__getitem__, found), np.int64, len(found))

    def passages(self, text: str) -> np.ndarray:
        """(passages, FEATURES): means over a passage's words, distinct share, repeats, commonest word's share, fill."""
        found = text.split()
        if not found:
            return np.zeros((1, FEATURES), np.float32)
        parts = []
        # Long texts in pieces of whole passages.
        step = PASSAGE_WORDS * 800
        for first in range(0, len(found), step):
            at = self._known(found[first : first + step])
            starts = np.arange(0, len(at), PASSAGE_WORDS)
            sizes = np.diff(np.append(starts, len(at)))
            out = np.zeros((len(starts), FEATURES), np.float32)
            out[:, :WORD_FEATURES] = np.add.reduceat(self.table[at], starts) / sizes[:, None]
            where = np.arange(len(at)) // PASSAGE_WORDS
            pairs, counts = np.unique(where * len(self.table) + at, return_counts=True)
            owner = pairs // len(self.table)
            again = (at[1:] == at[:-1]) & (where[1:] == where[:-1])
            out[:, WORD_FEATURES] = np.bincount(owner, minlength=len(starts)) / sizes
            out[:, WORD_FEATURES + 1] = np.bincount(where[1:][again], minlength=len(starts)) / sizes
            top = np.zeros(len(starts))
            np.maximum.at(top, owner, counts)
            out[:, WORD_FEATURES + 2] = top / sizes
            out[:, WORD_FEATURES + 3] = sizes / PASSAGE_WORDS
            parts.append(out)
        return np.concatenate(parts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class AttentionModel:
    """tanh encoder, gated attention over a bag's passages, logistic output."""

    NAMES = ("encode", "encode_bias", "tanh", "gate", "weigh", "out", "out_bias")

    def __init__(self, mean: np.ndarray, scale: np.ndarray, params: dict[str, np.ndarray], shift: float = 0.0):
        self.mean, self.scale, self.params, self.shift = mean, scale, params, shift

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        s = {"x": (x - self.mean) / self.scale}
        s["h"] = np.tanh(s["x"] @ p["encode"] + p["encode_bias"])
        s["t"], s["g"] = np.tanh(s["h"] @ p["tanh"]), _sigmoid(s["h"] @ p["gate"])
        e = (s["t"] * s["g"]) @ p["weigh"]
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        s["a"] = a / np.add.reduceat(a, starts)[bag]
        s["z"] = np.add.reduceat(s["a"][:, None] * s["h"], starts)
        s["y"], s["bag"] = _sigmoid(s["z"] @ p["out"] + p["out_bias"] + self.shift), bag
        return s

    @classmethod
    def train(cls, bags: list[np.ndarray], labels: np.ndarray, positive: float = 0.5) -> AttentionModel | None:
        """positive: share of label 1 among all labelled rows; the sample's own share is corrected to it."""
        if len(set(labels.tolist())) < 2:
            return None
        every = np.concatenate(bags)
        mean, scale = every.mean(0), every.std(0) + 1e-3
        rng = np.random.default_rng(11)
        shapes = ((FEATURES, HIDDEN), (HIDDEN,), (HIDDEN, ATTENTION), (HIDDEN, ATTENTION), (ATTENTION,), (HIDDEN,), (1,))
        params = {n: rng.normal(0, 0.3 / np.sqrt(s[0]), s) if "bias" not in n else np.zeros(s) for n, s in zip(cls.NAMES, shapes)}
        model = cls(mean, scale, params)
        first, second = ({n: np.zeros_like(v) for n, v in params.items()} for _ in range(2))
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                sizes = [len(bags[i]) for i in chosen]
                grads = model._gradients(np.concatenate([bags[i] for i in chosen]), np.cumsum([0, *sizes[:-1]]), labels[chosen])
                step += 1
                for name, grad in grads.items():
                    grad = grad + DECAY * params[name]
                    first[name] = 0.9 * first[name] + 0.1 * grad
                    second[name] = 0.999 * second[name] + 0.001 * grad**2
                    params[name] -= RATE * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
        own = labels.mean()
        model.shift = float(np.log(positive / (1 - positive)) - np.log(own / (1 - own)))
        return model

    def _gradients(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p, s = self.params, self.forward(x, starts)
        dy = (s["y"] - labels) / len(labels)
        dz = dy[:, None] * p["out"]
        da = (s["h"] * dz[s["bag"]]).sum(1)
        de = s["a"] * (da - np.add.reduceat(s["a"] * da, starts)[s["bag"]])
        du = de[:, None] * p["weigh"]
        dt, dg = du * s["g"] * (1 - s["t"] ** 2), du * s["t"] * s["g"] * (1 - s["g"])
        dh = (s["a"][:, None] * dz[s["bag"]] + dt @ p["tanh"].T + dg @ p["gate"].T) * (1 - s["h"] ** 2)
        return {
            "encode": s["x"].T @ dh, "encode_bias": dh.sum(0), "tanh": s["h"].T @ dt, "gate": s["h"].T @ dg,
            "weigh": (s["t"] * s["g"]).T @ de, "out": s["z"].T @ dy, "out_bias": dy.sum(keepdims=True),
        }

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        return self.forward(np.concatenate(bags), np.cumsum([0, *[len(b) for b in bags[:-1]]]))["y"]


def train_quality_model(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AttentionModel | None:
    """Model from at most `sample` documents of each label that are not held out; None without both labels."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")).where("quality IN (0, 1)")
    counts = {r["quality"]: r["count"] for r in known.where(~held_out()).groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    ids = F.broadcast(sample_ids(known, "quality", sample))  # at most `sample` of each of two labels

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            parts = []
            for text in batch.column("text"):
                bag = encoder.passages(text.as_py() or "")
                parts.append(bag[np.unique(np.linspace(0, len(bag) - 1, min(len(bag), TRAIN_PASSAGES)).astype(int))].ravel())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(parts, pa.list_(pa.float32()))], ["doc_id", "label", "bag"])

    rows = documents.select("doc_id", "text").join(ids, "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    bags = sorted(tuple(r) for r in rows.mapInArrow(drawn, "doc_id long, label int, bag array<float>").collect())
    arrays = [np.array(b, np.float32).reshape(-1, FEATURES) for _, _, b in bags]
    return AttentionModel.train(arrays, np.array([y for _, y, _ in bags], float), counts[1] / (counts[0] + counts[1])) if bags else None


def score_documents(documents: DataFrame, model: AttentionModel | None, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages of every row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            scores, sizes = [], []
            for _, texts in text_groups(batch.column("text")):
                bags = [encoder.passages(t) for t in texts]
                scores += model.score(bags).tolist() if model else [0.5] * len(bags)
                sizes += map(len, bags)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64())],
                ["doc_id", "held_out", "score", "n_passages"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out().alias("held_out"))
    out = rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, n_passages long")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"), "n_passages")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_documents(documents, train_quality_model(documents, table(spark, sf_dir, "labels")))


QUERIES = {"op3_quality": op3_quality}
ORACLES: dict[str, str] = {}
