"""Language identification: averaged hashed subword embeddings under a linear softmax.

Training, in numpy on the driver, sees a bounded sample: at most SAMPLE documents of a language and PASSAGES short
word windows of each, drawn over the whole text by hash. A fifth of the documents is kept back to fit a temperature
and the rejection threshold. Prediction runs over whole texts in tasks; because the model is linear after averaging,
a word's share of the logits is computed once and kept in a bounded cache. One scan, no shuffle.

Defined results: `und` with score 0 for null texts and texts without letters, and for all texts if nothing could be
learned. `rejected` marks these and predictions below the calibrated threshold. Ties go to the first language in
alphabetical order. Rows may repeat; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia.llm.common import table
from retentia.llm.pretokens import text_groups
from retentia.llm.sampling import held_out, sample_ids

SAMPLE = 400
PASSAGES = 4
PASSAGE_WORDS = 10
BUCKETS = 1 << 15
DIM = 16
EPOCHS = 6
BATCH = 32
RATE = 0.5
LONGEST_GRAM = 4
# Share of correctly predicted calibration passages that the threshold may reject.
REJECTED_SHARE = 0.001
CACHE_WORDS = 400_000
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def subwords(word: str) -> list[int]:
    """Buckets of the word and of its character n-grams, with word ends marked; none if it has no letter."""
    if not any(map(str.isalpha, word)):
        return []
    marked = f"<{word}>"
    grams = [marked] + [marked[i : i + n] for n in range(1, LONGEST_GRAM + 1) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode()) % BUCKETS for g in grams]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def passages(doc_id: int, text: str) -> list[list[str]]:
    """Up to PASSAGES word windows, at positions drawn over the whole text by hash of the id."""
    found = words(text)
    room = max(1, len(found) - PASSAGE_WORDS + 1)
    starts = sorted({zlib.crc32(f"{doc_id}:{k}".encode()) % room for k in range(PASSAGES)})
    return [found[s : s + PASSAGE_WORDS] for s in starts] if found else []


class LanguageModel:
    def __init__(self, languages: list[str], shares: np.ndarray, bias: np.ndarray, temperature: float = 1.0, threshold: float = 0.0):
        # shares: (bucket, language) embeddings already multiplied by the output layer.
        self.languages, self.shares, self.bias = languages, shares.astype(np.float32), bias
        self.temperature, self.threshold = temperature, threshold

    @classmethod
    def train(cls, rows: list[tuple[int, str, list[list[str]]]]) -> LanguageModel:
        """rows: (doc_id, language, passages)."""
        languages = sorted({lang for _, lang, _ in rows})
        if not languages:
            return cls([], np.zeros((BUCKETS, 0)), np.zeros(0))
        known: dict[str, list[int]] = {}
        fit, calibrate = [], []
        for doc_id, lang, parts in sorted(rows, key=lambda r: (r[0], r[1])):
            to = calibrate if zlib.crc32(f"calibrate {doc_id}".encode()) % 5 == 0 else fit
            for part in parts:
                grams = [g for w in part for g in known.setdefault(w, subwords(w))]
                if grams:
                    to.append((np.array(grams), languages.index(lang)))
        fit = fit or calibrate
        rng = np.random.default_rng(7)
        embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        out, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
        # Languages weigh alike, however many passages they have.
        size = np.bincount([y for _, y in fit], minlength=len(languages))
        weight = (len(fit) / np.maximum(size, 1) / len(languages)).astype(np.float32)
        steps, step = EPOCHS * -(-len(fit) // BATCH), 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(fit))
            for first in range(0, len(fit), BATCH):
                batch = [fit[i] for i in order[first : first + BATCH]]
                rate = RATE * (1 - step / steps)
                step += 1
                flat = np.concatenate([g for g, _ in batch])
                lengths = np.array([len(g) for g, _ in batch])
                hidden = np.add.reduceat(embed[flat], np.concatenate([[0], np.cumsum(lengths)[:-1]])) / lengths[:, None]
                truth = np.array([y for _, y in batch])
                error = cls._softmax(hidden @ out + bias)
                error[np.arange(len(batch)), truth] -= 1
                error *= weight[truth, None]
                back = error @ out.T
                out -= rate * hidden.T @ error / len(batch) * 4
                bias -= rate * error.mean(0)
                np.add.at(embed, flat, np.repeat(-rate * back / lengths[:, None], lengths, axis=0) * 4)
        model = cls(languages, embed @ out, bias)
        model._calibrate(calibrate or fit)
        return model

    @staticmethod
    def _softmax(logits: np.ndarray) -> np.ndarray:
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def _calibrate(self, rows: list[tuple[np.ndarray, int]]) -> None:
        """Temperature of least log loss; the threshold that rejects REJECTED_SHARE of right predictions."""
        logits = np.array([self.shares[g].mean(axis=0) + self.bias for g, _ in rows])
        truth = np.array([y for _, y in rows])
        tried = np.geomspace(0.1, 10, 81)
        loss = [-np.log(self._softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in tried]
        self.temperature = float(tried[int(np.argmin(loss))])
        chance = self._softmax(logits / self.temperature)
        right = chance.max(axis=1)[chance.argmax(axis=1) == truth]
        # Never above the point where another language would be as likely as not.
        self.threshold = min(float(np.quantile(right, REJECTED_SHARE)), 0.5) if len(right) else 0.0

    def scores(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Calibrated probabilities from summed shares and subword counts."""
        return self._softmax((sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature)


class Predictor:
    """Whole texts to (language, score, rejected); word shares in a bounded table."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.place: dict[str, int] = {}
        self.table = np.zeros((CACHE_WORDS, len(model.languages) + 1), np.float32)

    def _known(self, found: list[str]) -> np.ndarray:
        place = self.place
        new = {w for w in found if w not in place}
        if len(place) + len(new) > len(self.table):
            place.clear()
            new = set(found)
            if len(new) > len(self.table):
                self.table = np.zeros((len(new), self.table.shape[1]), np.float32)
        for word in new:
            at = place[word] = len(place)
            grams = subwords(word)
            self.table[at, :-1] = self.model.shares[grams].sum(axis=0)
            self.table[at, -1] = len(grams)
        return np.fromiter(map(place.__getitem__, found), np.int64, len(found))

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        width = len(self.model.languages)
        totals = np.zeros((len(texts), width + 1))
        for k, text in enumerate(texts):
            found = words(text)
            # Long texts in pieces, so that a piece always fits the table.
            for first in range(0, len(found), 50_000):
                at = self._known(found[first : first + 50_000])
                totals[k] += self.table[at].sum(axis=0, dtype=np.float64)
        if not width:
            return [(UNKNOWN, 0.0, True)] * len(texts)
        chance = self.model.scores(totals[:, :-1], totals[:, -1])
        best = chance.argmax(axis=1)
        out = []
        for k, b in enumerate(best):
            if totals[k, -1] == 0:
                out.append((UNKNOWN, 0.0, True))
            else:
                out.append((self.model.languages[b], float(min(1.0, chance[k, b])), bool(chance[k, b] < self.model.threshold)))
        return out


def train_language_model(documents: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Model from at most `sample` documents of each value of lang that are not held out."""
    ids = F.broadcast(sample_ids(documents.where("text IS NOT NULL"), "lang", sample))  # at most `sample` a language

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [passages(d, t.as_py()) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(parts, pa.list_(pa.list_(pa.string())))], ["doc_id", "lang", "parts"]
            )

    rows = documents.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where("text IS NOT NULL")
    chosen = rows.join(ids.select("doc_id", F.col("label").cast("string").alias("lang")), ["doc_id", "lang"]).select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    return LanguageModel.train([tuple(r) for r in chosen.mapInArrow(drawn, "doc_id long, lang string, parts array<array<string>>").collect()])


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(held.value)
        for batch in batches:
            rows = [r for _, texts in text_groups(batch.column("text")) for r in predictor.predict(texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out().alias("held_out"))
    return rows.mapInArrow(predicted, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """Rows of `documents` whose language is not rejected, all columns as they are.

    Each row is judged by its own text: null ids and repeated rows are kept or go like any other; a null text goes.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(held.value)
        for batch in batches:
            for first, texts in text_groups(batch.column(place)):
                stay = pa.array([not r[2] for r in predictor.predict(texts)], pa.bool_())
                yield batch.slice(first, len(texts)).filter(stay)

    return documents.mapInArrow(kept, documents.schema)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return identify(documents, train_language_model(documents))


QUERIES = {"op2_language": op2_language}
ORACLES: dict[str, str] = {}
