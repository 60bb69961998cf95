"""Language of texts by string kernels: Nystroem landmarks and one-versus-rest kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.scratch import write_table

# rows per language that the classifier is fitted on, and those of them that serve as landmarks: bounds for the driver
FIT_ROWS, LANDMARKS = 1500, 48
# languages with fewer training rows than this are not learned, and at most so many are
LEAST_ROWS, MOST_LANGUAGES = 2, 200
# n-grams of two to four bytes are hashed into this many presence bits
BITS = 1 << 14
NGRAMS = (2, 3, 4)
RIDGE = 1e-3
# texts per matrix product
TEXTS = 256

# ASCII that is no letter reads as a space, so that digits and marks say nothing about the language
_LETTERS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def presence(text: str | None, out: np.ndarray) -> None:
    """Mark in `out` (one byte per bit) every hashed n-gram that the lower-cased text holds."""
    raw = b" " + (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS_ONLY) + b" "
    codes = np.frombuffer(raw, np.uint8).astype(np.uint32)
    grams = codes
    for n in range(2, NGRAMS[-1] + 1):
        grams = grams[:-1] * np.uint32(257) + codes[n - 1 :]
        if n in NGRAMS:
            out[((grams + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - 14)] = 1


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(rows.sum(axis=1, dtype=np.float32), 1))


@dataclass
class Classifier:
    """Scores are kernel values with the landmarks, times one column of weights per language."""

    languages: list[str]
    landmarks: np.ndarray  # presence rows over the square root of their size
    weights: np.ndarray
    offset: np.ndarray

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        """Shared n-grams over the geometric mean of both sizes."""
        rows = rows.astype(np.float32)
        return (rows @ self.landmarks.T) / _norms(rows)[:, None]

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language, and its share of the softened scores."""
        scores = self.kernel(rows) @ self.weights + self.offset
        odds = np.exp(4 * (scores - scores.max(axis=1, keepdims=True)))
        best = scores.argmax(axis=1)
        return best, odds[np.arange(len(rows)), best] / odds.sum(axis=1)


def _spectra(df: DataFrame) -> DataFrame:
    """(lang, bits): presence rows packed to bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for value in batch.column("text"):
                row = np.zeros(BITS, np.uint8)
                presence(value.as_py(), row)
                packed.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(packed, pa.binary())], names=["lang", "h", "bits"])

    return df.select("lang", "h", "text").mapInArrow(pack, "lang string, h long, bits binary")


def fit(training: DataFrame, doc_id: str, text: str, lang: str) -> Classifier | None:
    """A classifier from a bounded sample of `training`: at most about FIT_ROWS rows of each language, by hash of the id.

    None if no language has enough rows. Only whole texts and `lang` are used.
    """
    rows = training.select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(doc_id), F.lit(23)).alias("h")
    ).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = (
        rows.groupBy("lang").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_ROWS).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    )
    if not counts:
        return None
    # a share of each language by hash, so that no language is collected or ordered as a whole
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], min(1.0, FIT_ROWS / row["n"])).otherwise(share)
    picked = rows.filter(F.pmod("h", F.lit(1_000_003)) / 1_000_003.0 < share)
    found = write_table(_spectra(picked), "language-spectra").toArrow().sort_by([("h", "ascending"), ("lang", "ascending")])
    languages = sorted(row["lang"] for row in counts)
    spoken = np.array(found["lang"].to_pylist())
    languages = [x for x in languages if (spoken == x).any()]
    index = np.searchsorted(languages, spoken)
    packed = np.frombuffer(b"".join(found["bits"].to_pylist()), np.uint8).reshape(-1, BITS // 8)
    chosen = np.concatenate([np.flatnonzero(index == k)[:LANDMARKS] for k in range(len(languages))])
    landmarks = np.unpackbits(packed[chosen], axis=1).astype(np.float32)
    landmarks /= _norms(landmarks)[:, None]
    model = Classifier(languages, landmarks, np.zeros(0), np.zeros(0))
    kernel = np.concatenate(
        [model.kernel(np.unpackbits(packed[s : s + TEXTS], axis=1)) for s in range(0, len(packed), TEXTS)]
    ).astype(np.float64)
    # Nystroem: features are kernel values times the inverse root of the landmarks' own kernel
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ root
    # one ridge regression per language against the rest; each language weighs the same
    weight = 1.0 / np.bincount(index, minlength=len(languages))[index]
    weight *= len(weight) / weight.sum()
    target = np.where(index[:, None] == np.arange(len(languages)), 1.0, -1.0)
    centre, middle = np.average(features, axis=0, weights=weight), np.average(target, axis=0, weights=weight)
    x, y = features - centre, target - middle
    solved = np.linalg.solve((x * weight[:, None]).T @ x + RIDGE * len(x) * np.eye(x.shape[1]), (x * weight[:, None]).T @ y)
    model.weights = (root @ solved).astype(np.float32)
    model.offset = (middle - centre @ solved).astype(np.float32)
    return model


def identify(df: DataFrame, text: str, model: Classifier | None, predicted: str = "lang_pred", score: str = "score") -> DataFrame:
    """`df` without `text`, with the language of each whole text and a score between 0 and 1.

    A NULL text, one without any letter, and every text when nothing was learned
    is `und` with score 0. Equal scores go to the language that comes first by
    name. Columns named like the outputs are replaced.
    """
    df = df.drop(*({predicted, score} - {text}))
    kept = [c for c in df.columns if c != text]
    rows = df.select(*kept, F.col(text).alias(text), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letters"))
    if model is None:
        return rows.select(*kept, F.lit("und").alias(predicted), F.lit(0.0).alias(score))
    schema = rows.select(*kept, F.lit("").alias(predicted), F.lit(0.0).alias(score)).schema
    names = [*model.languages, "und"]

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                rows = np.zeros((part.num_rows, BITS), np.uint8)
                letters = np.array(part.column("__letters").to_pylist(), bool)
                for k, value in enumerate(part.column(text)):
                    if letters[k]:
                        presence(value.as_py(), rows[k])
                best, scores = model.predict(rows)
                best, scores = np.where(letters, best, len(names) - 1), np.where(letters, scores, 0.0)
                columns = [part.column(c) for c in kept] + [pa.array([names[k] for k in best]), pa.array(scores.astype(float))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, predicted, score])

    return rows.mapInArrow(classify, schema)
