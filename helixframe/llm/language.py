"""Language identification by averaged subword embeddings and a linear softmax.

A text is lower-cased and reduced to its letters; its subwords are byte n-grams inside words, the
borders of a word included, hashed into ``BUCKETS``. The embeddings of all subwords of the whole
text are averaged and classified by a linear softmax. Both layers are trained together by
stochastic gradient descent in numpy, on the driver, from the hashed counts of at most
``SAMPLE_ROWS`` labelled documents (fewer than ``SAMPLE_ROWS / languages`` of each language by
intent, chosen by a hash of the row). A part of the sample is set aside for calibration: a
temperature that makes the score a probability, and the least score at which at most
``ACCEPTED_ERRORS`` of the accepted texts are wrong. Predictions below it are marked as rejected.

Only rows whose ``crc32(doc_id) % 5`` isn't 0 and whose language isn't null are learned from; a null
id counts as an empty one, and is held out. A text that is null or has no letter is ``und`` with
score 0; so is everything if there is nothing to learn from. Repeated rows get equal predictions,
and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import filled, read
from helixframe.llm.queries import query

UNKNOWN = "und"
BUCKETS = 1 << 14
DIMENSIONS = 16
N_GRAMS = (2, 3, 4)
SAMPLE_ROWS = 3000
STEPS, BATCH, LEARNING_RATE = 1200, 32, 20.0
ACCEPTED_ERRORS = 0.01
SEED = 5

_LETTERS = re.compile(r"[^\W\d_]+")
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@dataclass
class LanguageModel:
    """Weight of every subword for every language; the two layers multiplied."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least_score: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether the score is high enough to be relied on."""
        counts = subword_counts(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, False
        logits = (counts @ self.weights) / max(counts.sum(), 1.0) + self.bias
        chances = softmax(logits / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best]), bool(chances[best] >= self.least_score)


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def subword_counts(text: str | None) -> np.ndarray | None:
    """Number of subwords per bucket, or None if the text has no letter."""
    words = _LETTERS.findall((text or "").lower())
    if not any(letter.isalpha() for word in words for letter in word):
        return None
    joined = f" {' '.join(words)} ".encode("utf-8", "replace")
    data = np.frombuffer(joined, np.uint8)
    blank = data == 32
    data = data.astype(np.uint32)
    counts = np.zeros(BUCKETS)
    for n in N_GRAMS:
        size = len(data) - n + 1
        if size <= 0:
            continue
        value = np.full(size, n, np.uint32)
        for shift in range(n):
            value = value * np.uint32(0x01000193) + data[shift : shift + size]
        inside = np.ones(size, bool)
        for shift in range(1, n - 1):
            inside &= ~blank[shift : shift + size]
        value = value[inside] * _MULTIPLIERS[n % 3]
        counts += np.bincount(value >> np.uint32(18), minlength=BUCKETS)
    return counts


def held_out(doc_id: str = "doc_id") -> Column:
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list:
    """Hashed counts of a bounded sample, as (language, for calibration, buckets, counts)."""
    labelled = docs.where(~held_out() & F.col("lang").isNotNull())
    # One row per language
    sizes = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return []
    each = max(1, rows // len(sizes))
    rates = F.create_map(
        *(F.lit(it) for lang, size in sizes.items() for it in (lang, min(1.0, each / size)))
    )
    place = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(place < F.element_at(rates, F.col("lang"))).select(
        "lang", (F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(5)) == 0).alias("check"), "text"
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, check, text in batch.itertuples(index=False):
                counts = subword_counts(text)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    out.append(
                        (lang, check, at.astype("<u2").tobytes(), counts[at].astype("<f4").tobytes())
                    )
            yield pd.DataFrame(out, columns=["lang", "check", "at", "counts"])

    counted = sample.mapInPandas(count, "lang string, check boolean, at binary, counts binary")
    # The sample is even in the hash, so its size is near its intent; the limit makes it a bound
    found = counted.limit(2 * rows).collect()
    return sorted((tuple(row) for row in found), key=lambda row: (row[0], bytes(row[2]), bytes(row[3])))


def train(sample: list) -> LanguageModel:
    """Fit both layers by gradient descent, then temperature and least score on the rows set aside."""
    languages = sorted({row[0] for row in sample})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    target = np.array([languages.index(row[0]) for row in sample])
    at = [np.frombuffer(row[2], "<u2") for row in sample]
    share = [np.frombuffer(row[3], "<f4") for row in sample]
    share = [it / it.sum() for it in share]
    check = np.array([bool(row[1]) for row in sample])
    if check.all() or not check.any():
        check = np.arange(len(sample)) % 5 == 0
    if check.all():
        check[:] = False

    def dense(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), BUCKETS), np.float32)
        for line, row in enumerate(rows):
            out[line, at[row]] = share[row]
        return out

    random = np.random.default_rng(SEED)
    embeddings = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    learned = np.flatnonzero(~check)
    order = np.zeros(0, np.int64)
    for step in range(STEPS):
        if len(order) < BATCH:
            order = np.concatenate((order, random.permutation(learned)))
        rows, order = order[:BATCH], order[BATCH:]
        rate = np.float32(LEARNING_RATE * (1 - step / STEPS))
        inputs = dense(rows)
        hidden = inputs @ embeddings
        wrong = softmax(hidden @ output + bias).astype(np.float32)
        wrong[np.arange(len(rows)), target[rows]] -= 1
        wrong /= len(rows)
        back = wrong @ output.T
        output -= rate / DIMENSIONS * (hidden.T @ wrong)
        bias -= rate / 100 * wrong.sum(axis=0)
        embeddings -= rate * DIMENSIONS * (inputs.T @ back)
    weights = embeddings @ output

    rows = np.flatnonzero(check) if check.any() else learned
    logits = np.concatenate([dense(rows[k : k + 64]) @ weights + bias for k in range(0, len(rows), 64)])
    truth = target[rows]

    def loss(temperature: float) -> float:
        chances = softmax(logits / temperature)[np.arange(len(rows)), truth]
        return float(-np.log(np.maximum(chances, 1e-12)).mean())

    temperature = min((2.0**power for power in np.arange(-4, 4.01, 0.25)), key=loss)
    chances = softmax(logits / temperature)
    order = np.argsort(-chances.max(axis=1), kind="stable")
    wrong = np.cumsum(chances.argmax(axis=1)[order] != truth[order])
    fine = np.flatnonzero(wrong <= ACCEPTED_ERRORS * np.arange(1, len(rows) + 1))
    least = float(chances.max(axis=1)[order][fine[-1]]) if len(fine) else 1.0
    return LanguageModel(languages, weights.astype(np.float64), bias.astype(np.float64), float(temperature), least)


def identify(docs: DataFrame, model: LanguageModel, reject: bool = False) -> DataFrame:
    """Prediction per document; with ``reject``, unreliable ones are ``und``."""

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [model.predict(text) for text in batch.pop("text")]
            batch["lang_pred"] = [UNKNOWN if reject and not sure else lang for lang, _, sure in found]
            batch["score"] = [score for _, score, _ in found]
            batch["rejected"] = [not sure for _, _, sure in found]
            yield batch

    rows = docs.select("doc_id", held_out().alias("held_out"), filled("text").alias("text"))
    schema = rows.drop("text").schema
    schema = schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInPandas(predict, schema)


@query("op3_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, train(training_sample(docs)))
