"""Quality rules: base measures of a text, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams are counted: one over all documents (raw), one over
documents that labels call good (trusted). The score of a document is the mean over its n-grams of
the logarithm of trusted by raw probability, so that it doesn't depend on length. A document that
passes the base rule is kept if its score is at least ``LEAST_SCORE``; no random numbers are drawn.

The raw counts cover every document and whole texts. The trusted ones are a fit on a sample of at
most ``TRUSTED_ROWS`` labelled documents, those with the smallest hashes of their id. Without
labels both distributions are the same, all scores are 0, and the base rule decides alone.

A null text counts as empty: it has no words and fails the base rule. Repeated rows are judged one
by one and alike. Empty tables give empty results; further columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import byte_array, filled, read
from helixframe.llm.queries import query

N_GRAM = 4
BUCKETS = 1 << 15
#: Added to every count.
SMOOTHING = 1.0
TRUSTED_ROWS = 20_000
#: Nats per n-gram.
LEAST_SCORE = -0.3
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the text holds at least twice."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(
        pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True
    )
    again = counts[windows] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    """The base measures of a text, in the order of ``MEASURES``."""
    words = text.encode("utf-8", "replace").split()
    blanks = sum(map(text.count, BLANKS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - blanks,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def n_gram_buckets(text: str) -> np.ndarray:
    data = byte_array(text).astype(np.uint32)
    count = len(data) - N_GRAM + 1
    if count <= 0:
        return np.zeros(0, np.uint32)
    value = np.zeros(count, np.uint32)
    for shift in range(N_GRAM):
        value *= np.uint32(0x01000193)
        value += data[shift : shift + count]
    value *= np.uint32(0x9E3779B1)
    return value >> np.uint32(32 - BUCKETS.bit_length() + 1)


def trusted_documents(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """A bounded sample of the ids that labels call good."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def n_gram_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Per bucket the n-grams of all documents and those of the trusted ones."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, is_good in zip(batch["text"], batch["good"], strict=True):
                own = np.bincount(n_gram_buckets(text), minlength=BUCKETS)
                raw += own
                if is_good:
                    good += own
        at = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": at, "raw": raw[at], "good": good[at]})

    flagged = docs.select("doc_id", filled("text").alias("text")).join(
        F.broadcast(trusted.withColumn("good", F.lit(True))), "doc_id", "left"
    )
    counts = flagged.select("text", F.col("good").isNotNull().alias("good")).mapInPandas(
        count, "bucket long, raw long, good long"
    )
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Logarithm of trusted by raw probability per bucket; a table of ``BUCKETS`` numbers."""
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():
        raw[row["bucket"]], good[row["bucket"]] = row["raw"], row["good"]
    if not good.any():
        return np.zeros(BUCKETS)
    shares = [(it + SMOOTHING) / (it.sum() + SMOOTHING * BUCKETS) for it in (good, raw)]
    return np.log(shares[0]) - np.log(shares[1])


def score(text: str, ratios: np.ndarray) -> float:
    buckets = n_gram_buckets(text)
    return float(ratios[buckets].mean()) if len(buckets) else 0.0


def judge(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Measures, score and verdict per document, after the named columns (``doc_id`` only)."""
    ratios = log_ratios(n_gram_counts(docs, trusted_documents(labels)))

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.pop("text_to_judge_")
            rows = [(*measure(text), score(text, ratios)) for text in texts]
            found = pd.DataFrame(rows, columns=[*MEASURES, "score"], index=batch.index)
            failed = (found["n_words"] < MIN_WORDS) | (
                100 * found["n_repeat_words"] > MOST_REPEATED_PERCENT * found["n_words"]
            )
            yield batch.assign(
                **found, base_failed=failed, kept=~failed & (found["score"] >= LEAST_SCORE)
            )

    chosen = docs.select(*(columns or ["doc_id"]), filled("text").alias("text_to_judge_"))
    schema = chosen.drop("text_to_judge_").schema
    for name in MEASURES:
        schema = schema.add(name, "long")
    schema = schema.add("score", "double").add("base_failed", "boolean").add("kept", "boolean")
    return chosen.mapInPandas(judged, schema)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    doc = F.struct(*(docs[name] for name in docs.columns)).alias("doc")
    ratios = log_ratios(n_gram_counts(docs, trusted_documents(labels)))

    @F.pandas_udf("boolean")
    def is_kept(texts: pd.Series) -> pd.Series:
        def keep(text: str) -> bool:
            words, _, _, _, repeated = measure(text)
            if words < MIN_WORDS or 100 * repeated > MOST_REPEATED_PERCENT * words:
                return False
            return score(text, ratios) >= LEAST_SCORE

        return texts.map(keep).astype(bool)

    rows = docs.select(doc, filled("text").alias("text")).where(is_kept("text"))
    return rows.select("doc.*")


@query("op7_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", *MEASURES, "base_failed", "kept", "score")
