"""Phrases against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from helixframe.llm import collocations as module


def plain_pieces(text: str | None) -> list[list[str]]:
    upper = {k: k + 32 for k in range(65, 91)}
    pieces = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(upper))
    return [re.findall(r"[^\x20\x09]+", it) for it in pieces]


def plain_collocations(rows: list[tuple], least: int, covered: int, top: int) -> list[tuple]:
    counts: Counter = Counter()
    for text, lang in rows:
        for words in plain_pieces(text):
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    counts[(lang or "und", *words[at : at + size])] += 1
    out = []
    candidates = {key: n for key, n in counts.items() if len(key) > 2 and n >= least}
    most: Counter = Counter()
    for (lang, *words), n in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                inner = (lang, *words[at : at + size])
                most[inner] = max(most[inner], n)
    for (lang, *words), a in candidates.items():
        if 100 * most[(lang, *words)] >= covered * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        n = sum(f for key, f in counts.items() if key[0] == lang and len(key) == 2)
        out.append((lang, " ".join(words), a, left, right, n, score))
    ranked = []
    for lang in {row[0] for row in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, k, *row[1:]) for k, row in enumerate(own[:top], 1)]
    return sorted(ranked)


def mined(spark, rows, **given) -> list[tuple]:
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    return sorted(tuple(row) for row in module.mine_collocations(docs, **given).drop("left", "right").collect())


def random_rows(seed: int, count: int, words: list[str]) -> list[tuple]:
    rng = random.Random(seed)
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", ";"]
    return [
        (
            "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 80))),
            rng.choice(["en", "en", "de", None]),
        )
        for _ in range(count)
    ]


@pytest.mark.parametrize("shard_bytes", [100, 1 << 22])
@pytest.mark.parametrize("least", [2, 7])
def test_against_plain_counts(spark, monkeypatch, shard_bytes, least):
    monkeypatch.setattr(module, "SHARD_BYTES", shard_bytes)
    rows = random_rows(least, 120, ["a", "B", "b", "Ünd", "ÜND", "c-d", "x y", "\x85", "é"])
    found = mined(spark, rows, least=least, covered=80, top=50)
    assert found == plain_collocations(rows, least, 80, 50)
    assert len(found) > 20


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = random_rows(5, 100, list("abcdef"))
    before = mined(spark, rows, least=5)
    monkeypatch.setattr(module, "BITS_PER_KEY", 0.0001)
    monkeypatch.setattr(module, "BLOCK_BITS", 32_768)
    everything = module.Filter(1, np.full(4096, 255, np.uint8))
    monkeypatch.setattr(
        module, "frequent_filter", lambda rows, keys: rows.sparkSession.sparkContext.broadcast(everything)
    )
    assert mined(spark, rows, least=5) == before


@pytest.mark.parametrize("seed", range(5))
def test_index_counts_phrases_and_their_extensions(seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices("abc", k=rng.randint(0, 40))) + rng.choice(["", ".", ", b a"]) for _ in range(6)]
    shard = module.Shard([it.encode() for it in texts], ["en"] * len(texts))
    words = {h: shard.data[shard.starts[k] : shard.ends[k]].decode() for h, k in zip(range(9), shard.example)}
    symbols = shard.symbols(np.ones(len(shard.hashes), bool))
    found = {}
    for phrase, sizes, left, right in module.phrases(symbols, 4, None, 1):
        for row, *numbers in zip(phrase.tolist(), sizes, left, right, strict=True):
            found[tuple(words[it - module.FIRST_WORD] for it in row)] = tuple(map(int, numbers))
    expected: dict[tuple, list[int]] = {}
    for text in texts:
        for piece in plain_pieces(text):
            for size in range(2, 5):
                for at in range(len(piece) - size + 1):
                    counts = expected.setdefault(tuple(piece[at : at + size]), [0, 0, 0])
                    counts[0] += 1
                    counts[1] += at > 0
                    counts[2] += at + size < len(piece)
    assert found == {key: tuple(it) for key, it in expected.items()}


@pytest.mark.parametrize("size", [3, 4])
@pytest.mark.parametrize("seed", range(4))
def test_text_without_words_in_no_phrase(seed, size):
    rng = np.random.default_rng(seed)
    symbols = np.concatenate(([0], rng.integers(0, 9, 600), [0]))

    def may_be(rows):
        return (rows @ np.array([7, 3, 5])[: size - 1]) % 5 < 2

    def long_phrases(text):
        found = {}
        for phrase, *numbers in module.phrases(text, size, may_be, size - 1):
            if phrase.shape[1] == size:
                found |= dict(zip(map(tuple, phrase.tolist()), zip(*numbers, strict=True), strict=True))
        return found

    less = module.only_in_phrases(symbols, size, may_be)
    assert len(less) < len(symbols)
    assert long_phrases(less) == long_phrases(symbols) != {}
    for phrase in long_phrases(symbols):
        assert may_be(np.array([phrase[:-1], phrase[1:]])).all()


def test_odd_documents(spark, odd_docs, no_docs):
    # Repeated rows count twice, and a very long text is counted whole
    rows = [(row["text"], row["lang"]) for row in odd_docs.collect()]
    found = module.mine_collocations(odd_docs, least=8)
    assert sorted(tuple(it) for it in found.drop("left", "right").collect()) == plain_collocations(rows, 8, 80, 2000)
    assert module.mine_collocations(no_docs).count() == 0
    assert module.mine_collocations(odd_docs.where("doc_id IN (1, 2, 6)")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9 * 10**17
    phrases = {2: spark.createDataFrame([(1, 2, 0, 0, big)], "w1 long, w2 long, w3 long, w4 long, f long")}
    words = spark.createDataFrame([(1, big + 1), (2, big + 3)], "w1 long, f long")
    row = module.scored_phrases(phrases, words).first()
    assert (row["l"], row["r"]) == (big + 1, big + 3)
    assert row["score"] == 2_000_000 * big // (2 * big + 4)


def test_parts_that_are_too_many_to_broadcast(spark, monkeypatch):
    schema = "w1 long, w2 long, w3 long, w4 long, f long"
    phrases = {
        2: spark.createDataFrame([(1, 2, 0, 0, 60), (2, 3, 0, 0, 50), (3, 4, 0, 0, 55)], schema),
        3: spark.createDataFrame([(1, 2, 3, 0, 45), (2, 3, 4, 0, 40)], schema),
        4: spark.createDataFrame([(1, 2, 3, 4, 35)], schema),
    }
    words = spark.createDataFrame([(k, 100 + k) for k in range(1, 5)], "w1 long, f long")
    expected = sorted(tuple(it) for it in module.scored_phrases(phrases, words).collect())
    monkeypatch.setattr(module, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(module, "WORD_ROWS", -1)
    scored = module.scored_phrases(phrases, words)
    # A salted join holds its rows several times; six of them in a chain are not one plan
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
    assert sorted(tuple(it) for it in scored.collect()) == expected
    assert len(expected) == 6
