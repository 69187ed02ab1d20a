"""Whole results of operators that SQL can't express, against plain Python over the same tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest

from helixframe.llm import language, quality, substring_dedup, suffix_dedup, url_filters
from helixframe.llm.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def table(name: str, columns: str) -> list[tuple]:
    return duckdb.connect().execute(f"SELECT {columns} FROM '{SF_DIR}/{name}.parquet'").fetchall()


def by_id(df, key: str = "doc_id") -> dict:
    return {row[key]: row.asDict() for row in df.collect()}


# Language identification


def plain_prediction(model: language.LanguageModel, text: str | None) -> tuple[str, float]:
    """One subword after another, with Python's numbers."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not any(it.isalpha() for it in "".join(words)):
        return "und", 0.0
    data, seen = f" {' '.join(words)} ".encode(), Counter()
    factors = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
    for n in (2, 3, 4):
        for at in range(len(data) - n + 1):
            gram = data[at : at + n]
            if 32 in gram[1:-1]:
                continue
            value = n
            for byte in gram:
                value = (value * 0x01000193 + byte) % (1 << 32)
            seen[(value * factors[n % 3] % (1 << 32)) >> 18] += 1
    total = sum(seen.values())
    logits = [
        sum(count * model.weights[bucket][k] for bucket, count in seen.items()) / total + model.bias[k]
        for k in range(len(model.languages))
    ]
    powers = [math.exp((it - max(logits)) / model.temperature) for it in logits]
    best = max(range(len(powers)), key=powers.__getitem__)
    return model.languages[best], powers[best] / sum(powers)


def test_language_predictions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.train(language.training_sample(docs))
    found = by_id(QUERIES["op3_language_id"](spark, SF_DIR))
    texts = table("documents", "doc_id, text")
    assert len(found) == len(texts)
    for doc_id, text in texts:
        lang, score = plain_prediction(model, text)
        assert found[doc_id]["lang_pred"] == lang
        assert found[doc_id]["score"] == pytest.approx(score, abs=1e-9)


# Substrings


def plain_chunks(data: bytes) -> list[tuple[int, int]]:
    """The hash rolls byte by byte; a window of sixteen bytes is all it remembers."""
    out, begin, value = [], 0, 0
    gear = [int(it) for it in substring_dedup._GEAR]
    for at, byte in enumerate(data):
        value = ((value << 2) + gear[byte]) % (1 << 32)
        if value >> 27 == 0 or at + 1 - begin == 4096 or at + 1 == len(data):
            out.append((begin, at + 1))
            begin = at + 1
    return out


def runs_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def plain_repeats(docs: dict[int, bytes]) -> dict[int, tuple[int, int, int, int]]:
    chunks = {doc: plain_chunks(data) for doc, data in docs.items()}
    times, owner = Counter(), {}
    for doc in sorted(docs):
        for begin, end in chunks[doc]:
            times[docs[doc][begin:end]] += 1
            owner.setdefault(docs[doc][begin:end], doc)
    out = {}
    for doc, data in docs.items():
        repeated = [it for it in chunks[doc] if times[data[slice(*it)]] > 1]
        long = [(a, b) for a, b in runs_of(repeated) if b - a >= 64]
        gone, seen = [], set()
        for begin, end in repeated:
            content = data[begin:end]
            inside = any(a <= begin and end <= b for a, b in long)
            if inside and (owner[content] != doc or content in seen or end - begin < 16):
                gone.append((begin, end))
            seen.add(content)
        cut = [(a, b) for a, b in runs_of(gone) if b - a >= 64]
        out[doc] = (len(data), sum(b - a for a, b in long), sum(b - a for a, b in cut), len(cut))
    return out


def test_substrings(spark):
    docs = {doc: (text or "").encode() for doc, text in table("documents", "doc_id, text")}
    found = by_id(QUERIES["op4_substring_dedup"](spark, SF_DIR))
    names = ("n_bytes", "n_repeated", "n_removed", "n_spans")
    expected = plain_repeats(docs)
    assert {doc: tuple(row[name] for name in names) for doc, row in found.items()} == expected
    assert sum(row[2] > 0 for row in expected.values()) > 10


def test_substrings_of_long_texts(spark):
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefgh ", k=500))
    docs = {
        1: "a" * 10_000,
        2: "".join(rng.choices("abc", k=30_000)) + passage,
        3: passage * 3,
        4: "x" + passage,
        5: "",
        6: "a" * 9_999,
    }
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = by_id(substring_dedup.count_repeats(df))
    names = ("n_bytes", "n_repeated", "n_removed", "n_spans")
    assert {doc: tuple(row[name] for name in names) for doc, row in found.items()} == plain_repeats(
        {doc: text.encode() for doc, text in docs.items()}
    )


# URL filters


def plain_verdicts(pages: list[tuple]) -> dict[int, str]:
    """Rules, host graph and both ranks by power iteration over dictionaries."""
    lower = {k: k + 32 for k in range(65, 91)}
    rules = url_filters.RULES
    parsed, links, seeds = {}, Counter(), {"allow": Counter(), "block": Counter()}
    for page_id, url, html in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = host.translate(lower)
        fitting = [
            (len(h + p), verdict)
            for verdict, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        verdict = max(fitting)[1] if fitting else None
        parsed[page_id] = (host, verdict)
        if verdict:
            seeds[verdict][host] += 1
        for it in re.findall(r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'<>\s]+)""", html or ""):
            target = re.sub(":[0-9]*$", "", re.sub("^[^@]*@", "", it.translate(lower)))
            if host and target:
                links[host, target] += 1
    for host in {it for pair in links for it in pair[1:]} | {host for host, _ in parsed.values()}:
        labels = host.split(".")
        for k in range(len(labels) - 2):
            above, below = ".".join(labels[k + 1 :]), ".".join(labels[k:])
            links[below, above] = max(links[below, above], 0)
    family = Counter()
    for host in {it for pair in links for it in pair[1:]} | {host for host, _ in parsed.values()}:
        labels = host.split(".")
        for k in range(len(labels) - 2):
            pair = (".".join(labels[k:]), ".".join(labels[k + 1 :]))
            family[pair] = family[pair[::-1]] = 1
    links = Counter({pair: n for pair, n in (links + family).items() if pair[0] != pair[1] and n})

    def ranks(edges: Counter, first: Counter) -> dict[str, float]:
        out_of = defaultdict(int)
        for (a, _), n in edges.items():
            out_of[a] += n
        total = sum(first.values())
        mass = {host: n / total for host, n in first.items()}
        rank = defaultdict(float, mass)
        for _ in range(120):
            moved = defaultdict(float)
            for (a, b), n in edges.items():
                if a in mass:
                    moved[b] += 0.85 * mass[a] * n / out_of[a]
            mass = moved
            for host, it in mass.items():
                rank[host] += it
        every = sum(rank.values())
        return {host: it / every for host, it in rank.items()}

    trust = ranks(links, seeds["allow"]) if seeds["allow"] else {}
    distrust = ranks(Counter({(b, a): n for (a, b), n in links.items()}), seeds["block"]) if seeds["block"] else {}
    return {
        page_id: verdict or ("block" if distrust.get(host, 0) > trust.get(host, 0) else "allow")
        for page_id, (host, verdict) in parsed.items()
    }


def test_verdicts_of_the_pages(spark):
    found = by_id(QUERIES["op5_url_filters"](spark, SF_DIR), "page_id")
    expected = plain_verdicts(table("pages", "page_id, url, html"))
    assert {page: row["verdict"] for page, row in found.items()} == expected


def test_verdicts_of_linked_pages(spark):
    rng = random.Random(3)
    hosts = [f"h{k}.{rng.choice(['net', 'org', 'com'])}" for k in range(30)]
    hosts += [f"sub{k}.{hosts[k]}" for k in range(8)] + ["example.org"]
    pages = []
    for k in range(200):
        html = "".join(f'<a href="http://{rng.choice(hosts)}/x">t</a>' for _ in range(rng.randint(0, 4)))
        pages.append((k, f"http://{rng.choice(hosts)}/{rng.choice(['en/1', 'es/', 'fr/2', 'de/3', ''])}", html))
    # Repeated rows, null columns, a very long page and columns with clashing names
    pages += [(200, "http://h1.net/", None), (200, "http://h1.net/", None), (201, None, "<a href=//h1.net>"), (202, "http://h2.net/", '<a href="//h3.net/">' * 50_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    df = df.selectExpr("*", "'x' AS host", "'y' AS verdict", "1 AS rank", "'z' AS kind")
    found = url_filters.judge_urls(df.drop("host", "verdict")).collect()
    assert len(found) == len(pages)
    expected = plain_verdicts(pages)
    assert {row["page_id"]: row["verdict"] for row in found} == expected
    assert set(expected.values()) == {"allow", "block"}
    clashing = url_filters.judge_urls(df).collect()
    assert {row["page_id"]: row["verdict"] for row in clashing} == expected


# Quality


def test_quality_scores(spark):
    texts = {doc: (text or "").encode() for doc, text in table("documents", "doc_id, text")}
    good = {doc for doc, label in table("labels", "doc_id, quality") if label == 1}

    def buckets(data: bytes) -> list[int]:
        out = []
        for at in range(len(data) - 3):
            value = 0
            for byte in data[at : at + 4]:
                value = (value * 0x01000193 + byte) % (1 << 32)
            out.append((value * 0x9E3779B1 % (1 << 32)) >> (33 - quality.BUCKETS.bit_length()))
        return out

    own = {doc: Counter(buckets(data)) for doc, data in texts.items()}
    raw, trusted = Counter(), Counter()
    for doc, counts in own.items():
        raw += counts
        if doc in good:
            trusted += counts
    extra = quality.SMOOTHING * quality.BUCKETS
    all_raw, all_trusted = sum(raw.values()) + extra, sum(trusted.values()) + extra

    def ratio(bucket: int) -> float:
        smooth = quality.SMOOTHING
        return math.log((trusted[bucket] + smooth) / all_trusted) - math.log((raw[bucket] + smooth) / all_raw)

    found = by_id(QUERIES["op7_quality_rules"](spark, SF_DIR))
    assert len(found) == len(texts)
    for doc, counts in own.items():
        total = sum(counts.values())
        score = sum(n * ratio(bucket) for bucket, n in counts.items()) / total if total else 0.0
        assert found[doc]["score"] == pytest.approx(score, abs=1e-9)
        if abs(score - quality.LEAST_SCORE) > 1e-9:
            assert found[doc]["kept"] == (not found[doc]["base_failed"] and score >= quality.LEAST_SCORE)


# Suffix dedup


@pytest.mark.parametrize("width", [1, 5, 31])
def test_anchors_of_texts_in_parts(monkeypatch, width):
    """The smallest hash of every window, leftmost; a long text is looked at in parts."""
    rng = np.random.default_rng(width)
    hashes = rng.integers(0, 40, 700, dtype=np.uint64) << np.uint64(40)
    expected = sorted({int(at + hashes[at : at + width].argmin()) for at in range(len(hashes) - width + 1)})
    for bits in (7, 8, 28):
        monkeypatch.setattr(suffix_dedup, "PLACE_BITS", bits)
        assert suffix_dedup.anchors(hashes, width).tolist() == expected


def test_a_very_long_text(spark):
    from test_llm import check_suffix

    rng = random.Random(4)
    passage = "".join(rng.choices("abcde ", k=300))
    docs = [(1, "".join(rng.choices("abcdefgh ", k=60_000)) + passage), (2, "z" * 50 + passage), (3, None), (4, "b" * 5000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check_suffix([row.asDict() for row in suffix_dedup.remove_repeats(df, 100).collect()], docs, 100)
