"""Operators on texts against plain versions, and on tables of odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from oracle import compare, connect

import corpus_pipeline
from helixframe.llm import (
    exact_dedup,
    html_text,
    language,
    mixing,
    ngram_join,
    packing,
    quality,
    substring_dedup,
    suffix_dedup,
    url_filters,
)
from helixframe.llm.catalog import ORACLES, QUERIES
from helixframe.llm.common import byte_array
from helixframe.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def table(name: str) -> list[tuple]:
    return duckdb.connect().execute(f"SELECT * FROM '{SF_DIR}/{name}.parquet'").fetchall()


def rows(df) -> list[dict]:
    return [row.asDict() for row in df.collect()]


@pytest.fixture(scope="module")
def texts() -> dict[int, str]:
    return {row[0]: row[1] or "" for row in table("documents")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_a_query_per_operator():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


# Exact dedup


def test_exact_dedup_odd_rows(odd_docs, no_docs):
    found = rows(exact_dedup.mark_copies(odd_docs))
    assert len(found) == 10
    by_group = defaultdict(list)
    for row in found:
        by_group[row["text_sha256"]].append(row)
    assert all(sum(row["kept"] for row in group) == 1 for group in by_group.values())
    empty = by_group[hashlib.sha256(b"").hexdigest()]
    assert {(row["doc_id"], row["keep_id"], row["group_size"]) for row in empty} == {(1, 2, 2), (2, 2, 2)}
    upper = next(row for row in found if row["doc_id"] == 5)
    assert (upper["kept"], upper["group_size"]) == (True, 3)
    kept = rows(exact_dedup.drop_copies(odd_docs))
    assert len(kept) == len(by_group) and set(kept[0]) == set(odd_docs.columns)
    assert exact_dedup.mark_copies(no_docs).count() == 0
    assert exact_dedup.drop_copies(no_docs).count() == 0


def test_full_filter_changes_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = exact_dedup.mark_copies(docs).toPandas().sort_values("doc_id", ignore_index=True)
    monkeypatch.setattr(exact_dedup, "MAX_BLOCKS", 1)
    monkeypatch.setattr(exact_dedup, "BLOCK_BITS", 8)
    after = exact_dedup.mark_copies(docs).toPandas().sort_values("doc_id", ignore_index=True)
    pd.testing.assert_frame_equal(before, after)


# Packing


def test_tokens_are_those_of_the_tokenizer():
    import public_tokenizers

    words = packing.WordTokenizer(public_tokenizers.path(packing.TOKENIZER))
    random.seed(1)
    alphabet = "abzAZ0 9'!?#<|>\t\nÀßÿ×÷éμΣ́  日'sd\x1c\x85"
    cases = ["".join(random.choices(alphabet, k=random.randint(0, 60))) for _ in range(3000)]
    cases += ["It's  a'll'd ''s 't.'re", "<|endoftext|>hi a<|startoftext|>b", "İstanbul ﬁ ½ ²3 ΟΔΥΣΣΕΥΣ"]
    for text, ids in zip(cases, words.encode(cases), strict=True):
        expected = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text


def best_fit_decreasing(counts: Counter, capacity: int) -> int:
    rooms: list[int] = []
    for length in sorted(counts.elements(), reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once(seed):
    random.seed(seed)
    counts = Counter(random.randint(1 + 100 * seed, 700) for _ in range(300))
    used: Counter = Counter()
    bins = packing.plan_sequences(dict(counts), 1000)
    for lengths, often in bins:
        assert sum(lengths) <= 1000
        for length in lengths:
            used[length] += often
    assert used == counts
    number = sum(often for _, often in bins)
    assert packing.lower_bound(counts, 1000) <= number <= best_fit_decreasing(counts, 1000)


def check_packing(found: list[dict], texts: list[tuple]) -> None:
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    expected = Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = np.array(ids[start : start + 2048], "<u4")
            expected[doc_id, piece, start, len(own), zlib.crc32(own.tobytes())] += 1
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(row[name] for name in names) for row in found) == expected
    ends: dict[int, int] = defaultdict(int)
    for row in sorted(found, key=lambda row: (row["sequence_id"], row["offset"])):
        assert row["offset"] == ends[row["sequence_id"]]
        ends[row["sequence_id"]] += row["length"]
    assert max(ends.values(), default=0) <= 2048


def test_packing(spark, odd_docs, no_docs, texts):
    found = rows(QUERIES["op2_best_fit_packing"](spark, SF_DIR))
    check_packing(found, list(texts.items()))
    assert len({row["sequence_id"] for row in found}) == -(-sum(row["length"] for row in found) // 2048)
    odd = rows(packing.pack_documents(odd_docs))
    check_packing(odd, [(row["doc_id"], row["text"]) for row in odd_docs.collect()])
    assert packing.pack_documents(no_docs).count() == 0


# Language identification


def test_language(spark, odd_docs, no_docs):
    found = {row["doc_id"]: row for row in rows(QUERIES["op3_language_id"](spark, SF_DIR))}
    truth = {row[0]: row[2] for row in table("documents")}
    held = [doc for doc in truth if zlib.crc32(str(doc).encode()) % 5 == 0]
    assert {doc for doc, row in found.items() if row["held_out"]} == set(held)
    assert np.mean([found[doc]["lang_pred"] == truth[doc] for doc in held]) > 0.95
    assert all(0 <= row["score"] <= 1 for row in found.values())

    odd = rows(language.identify(odd_docs, language.train(language.training_sample(odd_docs))))
    assert len(odd) == 10
    assert all((row["lang_pred"] == "und") == (row["doc_id"] in (1, 2, 6, 8)) for row in odd)
    nothing = language.train(language.training_sample(no_docs))
    assert {row["lang_pred"] for row in rows(language.identify(odd_docs, nothing))} == {"und"}


# Substrings


def plain_removed(data: list[bytes], length: int) -> list[list[bool]]:
    starts = Counter(it[k : k + length] for it in data for k in range(len(it) - length + 1))
    out = []
    for it in data:
        gone = [False] * len(it)
        for k in range(len(it) - length + 1):
            if starts[it[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        out.append(gone)
    return out


def check_suffix(found: list[dict], docs: list[tuple], length: int) -> None:
    data = [(text or "").encode() for _, text in docs]
    expected = Counter()
    for (doc_id, _), own, gone in zip(docs, data, plain_removed(data, length), strict=True):
        runs = sum(flag for flag, _ in itertools.groupby(gone))
        rest = bytes(byte for byte, flag in zip(own, gone, strict=True) if not flag)
        expected[doc_id, len(own), sum(gone), runs, hashlib.sha256(rest).hexdigest()] += 1
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(row[name] for name in names) for row in found) == expected


def test_suffix_dedup(spark, texts):
    found = rows(QUERIES["op10_suffix_array_dedup"](spark, SF_DIR))
    check_suffix(found, list(texts.items()), 400)


@pytest.mark.parametrize("crowd", [1, 4, 1000])
def test_suffix_dedup_of_repetitive_texts(spark, odd_docs, no_docs, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    random.seed(7)
    passage = [bytes(random.choices(b"abcd ", k=size)).decode() for size in (41, 47, 60, 90)]
    docs = [(k, "".join(random.choice(passage + list("xyzab")) for _ in range(random.randint(0, 9)))) for k in range(60)]
    docs += [(100, "a" * 300), (101, "ab" * 100), (102, passage[0]), (103, passage[0][1:] * 3), (104, "é" * 90)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check_suffix(rows(suffix_dedup.remove_repeats(df, 40)), docs, 40)
    odd = [(row["doc_id"], row["text"]) for row in odd_docs.collect()]
    odd = [it for it in odd if it[0] != 3]
    check_suffix(rows(suffix_dedup.remove_repeats(odd_docs.where("doc_id <> 3 OR doc_id IS NULL"), 40)), odd, 40)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_substring_dedup(spark, odd_docs, no_docs):
    random.seed(3)

    def prose(words: int) -> str:
        return " ".join("".join(random.choices("abcdefghiklmnoprstu", k=random.randint(2, 9))) for _ in range(words))

    passage = prose(60)
    docs = [(k, prose(80)) for k in range(40)]
    docs += [(100 + k, f"{prose(30 + k)} {passage} {prose(30)}") for k in range(8)]
    docs += [(200, docs[0][1]), (201, docs[0][1][:100] + "inserted" + docs[0][1][100:])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {row["doc_id"]: row for row in rows(substring_dedup.count_repeats(df))}
    assert all(found[k]["n_repeated"] == 0 for k in range(1, 40))
    assert all(found[k]["n_repeated"] > 150 for k in range(100, 108))
    assert found[100]["n_removed"] == 0 and all(found[k]["n_removed"] > 150 for k in range(101, 108))
    assert found[200]["n_removed"] == found[200]["n_bytes"] and found[0]["n_removed"] == 0
    assert found[201]["n_removed"] > 0.6 * found[201]["n_bytes"]
    kept = {row["doc_id"]: row["text"] for row in rows(substring_dedup.deduplicated(df))}
    assert kept[200] == "" and kept[5] == docs[5][1]
    assert substring_dedup.count_repeats(odd_docs).count() == 10
    assert substring_dedup.deduplicated(odd_docs).count() == 10
    assert substring_dedup.count_repeats(no_docs).count() == 0


def test_chunks_resist_shifts():
    data = byte_array("".join(chr(97 + (k * k // 7) % 23) for k in range(5000)))
    ends = substring_dedup.chunk_ends(data)
    shifted = substring_dedup.chunk_ends(np.concatenate((byte_array("xyz"), data))) - 3
    assert set(ends[ends > 20]) == set(shifted[shifted > 20])
    assert np.diff(substring_dedup.chunk_ends(byte_array("a" * 20_000))).max() <= substring_dedup.LONGEST_CHUNK


# URL filters


def test_url_parts_and_rules(spark):
    urls = [
        ("HTTP://Sub.Example.ORG/es/x?y#z", "sub.example.org", "/es/x", "example.org/es/", "block"),
        ("http://example.org/en/1234", "example.org", "/en/1234", "example.org/en/1", "block"),
        ("http://other.org/en/1", "other.org", "/en/1", "org/", "allow"),
        ("https://a.com?/fr/", "a.com", "", None, "allow"),
        ("https://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
        ("no-host.com/de/", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("x://notorg/", "notorg", "/", None, "allow"),
        ("ftp://É.COM#/de/", "É.com", "", None, "allow"),
    ]
    pages = spark.createDataFrame(
        [(k, row[0], None) for k, row in enumerate(urls)], "page_id long, url string, html string"
    )
    found = {row["page_id"]: row for row in rows(url_filters.judge_urls(pages))}
    names = ("host", "path", "rule", "verdict")
    assert [tuple(found[k][name] for name in names) for k in range(len(urls))] == [row[1:] for row in urls]
    assert url_filters.judge_urls(pages.where("false")).count() == 0


def test_ranks_are_those_of_plain_power_iteration(spark):
    random.seed(2)
    hosts = [f"h{k}.net" for k in range(12)]
    links = {(a, b): random.randint(1, 3) for a in hosts for b in random.sample(hosts, 3) if a != b}
    seeds = {"h0.net": 3, "h5.net": 1}
    df = spark.createDataFrame([("allow", a, b, n) for (a, b), n in links.items()], "kind string, source string, target string, links long")
    start = spark.createDataFrame([("allow", host, n) for host, n in seeds.items()], "kind string, host string, pages long")
    found = {row["host"]: row["rank"] for row in rows(url_filters.spread(df, start))}
    first = {host: seeds.get(host, 0) / 4 for host in hosts}
    rank = dict(first)
    for _ in range(300):
        moved = dict.fromkeys(hosts, 0.0)
        for (a, b), n in links.items():
            moved[b] += 0.85 * rank[a] * n / sum(m for (c, _), m in links.items() if c == a)
        rank = {host: first[host] + moved[host] for host in hosts}
    total = sum(rank.values())
    assert all(abs(found.get(host, 0) - rank[host] / total) < 0.01 for host in hosts)


def test_distrust_spreads_against_links(spark):
    pages = [
        (1, "http://good.com/fr/1", '<a href="http://friend.net/x">a</a>'),
        (2, "http://friend.net/en/1", None),
        (3, "http://bad.com/de/1", "<p>none</p>"),
        (4, "http://spam.net/en/2", "<a HREF = '//BAD.com:80/de/1'>b</a>"),
        (5, "http://alone.net/", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    verdicts = {row["page_id"]: row["verdict"] for row in rows(url_filters.judge_urls(df))}
    assert verdicts == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow"}


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    pages = [(0, "http://bad.com/de/1", None), (1, "http://h1.net/", '<a href="http://bad.com/">a</a>')]
    pages += [(k, f"http://h{k}.net/", f'<a href="http://h{k - 1}.net/">a</a>') for k in range(2, 100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    verdicts = {row["page_id"]: row["verdict"] for row in rows(url_filters.judge_urls(df))}
    assert verdicts == dict.fromkeys(range(100), "block")


# Mixing


def test_mixing(spark, odd_docs, no_docs):
    found = rows(QUERIES["op6_source_mix"](spark, SF_DIR))
    sources = {row[0]: row[3] for row in table("documents")}
    taken, targets = Counter(), {}
    for row in found:
        taken[sources[row["doc_id"]]] += row["taken"]
        targets[sources[row["doc_id"]]] = row["target"]
        assert row["taken"] <= 3 * row["size"]
    largest = max(row["size"] for row in found)
    assert all(abs(taken[source] - target) <= largest / 2 + 1 for source, target in targets.items())
    assert abs(sum(targets.values()) - sum(row["size"] for row in found)) < 1e-3

    odd = rows(mixing.sample_mix(odd_docs))
    assert len(odd) == 10 and all(row["taken"] <= 3 * row["size"] for row in odd)
    assert [row["size"] for row in odd if row["doc_id"] in (1, 2, 8)] == [0, 0, 0]
    again = mixing.sample_mix(odd_docs.repartition(7))
    assert Counter(map(tuple, again.collect())) == Counter(tuple(row.values()) for row in odd)
    assert mixing.sample_mix(no_docs).count() == 0
    assert set(mixing.mixed_documents(odd_docs).columns) == set(odd_docs.columns)


def test_mixed_documents_are_those_taken(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    copies = Counter(row["doc_id"] for row in rows(mixing.mixed_documents(docs)))
    expected = {row["doc_id"]: row["taken"] / row["size"] for row in rows(mixing.sample_mix(docs)) if row["size"]}
    assert all(copies[doc] == count for doc, count in expected.items())


# Quality


def plain_measures(text: str) -> tuple:
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    in_window = set()
    for k, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if windows[window] > 1:
            in_window |= {k, k + 1, k + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    duplicates = sum(line in lines[:k] for k, line in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(in_window))


def test_quality(spark, odd_docs, no_docs, texts):
    found = {row["doc_id"]: row for row in rows(QUERIES["op7_quality_rules"](spark, SF_DIR))}
    labels = {row[0]: row[1] for row in table("labels")}
    raw, good = Counter(), Counter()
    for doc, text in texts.items():
        data = text.encode()
        grams = Counter(data[k : k + 4] for k in range(len(data) - 3))
        raw += grams
        if labels.get(doc) == 1:
            good += grams
    slots = {gram: int(quality.n_gram_buckets(gram.decode("latin-1"))[0]) for gram in raw if max(gram) < 128}
    assert len(set(slots.values())) > 0.7 * len(slots)
    for doc, row in found.items():
        assert tuple(row[name] for name in quality.MEASURES) == plain_measures(texts[doc])
        failed = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
        assert row["base_failed"] == failed
        assert row["kept"] == (not failed and row["score"] >= quality.LEAST_SCORE)
        if doc in labels and not failed:
            assert row["kept"] == bool(labels[doc]), texts[doc][:200]

    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = rows(quality.judge(odd_docs, empty))
    assert len(odd) == 10 and all(row["score"] == 0 and row["kept"] == (not row["base_failed"]) for row in odd)
    assert quality.judge(no_docs, empty).count() == 0
    assert set(quality.good_documents(odd_docs, empty).columns) == set(odd_docs.columns)


def test_repeated_words():
    random.seed(4)
    for _ in range(200):
        words = random.choices("abc", k=random.randint(0, 12))
        assert quality.measure(" ".join(words)) == plain_measures(" ".join(words))


# N-gram join


def word_sets(text: str) -> frozenset:
    words = WORD.findall(text.lower())
    size = min(5, len(words))
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) if words else frozenset()


def plain_classes(docs: dict) -> tuple[dict, dict]:
    sets = {doc: word_sets(text) for doc, text in docs.items()}
    links, root = Counter(), {doc: doc for doc in docs}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    for a, b in itertools.combinations(sorted(docs), 2):
        if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {doc: find(doc) for doc in docs}, links


@pytest.mark.parametrize("block", [3, 256])
def test_ngram_join(spark, monkeypatch, texts, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    random.seed(6)
    docs = dict(texts)
    base = [f"w{random.randint(0, 500)}" for _ in range(120)]
    for k in range(60):
        words = list(base)
        for _ in range(random.randint(0, 5)):
            words[random.randrange(120)] = f"new{random.randint(0, 99)}"
        docs[1000 + k] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    classes, links = plain_classes(docs)
    for row in rows(ngram_join.join_near(df)):
        assert (row["class_id"], row["n_links"]) == (classes[row["doc_id"]], links[row["doc_id"]])
        assert row["kept"] == (row["class_id"] == row["doc_id"])
    kept = {row["doc_id"] for row in rows(ngram_join.drop_near_copies(df))}
    assert kept == set(classes.values())


def test_ngram_join_odd_rows(odd_docs, no_docs):
    found = rows(ngram_join.join_near(odd_docs))
    assert len(found) == 10
    links = {row["doc_id"]: (row["class_id"], row["n_links"]) for row in found}
    assert (links[4], links[5], links[1], links[3]) == ((4, 2), (4, 2), (1, 0), (3, 0))
    kept = rows(ngram_join.drop_near_copies(odd_docs))
    assert sorted(str(row["doc_id"]) for row in kept) == ["1", "2", "3", "4", "6", "7", "8", "None"]
    assert ngram_join.join_near(no_docs).count() == 0
    assert ngram_join.drop_near_copies(no_docs).count() == 0


def test_recall_of_the_bands():
    length = ngram_join.prefix_length()
    assert 1 - (1 - 0.8**length) ** ngram_join.TREES >= ngram_join.RECALL
    met = 0
    random_ = np.random.default_rng(0)
    for _ in range(200):
        common = random_.integers(0, 1 << 63, 160, dtype=np.uint64)
        own = random_.integers(0, 1 << 63, (2, 20), dtype=np.uint64)
        labels = [ngram_join.trie_labels(np.concatenate((common, it)), length) for it in own]
        met += bool((labels[0] == labels[1]).any())
    assert met >= 199


def test_components(spark):
    random.seed(8)
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(5000, 5001), (5001, 5000), (7, 7)]
    found = {row["node"]: row["root"] for row in rows(components(spark.createDataFrame(edges, "a long, b long")))}
    assert all(found[k] == 0 for k in range(201)) and all(found[k] == 1000 for k in range(1000, 1100))
    assert found[5001] == 5000 and len(found) == 201 + 100 + 2


# HTML


def test_html_blocks():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head>
    <body class="nav"><nav><ul><li><a href="/x">Menu</a></ul><header>Top</header><!-- <p>no</p> -->
    <div class="side-bar ad">Buy</div><article><header><h1>Title &amp;  more</h1></header><p>One <b>bo</b>ld&nbsp;word<br>next
    <p><b>Open<p>Closed</b> a &lt; b <form>field</form><aside>extra</aside><div id="comments">me too</div>
    <p title="a > b">last</p></article><footer>end</footer></body>"""
    blocks, kinds = html_text.page_blocks(page)
    kept = [block for block, kind in zip(blocks, kinds, strict=True) if kind == html_text.KEPT]
    assert kept == ["Title & more", "One bold word", "next", "Open", "Closed a < b", "last"]


def test_html_boilerplate_of_a_host(spark):
    random.seed(9)
    shared = "we use small files to remember what you like here ok"
    pages = [(k, "http://a.net/x", f"<body><div>{shared}</div><p>own{k} text{k} of{k} page {k}</p></body>") for k in range(9)]
    pages += [(20, "http://b.net/x", f"<body><div>{shared}</div></body>"), (21, None, None), (22, "http://a.net/", "")]
    pages += [(k, "http://c.net/x", "<article><p>the same long article stands on two pages of a host</p></article>") for k in (30, 31)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS blocks", "3 AS text")
    found = {row["page_id"]: row for row in rows(html_text.main_texts(df))}
    assert all(found[k]["text"] == f"own{k} text{k} of{k} page {k}" for k in range(9))
    assert found[20]["text"] == shared and found[21]["text"] == found[22]["text"] == ""
    assert found[30]["text"] == found[31]["text"] != "" and found[30]["n_chars"] == len(found[30]["text"])
    assert html_text.main_texts(df.where("false")).count() == 0


def test_html_coverage_of_a_large_host(spark):
    """A page's text depends on all pages of its host, however many a task counts at once."""
    random.seed(11)
    shared = [" ".join(f"run{k}word{n}" for n in range(10)) for k in range(30)]
    # Every run stands on two pages of 60
    pages = [
        (k, "http://a.net/x", f"<div>{shared[k % 30]}</div><p>{' '.join(f'own{k}x{n}' for n in range(9))}</p>") for k in range(60)
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = [
        {row["page_id"]: row["text"] for row in rows(html_text.main_texts(df, group_pages=size))} for size in (2, 400)
    ]
    assert found[0] == found[1] == {k: " ".join(f"own{k}x{n}" for n in range(9)) for k in range(60)}


def test_html_titles_inside_of_articles():
    page = """<header class="site-header">Site</header><article><div class="entry-header"><h1>Title</h1></div>
        <p>Text</p><div id="share-header">Share</div><div class="comments">No</div></article>"""
    blocks, kinds = html_text.page_blocks(page)
    assert [it for it, kind in zip(blocks, kinds, strict=True) if kind == html_text.KEPT] == ["Title", "Text"]


@pytest.mark.parametrize("group_pages", [3, 400])
def test_html_strings_are_those_of_the_suffix_array(spark, group_pages):
    """Counted over groups of pages, strings cover the words that one suffix array of a host covers."""
    random.seed(12)
    pages = [
        (k, f"http://{'ab'[k % 2]}.net/{k}", "".join(f"<p>{' '.join(random.choices('xyz', k=random.randint(1, 25)))}</p>" for _ in range(2)))
        for k in range(24)
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    parsed = html_text.parsed_pages(df).withColumn("host", F.xxhash64("host"))
    found = {row["string"] for row in rows(html_text.shared_strings(parsed, group_pages))}
    by_host = defaultdict(list)
    for row in parsed.collect():
        by_host[row["host"]].append(list(row["blocks"]))
    covered = 0
    for host, texts in by_host.items():
        expected = html_text.covered_words([html_text.word_hashes(it, host) for it in texts])
        for blocks, flags in zip(texts, expected, strict=True):
            starts = np.flatnonzero(np.isin(html_text.string_hashes(blocks, host), list(found)))
            own = html_text._words_from(starts, len(flags), html_text.LEAST_RUN)
            assert (own == flags).all()
            covered += own.sum()
    assert covered > 0


def test_html_main_text_on_several_pages(spark):
    """Copies, print views and quotes in plain blocks stay; what their pages share otherwise goes."""

    def words(name: str, size: int) -> str:
        return " ".join(f"{name}{n}" for n in range(size))

    menu, quote = words("menu", 12), words("quote", 10)
    texts = {k: words(f"text{k}x", 60) for k in range(9)}
    texts[7] += f" {quote} {words('seven', 5)}"
    texts[8] += f" {quote} {words('eight', 5)}"
    pages = [(k, f"http://a.net/{k}", f"<div>{menu}</div><p>{text}</p>") for k, text in texts.items()]
    # A repeated row, a mirror, a print view with a few words more, another one below an article, and a stub
    pages += [pages[0], (10, "http://a.net/m", pages[1][2]), (11, "http://a.net/p", f"<p>{texts[2]}</p><p>printed page</p>")]
    pages += [(12, "http://a.net/r", f"<article>{texts[3]}</article>"), (13, "http://a.net/s", f"<div>{menu}</div>")]
    pages += [(20, "http://b.net/x", f"<div>{quote}</div>")] * 2
    pages += [(k, "http://c.net/x", f"<div>{texts[4]}</div><div>{words(f'c{k}x', k - 30)}</div>") for k in (31, 36)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = rows(html_text.main_texts(df))
    assert len(found) == len(pages)
    by_id = {row["page_id"]: row["text"] for row in found}
    assert {k: by_id[k] for k in texts} == texts
    assert by_id[10] == texts[1] and by_id[11] == f"{texts[2]} printed page" and by_id[12] == texts[3]
    assert by_id[13] == menu and by_id[20] == quote
    assert by_id[31].startswith(texts[4]) and by_id[36].startswith(texts[4])
    assert all(by_id[row["page_id"]] == row["text"] for row in found)


def test_html_articles_of_the_pages(spark):
    found = {row["page_id"]: row["text"] for row in rows(QUERIES["op9_html_extraction"](spark, SF_DIR))}
    for page_id, _, page in table("pages"):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        inner = re.sub(r"</?(?:p|h1|br)>", " ", inner)
        import html

        assert found[page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_covered_words_against_all_windows():
    random.seed(10)
    for _ in range(100):
        streams = [np.array(random.choices(range(3), k=random.randint(0, 14)), np.int64) for _ in range(4)]
        flags = html_text.covered_words(streams, 3)
        pages = defaultdict(set)
        for page, words in enumerate(streams):
            for k in range(len(words) - 2):
                pages[tuple(words[k : k + 3])].add(page)
        for words, own in zip(streams, flags, strict=True):
            expected = np.zeros(len(words), bool)
            for k in range(len(words) - 2):
                if len(pages[tuple(words[k : k + 3])]) > 1:
                    expected[k : k + 3] = True
            assert (own == expected).all()


# Pipeline


def test_pipeline(spark, texts):
    """Stage by stage against plain versions; mixing and packing are deterministic."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {row["doc_id"] for row in rows(QUERIES["op7_quality_rules"](spark, SF_DIR)) if row["kept"]}
    groups: dict[str, int] = {}
    for doc in sorted(good):
        groups[re.sub("[A-Z]", lambda it: it[0].lower(), texts[doc])] = doc
    classes, _ = plain_classes({doc: texts[doc] for doc in groups.values()})
    kept = set(classes.values())
    stages = dict(corpus_pipeline.STAGES)
    found = docs
    for name, expected in zip(list(stages)[:3], (good, set(groups.values()), kept), strict=True):
        found = spark.createDataFrame(stages[name](spark, found, SF_DIR).toPandas(), docs.schema)
        assert sorted(row["doc_id"] for row in found.collect()) == sorted(expected)
    mix = Counter(row["doc_id"] for row in mixing.mixed_documents(found).collect())
    packed = rows(corpus_pipeline.run(spark, SF_DIR))
    check_packing(packed, [(doc, texts[doc]) for doc in mix.elements()])


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert set(docs.columns) == set(odd_docs.columns)
            docs.count()
