"""Main text of web pages, with boilerplate found by counting the strings of a host's pages.

A page becomes a stream of blocks. Markup decides where it is clear: what stands in menus, headers,
footers, sidebars, forms, adverts, notices and comments is dropped, what stands in an article is
kept. All other blocks are kept unless they are boilerplate, and in pages with an article they are
outside of it and dropped.

Boilerplate is what pages of a host share, however many the host has. The words of all blocks of a
page are one stream. A task concatenates the streams of ``GROUP_PAGES`` pages and sorts their suffixes as deep
as ``LEAST_RUN`` words, so that strings of so many words that repeat across pages are neighbours; how many
distinct pages have each is added up by Spark under a 64-bit hash of host and string, as a host may have
more pages than a task could hold. Strings of two different pages or more return to the pages with undecided
blocks: the words of such strings are covered. Covered words of undecided blocks are removed, unique runs are kept. Two different strings
with the same hash would count as one. Strings are counted only for hosts that have undecided blocks.

Main text can stand on two pages, too, and is not removed for that:

* Articles are decided by their markup. Strings with a word of an article count for no other page.
* Rows and pages with the same blocks are one page.
* In a block that has at least as many words of its own, covered words are a quote and stay.
* A page of which ``WHOLE`` of the undecided words would be removed is a copy, such as a print view.
  Copies keep all, and pages vouch for strings that they keep: only strings that two pages would
  still remove are boilerplate. Where these alone make up ``WHOLE`` of a page, it keeps them.

Pages that share a long text in blocks of its own, and have more than a tenth of other words each,
can't be told from pages with boilerplate, and lose it. Pages with less than a tenth of own words
can't be told from copies, and keep their boilerplate.

Null html counts as empty; its text is empty. A null url has the host "". Repeated rows have the
same text. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from helixframe.llm.common import (
    bounded_broadcast,
    byte_array,
    checkpointed,
    mixed,
    prefix_hashes,
    read,
    span_hashes,
)
from helixframe.llm.queries import query
from helixframe.llm.url_filters import host_and_path

#: Pages whose strings a task counts at once before Spark adds up the counts; changes no row.
GROUP_PAGES = 400
LEAST_RUN = 8
#: Share of a page's undecided words that is no boilerplate.
WHOLE = 0.9
DROPPED, OPEN, KEPT = 0, 1, 2
#: Content identity: two 64-bit hashes of host, blocks and kinds.
CONTENT = ["content_a", "content_b"]

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title|select|button)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Elements by what they do to the text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav header footer aside form dialog menu".split())
MAIN = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|breadcrumb|breadcrumbs|"
    r"comment|comments|consent|cookie|cookies|disqus|footer|header|masthead|menu|modal|nav|navbar|"
    r"navigation|newsletter|notice|notices|popup|promo|promotion|related|replies|reply|search|share|"
    r"sharing|sidebar|social|sponsor|sponsored|subscribe|toolbar|widget)(?:$|[\s_-])",
    re.I,
)


#: Marks that stand for the title of an article, where they stand inside of one.
TITLE = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])", re.I)


def _is_aside(name: str, rest: str, in_article: bool) -> bool:
    """Whether an element holds something else than main text."""
    if name in ASIDE and not (name == "header" and in_article):
        return True
    if "=" not in rest or name in ("html", "body"):
        return False
    for found in _ATTRIBUTE.finditer(rest):
        key = found[1].lower()
        value = found[2] or found[3] or found[4] or ""
        if key in ("class", "id"):
            if in_article:
                value = TITLE.sub(" ", value)
            if MARKED.search(value):
                return True
        if key == "role" and value.lower() in ROLES:
            return True
    return False


def page_blocks(page: str) -> tuple[list[str], list[int]]:
    """Blocks of a page in order, and whether each is dropped, open or kept."""
    blocks: list[str] = []
    kinds: list[int] = []
    parts: list[str] = []
    # Open elements: name, whether it is aside, whether it is an article
    stack: list[tuple[str, bool, bool]] = []
    asides = articles = 0

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                blocks.append(text)
                kinds.append(DROPPED if asides else KEPT if articles else OPEN)

    def pop(count: int) -> None:
        nonlocal asides, articles
        for _, aside, article in stack[len(stack) - count :]:
            asides -= aside
            articles -= article
        del stack[len(stack) - count :]

    for token in _TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            parts.append(text)
            continue
        name = token["name"]
        if name is None:
            if token["raw"]:
                end_block()
            continue
        name = name.lower()
        if name in INLINE:
            continue
        end_block()
        if name in VOID:
            continue
        if token["close"]:
            for count, (opened, _, _) in enumerate(reversed(stack), 1):
                if opened == name:
                    pop(count)
                    break
            continue
        article = name in MAIN and not _is_aside(name, token["rest"], True)
        if article and asides and not articles:
            # An article is no part of a menu: the latter was not closed
            first = next(k for k, it in enumerate(stack) if it[1])
            pop(len(stack) - first)
        aside = not article and _is_aside(name, token["rest"], articles > 0)
        stack.append((name, aside, article))
        asides += aside
        articles += article
    end_block()
    if KEPT in kinds:
        kinds = [DROPPED if kind == OPEN else kind for kind in kinds]
    return blocks, kinds


def _words_from(starts: np.ndarray, size: int, least: int) -> np.ndarray:
    """A flag for each of so many words in a string of ``least`` words from one of the starts."""
    edges = np.zeros(size + least + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + least, -1)
    return np.cumsum(edges)[:size] > 0


def suffix_ranks(streams: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of concatenated pages, as far as it matters: ``least`` words deep.

    For every word the rank of the suffix that it starts, its page, and whether the page has so many
    words from there on. Suffixes that share their first ``least`` words share their rank.
    """
    sizes = np.array([len(it) for it in streams], np.int64)
    words = np.concatenate([*streams, np.zeros(0, np.int64)])
    page = np.repeat(np.arange(len(streams)), sizes)
    size = len(words)
    rest = np.repeat(np.cumsum(sizes), sizes) - np.arange(size)
    _, rank = np.unique(words, return_inverse=True)
    depth = 1
    while depth < least:
        # Suffixes ordered by ``depth`` words are ordered by twice as many from the ranks of what follows
        step = min(depth, least - depth)
        following = np.full(size, -1, np.int64)
        inside = rest > step
        following[inside] = rank[np.flatnonzero(inside) + step]
        _, rank = np.unique(rank * (size + 1) + following + 1, return_inverse=True)
        depth += step
    return rank, page, rest >= least


def pages_of_ranks(rank: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one suffix of each rank, and the number of distinct pages that have it."""
    order = np.lexsort((page, rank))
    rank, page = rank[order], page[order]
    new_rank = np.concatenate(([True], rank[1:] != rank[:-1]))[: len(rank)]
    new_page = new_rank | np.concatenate(([True], page[1:] != page[:-1]))[: len(rank)]
    first = np.flatnonzero(new_rank)
    return order[first], np.add.reduceat(new_page, first, dtype=np.int64) if len(first) else first


def covered_words(streams: list[np.ndarray], least: int = LEAST_RUN) -> list[np.ndarray]:
    """Per page a flag for each word in a string of ``least`` words that another page has, too."""
    rank, page, whole = suffix_ranks(streams, least)
    at = np.flatnonzero(whole)
    places, pages = pages_of_ranks(rank[at], page[at])
    shared = np.zeros(len(rank) + 1, bool)
    shared[rank[at][places[pages > 1]]] = True
    flags = _words_from(at[shared[rank[at]]], len(rank), least)
    return np.split(flags, np.cumsum([len(it) for it in streams])[:-1])


def word_hashes(blocks: list[str], host: int) -> np.ndarray:
    """64-bit hashes of a host's words."""
    data = byte_array(" ".join(blocks))
    if not len(data):
        return np.zeros(0, np.int64)
    ends = np.append(np.flatnonzero(data == ord(" ")), len(data))
    spans = span_hashes(prefix_hashes(data), np.append(0, ends[:-1] + 1), ends)
    return mixed(spans ^ np.array([host], np.int64).view(np.uint64)).view(np.int64)


def string_hashes(blocks: list[str], host: int, least: int = LEAST_RUN) -> np.ndarray:
    """64-bit hashes of a host's strings of ``least`` words, by the word they start at."""
    data = byte_array(" ".join(blocks))
    ends = np.append(np.flatnonzero(data == ord(" ")), len(data))
    starts = np.append(0, ends[:-1] + 1)
    if len(starts) < least:
        return np.zeros(0, np.int64)
    spans = span_hashes(prefix_hashes(data), starts[: len(starts) - least + 1], ends[least - 1 :])
    return mixed(spans ^ np.array([host], np.int64).view(np.uint64)).view(np.int64)


def _word_kinds(blocks: list[str], kinds: list[int]) -> np.ndarray:
    return np.repeat(np.array(kinds, np.int64), [block.count(" ") + 1 for block in blocks])


def open_text(blocks: list[str], kinds: list[int], removed: np.ndarray) -> str:
    """Words of blocks that are not dropped, without the removed ones."""
    words = " ".join(blocks).split(" ")
    kept = (_word_kinds(blocks, kinds) != DROPPED) & ~removed
    return " ".join([words[k] for k in np.flatnonzero(kept)])


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, blocks, kinds) and two hashes of the host and the blocks per page."""
    host, _ = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [page_blocks(page) for page in batch.pop("html")]
            batch["blocks"] = [blocks for blocks, _ in found]
            batch["kinds"] = [kinds for _, kinds in found]
            yield batch

    schema = rows.drop("html").schema.add("blocks", ArrayType(StringType()))
    parsed = rows.mapInPandas(parse, schema.add("kinds", ArrayType(IntegerType())))
    return parsed.withColumns(
        {
            "content_a": F.xxhash64("host", "blocks", "kinds"),
            "content_b": F.xxhash64("kinds", "blocks", "host"),
        }
    )


def _parts(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), size):
            yield batch.iloc[at : at + size]


def shared_strings(contents: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """(string, pages) of the strings outside of articles in two pages of a host or more."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _parts(batches, group_pages):
            streams, strings, outside = [], [], []
            for row in part.itertuples():
                streams.append(word_hashes(row.blocks, row.host))
                strings.append(string_hashes(row.blocks, row.host))
                outside.append(_each_string(_word_kinds(row.blocks, row.kinds) == KEPT) == 0)
            rank, page, whole = suffix_ranks(streams, LEAST_RUN)
            # One entry per string, in the order of the words that they start at
            at = np.flatnonzero(whole)
            wanted = np.concatenate(outside)
            places, pages = pages_of_ranks(rank[at][wanted], page[at][wanted])
            yield pd.DataFrame({"string": np.concatenate(strings)[wanted][places], "pages": pages})

    counted = contents.select("host", "blocks", "kinds").mapInPandas(count, "string long, pages long")
    return counted.groupBy("string").agg(F.sum("pages").alias("pages")).where("pages > 1")


def strings_of_contents(contents: DataFrame, strings: DataFrame) -> DataFrame:
    """Contents with an open block and, as an array, those of the strings that they have."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _parts(batches, GROUP_PAGES):
            found = [np.unique(string_hashes(row.blocks, row.host)) for row in part.itertuples()]
            times = [len(it) for it in found]
            own = {name: np.repeat(part[name].to_numpy(), times) for name in CONTENT}
            yield pd.DataFrame(own | {"string": np.concatenate(found)})

    undecided = contents.where(F.array_contains("kinds", OPEN))
    found = undecided.select(*CONTENT, "host", "blocks").mapInPandas(
        find, "content_a long, content_b long, string long"
    )
    found = found.join(bounded_broadcast(strings), "string")
    return undecided.join(found.groupBy(*CONTENT).agg(F.collect_list("string").alias("strings")), CONTENT)


def _each_string(flags: np.ndarray, least: int = LEAST_RUN) -> np.ndarray:
    """How many words of each string have a flag."""
    sums = np.append(0, np.cumsum(flags))
    return sums[least:] - sums[:-least]


def removed_words(blocks: list[str], kinds: list[int], hashes: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """A flag for each word of an open block that is removed if the strings are boilerplate."""
    words = _word_kinds(blocks, kinds)
    removed = _words_from(np.flatnonzero(np.isin(hashes, strings)), len(words), LEAST_RUN) & (words == OPEN)
    sizes = [block.count(" ") + 1 for block in blocks]
    covered = np.add.reduceat(removed, np.append(0, np.cumsum(sizes)[:-1]), dtype=np.int64)
    removed &= np.repeat(2 * covered > sizes, sizes)
    if removed.sum() >= WHOLE * (words == OPEN).sum():
        removed[:] = False
    return removed


def cleaned_texts(contents: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """(content_a, content_b, cleaned) of the contents that have boilerplate in open blocks."""

    def vouch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _parts(batches, GROUP_PAGES):
            own = []
            for row in part.itertuples():
                hashes = string_hashes(row.blocks, row.host)
                removed = removed_words(row.blocks, row.kinds, hashes, row.strings)
                stays = _each_string((_word_kinds(row.blocks, row.kinds) == OPEN) & ~removed) > 0
                # Where a page removes a string at one place, it doesn't vouch for it at another
                kept = np.setdiff1d(hashes[stays], hashes[~stays])
                own.append(kept[np.isin(kept, row.strings)])
            found, pages = np.unique(np.concatenate(own), return_counts=True)
            yield pd.DataFrame({"string": found, "kept": pages})

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for row in batch.itertuples():
                removed = removed_words(row.blocks, row.kinds, string_hashes(row.blocks, row.host), row.strings)
                texts.append(open_text(row.blocks, row.kinds, removed))
            yield batch[CONTENT].assign(cleaned=texts)

    # Materialised, so that Spark can split a hot string in the join
    shared = checkpointed(shared_strings(contents, group_pages))
    kept = strings_of_contents(contents, shared.select("string")).mapInPandas(vouch, "string long, kept long")
    kept = kept.groupBy("string").agg(F.sum("kept").alias("kept"))
    left = F.col("pages") - F.coalesce("kept", F.lit(0))
    boilerplate = checkpointed(shared.join(kept, "string", "left").where(left > 1).select("string"))
    return strings_of_contents(contents, boilerplate).mapInPandas(
        clean, "content_a long, content_b long, cleaned string"
    )


def main_texts(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) per page; ``group_pages`` changes no row."""
    parsed = parsed_pages(pages)
    is_open = F.array_contains("kinds", OPEN)
    texts = parsed.select(
        "page_id", "url", *CONTENT, F.expr(f"array_join(filter(blocks, (it, k) -> kinds[k] != {DROPPED}), ' ')").alias("text")
    )
    hosts = checkpointed(parsed.where(is_open).select("host").distinct())
    if not hosts.isEmpty():
        # Only hosts with an undecided page have a use for their strings
        contents = parsed.join(bounded_broadcast(hosts), "host", "leftsemi").groupBy(*CONTENT)
        contents = checkpointed(
            contents.agg(
                F.xxhash64(F.first("host")).alias("host"),
                F.first("blocks").alias("blocks"),
                F.first("kinds").alias("kinds"),
            )
        )
        # Materialised, so that Spark can split a page that is repeated very often
        cleaned = checkpointed(cleaned_texts(contents, group_pages))
        texts = texts.join(cleaned, CONTENT, "left").withColumn("text", F.coalesce("cleaned", "text"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op9_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages"))
