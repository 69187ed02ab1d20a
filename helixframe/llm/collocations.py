"""Phrase collocations from an FM-index per shard over word ids.

A shard is a run of documents of about ``SHARD_BYTES`` within a task. Its words become ids, and pieces
are kept apart by a boundary symbol. Two Burrows-Wheeler transforms are built of the ids, one of the text
and one of its reverse, both sorted by as many words as the longest phrase wanted has. A phrase is an interval
of either one. Extending all phrases of a length by a word to the right splits their intervals in
the reverse transform by the words in there; where the parts begin follows from ranks in that transform
and from the number of smaller words in the interval, so that both intervals stay in step. How many
occurrences can be extended to the left or right within their piece is read from the boundaries in
the intervals. Counts and extensions are summed across shards by Spark.

No phrase is frequent unless its parts are. So words are counted first, then phrases of two, three and four words
whose parts of one word less are frequent. What is frequent is handed to the tasks as a Bloom filter of at
most ``MAX_BLOCKS`` blocks: one that is too full lets more phrases through to the count, and changes no result.

A word is known by a 64-bit hash of its language and bytes; two words of one hash would count as one.
Null texts are empty, a null language is ``und``. Repeated rows count repeatedly. Texts without words
and empty tables give no phrases; columns besides ``text`` and ``lang`` are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from helixframe.llm.common import checkpointed, filled, mixed, prefix_hashes, read, span_hashes
from helixframe.llm.queries import query
from helixframe.plans.skew import BROADCAST_ROWS, fits_broadcast, skew_join

LONGEST = 4
LEAST = 30
#: A phrase is dropped if a longer one has at least this percentage of its occurrences.
COVERED = 80
TOP = 2000
SCORE_SCALE = 2_000_000
SHARD_BYTES = 1 << 20
#: Texts that are taken out of a batch, and rows that are handed on, at once.
SLICE_TEXTS = 256
SLICE_ROWS = 1 << 14

#: Bits of a filter per key, and in a block, as in Spark's bitmaps; at most 64 MB are broadcast.
BITS_PER_KEY = 16
BLOCK_BITS = 32_768
MAX_BLOCKS = 1 << 14
#: Parts that a language is ranked in before its best are ranked together.
RANK_PARTS = 64
#: Rows up to which the counts of single words are broadcast, of 40 bytes each.
WORD_ROWS = 1_000_000

#: Symbols of a shard's text that stand for no word: the end of a piece, and any rare word.
BOUNDARY, RARE, FIRST_WORD = 0, 1, 2
KEYS = [f"w{k}" for k in range(1, LONGEST + 1)]

_TABLE = bytearray(range(256))
for _byte in range(ord("A"), ord("Z") + 1):
    _TABLE[_byte] = _byte + 32
for _byte in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_byte] = 10
_TABLE[9] = 32


# Words of a shard


def _language_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Shard:
    """The words of some documents: hashes, places, and the piece each one is in."""

    def __init__(self, texts: Sequence[bytes], langs: Sequence[str]):
        self.data = b"\n".join([*texts, b""]).translate(bytes(_TABLE))
        self.langs = langs
        data = np.frombuffer(self.data, np.uint8)
        in_word = np.zeros(len(data) + 2, np.int8)
        in_word[1:-1] = (data != 32) & (data != 10)
        edges = np.diff(in_word)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        document_ends = np.cumsum([len(it) + 1 for it in texts])
        self.documents = np.searchsorted(document_ends, self.starts, side="right")
        self.pieces = np.cumsum(data == 10, dtype=np.int64)[self.starts]
        salts = np.array([_language_hash(it) for it in langs], np.uint64)
        hashes = mixed(span_hashes(prefix_hashes(data), self.starts, self.ends) + salts[self.documents])
        # Zero stands for no word in the keys of shorter phrases
        hashes[hashes == 0] = 1
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))[: len(ordered)]
        runs = np.flatnonzero(new)
        self.hashes, self.counts = ordered[runs], np.diff(runs, append=len(ordered))
        #: One occurrence of each word
        self.example = order[runs]
        self.ids = np.empty(len(ordered), np.int64)
        self.ids[order] = np.cumsum(new) - 1

    def symbols(self, frequent: np.ndarray) -> np.ndarray:
        """Word ids as a text with boundaries; ``frequent`` says of each id whether it is a word there."""
        ids = np.where(frequent[self.ids], self.ids + FIRST_WORD, RARE)
        after = np.flatnonzero(np.diff(self.pieces, append=-1))
        return np.concatenate(([BOUNDARY], np.insert(ids, after + 1, BOUNDARY)))


def only_in_phrases(symbols: np.ndarray, size: int, may_be: Callable) -> np.ndarray:
    """The text with words that are in no phrase of so many words made rare.

    Both parts of a phrase with one word less must be wanted: ``may_be`` says so of rows of symbols. Neighbouring
    rare words become one: that a word stands there is all that is asked of them.
    """
    count = len(symbols)
    word = symbols >= FIRST_WORD
    starts = np.flatnonzero(np.convolve(word, np.ones(size - 1, np.int64), "valid") == size - 1)
    part = np.zeros(count + 1, bool)
    part[starts] = may_be(symbols[starts[:, None] + np.arange(size - 1)])
    first = np.flatnonzero(part[:-1] & part[1:])
    edges = np.zeros(count + size + 1, np.int64)
    edges[first] += 1
    edges[first + size] -= 1
    out = np.where((np.cumsum(edges)[:count] > 0) | (symbols == BOUNDARY), symbols, RARE)
    again = np.concatenate(([False], (out[1:] == RARE) & (out[:-1] == RARE)))
    return out[~again]


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """Shards of about ``SHARD_BYTES``; a longer text is a shard of its own."""
    texts: list[bytes] = []
    langs: list[str] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_TEXTS):
            some = batch.slice(at, SLICE_TEXTS)
            column = some.column("text").cast(pa.large_binary()).to_pylist()
            for text, lang in zip(column, some.column("lang").to_pylist(), strict=True):
                texts.append(text)
                langs.append(lang)
                size += len(text)
                if size >= SHARD_BYTES:
                    yield Shard(texts, langs)
                    texts, langs, size = [], [], 0
    if texts:
        yield Shard(texts, langs)


# The index of a shard


class Transform:
    """Burrows-Wheeler transform of circular symbols, sorted by ``depth`` of them, with ranks."""

    def __init__(self, symbols: np.ndarray, depth: int):
        size, known = len(symbols), 1
        rank = symbols
        while known < depth:
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -known)
            order = np.argsort(key)
            known *= 2
            if known < depth:
                ordered = key[order]
                rank = np.empty(size, np.int64)
                rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        self.size = size
        self.bwt = symbols[order - 1]
        #: (symbol, place) of the transform in order: how many are smaller is a rank
        self.ranked = np.sort(self.bwt * size + np.arange(size))
        self.boundaries = np.concatenate(([0], np.cumsum(self.bwt == BOUNDARY)))

    def step(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where the interval that begins at a place begins once a symbol stands before it."""
        return np.searchsorted(self.ranked, symbols * self.size + places)

    def extended(self, low: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many of an interval have a word next to them."""
        return sizes - (self.boundaries[low + sizes] - self.boundaries[low])


def phrases(
    symbols: np.ndarray, longest: int, may_be: Callable, size: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Phrases of 2, 3, .. words: their symbols, occurrences, and those extended to the left and right.

    ``may_be`` says of rows of ``size`` symbols whether phrases that hold them are wanted.
    """
    ahead, back = Transform(symbols, longest), Transform(symbols[::-1], longest)
    counts = np.bincount(symbols)
    begins = np.concatenate(([0], np.cumsum(counts)))
    words = np.flatnonzero(counts)
    words = words[words >= FIRST_WORD][:, None]
    low, low_back, sizes = begins[words[:, 0]], begins[words[:, 0]], counts[words[:, 0]]
    span = len(counts)
    for _ in range(longest - 1):
        total = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(total[-1]) + np.repeat(low_back - total[:-1], sizes)
        split = np.sort(np.repeat(np.arange(len(sizes)) * span, sizes) + back.bwt[places])
        runs = np.flatnonzero(np.concatenate(([True], split[1:] != split[:-1]))[: len(split)])
        parent, symbol = np.divmod(split[runs], span)
        part = np.diff(runs, append=len(split))
        wanted = symbol >= FIRST_WORD
        if words.shape[1] + 1 >= size > 1:
            last = words[parent[wanted], words.shape[1] + 1 - size :]
            wanted[wanted] = may_be(np.concatenate((last, symbol[wanted][:, None]), axis=1))
        parent, symbol, part, runs = parent[wanted], symbol[wanted], part[wanted], runs[wanted]
        low = low[parent] + runs - total[parent]
        low_back = back.step(symbol, low_back[parent])
        words = np.concatenate((words[parent], symbol[:, None]), axis=1)
        sizes = part
        yield words, sizes, ahead.extended(low, sizes), back.extended(low_back, sizes)


# What is frequent


class Filter:
    """Two bits per key in blocks of bits."""

    def __init__(self, blocks: int, bits: np.ndarray | None = None):
        self.blocks, self.bits = blocks, bits

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        block = mixed(keys) % np.uint64(self.blocks)
        rest = mixed(keys + np.uint64(1))
        mask = np.uint64(BLOCK_BITS - 1)
        return block, rest & mask, (rest >> np.uint64(20)) & mask

    def holds(self, keys: np.ndarray) -> np.ndarray:
        block, first, second = self.places(keys)
        found = np.ones(len(keys), bool)
        for bit in (first, second):
            byte = self.bits[(block * np.uint64(BLOCK_BITS // 8) + (bit >> np.uint64(3))).astype(np.int64)]
            found &= (byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def phrase_keys(hashes: Sequence[np.ndarray]) -> np.ndarray:
    """64-bit keys of phrases, given the hashes of their words by place."""
    key = hashes[0]
    for following in hashes[1:]:
        key = mixed(key) + following
    return key


def frequent_filter(rows: DataFrame, keys: Sequence[str]) -> Broadcast:
    """The filter of the words or phrases in ``rows``, for all tasks."""
    blocks = min(MAX_BLOCKS, max(1, -(-rows.count() * BITS_PER_KEY // BLOCK_BITS)))
    empty = Filter(blocks)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [batch.column(k).to_numpy().view(np.uint64) for k in range(len(keys))]
            block, *bits = empty.places(phrase_keys(words))
            arrays = [np.tile(block, 2).view(np.int64), np.concatenate(bits).view(np.int64)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), names=["block", "bit"])

    found = (
        rows.select(*keys)
        .mapInArrow(places, "block long, bit long")
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )
    bits = np.zeros(blocks * BLOCK_BITS // 8, np.uint8)
    width = BLOCK_BITS // 8
    for row in found.toLocalIterator():
        bits[row["block"] * width : (row["block"] + 1) * width] = np.frombuffer(row["bitmap"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(Filter(blocks, bits))


# Counts over all shards


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(filled("text").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))


def count_words(docs: DataFrame) -> DataFrame:
    """All words: (w1, lang, word, f)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            at = shard.example
            words = [shard.data[i:j] for i, j in zip(shard.starts[at], shard.ends[at], strict=True)]
            langs = [shard.langs[k] for k in shard.documents[at]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.hashes.view(np.int64)),
                    pa.array(langs, pa.string()),
                    pa.array(words, pa.binary()).cast(pa.string()),
                    pa.array(shard.counts),
                ],
                names=["w1", "lang", "word", "f"],
            )

    counted = _prepared(docs).mapInArrow(count, "w1 long, lang string, word string, f long")
    return counted.groupBy("w1", "lang", "word").agg(F.sum("f").alias("f"))


def _slices(columns: Sequence[np.ndarray], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), SLICE_ROWS):
        arrays = [pa.array(it[at : at + SLICE_ROWS]) for it in columns]
        yield pa.RecordBatch.from_arrays(arrays, names=list(names))


def count_phrases(docs: DataFrame, size: int, words: Broadcast, parts: Broadcast | None = None) -> DataFrame:
    """Phrases of so many words: (w1, .., f, left, right).

    ``words`` are the frequent words, and ``parts`` the frequent phrases of one word less.
    """
    keys, numbers = KEYS[:size], ["f", "left", "right"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            symbols = shard.symbols(words.value.holds(shard.hashes))

            def may_be(rows: np.ndarray, hashes=shard.hashes) -> np.ndarray:
                return parts.value.holds(phrase_keys([hashes[it - FIRST_WORD] for it in rows.T]))

            if parts is not None:
                symbols = only_in_phrases(symbols, size, may_be)
            for found, *counted in phrases(symbols, size, may_be, size - 1):
                if found.shape[1] == size:
                    hashes = shard.hashes[found.T - FIRST_WORD]
                    yield from _slices([*hashes.view(np.int64), *counted], [*keys, *numbers])

    schema = T.StructType([T.StructField(name, T.LongType()) for name in [*keys, *numbers]])
    sums = [F.sum(name).alias(name) for name in numbers]
    counted = _prepared(docs).mapInArrow(count, schema).groupBy(*keys).agg(*sums)
    no_word = [F.lit(0).cast("long").alias(name) for name in KEYS[size:]]
    return counted.select(*keys, *no_word, *numbers)


def frequent_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST
) -> tuple[DataFrame, dict[int, DataFrame]]:
    """All words with their counts, and by their size the phrases that occur so often."""
    words = checkpointed(count_words(docs))
    known = frequent_filter(words.where(F.col("f") >= least), ["w1"])
    found: dict[int, DataFrame] = {}
    parts = None
    for size in range(2, longest + 1):
        found[size] = checkpointed(count_phrases(docs, size, known, parts).where(F.col("f") >= least))
        # Counts are written, and what they were found with is asked for no more
        if parts is not None:
            parts.destroy()
        parts = frequent_filter(found[size], KEYS[:size]) if size < longest else None
    known.destroy()
    return words, found


# Scores


def _key(begin: int, end: int) -> list[Column]:
    """The words ``begin`` to ``end`` of a phrase as the key of a phrase."""
    kept = [F.col(KEYS[k]) for k in range(begin, end)]
    kept += [F.lit(0).cast("long")] * (LONGEST - len(kept))
    return [it.alias(name) for it, name in zip(kept, KEYS, strict=True)]


def _with_counts(
    rows: DataFrame, part: str, begin: int, end: int, counts: DataFrame, small: bool
) -> DataFrame:
    """Add the count of the words ``begin`` to ``end`` of a phrase; one word may begin a third of all.

    A salted join has its rows in the plan several times over. So what it finds is written out, or else a chain
    of them makes a plan that grows with a power of its length.
    """
    own = [f"_{k}" for k in range(end - begin)]
    rows = rows.withColumns(dict(zip(own, (F.col(KEYS[k]) for k in range(begin, end)), strict=True)))
    names = [*(F.col(KEYS[k]).alias(own[k]) for k in range(end - begin)), F.col("f").alias(part)]
    counts = counts.select(*names)
    if small:
        return rows.join(F.broadcast(counts), own).drop(*own)
    return checkpointed(skew_join(rows, counts, own, salt_by=KEYS, max_rows=-1).drop(*own))


def scored_phrases(
    phrases: dict[int, DataFrame], words: DataFrame, chosen: dict[int, DataFrame] | None = None
) -> DataFrame:
    """Phrases, or the ``chosen`` ones, with their lowest-scoring cut: (w1, .., a, l, r, score).

    A part is looked up among the phrases of its size; single words, by far the most parts, are a small table.
    """
    chosen = chosen or phrases
    counts = {1: words.select("w1", "f")} | phrases
    # The table of a size is looked at once, not once per join
    small = {
        size: fits_broadcast(counts[size].select(*KEYS[:size], "f"), WORD_ROWS if size == 1 else BROADCAST_ROWS)
        for size in range(1, max(chosen))
    }
    out = []
    for size, rows in chosen.items():
        rows = rows.select(*KEYS, F.col("f").alias("a"))
        parts = [it for k in range(1, size) for it in ((f"_l{k}", 0, k), (f"_r{k}", k, size))]
        # Those that are written out come first, before the others are in the plan
        for part, begin, end in sorted(parts, key=lambda it: small[it[2] - it[1]]):
            rows = _with_counts(rows, part, begin, end, counts[end - begin], small[end - begin])
        cuts = []
        for k in range(1, size):
            score = f"CAST(a AS DECIMAL(20,0)) * {SCORE_SCALE} DIV (CAST(_l{k} AS DECIMAL(20,0)) + _r{k})"
            named = {"score": F.expr(f"CAST({score} AS BIGINT)"), "k": F.lit(k), "l": F.col(f"_l{k}"), "r": F.col(f"_r{k}")}
            cuts.append(F.struct(*(it.alias(name) for name, it in named.items())))
        lowest = cuts[0] if len(cuts) == 1 else F.least(*cuts)
        out.append(rows.select(*KEYS, "a", lowest.alias("cut")).select(*KEYS, "a", "cut.l", "cut.r", "cut.score"))
    return reduce(DataFrame.unionByName, out)


def uncovered(phrases: dict[int, DataFrame], covered: int = COVERED) -> dict[int, DataFrame]:
    """Without the phrases that lie in a longer one of nearly as many occurrences."""
    lost = F.expr(f"CAST(most AS DECIMAL(20,0)) * 100 >= CAST(f AS DECIMAL(20,0)) * {covered}")
    out = {}
    for size, rows in phrases.items():
        longer = [
            it.select(F.explode(F.array(*(F.struct(*_key(at, at + size)) for at in range(more - size + 1)))).alias("part"), "f")
            for more, it in phrases.items()
            if more > size
        ]
        if longer:
            most = reduce(DataFrame.unionByName, longer).groupBy("part").agg(F.max("f").alias("most"))
            rows = rows.join(most.select("part.*", "most"), KEYS, "left")
            rows = rows.where(~F.coalesce(lost, F.lit(False))).drop("most")
        out[size] = rows
    return out


def _best(rows: DataFrame, top: int, order: Sequence[Column], ranking: Callable[[], Column], part: Column) -> DataFrame:
    """Rows of a language that rank among its first ones, with their ``rank``.

    Ranked in parts first: at most RANK_PARTS times as many rows as are wanted are ranked together.
    """
    in_part = Window.partitionBy("lang", "_part").orderBy(*order)
    rows = rows.withColumn("_part", part).withColumn("rank", ranking().over(in_part))
    rows = rows.where(F.col("rank") <= top).drop("_part")
    whole = Window.partitionBy("lang").orderBy(*order)
    return rows.withColumn("rank", ranking().over(whole)).where(F.col("rank") <= top)


def mine_collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    covered: int = COVERED,
    top: int = TOP,
) -> DataFrame:
    """The best phrases of every language, with their counts and those of their extensions."""
    words, found = frequent_phrases(docs, longest, least)
    frequent = checkpointed(words.where(F.col("f") >= least))
    kept = {size: checkpointed(rows.select(*KEYS, "f")) for size, rows in uncovered(found, covered).items()}
    scored = checkpointed(scored_phrases(found, frequent, kept))

    # Phrases are only spelled out if their numbers, ties included, rank them among the first ones
    scored = skew_join(scored, frequent.select("w1", "lang"), ["w1"], salt_by=KEYS)
    numbers = [F.desc("score"), F.desc("a")]
    part = F.pmod(F.xxhash64(*KEYS), F.lit(RANK_PARTS))
    best = checkpointed(_best(scored, top, numbers, F.rank, part).drop("rank"))
    spelled = best.select("lang", F.struct(*KEYS).alias("key"), F.posexplode(F.array(*KEYS)).alias("at", "w1"))
    spelled = skew_join(spelled.where("w1 <> 0"), frequent.select("w1", "word"), ["w1"], salt_by=["key", "at"])
    text = F.array_join(F.sort_array(F.collect_list(F.struct("at", "word"))).word, " ")
    spelled = spelled.groupBy("key").agg(text.alias("phrase")).select("key.*", "phrase")
    extensions = reduce(DataFrame.unionByName, found.values()).select(*KEYS, "left", "right")
    named = best.join(spelled, KEYS).join(extensions, KEYS)

    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    ranked = _best(named, top, [*numbers, F.asc("phrase")], F.row_number, part)
    totals = checkpointed(words.groupBy("lang").agg(F.sum("f").alias("n")))
    ranked = skew_join(ranked, totals, ["lang"])
    shape = ["lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"]
    return ranked.select(*shape, "left", "right")


_SPACE = " \\t"
_ENDS = ".,;:!?\\n\\x0B\\f\\r"


def _sql() -> str:
    """Phrases by joining word positions, for the small tables that SQL is run on."""
    sizes = range(1, LONGEST + 1)
    grams = " UNION ALL ".join(
        f"SELECT lang, {size} AS size, array_to_string(w[i:i + {size - 1}], ' ') AS phrase FROM places "
        f"WHERE i + {size - 1} <= len(w)"
        for size in sizes
    )
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, size, a, {k} AS k, array_to_string(w[1:{k}], ' ') AS head, "
        f"array_to_string(w[{k + 1}:size], ' ') AS rest FROM candidates WHERE size > {k}"
        for k in range(1, LONGEST)
    )
    inner = " UNION ALL ".join(
        f"SELECT lang, a, array_to_string(w[{begin}:{begin + width - 1}], ' ') AS phrase FROM candidates "
        f"WHERE size >= {begin + width - 1} AND size > {width}"
        for width in range(2, LONGEST)
        for begin in range(1, LONGEST - width + 2)
    )
    return f"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
pieces AS (
    SELECT lang, unnest(list_transform(regexp_extract_all(text, '[^{_ENDS}]+'),
                        lambda p: regexp_extract_all(p, '[^{_SPACE}]+'))) AS w
    FROM texts
),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS ({grams}),
counts AS (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY lang, phrase, size),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (
    SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM counts
    WHERE size > 1 AND f >= {LEAST}
),
cuts AS ({cuts}),
scored AS (
    SELECT cuts.lang, cuts.phrase, a, k, heads.f AS l, rests.f AS r,
           CAST(CAST(a AS HUGEINT) * {SCORE_SCALE} // (heads.f + rests.f) AS BIGINT) AS score
    FROM cuts
    JOIN counts AS heads ON heads.lang = cuts.lang AND heads.phrase = cuts.head AND heads.size = k
    JOIN counts AS rests ON rests.lang = cuts.lang AND rests.phrase = cuts.rest AND rests.size = cuts.size - k
),
lowest AS (
    SELECT lang, phrase, a, l, r, score FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
longer AS (SELECT lang, phrase, max(a) AS most FROM ({inner}) GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang) LEFT JOIN longer USING (lang, phrase)
WHERE most IS NULL OR CAST(most AS HUGEINT) * 100 < CAST(a AS HUGEINT) * {COVERED}
QUALIFY rank <= {TOP}
"""


@query("op11_phrase_collocations", _sql())
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(read(spark, sf_dir, "documents")).drop("left", "right")
