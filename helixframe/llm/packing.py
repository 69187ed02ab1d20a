"""Best-fit packing of documents into sequences by bin completion.

Documents are tokenized, ended by id 0 and cut into pieces of at most ``CAPACITY`` tokens. Which
pieces share a sequence depends on their lengths alone, and there are at most ``CAPACITY`` lengths:
the packing is planned on the histogram of lengths, whose size does not grow with the data. The
plan says how many sequences hold which lengths. Pieces are numbered within their length, by
buckets, and look up their place in the plan.

The plan is made by bin completion. The largest length left opens a sequence; fillings of the rest
are enumerated depth first from large to small. A filling is dominated, and skipped, if one of its
lengths can be replaced by a longer one that still fits. Branches whose waste cannot fall below
that of the best filling so far are cut, and the best-fit filling is the first incumbent. If the
result needs more sequences than the lower bound, other branches take the second best filling at
one place each, over all places, and are cut as soon as their waste reaches that of the incumbent. The budget of
the search is a parameter; ``lower_bound`` says how far a plan can be from the best one.

A null text counts as empty: one token, id 0. Repeated rows are packed as often as they occur. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import checkpointed, filled, read
from helixframe.llm.queries import query

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
#: Branches looked at for one filling, and for a plan as a whole. Where the lower bound is met, and it is met by
#: the first fillings on all given tables, neither matters; where it isn't, the search ends with the best plan
#: so far once all places have been tried or the second number is spent. No piece depends on it.
FILLING_NODES = 2_000
SEARCH_NODES = 1_000_000
#: Words whose ids a Python worker remembers.
REMEMBERED = 500_000

#: Texts of these characters are split by the pattern below as the tokenizer would split them: the
#: characters are in composed form, and lower-casing keeps letters single letters.
_PLAIN = re.compile("[ \t-\r!-~À-ÿ]*")
_PIECE = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-z0-9ß-öø-ÿ]+"
)


class WordTokenizer:
    """Ids of texts by a public tokenizer that treats words and marks one by one.

    The ids of a text are those of its pieces in a row, and white space ends every piece. The ids
    of pieces are remembered, so the tokenizer's model sees few of them twice. Texts with other than
    plain characters are cut at white space only, and the whole tokenizer does the rest.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The model sees bytes as characters of their own
        by_byte = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = map(chr, range(ord("À"), ord("ÿ") + 1))
        self.alphabet = {ord(it): by_byte.pre_tokenize_str(it)[0][0] for it in letters}
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as unsigned 32-bit little-endian numbers."""
        for known in (self.pieces, self.chunks):
            if len(known) > REMEMBERED:
                known.clear()
        split: list[list] = []
        new_pieces: set[str] = set()
        new_chunks: set[bytes] = set()
        for text in texts:
            if _PLAIN.fullmatch(text) and "<|" not in text:
                split.append(_PIECE.findall(text.lower()))
                new_pieces.update(split[-1])
            else:
                split.append(text.encode("utf-8", "replace").split())
                new_chunks.update(split[-1])
        for piece in new_pieces.difference(self.pieces):
            known = piece if piece.isascii() else piece.translate(self.alphabet)
            ids = [token.id for token in self.model.tokenize(known)]
            self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        for chunk in new_chunks.difference(self.chunks):
            ids = self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids
            self.chunks[chunk] = np.array(ids, "<u4").tobytes()
        piece, chunk = self.pieces.__getitem__, self.chunks.__getitem__
        return [b"".join(map(piece if parts and isinstance(parts[0], str) else chunk, parts)) for parts in split]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per worker and file."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece of a document: its number, first token, length and the checksum of its ids."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        words = tokenizer(path or public_tokenizers.path(TOKENIZER))
        for batch in batches:
            rows = []
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                for doc_id, ids in zip(part["doc_id"], words.encode(list(part["text"])), strict=True):
                    ids += b"\0\0\0\0"
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[start : start + 4 * capacity]
                        rows.append((doc_id, piece, start // 4, len(own) // 4, zlib.crc32(own)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), filled("text").alias("text"))
    return texts.mapInPandas(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


class Budget:
    """Branches that may still be looked at."""

    def __init__(self, nodes: int):
        self.nodes = nodes


def _best_fillings(
    counts: dict[int, int], sizes: list[int], first: int, room: int, budget: Budget
) -> list[tuple]:
    """The best undominated fillings of the room beside ``first``, as (waste, lengths)."""
    left = dict(counts)
    left[first] -= 1

    def best_fit(space: int) -> list[int]:
        chosen, used = [], dict(left)
        for size in sizes:
            while size <= space and used.get(size, 0) > 0:
                chosen.append(size)
                used[size] -= 1
                space -= size
        return chosen

    greedy = best_fit(room)
    found = [(room - sum(greedy), tuple(greedy))]
    nodes, most = 0, min(FILLING_NODES, budget.nodes)

    def dominated(chosen: list[int], waste: int) -> bool:
        for size in set(chosen):
            for longer in range(size + 1, size + waste + 1):
                if left.get(longer, 0) > chosen.count(longer):
                    return True
        return False

    def search(position: int, space: int, chosen: list[int]) -> bool:
        """True if a filling without waste has been found."""
        nonlocal nodes
        nodes += 1
        if left.get(space, 0) > chosen.count(space) and space > 0:
            found.append((0, (*chosen, space)))
            return True
        extended = False
        for index in range(position, len(sizes)):
            if nodes > most:
                return False
            size = sizes[index]
            if size > space or left.get(size, 0) <= chosen.count(size):
                continue
            extended = True
            chosen.append(size)
            if size == space or search(index, space - size, chosen):
                if size == space:
                    found.append((0, tuple(chosen)))
                chosen.pop()
                return True
            chosen.pop()
        if not extended and space < found[0][0] and not dominated(chosen, space):
            found.insert(0, (space, tuple(chosen)))
        return False

    if found[0][0] > 0:
        search(0, room, [])
    # Fitting best looks at the lengths, several of which cost as much as a branch
    budget.nodes -= nodes + len(sizes) // 10 + 1
    return sorted(set(found), key=lambda it: (it[0], -max(it[1], default=0), it[1]))[:2]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    tokens = sum(size * count for size, count in counts.items())
    large = sum(count for size, count in counts.items() if 2 * size > capacity)
    return max(-(-tokens // capacity), large)


def complete_bins(
    counts: dict[int, int],
    capacity: int,
    second_at: int = -1,
    most_waste: float = float("inf"),
    budget: Budget | None = None,
) -> list[tuple[tuple[int, ...], int]] | None:
    """Sequences as (lengths, how often), or None once their waste exceeds ``most_waste``.

    At place ``second_at`` the second best filling is taken instead of the best.
    """
    budget = budget or Budget(SEARCH_NODES)
    counts = {size: count for size, count in counts.items() if count}
    sizes = sorted(counts, reverse=True)
    bins: list[tuple[tuple[int, ...], int]] = []
    waste = 0
    while sizes:
        first = sizes[0]
        fillings = _best_fillings(counts, sizes, first, capacity - first, budget)
        lost, filling = fillings[min(len(fillings) - 1, int(len(bins) == second_at))]
        lengths = (first, *filling)
        needed = {size: lengths.count(size) for size in set(lengths)}
        often = min(counts[size] // need for size, need in needed.items())
        for size, need in needed.items():
            counts[size] -= need * often
        sizes = [size for size in sizes if counts[size]]
        bins.append((lengths, often))
        waste += lost * often
        # The last sequence may be partly empty in any packing
        if waste - lost > most_waste:
            return None
    return bins


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit in order of decreasing length, with sequences of the same lengths taken together."""
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for size in sorted((size for size, count in counts.items() if count), reverse=True):
        left = counts[size]
        while left:
            room = min((room for room in by_room if room >= size), default=None)
            if room is None:
                each = min(left, capacity // size)
                often = left // each
                by_room.setdefault(capacity - each * size, []).append(((size,) * each, often))
                left -= each * often
                continue
            lengths, often = by_room[room].pop()
            used = min(often, left)
            if used < often:
                by_room[room].append((lengths, often - used))
            if not by_room[room]:
                del by_room[room]
            by_room.setdefault(room - size, []).append(((*lengths, size), used))
            left -= used
    return [it for group in by_room.values() for it in group]


def plan_sequences(
    counts: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES
) -> list[tuple[tuple[int, ...], int]]:
    """The best packing found of so many pieces per length, looking at so many branches."""
    budget = Budget(nodes)
    # The first plan is always made as a whole
    best = complete_bins(counts, capacity)
    bound = lower_bound(counts, capacity)
    number = sum(often for _, often in best)
    other = best_fit_decreasing(counts, capacity)
    if sum(often for _, often in other) < number:
        best, number = other, sum(often for _, often in other)
    tokens = sum(size * count for size, count in counts.items())
    place = 0
    while number > bound and place < len(best) and budget.nodes > 0:
        other = complete_bins(counts, capacity, place, (number - 1) * capacity - tokens, budget)
        if other is not None and sum(often for _, often in other) < number:
            best, number, place = other, sum(often for _, often in other), 0
            continue
        place += 1
    return best


def _numbered(pieces: DataFrame, rows: int) -> DataFrame:
    """Number the pieces of each length from 0, without bringing a length together in one task."""
    buckets = max(1, round(rows**0.5))
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    starts = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("pieces"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        "length", "bucket", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first")
    )
    place = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    return (
        bucketed.withColumn("place", place)
        .join(starts, ["length", "bucket"])
        .withColumn("number", F.col("first") + F.col("place"))
        .drop("bucket", "place", "first")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length``) and the sequence and offset of each."""
    pieces = checkpointed(pieces.withColumn("row", F.monotonically_increasing_id()))
    histogram = pieces.groupBy("length").agg(F.count("*").alias("pieces"))
    # At most one row per length up to the capacity
    counts = {row["length"]: row["pieces"] for row in histogram.collect()}
    bins = plan_sequences(counts, capacity)

    # For each length its runs of places: from which piece on, in which sequences, at which offset
    places, used, sequence = [], dict.fromkeys(counts, 0), 0
    for lengths, often in bins:
        for size in dict.fromkeys(lengths):
            each = lengths.count(size)
            offset = sum(lengths[: lengths.index(size)])
            places.append((size, used[size], each, sequence, offset))
            used[size] += each * often
        sequence += often
    places.sort()
    size, first, each, start, offset = (np.array(it, np.int64) for it in zip(*places, strict=True)) if places else (np.zeros(0, np.int64),) * 5
    key = (size << 50) + first

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, number = batch["length"].to_numpy(np.int64), batch["number"].to_numpy(np.int64)
            run = np.searchsorted(key, (length << 50) + number, side="right") - 1
            at = number - first[run]
            batch["sequence_id"] = start[run] + at // each[run]
            batch["offset"] = offset[run] + at % each[run] * length
            yield batch.drop(columns="number")

    numbered = _numbered(pieces, sum(counts.values())).drop("row")
    schema = numbered.drop("number").schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInPandas(place, schema)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece of a document its place in a sequence."""
    packed = pack(token_pieces(docs, path, capacity), capacity)
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
