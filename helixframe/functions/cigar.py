"""Expressions on CIGARs, stored as ``array<struct<op:int,len:int>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes of the SAM specification, by position
OPERATIONS = "MIDNSHP=X"

ALIGNED = (0, 7, 8)
INSERTION = (1,)
DELETION = (2,)
CLIPPED = (4, 5)
CONSUMES_REFERENCE = (0, 2, 3, 7, 8)
CONSUMES_QUERY = (0, 1, 4, 7, 8)

CIGAR_TYPE = "array<struct<op:int,len:int>>"


def parse_cigar(text: Column) -> Column:
    """CIGAR text to an array of operations; ``*`` and null become null."""
    parts = F.regexp_extract_all(text, F.lit(r"\d+[MIDNSHP=X]"), F.lit(0))
    parsed = F.transform(
        parts,
        lambda it: F.struct(
            (F.instr(F.lit(OPERATIONS), F.right(it, F.lit(1))) - 1).cast("int").alias("op"),
            F.substring(it, F.lit(1), F.length(it) - 1).cast("int").alias("len"),
        ),
    )
    return F.when(text != "*", parsed)


def format_cigar(cigar: Column) -> Column:
    """Array of operations to CIGAR text (``*`` if null)."""
    parts = F.transform(
        cigar,
        lambda it: F.concat(
            it["len"].cast("string"), F.substring(F.lit(OPERATIONS), it["op"] + 1, F.lit(1))
        ),
    )
    return F.coalesce(F.array_join(parts, ""), F.lit("*"))


def _length_if(it: Column, ops: tuple[int, ...]) -> Column:
    """The length of an operation if it is one of the given ones, else 0: a look at one bit."""
    bits = F.lit(sum(1 << op for op in ops))
    return it["len"] * F.call_function("shiftright", bits, it["op"]).bitwiseAND(1)


def total_length(cigar: Column, ops: tuple[int, ...]) -> Column:
    """Sum of the lengths of the given operations."""
    return F.aggregate(cigar, F.lit(0), lambda acc, it: acc + _length_if(it, ops))


def reference_length(cigar: Column) -> Column:
    return total_length(cigar, CONSUMES_REFERENCE)


def query_length(cigar: Column) -> Column:
    return total_length(cigar, CONSUMES_QUERY)


def mapped_bases(cigar: Column) -> Column:
    return total_length(cigar, ALIGNED)


def _clipped(cigar: Column, first: Column, second: Column, ops: tuple[int, ...]) -> Column:
    """Clipped bases before the first other operation; most CIGARs have at most one operation there."""
    start = F.struct(F.lit(0).alias("total"), F.lit(True).alias("open"))

    def step(acc: Column, it: Column) -> Column:
        still_open = acc["open"] & it["op"].isin(*CLIPPED)
        return F.struct(
            (acc["total"] + F.when(still_open & it["op"].isin(*ops), it["len"]).otherwise(0)).alias(
                "total"
            ),
            still_open.alias("open"),
        )

    return (
        F.when(~first["op"].isin(*CLIPPED), 0)
        .when(~second["op"].isin(*CLIPPED), _length_if(first, ops))
        .otherwise(F.aggregate(cigar, start, step, lambda acc: acc["total"]))
    )


def clipped_front(cigar: Column, ops: tuple[int, ...] = CLIPPED) -> Column:
    """Number of clipped bases (soft and hard by default) before the first other operation."""
    return _clipped(cigar, F.get(cigar, F.lit(0)), F.get(cigar, F.lit(1)), ops)


def clipped_back(cigar: Column, ops: tuple[int, ...] = CLIPPED) -> Column:
    """Number of clipped bases after the last other operation."""
    size = F.size(cigar)
    return _clipped(F.reverse(cigar), F.get(cigar, size - 1), F.get(cigar, size - 2), ops)


def aligned_blocks(pos: Column, cigar: Column) -> Column:
    """Array of gap-free aligned blocks ``(ref_start, ref_end, query_start)``.

    The offsets are accumulated along the CIGAR: an aligned operation emits a block, and every
    operation advances the reference and/or query offset that it consumes. Padding (``P``)
    consumes neither.
    """
    empty = F.array().cast("array<struct<ref_start:bigint,ref_end:bigint,query_start:int>>")
    start = F.struct(
        pos.cast("long").alias("r"), F.lit(0).alias("q"), empty.alias("blocks")
    )

    def step(acc: Column, it: Column) -> Column:
        num = it["len"]
        block = F.struct(
            acc["r"].alias("ref_start"),
            (acc["r"] + num).alias("ref_end"),
            acc["q"].alias("query_start"),
        )
        return F.struct(
            (acc["r"] + _length_if(it, CONSUMES_REFERENCE)).cast("long").alias("r"),
            (acc["q"] + _length_if(it, CONSUMES_QUERY)).alias("q"),
            F.when(it["op"].isin(*ALIGNED), F.concat(acc["blocks"], F.array(block)))
            .otherwise(acc["blocks"])
            .alias("blocks"),
        )

    return F.aggregate(cigar, start, step, lambda acc: acc["blocks"])


def pieces(pos: Column, cigar: Column, whole: Column) -> Column:
    """Array of ``(kind, piece_start, piece_end)`` on the reference.

    The first piece is the aligned span, whose kind is ``whole``; the others are insertions
    (``i``), deletions (``d``) and skipped stretches (``n``). Inserted bases take the place of
    the bases that follow them.
    """
    item = "struct<kind:string,piece_start:bigint,piece_end:bigint>"
    init = F.struct(
        pos.cast("long").alias("r"), F.array().cast(f"array<{item}>").alias("pieces")
    )

    def step(acc: Column, it: Column) -> Column:
        op, num = it["op"], it["len"]
        kind = F.when(op == 1, "i").when(op == 2, "d").when(op == 3, "n")
        piece = F.struct(
            kind.alias("kind"),
            acc["r"].alias("piece_start"),
            (acc["r"] + num).alias("piece_end"),
        )
        return F.struct(
            (acc["r"] + F.when(op.isin(*CONSUMES_REFERENCE), num).otherwise(0))
            .cast("long")
            .alias("r"),
            F.when(kind.isNotNull(), F.concat(acc["pieces"], F.array(piece)))
            .otherwise(acc["pieces"])
            .alias("pieces"),
        )

    def finish(acc: Column) -> Column:
        span = F.struct(
            whole.alias("kind"),
            pos.cast("long").alias("piece_start"),
            acc["r"].alias("piece_end"),
        )
        return F.concat(F.array(span), acc["pieces"])

    return F.aggregate(cigar, init, step, finish)


def unclipped_start(pos: Column, cigar: Column) -> Column:
    return (pos - clipped_front(cigar)).cast("long")


def unclipped_end(pos: Column, cigar: Column) -> Column:
    return (pos + reference_length(cigar) + clipped_back(cigar)).cast("long")


def aligned_quality(cigar: Column, quals: Column) -> Column:
    """Sum of the base qualities without the soft-clipped ends; null if there are none."""
    front = clipped_front(cigar, ops=(4,))
    back = clipped_back(cigar, ops=(4,))
    kept = F.slice(quals, front + 1, F.greatest(F.size(quals) - front - back, F.lit(0)))
    return F.when(quals.isNotNull(), F.aggregate(kept, F.lit(0), lambda acc, it: acc + it))
