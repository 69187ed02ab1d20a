"""Operators on multiple sequence alignments: rows ``(msa, name, meta, sequence)``.

Sequences of one ``msa`` have equal lengths. What all sequences of an alignment say about its columns is
combined in planes: the set of bases of a column is one hexadecimal digit, and the digits of
``PLANE_COLUMNS`` columns are the bytes of one bitmap, so that a set operation over all sequences is
a ``bitmap_or_agg``. Only planes are shuffled for that, combined before they are; the text of planes returns
to the sequences, which are rewritten as a whole: they are neither cut into rows nor put together again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.binding import bound
from helixframe.functions.sequences import (
    IUPAC,
    MASK_CODES,
    MASK_DIGITS,
    fragments,
    split_positions,
)
from helixframe.plans.session import cut_lineage
from helixframe.plans.skew import skew_join

#: Columns of a plane: four bits each in a bitmap of 4096 bytes, which is what Spark combines.
PLANE_COLUMNS = 8192
#: Hexadecimal digits of a number that are compared at once.
NUMBER_DIGITS = 15
#: Codes of some but not all bases, and the digits of the sets they stand for.
SET_CODES = MASK_CODES.replace("N", "")
SET_DIGITS = "".join(
    digit for code, digit in zip(MASK_CODES, MASK_DIGITS, strict=True) if code != "N"
)
#: Codes of more than two bases are not bi-allelic
TWO_BASES = "".join(
    digit for bases, digit in zip(IUPAC.values(), MASK_DIGITS, strict=True) if len(bases) == 2
)


def chunks(sequences: DataFrame, width: int, column: str = "sequence") -> DataFrame:
    """Replace the sequence by rows ``(chunk, bases)`` of ``width`` characters."""
    pieces = fragments(F.col(column), width)
    others = [name for name in sequences.columns if name != column]
    return sequences.select(*others, F.posexplode(pieces).alias("chunk", "bases"))


def called_digits(bases: Column) -> Column:
    """A digit per column, 0 for ``N``, ``n`` and gaps and F for all else."""
    return F.regexp_replace(F.translate(bases, "Nn-", "000"), "[^0]", "F")


def set_digits(bases: Column, unknown: str = "0") -> Column:
    """A digit per column: the set of bases of the code; ``unknown`` for ``N``, gaps and all else."""
    codes = F.regexp_replace(F.upper(bases), f"[^{SET_CODES}]", "N")
    return F.translate(codes, SET_CODES + "N", SET_DIGITS + unknown)


def plane(digits: Column, fill: str = "0") -> Column:
    """The bitmap of up to ``PLANE_COLUMNS`` digits."""
    return F.unhex(F.rpad(digits, PLANE_COLUMNS, fill))


def planes_text(rows: DataFrame, keys: Sequence[str], digits: Column) -> DataFrame:
    """Per group of ``keys``, the digits of all its sequences combined: ``(.., planes, n)``.

    ``rows`` hold (chunk, bases) of ``PLANE_COLUMNS`` columns. The text is as long as a sequence.
    """
    combined = rows.groupBy(*keys, "chunk").agg(
        F.bitmap_or_agg(plane(digits)).alias("_plane"), F.count("*").alias("n")
    )
    ordered = F.array_sort(F.collect_list(F.struct("chunk", F.hex("_plane").alias("digits"))))
    return combined.groupBy(*keys).agg(
        F.array_join(F.transform(ordered, lambda it: it["digits"]), "").alias("planes"),
        F.max("n").alias("n"),
    )


def ascii_bytes(text: Column) -> Column:
    """Bytes of an ASCII text: any place is found at once, unlike that of a character."""
    return F.encode(text, "US-ASCII")


def part_of(data: Column, start: Column, size: Column) -> Column:
    """Part of some bytes as text again."""
    return F.substring(data, start, size).cast("string")


def _run_edges(digits: Column) -> Column:
    """Where runs of non-zero digits begin and end, in turn."""

    def edges(data: Column) -> Column:
        size = F.octet_length(data)

        def is_set(at: Column) -> Column:
            return (at >= 0) & (at < size) & (F.substring(data, at + 1, F.lit(1)) != F.lit(b"0"))

        return F.filter(F.sequence(F.lit(0), size), lambda at: is_set(at) != is_set(at - 1))

    return bound(ascii_bytes(digits), edges)


def msa_reduce(sequences: DataFrame) -> DataFrame:
    """Drop columns that are ``N``, ``n`` or a gap in all sequences of the alignment.

    Alignments without any other column vanish.
    """
    masks = planes_text(chunks(sequences, PLANE_COLUMNS), ["msa"], called_digits(F.col("bases")))
    # Edges are only wanted where sequences differ in the columns they lack
    masks = (
        masks.where(F.translate("planes", "0", "") != "")
        .withColumn("_edges", F.when(F.col("n") > 1, _run_edges(F.col("planes"))))
        .drop("n")
    )
    masks = cut_lineage(masks)
    own = called_digits(F.col("sequence"))
    all_lack = own == F.substring("planes", 1, F.length("sequence"))
    is_ascii = F.octet_length("sequence") == F.length("sequence")

    def kept(edges: Column, part: Callable[[Column, Column], Column]) -> Column:
        pairs = F.sequence(F.lit(0), F.floor(F.size(edges) / 2).cast("int") - 1)
        at, end = (lambda k: F.get(edges, 2 * k)), (lambda k: F.get(edges, 2 * k + 1))
        return F.array_join(F.transform(pairs, lambda k: part(at(k) + 1, end(k) - at(k))), "")

    def by_runs(edges: Column) -> Column:
        data, text = ascii_bytes(F.col("sequence")), F.col("sequence")
        by_bytes = bound(data, lambda it: kept(edges, lambda start, size: part_of(it, start, size)))
        return F.when(is_ascii, by_bytes).otherwise(
            kept(edges, lambda start, size: F.substring(text, start, size))
        )

    reduced = F.when(all_lack, F.translate("sequence", "Nn-", "")).otherwise(
        bound(F.col("_edges"), by_runs)
    )
    joined = skew_join(sequences.select("msa", "name", "meta", "sequence"), masks, ["msa"], salt_by=["name"])
    return joined.select("msa", "name", "meta", reduced.alias("sequence"))


def msa_filter_singletons(
    sequences: DataFrame, is_target: Column, is_reference: Column
) -> DataFrame:
    """Restrict the target sequences to the bases seen in the reference sequences.

    Every called base of a target is intersected with the union of the bases of the references in
    its column. Changed bases are written in lower case, ``n`` if nothing is left. Targets of
    alignments without references, and all other sequences, are unchanged.
    """
    references = chunks(sequences.where(is_reference).select("msa", "sequence"), PLANE_COLUMNS)
    # Materialised, since their number decides how they are joined: otherwise the references are read for each question
    allowed = cut_lineage(planes_text(references, ["msa"], set_digits(F.col("bases"))).drop("n"))
    rows = sequences.select("msa", "name", "meta", "sequence", is_target.alias("_target"))
    joined = skew_join(rows, allowed, ["msa"], "left", salt_by=["name"])
    def number(digits: Column) -> Column:
        return F.conv(digits, 16, 10).cast("long")

    def restricted(base: Column, code: Column) -> Column:
        skipped = F.upper(base).isin("N", "-", "")
        return F.when(skipped | (F.upper(base) == code), base).otherwise(F.lower(code))

    def piece(bases: Column, k: Column, own: Column, allowed: Column, only_codes: Column) -> Column:
        at, size = k * NUMBER_DIGITS + 1, F.length(bases)
        mine = part_of(own, at, size)
        common = number(mine).bitwiseAND(number(part_of(allowed, at, size)))
        digits = F.lpad(F.conv(common.cast("string"), 10, 16), size, F.lit("0"))
        # The digit F stands for a column without restriction, which only N would have
        codes = F.split(F.translate(digits, MASK_DIGITS + "0", MASK_CODES + "N"), "")
        changed = F.array_join(F.zip_with(F.split(bases, ""), codes, restricted), "")
        # Sets that lie within the references' need no look at single columns
        return F.when((common == number(mine)) & only_codes, bases).otherwise(changed)

    pieces = fragments(F.col("sequence"), NUMBER_DIGITS)
    # Asked once per sequence, as a search costs much more than the few numbers of a piece
    only_codes = ~F.upper("sequence").rlike(f"[^{SET_CODES}N-]")
    changed = bound(
        ascii_bytes(set_digits(F.col("sequence"))),
        lambda own: bound(
            ascii_bytes(F.col("planes")),
            lambda allowed: bound(
                only_codes,
                lambda clean: F.array_join(F.transform(pieces, lambda it, k: piece(it, k, own, allowed, clean)), ""),
            ),
        ),
    )
    return joined.select(
        "msa",
        "name",
        "meta",
        F.when(F.col("_target") & F.col("planes").isNotNull(), changed)
        .otherwise(F.col("sequence"))
        .alias("sequence"),
    )


def msa_split(sequences: DataFrame, split_by: str = "123") -> DataFrame:
    """De-interleave by position: one row per sequence and key, ``meta`` is dropped."""
    parts = split_positions(F.col("sequence"), split_by)
    entries = F.array(
        *(
            F.struct(F.lit(key).alias("key"), value.alias("sequence"))
            for key, value in parts.items()
        )
    )
    return sequences.select("msa", "name", F.inline(entries))


def msa_join(alignments: Sequence[DataFrame]) -> DataFrame:
    """Concatenate the sequences of several alignments by name, in the order given.

    All alignments must hold the same names; ``meta`` is dropped.
    """
    if not alignments:
        raise ValueError("no alignments to join")
    numbered = [
        df.select("name", F.lit(idx).alias("_idx"), "sequence") for idx, df in enumerate(alignments)
    ]
    parts = F.array_sort(F.collect_list(F.struct("_idx", "sequence")))
    joined = reduce(DataFrame.unionByName, numbered).groupBy("name").agg(parts.alias("_parts"))
    complete = F.size("_parts") == len(alignments)
    return joined.select(
        "name",
        F.when(complete, F.array_join(F.transform("_parts", lambda it: it["sequence"]), ""))
        .otherwise(F.raise_error(F.concat(F.lit("name not in all alignments: "), "name")))
        .alias("sequence"),
    )


def missing_names(sequences: DataFrame, names: DataFrame) -> DataFrame:
    """Names that no sequence has."""
    return names.join(sequences.select("name"), "name", "left_anti")


def _require_known(sequences: DataFrame, names: DataFrame) -> None:
    unknown = missing_names(sequences, names).limit(5).collect()
    if unknown:
        raise KeyError(f"unknown sequences: {[row['name'] for row in unknown]}")


def msa_select(sequences: DataFrame, names: DataFrame) -> DataFrame:
    """Sequences with the given names, which must exist."""
    _require_known(sequences, names)
    return sequences.join(names.select("name"), "name", "left_semi")


def msa_exclude(sequences: DataFrame, names: DataFrame) -> DataFrame:
    """Sequences other than the given ones, which must exist."""
    _require_known(sequences, names)
    return sequences.join(names.select("name"), "name", "left_anti")


def msa_exclude_flagged(sequences: DataFrame) -> DataFrame:
    """Drop sequences with ``EXCLUDE`` among the ``;``-separated fields of their meta text."""
    fields = F.split(F.upper(F.coalesce("meta", F.lit(""))), ";")
    return sequences.where(~F.exists(fields, lambda it: F.trim(it) == "EXCLUDE"))


def msa_truncate(sequences: DataFrame, length: int) -> DataFrame:
    return sequences.withColumn("sequence", F.substring("sequence", 1, length))


def msa_shape(sequences: DataFrame) -> DataFrame:
    """Per alignment: number of sequences and of distinct names, and the common length."""
    return sequences.groupBy("msa").agg(
        F.count("*").alias("n_sequences"),
        F.count_distinct("name").alias("n_names"),
        F.min(F.length("sequence")).alias("min_length"),
        F.max(F.length("sequence")).alias("max_length"),
    )


def unique_names(rows: DataFrame, keys: Sequence[str], name: str = "name") -> DataFrame:
    """Names that occur more than once."""
    return rows.groupBy(*keys, name).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def align_to_reference(reference: Column, majority: Column) -> Column:
    """Insert gaps into the consensus where the aligned reference has them.

    The k-th base of the consensus goes to the k-th column without a gap; gaps after the last one
    are left out.
    """
    columns = F.split(reference, "")
    taken = F.filter(
        F.transform(columns, lambda base, idx: F.when(~base.isin("-", ""), idx)),
        lambda idx: idx.isNotNull(),
    )
    spread = F.zip_with(
        F.zip_with(
            taken,
            F.concat(F.array(F.lit(-1)), taken),
            lambda at, before: F.repeat(F.lit("-"), at - before - 1),
        ),
        F.filter(F.split(majority, ""), lambda base: base != ""),
        lambda gaps, base: F.concat(gaps, base),
    )
    return F.array_join(spread, "")
