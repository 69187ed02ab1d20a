"""Expressions on nucleotide sequences and genotypes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC nucleotide codes and the bases that they stand for
IUPAC = {
    "A": "A",
    "C": "C",
    "G": "G",
    "T": "T",
    "R": "AG",
    "Y": "CT",
    "K": "GT",
    "M": "AC",
    "S": "CG",
    "W": "AT",
    "B": "CGT",
    "D": "AGT",
    "H": "ACT",
    "V": "ACG",
    "N": "ACGT",
}
# Codes with a complement, and the complements
COMPLEMENT_FROM = "ATCGNRYKMSWBVDHX"
COMPLEMENT_TO = "TAGCNYRMKSWVBHDX"

#: Bit per base; a set of bases is a number in 0..15 and so one hexadecimal digit.
BASE_BITS = {"A": 1, "C": 2, "G": 4, "T": 8}


def _set_digit(bases: str) -> str:
    return format(sum(BASE_BITS[base] for base in bases), "X")


#: Codes, and the hexadecimal digit of the set of bases of each code
MASK_CODES = "".join(IUPAC)
MASK_DIGITS = "".join(_set_digit(bases) for bases in IUPAC.values())


def complement(sequence: Column) -> Column:
    """Complement, preserving case; characters without a complement become ``N``."""
    known = COMPLEMENT_FROM + COMPLEMENT_FROM.lower()
    return F.translate(
        F.regexp_replace(sequence, f"[^{known}]", "N"),
        known,
        COMPLEMENT_TO + COMPLEMENT_TO.lower(),
    )


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(complement(sequence))


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(value) for item in mapping.items() for value in item]
    return F.element_at(F.create_map(*pairs), key)


def encode_genotype(bases: Column) -> Column:
    """IUPAC code of a set of the letters ACGTN (commas are ignored); anything else fails."""
    letters = F.array_remove(F.array_distinct(F.split(F.translate(bases, ",", ""), "")), "")
    key = F.array_join(F.array_sort(letters), "")
    known = {bases: code for code, bases in IUPAC.items()}
    known["N"] = "N"
    code = F.try_element_at(
        F.create_map(*[F.lit(value) for item in known.items() for value in item]), key
    )
    return F.coalesce(
        code, F.raise_error(F.concat(F.lit("cannot encode genotype "), bases)).cast("string")
    )


def decode_genotype(code: Column) -> Column:
    """Bases of an IUPAC code, null for any other character."""
    pairs = [F.lit(value) for item in IUPAC.items() for value in item]
    return F.try_element_at(F.create_map(*pairs), code)


def split_positions(sequence: Column, split_by: str = "123") -> dict[str, Column]:
    """De-interleave a sequence: one column per distinct key of the cyclic ``split_by``."""
    if not split_by:
        raise ValueError("no positions to split by")

    letters = F.split(sequence, "")

    def letters_of(key: str) -> Column:
        wanted = [idx for idx, value in enumerate(split_by) if value == key]
        kept = F.filter(letters, lambda _, idx: (idx % len(split_by)).isin(*wanted))
        return F.array_join(kept, "")

    return {key: letters_of(key) for key in dict.fromkeys(split_by)}


def complexity(sequence: Column) -> Column:
    """Number of homopolymer runs."""
    return F.length(F.regexp_replace(sequence, r"(?s)(.)\1+", "$1"))


def mask_letters(sequence: Column) -> Column:
    """Replace every ASCII letter other than ACGTN (of either case) by ``N``."""
    return F.regexp_replace(sequence, "[a-zA-Z&&[^acgtnACGTN]]", "N")


def uncalled_bases(sequence: Column) -> Column:
    """Number of ``n``, ``N`` and ``-``."""
    return F.length(sequence) - F.length(F.translate(sequence, "nN-", ""))


def autosome_or_sex_name(contig: Column) -> Column:
    """Number, ``X`` or ``Y``, with or without a ``chr`` prefix; null for other contigs."""
    name = F.upper(F.regexp_extract(contig, r"^(?i)(?:chr)?([0-9]+|x|y)$", 1))
    return F.when(name != "", name)


def is_autosome(contig: Column) -> Column:
    return F.coalesce(autosome_or_sex_name(contig).rlike("^[0-9]+$"), F.lit(False))


def panel_alleles(codes: Column) -> Column:
    """Alleles of a string with one code per sample: two per sample, ``N`` is missing.

    Codes for more than two bases are not bi-allelic and fail.
    """
    letters = F.filter(F.split(codes, ""), lambda it: (it != "N") & (it != ""))

    def pair(code: Column) -> Column:
        bases = decode_genotype(code)
        return (
            F.when(F.length(bases) == 1, F.array(bases, bases))
            .when(F.length(bases) == 2, F.array(F.substring(bases, 1, 1), F.substring(bases, 2, 1)))
            .otherwise(
                F.raise_error(F.concat(F.lit("not bi-allelic: "), code)).cast("array<string>")
            )
        )

    return F.flatten(F.transform(letters, pair))


def is_transition(alleles: Column) -> Column:
    """True if the set of alleles is exactly {A, G} or {C, T}."""
    return F.array_join(F.array_sort(F.array_distinct(alleles)), "").isin("AG", "CT")


def sex_code(sex: Column) -> Column:
    """MALE, FEMALE, NA as 1, 2, 0."""
    upper = F.upper(sex)
    return F.when(upper == "MALE", 1).when(upper == "FEMALE", 2).when(upper == "NA", 0)


def group_label(names: Column) -> Column:
    """Sorted names joined by `` / ``."""
    return F.array_join(F.array_sort(names), " / ")


def fragments(text: Column, size: int, fill: str | None = None) -> Column:
    """Array of pieces of ``size`` characters; the last one is filled up if ``fill`` is given."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return pieces if fill is None else F.transform(pieces, lambda it: F.rpad(it, size, fill))
