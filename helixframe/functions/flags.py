"""The bits of the alignment FLAG field and predicates on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FLAG bits of the SAM specification
PAIRED = 0x1
PROPER_PAIR = 0x2
UNMAPPED = 0x4
MATE_UNMAPPED = 0x8
REVERSE = 0x10
MATE_REVERSE = 0x20
MATE_1 = 0x40
MATE_2 = 0x80
SECONDARY = 0x100
QC_FAIL = 0x200
DUPLICATE = 0x400
SUPPLEMENTARY = 0x800

#: Bits that only have a meaning for paired reads.
PAIR_ONLY = PROPER_PAIR | MATE_UNMAPPED | MATE_REVERSE | MATE_1 | MATE_2
#: Records ignored by coverage, depths and panel sampling.
DEFAULT_EXCLUDED = SUPPLEMENTARY | DUPLICATE | QC_FAIL | SECONDARY | UNMAPPED
#: Records ignored by the duplicated-input check.
NOT_PRIMARY_ALIGNED = UNMAPPED | SECONDARY | SUPPLEMENTARY
#: Records that never take part in duplicate marking of merged reads.
NOT_COLLAPSIBLE = PAIRED | UNMAPPED | SECONDARY | QC_FAIL | SUPPLEMENTARY


def has_any(flag: Column | str, mask: int) -> Column:
    """True if at least one bit of ``mask`` is set."""
    column = F.col(flag) if isinstance(flag, str) else flag
    return column.bitwiseAND(F.lit(mask)) != 0


def has_none(flag: Column | str, mask: int) -> Column:
    """True if no bit of ``mask`` is set."""
    return ~has_any(flag, mask)


def clear(flag: Column, mask: int) -> Column:
    """``flag`` with the bits of ``mask`` cleared."""
    return flag.bitwiseAND(F.lit(~mask))


def mate_number(flag: Column | str = "flag") -> Column:
    """1 or 2 for a mate of a pair; null if unpaired, or if both or neither bit is set."""
    first, last = has_any(flag, MATE_1), has_any(flag, MATE_2)
    return F.when(
        has_any(flag, PAIRED) & (first != last),
        F.when(first, F.lit(1)).otherwise(F.lit(2)),
    )


def read_type(flag: Column | str = "flag") -> Column:
    """Label used in the duplicate report."""
    return (
        F.when(has_any(flag, PAIRED) & has_any(flag, MATE_1), "first mate")
        .when(has_any(flag, PAIRED) & has_any(flag, MATE_2), "second mate")
        .otherwise("single read")
    )
