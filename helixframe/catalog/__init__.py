"""Named queries over the test tables, each with its SQL counterpart."""

from helixframe.catalog import alignments, duplicates, files, mates, panels, sequences, tables  # noqa: F401
from helixframe.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
