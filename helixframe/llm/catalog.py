"""All queries of this subpackage; importing the modules registers them."""

from helixframe.llm import (  # noqa: F401
    centroids,
    collocations,
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
    warc,
)
from helixframe.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
