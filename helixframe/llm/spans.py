"""Cutting marked spans of bytes out of documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import ROW_KEY, with_row_key


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching spans, in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))
    return starts[new], ends[last]


def cut_documents(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per document the bytes that the ``spans`` (row key, start, end) leave, as (.., rest binary)."""
    listed = spans.groupBy(*ROW_KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = with_row_key(docs, "doc_id", "text").join(listed, ROW_KEY, "left").drop(*ROW_KEY)
    joined = joined.select(
        "doc_id",
        "text",
        F.col("spans.start").alias("starts"),
        F.col("spans.end").alias("ends"),
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, starts, ends in zip(batch["text"], batch["starts"], batch["ends"], strict=True):
                data = text.encode("utf-8", "replace")
                removed, count, rest = 0, 0, data
                if starts is not None:
                    starts, ends = merge_spans(np.array(starts, np.int64), np.array(ends, np.int64))
                    removed, count = int((ends - starts).sum()), len(starts)
                    edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(data)]
                    rest = b"".join(data[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                rows.append((len(data), removed, count, hashlib.sha256(rest).hexdigest()))
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pd.concat(
                [batch[["doc_id"]], pd.DataFrame(rows, columns=names, index=batch.index)], axis=1
            )

    schema = joined.select("doc_id").schema
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    return joined.mapInPandas(cut, schema.add("kept_sha256", "string"))
