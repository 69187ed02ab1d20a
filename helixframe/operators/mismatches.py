"""Edit distances and mismatching positions of alignments against their reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.functions import flags as fl
from helixframe.plans.skew import skew_join

#: Reference bases per row of the join.
WIDTH = 1024
#: Rows of the reference up to which it may be broadcast: 32 MB of bases.
BROADCAST_CHUNKS = 1 << 15
# Fixed value: aligned bases and deletions are what an MD tag describes
_DESCRIBED = (*C.ALIGNED, *C.DELETION)
# Fixed value: what ends a mismatch, or the bases of a deletion, in the text made by ``_compared``
_END = "\n"


def _described_spans(pos: Column, cigar: Column) -> Column:
    """Reference spans ``(from, to)`` of the aligned and deleted bases; skipped ones are left out."""
    empty = F.array().cast("array<struct<from:bigint,to:bigint>>")

    def step(acc: Column, it: Column) -> Column:
        end = (acc["at"] + F.when(it["op"].isin(*C.CONSUMES_REFERENCE), it["len"]).otherwise(0)).cast("long")
        span = F.array(F.struct(acc["at"].alias("from"), end.alias("to")))
        return F.struct(
            end.alias("at"),
            F.when(it["op"].isin(*_DESCRIBED), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    start = F.struct(pos.cast("long").alias("at"), empty.alias("spans"))
    return F.aggregate(cigar, start, step, lambda acc: acc["spans"])


def reference_bases(alignments: DataFrame, reference: DataFrame, width: int = WIDTH) -> DataFrame:
    """(read_id, bases): the reference under the aligned and deleted bases of every mapped record.

    Spans and reference meet in chunks of ``width`` bases, and only the bases in question leave the
    join. Bases that ``reference`` doesn't hold are missing.
    """
    mapped = alignments.where(fl.has_none("flag", fl.UNMAPPED) & F.col("cigar").isNotNull())
    spans = mapped.select("read_id", "contig", F.inline(_described_spans(F.col("pos"), F.col("cigar"))))

    def chunks(start: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / width), F.floor((end - 1) / width)))

    asked = spans.where("from < to").withColumn("chunk", chunks(F.col("from"), F.col("to")))
    end = F.col("start") + F.length("sequence")
    held = (
        reference.where(F.length("sequence") > 0)
        .select("contig", "start", "sequence", chunks(F.col("start"), end).alias("chunk"))
        .withColumn("_first", F.greatest("start", F.col("chunk") * width).cast("long"))
        .select(
            "contig",
            "chunk",
            "_first",
            F.substring("sequence", (F.col("_first") - F.col("start") + 1).cast("int"),
                        ((F.col("chunk") + 1) * width - F.col("_first")).cast("int")).alias("_held"),
        )
    )
    low = F.greatest("from", "_first", F.col("chunk") * width)
    high = F.least("to", F.col("_first") + F.length("_held"), (F.col("chunk") + 1) * width)
    parts = (
        skew_join(asked, held, ["contig", "chunk"], salt_by=["read_id"], max_rows=BROADCAST_CHUNKS)
        .withColumns({"_low": low, "_high": high})
        .where("_low < _high")
        .select(
            "read_id",
            F.col("_low").alias("at"),
            F.substring("_held", (F.col("_low") - F.col("_first") + 1).cast("int"),
                        (F.col("_high") - F.col("_low")).cast("int")).alias("part"),
        )
    )
    ordered = F.array_sort(F.collect_list(F.struct("at", "part")))
    joined = F.array_join(F.transform(ordered, lambda it: it["part"]), "")
    return parts.groupBy("read_id").agg(F.upper(joined).alias("bases"))


def _compared(cigar: Column, query: Column, bases: Column) -> Column:
    """``=`` per match, the reference base per mismatch, and ``^bases`` per deletion; the latter two end in ``_END``.

    ``query`` holds bases that match nothing as something else than bases.
    """

    def step(acc: Column, it: Column) -> Column:
        op, num = it["op"], it["len"]
        theirs = F.slice(bases, acc["r"] + 1, num)
        pairs = F.zip_with(
            F.slice(query, acc["q"] + 1, num),
            theirs,
            lambda a, b: F.when((a == b) | (a == "="), "=").otherwise(F.concat(b, F.lit(_END))),
        )
        text = F.when(op.isin(*C.ALIGNED), F.array_join(pairs, "")).when(
            op.isin(*C.DELETION) & (num > 0), F.concat(F.lit("^"), F.array_join(theirs, ""), F.lit(_END))
        )
        return F.struct(
            (acc["q"] + F.when(op.isin(*C.CONSUMES_QUERY), num).otherwise(0)).alias("q"),
            (acc["r"] + F.when(op.isin(*_DESCRIBED), num).otherwise(0)).alias("r"),
            F.concat(acc["text"], F.coalesce(text, F.lit(""))).alias("text"),
        )

    start = F.struct(F.lit(0).alias("q"), F.lit(0).alias("r"), F.lit("").alias("text"))
    return F.aggregate(cigar, start, step, lambda acc: acc["text"])


def set_mismatch_tags(alignments: DataFrame, reference: DataFrame, width: int = WIDTH) -> DataFrame:
    """Set the tags ``NM`` (mismatches, inserted and deleted bases) and ``MD`` of every record.

    ``reference`` holds (contig, start, sequence) in rows of any length that don't overlap. ``N``
    matches nothing. Records that are unmapped, have no bases, or lie on bases that the reference
    doesn't hold have neither tag.
    """
    cigar = F.col("cigar")
    joined = alignments.join(reference_bases(alignments, reference, width), "read_id", "left")
    whole = F.length("bases") == C.total_length(cigar, _DESCRIBED)
    known = whole & (F.length("seq") == C.query_length(cigar))
    query = F.translate(F.upper("seq"), "N", "\x01")
    compared = joined.withColumns(
        {"_query": F.split(query, ""), "_bases": F.split("bases", "")}
    ).withColumn("_text", F.when(known, _compared(cigar, F.col("_query"), F.col("_bases"))))

    # Every part but the last is a run of matches, which may be empty, and the edit after it
    parts = F.split("_text", _END)

    def counted(part: Column) -> Column:
        edit = F.ltrim(part, F.lit("="))
        return F.concat((F.length(part) - F.length(edit)).cast("string"), edit)

    md = F.array_join(F.transform(parts, counted), "")
    deletions = F.size(F.filter(cigar, lambda it: it["op"].isin(*C.DELETION) & (it["len"] > 0)))
    changed = F.size(parts) - 1 - deletions
    nm = changed + C.total_length(cigar, (*C.INSERTION, *C.DELETION))

    def tag(name: str, kind: str, value: Column) -> Column:
        return F.create_map(F.lit(name), F.struct(F.lit(kind).alias("type"), value.cast("string").alias("value")))

    others = F.map_filter("tags", lambda name, _: ~name.isin("NM", "MD"))
    both = F.map_concat(others, tag("NM", "i", nm), tag("MD", "Z", md))
    tags = F.when(F.col("_text").isNotNull(), both).otherwise(others)
    return compared.withColumn("tags", tags).select(*alignments.columns)
