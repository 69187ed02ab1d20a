"""Mixing sources to target weights by Pareto order sampling.

The words of the mix are shared among the sources by weight; no target exceeds ``MOST_COPIES``
times the words of its source, and what is above goes to the other sources by weight. A target of
2.4 times its source means two certain copies of every document, and a third one with an inclusion
probability of 0.4. For the latter, documents are ranked by the odds of a random number divided by
the odds of their inclusion, and the first ones are taken until their words fill the target. The
sample has a fixed size: a source is off its target by half a document at most.

The random number is a hash of the row, so reruns agree under any partitioning. The place where the
words of a source reach its target is found by two histograms, so that no source is ever sorted in
one task: only the rows of one of 2**20 slots are.

Null texts have no words. Documents without words are taken with no words. Null is a source of its
own and comes last. Repeated rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import WORD, bounded_broadcast, checkpointed, filled, read
from helixframe.llm.queries import query

#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
#: Most words taken of a document or source, in multiples of its own.
MOST_COPIES = 3
SEED = 17
#: Slots of a histogram; the second one splits a slot of the first.
SLOTS = 1024


def source_key(source: str = "source") -> Column:
    """A key without nulls, for joins."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source of ``sizes`` (source, size): its words, weight and target.

    Sources that reach their limit are those with the least limit per weight; what they leave is
    shared by weight. The table has a row per source and is ordered in one task.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    position = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (position % len(WEIGHTS)) + 1)
    rows = sources.withColumn("rank", position).withColumn("weight", weight.cast("long"))

    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    limit = F.col("source_size") * MOST_COPIES
    by_limit = Window.orderBy(limit / F.col("weight"), "rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "left_words": F.sum("source_size").over(everything)
            - F.coalesce(F.sum(limit).over(before), F.lit(0)),
            "left_weight": F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    level = F.col("left_words") / F.col("left_weight")
    rows = rows.withColumn("level", level).withColumn(
        "limited", limit / F.col("weight") < F.col("level")
    )
    shared = F.max(F.when(~F.col("limited"), F.col("level"))).over(everything)
    target = F.when(F.col("limited"), limit.cast("double")).otherwise(F.col("weight") * shared)
    return rows.select("source", "source_size", "weight", target.alias("target"))


def _cut(rows: DataFrame, slot: str, start: str) -> DataFrame:
    """Per source the slot in which its words, summed by slots, pass the ``extra`` ones wanted."""
    window = Window.partitionBy("key").orderBy(slot)
    total = (
        rows.groupBy("key", "extra", start, slot)
        .agg(F.sum("size").alias("words"))
        .withColumn("end", F.col(start) + F.sum("words").over(window))
    )
    return (
        total.where("extra < end")
        .groupBy("key")
        .agg(F.min(slot).alias("cut"), F.min(F.col("end") - F.col("words")).alias("before"))
    )


def measured(docs: DataFrame, *payload: Column) -> DataFrame:
    """Per document its source, number of words and random number, besides the ``payload``."""
    text = filled("text")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws("|", F.lit(str(SEED)), name, F.md5(text)))
    # 52 bits; never 0 or 1
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return docs.select(
        "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        uniform.alias("uniform"),
        *payload,
    )


def copies_to_take(sizes: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the target of their source and the number of ``copies`` to take of each.

    ``sizes`` are the measures of all documents, materialised; ``rows`` are the same ones with any
    further columns. Rows alike in random number and size are interchangeable.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = checkpointed(
        source_targets(sizes).select(
            source_key().alias("key"),
            "source_size",
            "target",
            F.floor(ratio).alias("whole"),
            (ratio - F.floor(ratio)).alias("inclusion"),
            (F.col("target") - F.floor(ratio) * F.col("source_size")).alias("extra"),
        )
    )

    def planned(table: DataFrame) -> DataFrame:
        slots = {
            "slot": F.floor(F.col("uniform") * SLOTS),
            "part": F.floor(F.col("uniform") * SLOTS * SLOTS),
            "zero": F.lit(0).cast("long"),
        }
        return table.withColumn("key", source_key()).join(bounded_broadcast(plan), "key").withColumns(slots)

    # Within a source the rank grows with the random number; slots are even in the latter
    all_sizes = planned(sizes)
    names = {"cut": "cut_slot", "before": "slot_start"}
    first = checkpointed(_cut(all_sizes, "slot", "zero").withColumnsRenamed(names))
    in_slot = all_sizes.join(bounded_broadcast(first), "key").where("slot = cut_slot")
    names = {"cut": "cut_part", "before": "part_start"}
    second = checkpointed(_cut(in_slot, "part", "slot_start").withColumnsRenamed(names))

    placed = planned(rows).join(bounded_broadcast(first), "key", "left")
    placed = placed.join(bounded_broadcast(second), "key", "left")
    # A source without a cut is taken whole: its words end where the target does
    sooner = F.col("cut_slot").isNull() | (F.col("slot") < F.col("cut_slot"))
    sooner = sooner | ((F.col("slot") == F.col("cut_slot")) & (F.col("part") < F.col("cut_part")))
    at_cut = F.coalesce(
        (F.col("slot") == F.col("cut_slot")) & (F.col("part") == F.col("cut_part")), F.lit(False)
    )
    odds = F.col("uniform") / (1 - F.col("uniform"))
    included = F.col("inclusion") / (1 - F.col("inclusion"))
    rank = F.when(F.col("inclusion") > 0, odds / included).otherwise(F.lit(float("inf")))
    order = Window.partitionBy("key").orderBy("rank", "uniform", "size")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("part_start")
    more = end - F.col("size") / 2 <= F.col("extra")

    settled = placed.where(~at_cut).withColumn("rank", rank).withColumn("more", sooner)
    at_the_cut = placed.where(at_cut).withColumn("rank", rank).withColumn("more", more)
    both = settled.unionByName(at_the_cut)
    copies = F.col("whole") + F.when(F.col("inclusion") > 0, F.col("more").cast("long")).otherwise(0)
    return both.select(*rows.columns, "source_size", "target", copies.alias("copies"))


def sample_mix(docs: DataFrame) -> DataFrame:
    """One row per document: its words, those of its source, the target, and the words taken."""
    sizes = checkpointed(measured(docs, F.col("doc_id")))
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return copies_to_take(sizes, sizes).select("doc_id", "size", "source_size", "target", taken)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    sizes = checkpointed(measured(docs))
    doc = F.struct(*(docs[name] for name in docs.columns)).alias("doc")
    rows = copies_to_take(sizes, measured(docs, doc))
    return rows.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


SQL = r"""
WITH RECURSIVE sizes AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           (('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' ||
             md5(coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS uniform
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight
    FROM sizes GROUP BY source
), reshared AS (
    SELECT source, source_size, weight, false AS limited,
           0 AS round FROM sources
    UNION ALL
    SELECT source, source_size, weight,
           limited OR weight * ((sum(source_size) OVER () -
               sum(CASE WHEN limited THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE /
               sum(CASE WHEN limited THEN 0 ELSE weight END) OVER ()::DOUBLE) > 3 * source_size,
           round + 1
    FROM reshared WHERE round < (SELECT count(*) FROM sources)
), targets AS (
    SELECT source, source_size,
           CASE WHEN limited THEN (3 * source_size)::DOUBLE
                ELSE weight * ((sum(source_size) OVER () -
                    sum(CASE WHEN limited THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE /
                    sum(CASE WHEN limited THEN 0 ELSE weight END) OVER ()::DOUBLE) END AS target
    FROM reshared WHERE round = (SELECT count(*) FROM sources)
), ranked AS (
    SELECT doc_id, size, source_size, target, floor(target / source_size)::BIGINT AS whole,
           target / source_size - floor(target / source_size) AS inclusion,
           sum(size) OVER (PARTITION BY s.source ORDER BY uniform, size
                           ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       coalesce((whole + CASE WHEN inclusion > 0 AND middle <= target - whole * source_size
                              THEN 1 ELSE 0 END) * size, 0)::BIGINT AS taken
FROM ranked
"""


@query("op6_source_mix", SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_mix(read(spark, sf_dir, "documents"))
