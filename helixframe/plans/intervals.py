"""Interval joins and scans along positions, cut into fixed-width bins.

A contig may hold a third of all rows, so nothing here is partitioned by contig alone: work is
partitioned by (contig, bin), and rows at one position are aggregated before any window runs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.plans.skew import BROADCAST_ROWS, fits_broadcast, skew_join

#: Width of the bins of a scan along positions.
BIN_WIDTH = 1 << 14
#: Smallest bin width of an interval join; bins are 2**LEVEL_BITS times as wide with every level.
MIN_WIDTH = 1 << 7
LEVEL_BITS = 3
#: Bits of the longest contig that the levels are made for; longer intervals touch several bins.
CONTIG_BITS = 31
#: Rows up to which a side of an interval join is placed at all levels there may be.
SMALL_ROWS = 20_000


def _bin_of(position: Column | str, width: int) -> Column:
    """Bin of a position; widths are powers of two, so that this is a shift."""
    return F.shiftright(position, width.bit_length() - 1).cast("long")


def _bins(start: Column, end: Column, width: int) -> Column:
    """Bins touched by the half-open interval."""
    return F.sequence(_bin_of(start, width), _bin_of(F.greatest(end, start + 1) - 1, width))


def power_of_two(value: float) -> int:
    """Smallest power of two that is not less than ``value``."""
    return 1 << max(0, math.ceil(value) - 1).bit_length()


def _level_bits(width: int) -> list[int]:
    """Bits of the bin widths of all levels, from ``width`` on to more than a contig has."""
    first = width.bit_length() - 1
    return list(range(first, max(first, CONTIG_BITS) + LEVEL_BITS, LEVEL_BITS))


def _level_of(length: Column, bits: list[int]) -> Column:
    """The level with bins that are not shorter than the interval, or else the last one."""
    return sum(((length > (1 << it)).cast("int") for it in bits[:-1]), F.lit(0))


def _placed(rows: DataFrame, span: tuple[str, str], bits: list[int], top: int, own: str) -> DataFrame:
    """Rows in the bins they touch at their ``own`` level and at all those above, up to ``top``.

    A bin is at least as long as an interval that is placed in it, which so touches one or two.
    """
    start, end = F.col(span[0]), F.col(span[1])
    rows = rows.where(start < end).withColumn(own, _level_of(end - start, bits))
    level = F.explode(F.sequence(F.col(own), F.greatest(own, F.lit(top)))) if top else F.col(own)
    rows = rows.withColumn("_level", level)
    shift = (F.col("_level") * LEVEL_BITS + bits[0]).cast("int")
    first, last = (F.call_function("shiftright", it.cast("long"), shift) for it in (start, end - 1))
    return rows.withColumn("_bin", F.explode(F.sequence(first, last)))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    contig: str = "contig",
    width: int | None = None,
) -> DataFrame:
    """All pairs of overlapping half-open intervals of the same contig.

    Bins come in levels of growing width, and an interval belongs to the first level whose bins are not
    shorter than it is. A pair meets at the higher one of its two levels: either side is placed in the one or
    two bins that it touches at its own level, and at those above that the other side has. So a row
    makes a few rows, however long it is and however short the intervals it is compared with. A pair is
    emitted in the bin of its first shared base, hence once.

    ``right`` should be the side with fewer rows: it is broadcast if small, otherwise hot bins of ``left``
    are salted. The narrowest bins are fitted to the mean interval of ``right``, unless ``width`` (a power of
    two) is given. The column names of both sides must differ, except for ``contig``.
    """
    (l_start, l_end), (r_start, r_end) = left_span, right_span
    length = F.col(r_end) - F.col(r_start)
    found = right.agg(F.avg(length).alias("mean"), F.max(length).alias("longest")).first()
    bits = _level_bits(width or power_of_two(max(MIN_WIDTH, found["mean"] or 1)))

    def highest(longest: int | None) -> int:
        return sum((longest or 0) > (1 << it) for it in bits[:-1])

    # A small side is cheaply placed at all levels; for a large one it is worth to ask what there is
    small = fits_broadcast(right, SMALL_ROWS)
    top = len(bits) - 1
    if not small:
        top = highest(left.agg(F.max(F.col(l_end) - F.col(l_start))).first()[0])
    left = _placed(left, left_span, bits, highest(found["longest"]), "_left_level")
    right = _placed(right, right_span, bits, top, "_right_level")
    shift = (F.col("_level") * LEVEL_BITS + bits[0]).cast("int")
    condition = (
        (F.col("_level") == F.greatest("_left_level", "_right_level"))
        & (F.col(l_start) < F.col(r_end))
        & (F.col(r_start) < F.col(l_end))
        & (F.call_function("shiftright", F.greatest(l_start, r_start).cast("long"), shift) == F.col("_bin"))
    )
    # A small side has one or two rows at every level
    most = 2 * len(bits) * SMALL_ROWS if small else BROADCAST_ROWS
    joined = skew_join(left, right, [contig, "_level", "_bin"], "inner", condition, max_rows=most)
    return joined.drop("_level", "_bin", "_left_level", "_right_level")


def depth_runs(
    blocks: DataFrame,
    levels: Sequence[Sequence[str]],
    contig: str = "contig",
    span: tuple[str, str] = ("ref_start", "ref_end"),
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Runs of constant, non-zero depth of a set of intervals, at several grouping levels.

    ``levels`` lists groups of key columns; the runs of a level are those of all the intervals
    that agree on its keys. Other keys are set to ``*``. Output: all keys, contig, ``run_start``,
    ``run_end``, ``depth``.

    Intervals are cut at bin edges, so that every bin starts from depth zero and is swept on its
    own. The +1/-1 events are summed per position before the sweep: at most ``width`` rows per
    key and bin reach a window, however deep the pile-up.
    """
    start, end = span
    keys = list(dict.fromkeys(key for level in levels for key in level))
    edges = (
        blocks.where(F.col(start) < F.col(end))
        .select(
            *keys,
            contig,
            F.col(start).alias("_s"),
            F.col(end).alias("_e"),
            F.explode(_bins(F.col(start), F.col(end), width)).alias("_bin"),
        )
        .select(
            *keys,
            contig,
            "_bin",
            F.explode(
                F.array(
                    F.struct(
                        F.greatest("_s", F.col("_bin") * width).alias("pos"),
                        F.lit(1).alias("delta"),
                    ),
                    F.struct(
                        F.least("_e", (F.col("_bin") + 1) * width).alias("pos"),
                        F.lit(-1).alias("delta"),
                    ),
                )
            ).alias("_event"),
        )
        .select(*keys, contig, "_bin", "_event.pos", "_event.delta")
    )
    grouping = [contig, "_bin", "pos"]
    # Levels are built from sums per position, of which there are far fewer than reads
    finest = edges.groupBy(*keys, *grouping).agg(F.sum("delta").alias("delta"))
    events = (
        finest.groupingSets(
            [[*level, *grouping] for level in levels], *keys, *grouping
        )
        .agg(F.sum("delta").alias("delta"), *(F.grouping(key).alias(f"_g_{key}") for key in keys))
        .where(F.col("delta") != 0)
        .select(
            *(F.when(F.col(f"_g_{key}") == 1, "*").otherwise(F.col(key)).alias(key) for key in keys),
            *grouping,
            "delta",
        )
    )
    ordered = Window.partitionBy(*keys, contig, "_bin").orderBy("pos")
    return (
        events.withColumn("run_end", F.lead("pos").over(ordered))
        .withColumn(
            "depth",
            F.sum("delta").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .where((F.col("depth") > 0) & F.col("run_end").isNotNull())
        .select(*keys, contig, F.col("pos").alias("run_start"), "run_end", "depth")
    )


def running_before(
    rows: DataFrame,
    keys: Sequence[str],
    position: str,
    value: str,
    width: int,
    inclusive: bool = False,
) -> DataFrame:
    """Add ``_running``: the maximum of ``value`` over the rows at smaller positions.

    ``rows`` must have one row per (keys, position). The maximum within a bin comes from a window
    over that bin; what lies before the bin comes from a scan of one row per bin.
    """
    keys = list(keys)
    binned = rows.withColumn("_bin", _bin_of(position, width))
    per_bin = binned.groupBy(*keys, "_bin").agg(F.max(value).alias("_top"))
    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bin.select(*keys, "_bin", F.max("_top").over(earlier).alias("_carry"))
    last = 0 if inclusive else -1
    inside = (
        Window.partitionBy(*keys, "_bin")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, last)
    )
    return (
        binned.join(carry, [*keys, "_bin"], "left")
        .withColumn("_running", F.greatest("_carry", F.max(value).over(inside)))
        .drop("_bin", "_carry")
    )


def running_sums(
    rows: DataFrame, keys: Sequence[str], position: str, values: Sequence[str], width: int
) -> DataFrame:
    """Add ``_sum_*`` for each value: the sum over the rows up to and with this position.

    ``rows`` must have one row per (keys, position); keys may be null. What lies before a bin comes from a
    scan of one row per bin.
    """
    keys = list(keys)
    binned = rows.withColumn("_bin", _bin_of(position, width))
    per_bin = binned.groupBy(*keys, "_bin").agg(*(F.sum(it).alias(it) for it in values))
    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bin.select(
        *(F.col(it).alias(f"_key_{it}") for it in [*keys, "_bin"]),
        *(F.coalesce(F.sum(it).over(earlier), F.lit(0)).alias(f"_carry_{it}") for it in values),
    )
    inside = Window.partitionBy(*keys, "_bin").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    summed = binned.withColumns({f"_sum_{it}": F.sum(it).over(inside) for it in values})
    same = [F.col(it).eqNullSafe(F.col(f"_key_{it}")) for it in [*keys, "_bin"]]
    return summed.join(carry, same).select(
        *rows.columns, *((F.col(f"_sum_{it}") + F.col(f"_carry_{it}")).alias(f"_sum_{it}") for it in values)
    )


def islands(
    rows: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Coalesce overlapping or touching intervals: one row (keys, start, end) per island.

    An interval opens an island if it starts after the largest end seen before it. The island of
    an interval is then the last opening at or before its start.
    """
    keys = list(keys)
    spans = rows.groupBy(*keys, start).agg(F.max(end).alias(end))
    marked = running_before(spans, keys, start, end, width).select(
        *keys,
        start,
        end,
        F.when(
            F.col("_running").isNull() | (F.col(start) > F.col("_running")), F.col(start)
        ).alias("_opening"),
    )
    assigned = running_before(marked, keys, start, "_opening", width, inclusive=True)
    return (
        assigned.groupBy(*keys, F.col("_running").alias(start))
        .agg(F.max(end).alias(end))
    )


def lag_value(
    rows: DataFrame, keys: Sequence[str], position: str, value: str, width: int
) -> DataFrame:
    """Add ``_previous``: the value of the row before, in the order of a unique position.

    Like ``lag``, but the window runs per bin of ``width`` positions; the first row of a bin takes
    the last value of the bin before it from a scan of one row per bin.
    """
    keys = list(keys)
    binned = rows.withColumn("_bin", _bin_of(position, width))
    per_bin = binned.groupBy(*keys, "_bin").agg(F.max_by(value, position).alias("_last"))
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    carry = per_bin.select(*keys, "_bin", F.lag("_last").over(by_bin).alias("_carry"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(position)
    return (
        binned.join(carry, [*keys, "_bin"], "left")
        .withColumn("_previous", F.coalesce(F.lag(value).over(inside), F.col("_carry")))
        .drop("_bin", "_carry")
    )


def split_before(
    rows: DataFrame, keys: Sequence[str], position: str, predicate: Column, width: int
) -> DataFrame:
    """Add ``group``: the position of the last row at or before this one that starts a group.

    A row starts a group if it satisfies the predicate; rows before the first such row belong to
    the group null. Positions are unique.
    """
    marked = rows.withColumn("_start", F.when(predicate, F.col(position)))
    return (
        running_before(marked, keys, position, "_start", width, inclusive=True)
        .withColumnRenamed("_running", "group")
        .drop("_start")
    )
