"""Duplicate marking, and detection of reads included more than once.

None of the operators puts the reads of a group into one task. Groups are reduced to their winner
by aggregation, which combines on the map side, and the verdict returns to the records by a join
on ``read_id``, which is unique and therefore balanced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.functions import flags as fl
from helixframe.functions import hashing
from helixframe.functions.sequences import complexity
from helixframe.operators.alignments import tag_value
from helixframe.plans.session import cut_lineage
from helixframe.plans.skew import HOT_SHARE, fits_broadcast, skew_join

#: Base qualities below this do not count when the best of several pairs is chosen.
MIN_COUNTED_QUALITY = 15


#: Numbers are packed into one decimal digit by digit, so that packed ones are ordered like their parts.
ID_DIGITS = 19
COUNT_DIGITS, OPERATION_DIGITS = 12, 6
#: Steps of a quality, those of a seeded one.
QUALITY_STEPS = 1 << 32


def _packed(*parts: tuple[Column, int]) -> Column:
    """Non-negative whole numbers as one decimal, given the digits that each part has."""
    out = F.lit(0).cast("decimal(38,0)")
    for value, digits in parts:
        scale = F.lit("1" + "0" * digits).cast("decimal(38,0)")
        out = (out * scale + value.cast("decimal(38,0)")).cast("decimal(38,0)")
    return out


def _falling(value: Column, digits: int) -> Column:
    """Whole numbers in reverse order."""
    return F.lit("9" * digits).cast("decimal(38,0)") - value.cast("decimal(38,0)")


def _unpacked_id(packed: Column) -> Column:
    """The id in the last digits of a packed number."""
    return (packed % F.lit("1" + "0" * ID_DIGITS).cast("decimal(38,0)")).cast("long")


def _unpacked_falling_id(packed: Column) -> Column:
    rest = packed % F.lit("1" + "0" * ID_DIGITS).cast("decimal(38,0)")
    return _falling(rest, ID_DIGITS).cast("long")


def _apply_verdict(alignments: DataFrame, eligible: Column, keep: DataFrame) -> DataFrame:
    """Set the duplicate bit of eligible records that are not in ``keep`` (read_id, copies)."""
    joined = skew_join(alignments, keep, ["read_id"], "left", salt_by=["read_id"])
    kept = F.col("copies").isNotNull()
    marked = (
        F.when(eligible & kept, fl.clear(F.col("flag"), fl.DUPLICATE))
        .when(eligible, F.col("flag").bitwiseOR(F.lit(fl.DUPLICATE)))
        .otherwise(F.col("flag"))
    )
    return joined.withColumn("flag", marked)


def copy_numbers(
    alignments: DataFrame, by: Sequence[str] = (), seed: int = 0
) -> DataFrame:
    """The read to keep of every group of copies: ``(read_id, copies)``.

    Copies are merged reads with the same contig, strand and unclipped start and end. Of their
    CIGARs, those with most reads and then fewest operations are considered; the read with the
    highest base quality wins, and on ties the one whose CIGAR, and then the read itself, comes
    first. ``copies`` is the size of the group plus the copy numbers already recorded in its
    ``XP`` tags, and 1 for a read without copies. Missing qualities get a seeded value in (-1, 0].

    What decides is packed into decimals, which aggregate in hash tables: a CIGAR into its reads,
    length and best quality, and among those alike in that the one seen first.
    """
    cigar, pos = F.col("cigar"), F.col("pos")
    recorded = tag_value("XP", "i").cast("long")
    guess = F.when(F.col("quals").isNull(), -hashing.uniform(seed, F.col("read_id")))
    quality = F.coalesce(C.aligned_quality(cigar, F.col("quals")).cast("double"), guess)
    reads = alignments.where(_collapsible()).select(
        *by,
        "read_id",
        "contig",
        fl.has_any("flag", fl.REVERSE).alias("reverse"),
        C.unclipped_start(pos, cigar).alias("first"),
        C.unclipped_end(pos, cigar).alias("last"),
        "cigar",
        F.coalesce(recorded, F.lit(0)).alias("xp"),
        ((quality + 1) * QUALITY_STEPS).cast("long").alias("quality"),
    )
    key = [*by, "contig", "reverse", "first", "last"]
    falling_id = _falling(F.col("read_id"), ID_DIGITS)
    per_cigar = reads.groupBy(*key, "cigar").agg(
        F.count("*").alias("n"),
        F.sum("xp").alias("xp"),
        F.min("read_id").alias("seen"),
        F.max("quality").alias("quality"),
        F.max(_packed((F.col("quality"), ID_DIGITS), (falling_id, ID_DIGITS))).alias("best"),
    )
    rank = _packed(
        (F.col("n"), COUNT_DIGITS),
        (_falling(F.size("cigar"), OPERATION_DIGITS), OPERATION_DIGITS),
        (F.col("quality"), ID_DIGITS),
    )
    own = _packed((F.col("seen"), ID_DIGITS), (_unpacked_falling_id(F.col("best")), ID_DIGITS))
    # Of CIGARs alike the one seen first, then of all the highest: nothing is sorted
    per_rank = (
        per_cigar.select(*key, "n", "xp", rank.alias("rank"), own.alias("own"))
        .groupBy(*key, "rank")
        .agg(F.sum("n").alias("n"), F.sum("xp").alias("xp"), F.min("own").alias("own"))
    )
    per_key = per_rank.groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum("xp").alias("xp"), F.max_by("own", "rank").alias("winner")
    )
    return per_key.select(
        _unpacked_id(F.col("winner")).alias("read_id"),
        F.when(F.col("n") == 1, 1).otherwise(F.col("n") + F.col("xp")).cast("long").alias("copies"),
    )


def _collapsible() -> Column:
    return fl.has_none("flag", fl.NOT_COLLAPSIBLE) & F.col("cigar").isNotNull()


def mark_duplicates_collapsed(
    alignments: DataFrame, by: Sequence[str] = (), seed: int = 0
) -> DataFrame:
    """Flag all but the best copy of merged reads, and record the copy number in its ``XP`` tag.

    Paired, unmapped, secondary, supplementary and QC-failed records pass through unchanged.
    """
    marked = _apply_verdict(alignments, _collapsible(), copy_numbers(alignments, by, seed))
    tag = F.struct(F.lit("i").alias("type"), F.col("copies").cast("string").alias("value"))
    tagged = F.map_concat(
        F.map_filter("tags", lambda name, _: name != "XP"), F.create_map(F.lit("XP"), tag)
    )
    return marked.withColumn(
        "tags", F.when(F.col("copies").isNotNull(), tagged).otherwise(F.col("tags"))
    ).drop("copies")


def remove_duplicates(alignments: DataFrame) -> DataFrame:
    """Drop flagged records, except for unmapped ones without a position."""
    trailing = (
        fl.has_any("flag", fl.UNMAPPED) & F.col("contig").isNull() & (F.col("pos") == -1)
    )
    return alignments.where(fl.has_none("flag", fl.DUPLICATE) | trailing)


def mark_duplicates_paired(alignments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Flag duplicates among unmerged reads.

    Templates with exactly one first and one second mate are pairs, and compared by the unclipped
    5' ends and strands of both mates; other reads are compared by their own 5' end and strand,
    and lose against a pair with a mate there. The highest sum of base qualities wins, on ties the
    first read. Contigs are compared by a 64-bit hash of their names.
    """
    excluded = fl.UNMAPPED | fl.SECONDARY | fl.SUPPLEMENTARY | fl.QC_FAIL
    eligible = fl.has_none("flag", excluded) & F.col("cigar").isNotNull()
    cigar, pos, reverse = F.col("cigar"), F.col("pos"), fl.has_any("flag", fl.REVERSE)
    five_prime = F.when(reverse, C.unclipped_end(pos, cigar)).otherwise(
        C.unclipped_start(pos, cigar)
    )
    counted = F.filter("quals", lambda it: it >= MIN_COUNTED_QUALITY)
    quality = F.aggregate(counted, F.lit(0).cast("long"), lambda acc, it: acc + it)
    ends = alignments.where(eligible).select(
        *by,
        "read_id",
        "qname",
        fl.mate_number().alias("mate"),
        F.xxhash64("contig").alias("contig"),
        (five_prime.cast("long") * 2 + reverse.cast("long")).alias("end"),
        F.coalesce(quality, F.lit(0)).alias("quality"),
    )

    def of_mate(mate: int, column: str) -> Column:
        return F.max(F.when(F.col("mate") == mate, F.col(column)))

    def place(mate: str) -> Column:
        return F.struct(F.col(f"{mate}_contig").alias("contig"), F.col(f"{mate}_end").alias("end"))

    best = _packed(
        (F.col("quality"), ID_DIGITS), (_falling(F.col("early"), ID_DIGITS), ID_DIGITS)
    )
    pairs = (
        ends.where(F.col("mate").isNotNull())
        .groupBy(*by, "qname")
        .agg(
            F.count_if(F.col("mate") == 1).alias("n_first"),
            F.count_if(F.col("mate") == 2).alias("n_second"),
            *(
                of_mate(number, column).alias(f"{mate}_{name}")
                for number, mate in ((1, "first"), (2, "second"))
                for column, name in (("read_id", "id"), ("contig", "contig"), ("end", "end"))
            ),
            F.sum("quality").alias("quality"),
        )
        .where((F.col("n_first") == 1) & (F.col("n_second") == 1))
        .withColumns(
            {
                "low": F.least(place("first"), place("second")),
                "high": F.greatest(place("first"), place("second")),
                "early": F.least("first_id", "second_id"),
            }
        )
        .withColumn("best", best)
    )
    # Ids are unique, and so is what decides
    best_pairs = (
        pairs.groupBy(*by, "low", "high")
        .agg(*(F.max_by(name, "best").alias(name) for name in ("first_id", "second_id")))
        .select(F.explode(F.array("first_id", "second_id")).alias("read_id"))
    )
    in_pairs = pairs.select(F.explode(F.array("first_id", "second_id")).alias("read_id"))
    place_columns = [F.col("end.contig").alias("contig"), F.col("end.end").alias("end")]
    pair_ends = pairs.select(*by, F.explode(F.array("low", "high")).alias("end"))
    pair_ends = pair_ends.select(*by, *place_columns).distinct()
    single = _packed((F.col("quality"), ID_DIGITS), (_falling(F.col("read_id"), ID_DIGITS), ID_DIGITS))
    best_singles = (
        ends.join(in_pairs, "read_id", "left_anti")
        .groupBy(*by, "contig", "end")
        .agg(F.max(single).alias("best"))
        .join(pair_ends, [*by, "contig", "end"], "left_anti")
        .select(_unpacked_falling_id(F.col("best")).alias("read_id"))
    )
    keep = best_pairs.unionByName(best_singles).withColumn("copies", F.lit(1))
    return _apply_verdict(alignments, eligible, keep).drop("copies")


def dedup_library(alignments: DataFrame, seed: int = 0) -> DataFrame:
    """Mark duplicates per library: merged reads and unmerged reads each by their own rule.

    ``alignments`` must have a ``library`` column.
    """
    merged = F.col("qname").startswith("M_") | F.col("qname").startswith("MT_")
    return mark_duplicates_collapsed(alignments.where(merged), ["library"], seed).unionByName(
        mark_duplicates_paired(alignments.where(~merged), ["library"])
    )


def _content_key(any_query_name: bool) -> Column:
    """Digest of what must agree for two records to be the same data.

    Sequence and qualities are long and the shuffle carries only the digest. Missing qualities
    equal each other.
    """
    quals = F.coalesce(F.col("quals").cast("string"), F.lit("*"))
    fields = [
        F.coalesce("contig", F.lit("*")),
        F.col("pos").cast("string"),
        fl.has_any("flag", fl.REVERSE).cast("string"),
        F.col("seq"),
        quals,
    ]
    if not any_query_name:
        fields.insert(0, F.col("qname"))
    return F.sha2(F.concat_ws("\t", *fields), 256)


def duplicate_read_groups(
    alignments: DataFrame, any_query_name: bool = False, min_complexity: float = 0
) -> DataFrame:
    """Groups of two or more identical records: ``(content, first_read, n_reads, n_complex)``.

    Identical means the same position, strand, sequence, qualities and, unless switched off, name.
    ``n_complex`` counts the reads with enough homopolymer runs.
    """
    reads = alignments.where(
        fl.has_none("flag", fl.NOT_PRIMARY_ALIGNED) & (F.length("seq") > 0)
    ).select(
        "read_id",
        F.unhex(_content_key(any_query_name)).alias("content"),
        (complexity(F.col("seq")) >= min_complexity).alias("complex"),
    )
    return (
        reads.groupBy("content")
        .agg(
            F.min("read_id").alias("first_read"),
            F.count("*").alias("n_reads"),
            F.count_if("complex").alias("n_complex"),
        )
        .where(F.col("n_reads") > 1)
        .withColumn("content", F.lower(F.hex("content")))
    )


def min_complexity_filter(alignments: DataFrame, min_complexity: float) -> DataFrame:
    """Keep records with enough homopolymer runs."""
    return alignments.where(complexity(F.col("seq")) >= min_complexity)


def duplicate_totals(groups: DataFrame) -> DataFrame:
    """Number of groups, and of groups left after the complexity filter."""
    return groups.agg(
        F.count("*").alias("total"), F.count_if(F.col("n_complex") > 0).alias("filtered")
    )


def limit_report(groups: DataFrame, max_output: int = 0) -> DataFrame:
    """Groups that pass the complexity filter: all of them, or the first ``max_output``."""
    shown = groups.where(F.col("n_complex") > 0)
    return shown.orderBy("first_read").limit(max_output) if max_output else shown


def duplicate_report(
    alignments: DataFrame,
    readgroups: DataFrame,
    groups: DataFrame,
    any_query_name: bool = False,
) -> DataFrame:
    """Rows that describe the records of the given groups.

    Unknown sample, library and unit are ``?``. Records meet their group by the first 128 bits of the digest. Each
    is shuffled once at most, its qualities as text; those of hot groups, which are few, are not shuffled.
    """
    found = cut_lineage(
        groups.select(_short_key(F.col("content")).alias("_key"), "first_read", F.col("n_reads").alias("_n"))
    )
    quality = F.array_join(F.transform("quals", lambda it: F.chr(it + 33)), "")
    members = alignments.where(
        fl.has_none("flag", fl.NOT_PRIMARY_ALIGNED) & (F.length("seq") > 0)
    ).select(
        _short_key(_content_key(any_query_name)).alias("_key"),
        "read_id",
        "contig",
        "pos",
        "flag",
        "qname",
        "seq",
        quality.alias("qualities"),
        "rg",
    )
    known = readgroups.select("rg", "sample", "library", "platform_unit")
    rows = _with_first_reads(members, found)
    rows = skew_join(rows, known, ["rg"], "left", salt_by=["read_id"])

    return rows.select(
        "first_read",
        "read_id",
        "contig",
        "pos",
        fl.read_type().alias("read_type"),
        *(
            F.coalesce(name, F.lit("?")).alias(name)
            for name in ("sample", "library", "platform_unit")
        ),
        "qname",
        F.col("seq").alias("sequence"),
        "qualities",
    )


def _short_key(digest: Column) -> Column:
    """The first 128 bits of a digest in hexadecimal digits."""
    return F.unhex(F.substring(digest, 1, 32))


def _with_first_reads(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Records that have one of the materialised ``groups`` (_key, first_read, _n), with its first read.

    The sizes of the groups tell which are hot. There are at most ``HOT_SHARE`` of these, which are broadcast;
    their records go to any task, with a key that no group has.
    """
    reads = groups.select("_key", "first_read")
    if fits_broadcast(reads):
        return members.join(F.broadcast(reads), "_key").drop("_key")
    total = groups.agg(F.sum("_n")).first()[0]
    keys = groups.where(F.col("_n") * HOT_SHARE >= total).select("_key").distinct()
    hot = reads.join(F.broadcast(keys), "_key", "left_semi").withColumnRenamed("first_read", "_hot")
    spread = F.when(F.col("_hot").isNull(), F.col("_key")).otherwise(F.unhex(F.hex(F.xxhash64("read_id"))))
    members = members.join(F.broadcast(hot), "_key", "left").withColumn("_key", spread)
    return (
        members.join(reads, "_key", "left")
        .withColumn("first_read", F.coalesce("_hot", "first_read"))
        .where("first_read IS NOT NULL")
        .drop("_key", "_hot")
    )
