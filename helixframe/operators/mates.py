"""Mate fields of paired records, brought in line with the mates themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import cigar as C
from helixframe.functions import flags as fl


def _mates(alignments: DataFrame, by: Sequence[str]) -> DataFrame:
    """(read_id, mate) of the primary records whose template has one first and one second mate.

    Templates are aggregated to two fixed-size structs, and ids are unique: neither step gathers
    the records of a name that many of them share.
    """
    cigar, reverse = F.col("cigar"), fl.has_any("flag", fl.REVERSE)
    end = F.col("pos") + C.reference_length(cigar)
    mapped = fl.has_none("flag", fl.UNMAPPED)
    record = F.struct(
        "read_id",
        mapped.alias("mapped"),
        reverse.alias("reverse"),
        "contig",
        "pos",
        F.when(reverse, end).otherwise(F.col("pos")).cast("long").alias("five_prime"),
        "mapq",
        C.format_cigar(cigar).alias("cigar"),
    )
    number = fl.mate_number()
    primary = alignments.where(fl.has_none("flag", fl.SECONDARY | fl.SUPPLEMENTARY))
    records = primary.where(number.isNotNull()).select(
        *by, "qname", number.alias("number"), record.alias("record")
    )

    def of(mate: int) -> list[Column]:
        own = F.col("number") == mate
        return [F.count_if(own).alias(f"n{mate}"), F.max(F.when(own, F.col("record"))).alias(f"mate{mate}")]

    pairs = records.groupBy(*by, "qname").agg(*of(1), *of(2)).where("n1 = 1 AND n2 = 1")
    both = F.array(
        F.struct(F.col("mate1.read_id").alias("read_id"), F.col("mate1").alias("_own"), F.col("mate2").alias("_mate")),
        F.struct(F.col("mate2.read_id").alias("read_id"), F.col("mate2").alias("_own"), F.col("mate1").alias("_mate")),
    )
    return pairs.select(F.inline(both))


def fix_mates(alignments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Set the mate fields of primary paired records from their mates.

    Mate position and strand, the bit of an unmapped mate, the template length (between the 5' ends
    of mapped mates on one contig, else 0) and the tags ``MC`` and ``MQ`` are taken from the mate. An
    unmapped record is placed at its mapped mate. Records stay properly paired only if the forward
    mate's 5' end does not come after the reverse one's. Records without a single mate lose what they
    said of it. Unpaired, secondary and supplementary records pass through unchanged.
    """
    fixable = fl.has_any("flag", fl.PAIRED) & fl.has_none("flag", fl.SECONDARY | fl.SUPPLEMENTARY)
    own, mate = F.col("_own"), F.col("_mate")
    found = mate.isNotNull()
    mate_maps = F.coalesce(mate["mapped"], F.lit(False))
    own_maps = F.coalesce(own["mapped"], F.lit(False))
    together = own_maps & mate_maps & F.coalesce(own["contig"] == mate["contig"], F.lit(False))
    ahead = mate["five_prime"] - own["five_prime"]
    facing = (own["reverse"] != mate["reverse"]) & F.when(own["reverse"], ahead <= 0).otherwise(ahead >= 0)
    proper = fl.has_any("flag", fl.PROPER_PAIR) & together & F.coalesce(facing, F.lit(False))

    def bit(mask: int, is_set: Column) -> Column:
        return F.when(is_set, mask).otherwise(0)

    changed = fl.PROPER_PAIR | fl.MATE_UNMAPPED | fl.MATE_REVERSE
    flag = (
        fl.clear(F.col("flag"), changed)
        .bitwiseOR(bit(fl.PROPER_PAIR, proper))
        .bitwiseOR(bit(fl.MATE_UNMAPPED, ~mate_maps))
        .bitwiseOR(bit(fl.MATE_REVERSE, F.coalesce(mate["reverse"], F.lit(False))))
    )
    # Where a record or its mate is, an unmapped one being where the mapped one is
    moved, mate_moved = found & ~own_maps & mate_maps, found & own_maps & ~mate_maps

    def tag(name: str, kind: str, value: Column) -> Column:
        entry = F.create_map(F.lit(name), F.struct(F.lit(kind).alias("type"), value.cast("string").alias("value")))
        return F.when(mate_maps, entry).otherwise(F.create_map().cast("map<string,struct<type:string,value:string>>"))

    others = F.map_filter("tags", lambda name, _: ~name.isin("MC", "MQ"))
    values = {
        "flag": flag,
        "contig": F.when(moved, mate["contig"]).otherwise(F.col("contig")),
        "pos": F.when(moved, mate["pos"]).otherwise(F.col("pos")),
        "mate_contig": F.when(mate_moved, own["contig"]).when(found, mate["contig"]),
        "mate_pos": F.when(mate_moved, own["pos"]).when(found, mate["pos"]).otherwise(F.lit(-1)),
        "tlen": F.when(together, ahead).otherwise(0).cast("int"),
        "tags": F.map_concat(others, tag("MC", "Z", mate["cigar"]), tag("MQ", "i", mate["mapq"])),
    }
    return (
        alignments.join(_mates(alignments, by), "read_id", "left")
        .withColumns({name: F.when(fixable, value).otherwise(F.col(name)) for name, value in values.items()})
        .drop("_own", "_mate")
    )
