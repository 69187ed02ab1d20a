"""Sequencing-shaped views of the test tables, for Spark and (as CTEs) for SQL.

The formulas are plain integer arithmetic, so both sides see the same rows; everything computed
from the views differs between the two sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPEAT = "ACGTTGCANC"
#: Qualities up to this many are cut from a literal.
_LONGEST = 360


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, as it is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Columns of the read views; {div} is the integer division of the dialect
_READ_PARTS = """
    (((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey) * 100
        + CAST(l_quantity AS BIGINT) AS read_id,
    concat(CASE WHEN l_linenumber % 3 = 0 THEN 'M_' ELSE '' END,
           'r', l_orderkey, '.', l_linenumber) AS qname,
    concat('chr', l_suppkey % 5 + 1) AS contig,
    CAST((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 9900 AS BIGINT) AS pos,
    CAST(10 + l_partkey % 20 AS INT) AS m1,
    CAST(l_linenumber % 2 AS INT) AS ins,
    CAST(l_suppkey % 3 AS INT) AS del,
    CAST(l_quantity AS INT) AS m2,
    CAST(l_linenumber % 4 AS INT) AS clip,
    CAST(l_partkey % 61 AS INT) AS mapq,
    CAST((l_orderkey % 700) - 100 AS INT) AS tlen,
    CAST(CASE (l_orderkey + l_linenumber) % 10
         WHEN 0 THEN 4
         WHEN 1 THEN 1024
         WHEN 2 THEN 65 + 2 * (l_linenumber % 2)
         WHEN 3 THEN 129 + 2 * (l_linenumber % 2)
         WHEN 4 THEN 16
         ELSE 0 END AS INT) AS flag,
    CASE WHEN l_partkey % 50 = 0 THEN NULL
         WHEN l_partkey % 50 = 1 THEN 'unknown'
         ELSE concat('SM_', l_linestatus, '/LB', l_linenumber % 3) END AS rg,
    CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE concat('chr', l_partkey % 6) END AS mate_contig,
    CASE WHEN l_partkey % 6 = 0 THEN -1 ELSE (l_partkey * 17) % 9900 END AS mate_pos,
    l_orderkey, l_partkey, l_suppkey, l_linenumber
"""

# Same records at few positions, so that many of them are copies
_DUP_PARTS = (
    _READ_PARTS.replace(
        "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 9900 AS BIGINT) AS pos",
        "((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 9900) {div} 50 * 50"
        " AS BIGINT) AS pos",
    )
    .replace("10 + l_partkey % 20 AS INT) AS m1", "20 AS INT) AS m1")
    .replace("l_quantity AS INT) AS m2", "20 + l_linenumber % 2 AS INT) AS m2")
)

# Mates share a name; positions are few, so that templates collide
_PAIR_PARTS = (
    _READ_PARTS.replace(
        "concat(CASE WHEN l_linenumber % 3 = 0 THEN 'M_' ELSE '' END,\n"
        "           'r', l_orderkey, '.', l_linenumber) AS qname",
        "concat('p', l_orderkey, '.', (l_linenumber + 1) {div} 2) AS qname",
    )
    .replace(
        "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 9900 AS BIGINT) AS pos",
        "(l_orderkey % 37) * 200 + (l_linenumber % 2) * 150 AS BIGINT) AS pos",
    )
    .replace("concat('chr', l_suppkey % 5 + 1) AS contig", "concat('chr', l_orderkey % 5 + 1) AS contig")
    .replace("10 + l_partkey % 20 AS INT) AS m1", "20 AS INT) AS m1")
    .replace("l_quantity AS INT) AS m2", "20 + l_partkey % 3 AS INT) AS m2")
    .replace(
        """CASE (l_orderkey + l_linenumber) % 10
         WHEN 0 THEN 4
         WHEN 1 THEN 1024
         WHEN 2 THEN 65 + 2 * (l_linenumber % 2)
         WHEN 3 THEN 129 + 2 * (l_linenumber % 2)
         WHEN 4 THEN 16
         ELSE 0 END""",
        """CASE WHEN l_orderkey % 7 = 0 THEN 16 * (l_partkey % 2)
         ELSE 1 + 64 * (2 - l_linenumber % 2) + 2 * (1 - l_orderkey % 11 {div} 10)
              + 16 * (l_partkey % 2)
              + 1024 * (CASE WHEN l_partkey % 40 = 0 THEN 1 ELSE 0 END) END""",
    )
)

# Records whose fields contradict their flags
_RAW_PARTS = _READ_PARTS.replace(
    "ELSE 0 END AS INT) AS flag",
    "ELSE 2 * (l_partkey % 2) END\n"
    "         + (CASE WHEN l_partkey % 11 = 0 THEN 8 ELSE 0 END)\n"
    "         + (CASE WHEN l_partkey % 13 = 0 THEN 256 ELSE 0 END)\n"
    "         + (CASE WHEN l_partkey % 17 = 0 THEN 512 ELSE 0 END)\n"
    "         + (CASE WHEN l_partkey % 19 = 0 THEN 2048 ELSE 0 END) AS INT) AS flag",
)

_VARIANTS = {
    "reads": _READ_PARTS,
    "dup_reads": _DUP_PARTS,
    "pair_reads": _PAIR_PARTS,
    "raw_reads": _RAW_PARTS,
}

#: Columns of the alignment schema, in order
ALIGNMENT_COLUMNS = [
    "read_id",
    "qname",
    "flag",
    "contig",
    "pos",
    "mapq",
    "cigar",
    "mate_contig",
    "mate_pos",
    "tlen",
    "seq",
    "quals",
    "tags",
    "rg",
]


def alignments(spark: SparkSession, sf_dir: str, variant: str = "reads") -> DataFrame:
    """Alignment records made from ``lineitem``."""
    parts = table(spark, sf_dir, "lineitem").selectExpr(
        *_split_columns(_VARIANTS[variant].format(div="div"))
    )
    names = ("clip", "m1", "ins", "del", "m2")
    codes = (4, 0, 1, 2, 0)
    operations = F.filter(
        F.array(
            *(
                F.struct(F.lit(code).alias("op"), F.col(name).alias("len"))
                for name, code in zip(names, codes, strict=True)
            )
        ),
        lambda it: it["len"] > 0,
    )
    query_length = F.col("clip") + F.col("m1") + F.col("ins") + F.col("m2")
    return parts.select(
        "*",
        operations.alias("cigar"),
        F.expr(f"substr(repeat('{REPEAT}', 12), 1 + cast(l_partkey % 10 as int), clip + m1 + ins + m2)").alias("seq"),
        F.when(
            F.col("l_partkey") % 97 != 0,
            _qualities(F.col("l_partkey"), query_length),
        ).alias("quals"),
        F.map_from_entries(
            F.filter(
                F.array(
                    _tag("RG", "Z", F.col("rg")),
                    _tag("MC", "Z", F.concat(F.col("m1").cast("string"), F.lit("M"))),
                    _tag(
                        "XP",
                        "i",
                        F.when(F.col("l_partkey") % 5 == 0, F.col("l_partkey") % 4).cast("string"),
                    ),
                ),
                lambda it: it["value"]["value"].isNotNull(),
            )
        ).alias("tags"),
    ).select(*ALIGNMENT_COLUMNS)


def _qualities(key: Column, length: Column) -> Column:
    """``2 + (key + 7 i) % 39`` for i from 1 to ``length``: a slice of the values in their period where it is in them."""
    values = F.lit([2 + k * 7 % 39 for k in range(_LONGEST + 40)])
    # 28 times 7 is 1 modulo 39
    place = (key % 39 * 28 % 39 + 2).cast("int")
    each = F.transform(F.sequence(F.lit(1), length), lambda it: (2 + (key + it * 7) % 39).cast("int"))
    return F.when((key >= 0) & length.between(1, _LONGEST), F.slice(values, place, length)).otherwise(each)


def _tag(name: str, kind: str, value):
    return F.struct(
        F.lit(name).alias("key"),
        F.struct(F.lit(kind).alias("type"), value.alias("value")).alias("value"),
    )


def _split_columns(text: str) -> list[str]:
    """Items of a select list, split at the commas outside of parentheses."""
    items, depth, current = [], 0, ""
    for char in text:
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            items.append(current.strip())
            current = ""
        else:
            current += char
    return [*items, current.strip()]


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five contigs of 10 000 bases."""
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("int").alias("tid"),
        F.concat(F.lit("chr"), (F.col("r_regionkey") + 1).cast("string")).alias("contig"),
        F.lit(10000).cast("long").alias("length"),
    )


def readgroups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six read-groups: two samples with three libraries each."""
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_linestatus", (F.col("l_linenumber") % 3).alias("lib"))
        .distinct()
        .select(
            F.concat(F.lit("SM_"), "l_linestatus", F.lit("/LB"), "lib").alias("rg"),
            F.concat(F.lit("SM_"), "l_linestatus").alias("sample"),
            F.concat(F.lit("LB"), "lib").alias("library"),
            F.when(F.col("lib") != 2, F.concat(F.lit("PU"), "lib")).alias("platform_unit"),
            F.concat(F.lit("kind"), "lib").alias("description"),
        )
    )


def regions(spark: SparkSession, sf_dir: str, named: bool = True) -> DataFrame:
    """Overlapping intervals made from ``part``; some have no name of their own."""
    key = F.col("p_partkey")
    contig = F.concat(F.lit("chr"), (key % 5 + 1).cast("string"))
    name = F.when(key % 7 != 0, F.col("p_brand"))
    if named:
        name = F.coalesce(name, F.concat(contig, F.lit("*")))
    return table(spark, sf_dir, "part").select(
        key.alias("region_id"),
        contig.alias("contig"),
        ((key * 137) % 9000).cast("long").alias("start"),
        ((key * 137) % 9000 + 50 + F.col("p_size")).cast("long").alias("end"),
        name.alias("name"),
    )


def panel_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel of five samples, one row per distinct site, made from ``part``."""
    key = F.col("p_partkey")
    codes = F.concat(
        *(
            F.substring(F.lit("ACGTRYSWKM"), (key * k % 10 + 1).cast("int"), F.lit(1))
            for k in range(1, 6)
        )
    )
    return (
        table(spark, sf_dir, "part")
        .select(
            F.concat(F.lit("chr"), (key % 5 + 1).cast("string")).alias("contig"),
            ((key * 137) % 9900 + 1).cast("long").alias("pos"),
            key.alias("_key"),
            codes.alias("genotypes"),
        )
        .groupBy("contig", "pos")
        .agg(F.min_by("genotypes", "_key").alias("genotypes"))
        .withColumn("ref", F.translate(F.substring("genotypes", 1, 1), "RYSWKM", "ACCAGA"))
    )


def documents_as_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts as named sequences; texts of equal length form an alignment."""
    return table(spark, sf_dir, "documents").select(
        F.col("n_chars").alias("msa"),
        F.col("doc_id").cast("string").alias("name"),
        F.col("lang").alias("meta"),
        dna(F.col("text")).alias("sequence"),
    )


# Letters of a text and the nucleotide codes that they are mapped to
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
NUCLEOTIDES = "ACGTACGTRYMKSWACGTACGTNNACACGTACGTACGTRYMKSWACGTNNAC"


def dna(text):
    """Map a text onto nucleotide codes, character by character; the rest become gaps."""
    return F.regexp_replace(
        F.translate(text, LETTERS, NUCLEOTIDES), f"[^{''.join(sorted(set(NUCLEOTIDES)))}]", "-"
    )


_DNA_SQL = (
    f"regexp_replace(translate(text, '{LETTERS}', '{NUCLEOTIDES}'), "
    f"'[^{''.join(sorted(set(NUCLEOTIDES)))}]', '-', 'g')"
)

# Fixed values for the SQL: codes by the set of their bases (A 1, C 2, G 4, T 8), and as letters
CODE_SETS = "A 1 C 2 M 3 G 4 R 5 S 6 V 7 T 8 W 9 Y 10 H 11 K 12 D 13 B 14 N 15".split()
CODE_LETTERS = "A A C C G G T T R AG Y CT K GT M AC S CG W AT B CGT D AGT H ACT V ACG N ACGT".split()


def sql_cases(pairs: list[str], result: str = "WHEN '{0}' THEN {1}", leave_out: str = "") -> str:
    """``WHEN`` branches for a list of codes and values in turn."""
    branches = zip(pairs[::2], pairs[1::2], strict=True)
    return " ".join(result.format(*it) for it in branches if it[0] not in leave_out.split())


_CTES: dict[str, str] = {
    "contigs": """SELECT CAST(r_regionkey AS INT) AS tid, concat('chr', r_regionkey + 1) AS contig,
        CAST(10000 AS BIGINT) AS length FROM region""",
    "readgroups": """SELECT DISTINCT concat('SM_', l_linestatus, '/LB', l_linenumber % 3) AS rg,
        concat('SM_', l_linestatus) AS sample, concat('LB', l_linenumber % 3) AS library,
        CASE WHEN l_linenumber % 3 <> 2 THEN concat('PU', l_linenumber % 3) END AS platform_unit,
        concat('kind', l_linenumber % 3) AS description FROM lineitem""",
    "regions": """SELECT p_partkey AS region_id, concat('chr', p_partkey % 5 + 1) AS contig,
        CAST((p_partkey * 137) % 9000 AS BIGINT) AS "start",
        CAST((p_partkey * 137) % 9000 + 50 + p_size AS BIGINT) AS "end",
        coalesce(CASE WHEN p_partkey % 7 <> 0 THEN p_brand END,
                 concat('chr', p_partkey % 5 + 1, '*')) AS name FROM part""",
    "panel_sites": """SELECT contig, pos, genotypes,
        translate(substr(genotypes, 1, 1), 'RYSWKM', 'ACCAGA') AS ref FROM (
        SELECT concat('chr', p_partkey % 5 + 1) AS contig,
        CAST((p_partkey * 137) % 9900 + 1 AS BIGINT) AS pos,
        arg_min(concat("""
    + ", ".join(
        f"substr('ACGTRYSWKM', CAST(p_partkey * {k} % 10 + 1 AS INT), 1)" for k in range(1, 6)
    )
    + """), p_partkey) AS genotypes FROM part GROUP BY ALL)""",
    "sequences": f"""SELECT n_chars AS msa, CAST(doc_id AS VARCHAR) AS name, lang AS meta,
        {_DNA_SQL} AS sequence FROM documents""",
}
for _name, _parts in _VARIANTS.items():
    _CTES[_name] = f"""SELECT *, pos + m1 + del + m2 AS ref_end,
        clip + m1 + ins + m2 AS query_len,
        substr(repeat('{REPEAT}', 12), 1 + CAST(l_partkey % 10 AS INT), clip + m1 + ins + m2) AS seq,
        CASE WHEN l_partkey % 97 <> 0 THEN
            [CAST(2 + (l_partkey + i * 7) % 39 AS INT) FOR i IN range(1, clip + m1 + ins + m2 + 1)]
        END AS quals,
        concat(CASE WHEN clip > 0 THEN concat(clip, 'S') ELSE '' END, m1, 'M',
               CASE WHEN ins > 0 THEN concat(ins, 'I') ELSE '' END,
               CASE WHEN del > 0 THEN concat(del, 'D') ELSE '' END, m2, 'M') AS cigar_text,
        CASE WHEN l_partkey % 5 = 0 THEN CAST(l_partkey % 4 AS BIGINT) END AS xp
        FROM (SELECT {_parts.format(div="//")} FROM lineitem)"""


def with_views(*names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause that defines the given views, and further ones after them."""
    parts = {name: _CTES[name] for name in names} | (extra or {})
    return "WITH " + ", ".join(f"{name} AS ({body})" for name, body in parts.items()) + " "
