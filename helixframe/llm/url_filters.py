"""URL filters: rules first, then trust and distrust that spread over the links between hosts.

Hosts of pages that a rule allows are trusted seeds, hosts of pages that a rule blocks are blocked
seeds, each weighted by its pages. Trust spreads from trusted seeds along the links (personalised
PageRank); distrust spreads from blocked seeds against them, to the hosts that lead there. A host
links to the hosts in its pages' absolute links, and to and from the domain it belongs to. Links
are counted per pair of hosts, and so is everything that is shuffled afterwards.

A page that no rule fits is blocked if the distrust of its host exceeds ``BLOCK_RATIO`` times its
trust; a host that nothing reaches is allowed. Null urls, and such without ``://``, have an empty
host and path; no rule fits them, and they are allowed. Null html has no links. Repeated rows are
judged alike, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import bounded_broadcast, checkpointed, read
from helixframe.llm.queries import query

#: Verdict, host and start of the path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
#: Mass still on its way when spreading ends, at most, and the steps between two looks at it.
TOLERANCE = 1e-6
STEPS = 6
#: Edges to a task of a step; hosts are far fewer than pages, and steps many.
PART_EDGES = 200_000
BLOCK_RATIO = 1.0
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'<>\s]+)"""


def ascii_lower(text: Column) -> Column:
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, upper, upper.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.lit(""))
    return host, F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or null. Rules are a short list."""
    text = verdict = F.lit(None).cast("string")
    for name, rule_host, rule_path in sorted(rules, key=lambda it: len(it[1] + it[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(name)).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """Links between different hosts: (source, target, links), counted."""
    found = pages.where("host <> ''").select(
        "host", F.explode(F.regexp_extract_all("html", F.lit(_LINK), 1)).alias("target")
    )
    target = F.regexp_replace(F.regexp_replace(ascii_lower(F.col("target")), "^[^@]*@", ""), ":[0-9]*$", "")
    absolute = found.select(F.col("host").alias("source"), target.alias("target"))
    absolute = absolute.groupBy("source", "target").agg(F.count("*").alias("links"))

    # A name of three labels or more belongs to the domain without the first label
    hosts = absolute.select("target").union(pages.select("host").distinct()).distinct().toDF("host")
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(2), F.size(labels) - 1),
        lambda n: F.struct(
            F.array_join(F.slice(labels, n - 1, F.size(labels)), ".").alias("source"),
            F.array_join(F.slice(labels, n, F.size(labels)), ".").alias("target"),
        ),
    )
    up = hosts.where(F.size(labels) > 2).select(F.explode(above).alias("link")).select("link.*").distinct()
    down = up.select(F.col("target").alias("source"), F.col("source").alias("target"))
    family = up.unionByName(down).withColumn("links", F.lit(1).cast("long"))
    both = absolute.unionByName(family).where("source <> target AND target <> ''")
    return both.groupBy("source", "target").agg(F.sum("links").alias("links"))


def spread(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Rank per kind and host: (kind, host, rank), ranks of a kind adding up to 1.

    ``links`` have (kind, source, target, links), ``seeds`` have (kind, host, pages). Mass is moved
    step by step; what has been received adds up to the rank. Mass that reaches a host without links
    would start again at the seeds, which changes all ranks by the same factor. Spreading goes on for as
    long as it reaches new hosts, however little mass arrives there.
    """
    total = links.groupBy("kind", "source").agg(F.sum("links").alias("total"))
    edges = links.join(total, ["kind", "source"]).select(
        "kind",
        "source",
        "target",
        (F.col("links") / F.col("total") * DAMPING).alias("share"),
        F.lit(0.0).alias("keeps"),
    )
    hosts = edges.select("kind", F.explode(F.array("source", "target")).alias("source"))
    hosts = hosts.unionByName(seeds.select("kind", F.col("host").alias("source"))).distinct()
    # By an edge to itself a host keeps the rank that it has
    own = hosts.select("kind", "source", F.col("source").alias("target"), F.lit(0.0), F.lit(1.0))
    edges = checkpointed(edges.union(own))
    parts = max(1, -(-edges.count() // PART_EDGES))
    edges = bounded_broadcast(edges.withColumnRenamed("source", "host"))
    sums = seeds.groupBy("kind").agg(F.sum("pages").alias("all"))
    mass = F.col("pages") / F.col("all")
    state = seeds.join(F.broadcast(sums), "kind").select(
        "kind", "host", mass.alias("mass"), mass.alias("rank")
    )
    # Else every step would be dealt over as many tasks as a shuffle of the pages is
    state = state.coalesce(parts)
    reached = 0
    while True:
        for _ in range(STEPS):
            received = (
                state.join(edges, ["kind", "host"])
                .groupBy("kind", "target")
                .agg(
                    F.sum(F.col("mass") * F.col("share")).alias("mass"),
                    F.sum(F.col("rank") * F.col("keeps")).alias("rank"),
                )
            )
            state = received.select(
                "kind", F.col("target").alias("host"), "mass", (F.col("rank") + F.col("mass")).alias("rank")
            ).coalesce(parts)
        state = checkpointed(state)
        found = state.agg(F.sum("mass").alias("mass"), F.count("*").alias("hosts")).first()
        if found["hosts"] == reached and (found["mass"] or 0.0) < TOLERANCE:
            break
        reached = found["hosts"]
    sums = state.groupBy("kind").agg(F.sum("rank").alias("all"))
    return state.join(F.broadcast(sums), "kind").select(
        "kind", "host", (F.col("rank") / F.col("all")).alias("rank")
    )


def judge_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Host, path, rule and verdict per page, with the trust and distrust of its host."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumns({"rule": rule, "ruled": verdict})

    forward = checkpointed(host_links(parsed))
    kinds = forward.withColumn("kind", F.lit("allow")).unionByName(
        forward.select(
            F.col("target").alias("source"),
            F.col("source").alias("target"),
            "links",
            F.lit("block").alias("kind"),
        )
    )
    seeds = (
        ruled.where("ruled IS NOT NULL")
        .groupBy(F.col("ruled").alias("kind"), "host")
        .agg(F.count("*").alias("pages"))
    )
    ranks = spread(kinds, seeds)
    hosts = checkpointed(
        ranks.groupBy("host").agg(
            F.sum(F.when(F.col("kind") == "allow", F.col("rank")).otherwise(0.0)).alias("trust"),
            F.sum(F.when(F.col("kind") == "block", F.col("rank")).otherwise(0.0)).alias("distrust"),
        )
    )
    judged = ruled.drop("html").join(bounded_broadcast(hosts), "host", "left")
    judged = judged.fillna(0.0, ["trust", "distrust"])
    blocked = F.col("distrust") > F.col("trust") * BLOCK_RATIO
    own = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "trust", "distrust"
    )


@query("op5_url_filters")
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))
