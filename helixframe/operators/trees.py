"""Support of clades over many trees in Newick format.

A tree is cut into its tokens by one expression, and everything else is table work on tokens. The depth of
a token and the number of leaves before it are running sums over its tree. At one depth, a parenthesis and
the one that closes it follow each other, so that a clade is the range of leaves between the two. Its key
is the sum of 120-bit hashes of its leaves, a difference of running sums: the rows of a tree are as many
as its nodes, however many leaves a clade has.

Equal trees are counted before they are cut. Names of clades are only put together for clades that are
reported by name, once each.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.binding import bound

_TOKEN = r"'[^']*+(?:''[^']*+)*+'|[(),:;]|[^\s(),:;]+"
#: Bits of a leaf's hash in each of its parts; the sum over 2**23 leaves fits a long.
_PART_BITS = 40
_PARTS = ["_h1", "_h2", "_h3"]
#: What identifies a clade: the number of its leaves, and the parts of the sum of their hashes.
KEY = ["size", "h1", "h2", "h3"]


def _problem(tokens: Column) -> Column:
    """What is wrong with the tokens of a tree, or null."""

    def at(i: Column) -> Column:
        return F.coalesce(F.get(tokens, i), F.lit(""))

    def is_word(token: Column) -> Column:
        return (token != "") & ~token.isin("(", ")", ",", ":", ";")

    def follows(i: Column) -> Column:
        token, before = at(i), at(i - 1)
        # A name may have a length after it, a length may not
        named = is_word(before) & (at(i - 2) != ":")
        begins = before.isin("", "(", ",")
        return (
            F.when(token == "(", begins)
            .when(token == ":", begins | (before == ")") | named)
            .when(token.isin(")", ",", ";"), (before == ")") | is_word(before))
            .otherwise(begins | before.isin(")", ":"))
        )

    def step(state: Column, token: Column) -> Column:
        depth = state["depth"] + F.when(token == "(", 1).when(token == ")", -1).otherwise(0)
        closed = (depth < 0) | ((token == ",") & (depth < 1))
        return F.struct(depth.alias("depth"), (state["broken"] | closed).alias("broken"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("broken"))
    nesting = F.aggregate(tokens, start, step, lambda state: state["broken"] | (state["depth"] != 0))
    places = F.sequence(F.lit(0), F.size(tokens) - 1)
    one_end = F.size(F.filter(tokens, lambda it: it == ";")) == 1
    return (
        F.when(F.size(tokens) == 0, "empty tree")
        .when(F.element_at(tokens, -1) != ";", "missing semicolon")
        .when(~one_end | nesting, "parentheses do not match")
        .when(F.exists(places, lambda i: ~follows(i)), "malformed tree")
    )


def _tokens() -> Column:
    """The tokens of ``newick``; malformed trees fail."""
    message = F.concat(F.lit(": "), F.substring("newick", 1, 100))

    def checked(tokens: Column) -> Column:
        return bound(
            _problem(tokens),
            lambda problem: F.when(
                problem.isNotNull(), F.raise_error(F.concat(problem, message)).cast("array<string>")
            ).otherwise(tokens),
        )

    return bound(F.regexp_extract_all("newick", F.lit(_TOKEN), F.lit(0)), checked)


def _leaf_names(tokens: Column) -> Column:
    """Names of the leaves in order; a leaf with a length only has the name ''."""
    named = F.transform(
        tokens,
        lambda token, i: F.when(
            _starts_node(F.get(tokens, i - 1)) & (token != "("),
            F.when(token == ":", "").otherwise(token),
        ),
    )
    return F.filter(named, lambda it: it.isNotNull())


def _starts_node(before: Column) -> Column:
    return before.isNull() | before.isin("(", ",")


def tree_leaves(trees: DataFrame) -> DataFrame:
    """Leaves of every tree: ``(tree_id, leaves, duplicated)``; ``trees`` has (tree_id, newick)."""
    names = bound(_tokens(), _leaf_names)
    found = bound(
        names,
        lambda it: F.struct(
            F.array_join(F.array_sort(it), ",").alias("leaves"),
            (F.size(F.array_distinct(it)) != F.size(it)).alias("duplicated"),
        ),
    )
    return trees.where("newick IS NOT NULL").select("tree_id", F.inline(F.array(found)))


def _cut(trees: DataFrame, key: str) -> DataFrame:
    """Tokens: (key, at, token, before, depth, leaves before it, parts of the sum of their hashes).

    ``depth`` is that of the parentheses' inside. The tokens of a tree came from one row, and are at most as
    many as that has characters.
    """
    def rows(tokens: Column) -> Column:
        return F.transform(
            tokens,
            lambda token, i: F.struct(
                i.alias("at"), token.alias("token"), F.get(tokens, i - 1).alias("before")
            ),
        )

    known = trees.where("newick IS NOT NULL")
    tokens = known.select(key, F.inline(bound(_tokens(), rows)))
    is_leaf = _starts_node(F.col("before")) & (F.col("token") != "(")
    digest = F.md5(F.when(F.col("token") == ":", "").otherwise(F.col("token")))
    digits = _PART_BITS // 4
    parts = [
        F.when(is_leaf, F.conv(F.substring(digest, 1 + k * digits, digits), 16, 10).cast("long")).otherwise(0)
        for k in range(len(_PARTS))
    ]
    order = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    change = F.when(F.col("token") == "(", 1).when(F.col("before") == ")", -1).otherwise(0)
    return tokens.withColumns(
        {
            "is_leaf": is_leaf,
            # A closing parenthesis still belongs to its inside
            "depth": F.sum(change).over(order),
            "leaves": F.sum(is_leaf.cast("long")).over(order),
            **{name: F.sum(part).over(order) for name, part in zip(_PARTS, parts, strict=True)},
        }
    )


def _branches(tokens: DataFrame, key: str) -> DataFrame:
    """Nodes other than the root: (key, at, low, size, parts); their leaves begin with number ``low``.

    ``at`` is the place of a leaf, or of the parenthesis that closes an inner node.
    """
    inside = Window.partitionBy(key, "depth").orderBy("at")
    names = ["leaves", *_PARTS]
    # At one depth the parenthesis before a closing one is the one it closes
    opened = tokens.where("token IN ('(', ')')").select(
        key,
        "at",
        "depth",
        "token",
        F.lag("leaves").over(inside).alias("low"),
        *((F.col(name) - F.lag(name).over(inside)).alias(name) for name in names),
    )
    inner = opened.where("token = ')' AND depth > 1").select(key, "at", "low", *names)

    order = Window.partitionBy(key).orderBy("at").rowsBetween(-1, -1)
    own = [F.col(name) - F.coalesce(F.sum(name).over(order), F.lit(0)) for name in names]
    leaves = tokens.withColumns({f"_own_{name}": it for name, it in zip(names, own, strict=True)})
    leaves = leaves.where("is_leaf AND depth > 0").select(
        key,
        "at",
        (F.col("leaves") - 1).alias("low"),
        *(F.col(f"_own_{name}").alias(name) for name in names),
    )
    return inner.unionByName(leaves)


def _keyed(rows: DataFrame, *columns: str | Column) -> DataFrame:
    named = zip(["leaves", *_PARTS], KEY, strict=True)
    return rows.select(*columns, *(F.col(old).alias(new) for old, new in named))


def _distinct_trees(trees: DataFrame) -> DataFrame:
    """(newick, tree, n): equal texts once, known by their hash, and how many there are."""
    counts = trees.where("newick IS NOT NULL").groupBy("newick").agg(F.count("*").alias("n"))
    return counts.withColumn("tree", F.md5("newick"))


def _sides(distinct: DataFrame) -> DataFrame:
    """Both sides of every branch: (tree, low, high, inverted, key), each clade once per tree.

    A clade holds the leaves from ``low`` on and before ``high``, or all others if ``inverted``.
    """
    tokens = _cut(distinct, "tree")
    branches = _branches(tokens, "tree")
    names = ["leaves", *_PARTS]
    totals = tokens.where("token = ';'").select("tree", *(F.col(name).alias(f"_all_{name}") for name in names))
    both = branches.join(totals, "tree")
    high = (F.col("low") + F.col("leaves")).alias("high")
    straight = _keyed(both, "tree", "low", high, F.lit(False).alias("inverted"))
    rest = both.select(
        "tree", "low", high, *((F.col(f"_all_{name}") - F.col(name)).alias(name) for name in names)
    )
    inverted = _keyed(rest, "tree", "low", "high", F.lit(True).alias("inverted"))
    return straight.unionByName(inverted).where("size > 0").dropDuplicates(["tree", *KEY])


def clade_keys(trees: DataFrame) -> DataFrame:
    """Number of trees with each clade: ``(size, h1, h2, h3, support)``; linear in the leaves.

    Trees count as unrooted ones: every branch separates two sets of leaves, and both are clades. A leaf that
    a tree has several times counts as often.
    """
    distinct = _distinct_trees(trees)
    sides = _sides(distinct.select("tree", "newick"))
    # One row per branch and different tree, matched with one row per tree
    return (
        sides.join(distinct.select("tree", "n"), "tree").groupBy(*KEY).agg(F.sum("n").alias("support"))
    )


def clade_support(trees: DataFrame) -> DataFrame:
    """Number of trees with each clade, by name: ``(clade, support)``, leaves in order and with commas."""
    distinct = _distinct_trees(trees)
    sides = _sides(distinct.select("tree", "newick")).join(distinct.select("tree", "n"), "tree")
    counts = sides.groupBy(*KEY).agg(F.sum("n").alias("support"), F.min("tree").alias("tree"))
    # One tree lends its names to a clade
    shown = sides.drop("n").join(counts, ["tree", *KEY])
    leaves = distinct.select("tree", bound(_tokens(), _leaf_names).alias("_names"))
    low, size = F.col("low").cast("int"), (F.col("high") - F.col("low")).cast("int")
    inside = F.slice("_names", low + 1, size)
    outside = F.concat(
        F.slice("_names", F.lit(1), low), F.slice("_names", low + size + 1, F.size("_names"))
    )
    names = F.when(F.col("inverted"), outside).otherwise(inside)
    return shown.join(leaves, "tree").select(F.array_join(F.array_sort(names), ",").alias("clade"), "support")


def _formatted(fmt: str, values: dict[str, Column]) -> Column:
    """A format with named fields and specifications such as ``.1f``, as an expression."""
    parts = []
    for text, field, spec, _ in string.Formatter().parse(fmt):
        parts.append(F.lit(text))
        if field is None:
            continue
        value = values[field]
        if spec.startswith(".") and spec.endswith("f"):
            # Ties go to the even digit
            value = F.bround(value.cast("double"), int(spec[1:-1]))
        parts.append(F.format_string(f"%{spec}", value) if spec else value.cast("string"))
    return F.concat(F.lit(""), *parts)


def annotate_support(trees: DataFrame, bootstraps: DataFrame, fmt: str = "{Support}") -> DataFrame:
    """Label the inner nodes of rooted trees by their support: ``(tree_id, newick)``.

    ``fmt`` may use ``{Support}``, ``{Percentage}`` and ``{Fraction}``. Leaves keep their names
    and the root has none. All trees must have the same leaves, each once.
    """
    total = bootstraps.agg(F.count("newick")).scalar()
    tokens = _cut(trees.select("tree_id", "newick"), "tree_id")
    inner = _keyed(_branches(tokens, "tree_id"), "tree_id", "at").where("size > 0")
    support = clade_keys(bootstraps)
    counted = tokens.where("token = ')'").select("tree_id", "at").join(inner, ["tree_id", "at"])
    counted = counted.join(support, KEY, "left").select(
        "tree_id", "at", F.coalesce("support", F.lit(0)).cast("long").alias("support")
    )
    every = F.greatest(total, F.lit(1))
    label = _formatted(
        fmt,
        {
            "Support": F.col("support"),
            "Percentage": F.col("support") * 100.0 / every,
            "Fraction": F.col("support") / every,
        },
    )
    labels = counted.select("tree_id", "at", label.alias("label"))
    # Names of inner nodes make way for the labels
    kept = tokens.where("coalesce(before, '') <> ')' OR token IN ('(', ')', ',', ':', ';')")
    text = F.concat("token", F.coalesce("label", F.lit("")))
    parts = F.array_sort(F.collect_list(F.struct("at", text.alias("text"))))
    return (
        kept.select("tree_id", "at", "token")
        .join(labels, ["tree_id", "at"], "left")
        .groupBy("tree_id")
        .agg(F.array_join(F.transform(parts, lambda it: it["text"]), "").alias("newick"))
    )


def differing_leaves(trees: DataFrame, bootstraps: DataFrame) -> DataFrame:
    """Trees with repeated leaves, or with leaves that no tree of the other input has."""
    ours, theirs = tree_leaves(trees), tree_leaves(bootstraps)
    other = ours.join(theirs.select("leaves").distinct(), "leaves", "left_anti")
    return ours.where("duplicated").unionByName(other).select("tree_id").distinct()
