"""Interpretation of admixture results, and tables derived from external solvers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.sequences import group_label
from helixframe.plans.intervals import running_before
from helixframe.plans.session import cut_lineage
from helixframe.plans.skew import skew_join

#: Fraction from which a sample counts as a member of a component.
CUTOFF = 0.001
#: Name of the sample under test in the tables of fractions.
TEST_SAMPLE = "-"
#: Smallest false-positive rate assumed for a tranche.
MIN_FP_RATE = 0.001
#: Read counts per bin of the search for the nearest one.
LEVEL_WIDTH = 1 << 16


def _pair(first: str, second: str):
    return F.array_sort(F.array(first, second)).alias("pair")


def _nearest_levels(tests: DataFrame, simulations: DataFrame) -> DataFrame:
    """Per read count of the tests the nearest ones of the simulations: (n_reads, _lower, _upper)."""
    at = F.col("n_reads").cast("long")
    marks = simulations.select(at.alias("at"), at.alias("level")).unionByName(
        tests.select(at.alias("at"), F.lit(None).cast("long").alias("level"))
    )
    marks = marks.where("at IS NOT NULL").groupBy("at").agg(F.max("level").alias("level"))
    # Upwards the nearest level so far is the largest one; downwards likewise, with signs changed
    turned = marks.select((-F.col("at")).alias("at"), (-F.col("level")).alias("level"))
    lower, upper = (
        running_before(side, [], "at", "level", LEVEL_WIDTH, inclusive=True) for side in (marks, turned)
    )
    lower = lower.select(F.col("at").alias("n_reads"), F.col("_running").alias("_lower"))
    upper = upper.select((-F.col("at")).alias("n_reads"), (-F.col("_running")).alias("_upper"))
    return lower.join(upper, "n_reads")


def asof_simulations(tests: DataFrame, simulations: DataFrame) -> DataFrame:
    """Simulations to compare a test with: those of the nearest smaller and larger read count.

    ``tests`` holds (test, sample1, sample2, n_reads, k, has_ts, value), ``simulations`` (n_reads,
    k, sample1, sample2, has_ts, percentile, value). The order of the two samples does not matter.
    Output: (test, side, n_reads, value, percentile, sim_value); sides without a read
    count are missing, and sides without matching simulations have one row with nulls.
    """
    # Read by the join and by the search for sides without simulations
    sided = cut_lineage(
        skew_join(tests, _nearest_levels(tests, simulations), ["n_reads"], "left")
        .select(
            "test",
            _pair("sample1", "sample2"),
            "k",
            "has_ts",
            "value",
            F.explode(
                F.array(
                    F.struct(F.lit("lower").alias("side"), F.col("_lower").alias("n_reads")),
                    F.struct(F.lit("upper").alias("side"), F.col("_upper").alias("n_reads")),
                )
            ).alias("_side"),
        )
        .select("test", "pair", "k", "has_ts", "value", "_side.*")
        .where(F.col("n_reads").isNotNull())
    )
    keys = ["pair", "k", "has_ts", "n_reads"]
    blocks = simulations.select(
        _pair("sample1", "sample2"),
        "k",
        "has_ts",
        "n_reads",
        "percentile",
        F.col("value").alias("sim_value"),
    )
    columns = ["test", "side", "n_reads", "value", "percentile", "sim_value"]
    matched = skew_join(blocks, sided, keys).select(*columns)
    found = matched.select("test", "side").distinct()
    unmatched = sided.join(found, ["test", "side"], "left_anti").withColumns(
        {name: F.lit(None).cast("double") for name in columns[4:]}
    )
    return matched.unionByName(unmatched.select(*columns))


def percentile_bounds(selected: DataFrame) -> DataFrame:
    """Percentiles that enclose the value of a test: ``(test, side, n_reads, lower, upper)``.

    By increasing percentile, the lower bound is the last one before a simulated value exceeds
    the value, 0 if there is none. By decreasing percentile, the upper bound is the last one
    before a simulated value falls below it, 1 if there is none.

    The simulations of a test are not ordered: the first violation is an aggregate, and so are
    the bounds before it.
    """
    keys = ["test", "side", "n_reads"]
    point = F.struct("percentile", "sim_value")
    stops = selected.groupBy(*keys).agg(
        F.min(F.when(F.col("sim_value") > F.col("value"), point)).alias("_above"),
        F.max(F.when(F.col("sim_value") < F.col("value"), point)).alias("_below"),
    )
    before = F.col("_above").isNull() | (point < F.col("_above"))
    after = F.col("_below").isNull() | (point > F.col("_below"))
    return (
        skew_join(selected, stops, keys, "inner")
        .groupBy(*keys)
        .agg(
            F.coalesce(F.max(F.when(before, F.col("percentile"))), F.lit(0.0)).alias("lower"),
            F.coalesce(F.min(F.when(after, F.col("percentile"))), F.lit(1.0)).alias("upper"),
        )
    )


def percent_range(bounds: DataFrame) -> DataFrame:
    """Range of percentages and of read counts over both sides of a test.

    A missing side is replaced by the other; ``estimate`` says in which direction that errs.
    """

    def side(name: str):
        return F.max(
            F.when(F.col("side") == name, F.struct("n_reads", "lower", "upper"))
        ).alias(f"_{name}")

    both = bounds.groupBy("test").agg(side("lower"), side("upper"))
    low, high = F.coalesce("_lower", "_upper"), F.coalesce("_upper", "_lower")
    return both.select(
        "test",
        (100 * (1 - F.greatest(low["upper"], high["lower"]))).alias("lower_pct"),
        (100 * (1 - F.least(low["upper"], high["lower"]))).alias("upper_pct"),
        F.least(low["n_reads"], high["n_reads"]).alias("min_reads"),
        F.greatest(low["n_reads"], high["n_reads"]).alias("max_reads"),
        F.when(F.col("_lower").isNull(), "over")
        .when(F.col("_upper").isNull(), "under")
        .otherwise("none")
        .alias("estimate"),
    )


def ancestral_groups(fractions: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Reference groups of every component, and the fraction of the sample under test.

    ``fractions`` holds (keys, sample, component, fraction), ``groups`` (sample, group). A group
    belongs to a component if one of its members reaches the cutoff.
    """
    test = fractions.where(F.col("sample") == TEST_SAMPLE).select(
        *keys, "component", F.col("fraction").alias("value")
    )
    members = (
        skew_join(fractions.where(F.col("fraction") >= CUTOFF), groups, ["sample"])
        .groupBy(*keys, "component")
        .agg(group_label(F.collect_set("group")).alias("groups"))
    )
    return test.join(members, [*keys, "component"], "left").fillna({"groups": ""})


def mixed_groups(fractions: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Reference groups that load on more than one component, which makes a result unusable."""
    return (
        skew_join(fractions.where(F.col("fraction") >= CUTOFF), groups, ["sample"])
        .select(*keys, "group", "component")
        .distinct()
        .groupBy(*keys, "group")
        .agg(F.count("*").alias("n_components"))
        .where(F.col("n_components") > 1)
    )


def admixture_calls(fractions: DataFrame, keys: list[str]) -> DataFrame:
    """Number of components of the sample under test, and what that means."""
    n = F.count_if(F.col("fraction") >= CUTOFF)
    return (
        fractions.where(F.col("sample") == TEST_SAMPLE)
        .groupBy(*keys)
        .agg(n.alias("n_components"))
        .withColumn(
            "call",
            F.when(F.col("n_components") < 2, "none")
            .when(F.col("n_components") == 2, "hybrid")
            .otherwise("complex"),
        )
    )


def positive_tests(calls: DataFrame, keys: list[str]) -> DataFrame:
    """Number of tests, and of tests with more than one component."""
    return calls.groupBy(*keys).agg(
        F.count("*").alias("n_tests"), F.count_if(F.col("n_components") > 1).alias("n_positive")
    )


def best_replicate(replicates: DataFrame, keys: list[str]) -> DataFrame:
    """Replicate with the highest log-likelihood, on ties the last."""
    best = F.max(F.struct("loglik", "replicate")).alias("_best")
    return replicates.groupBy(*keys).agg(best).select(*keys, "_best.replicate", "_best.loglik")


def lead_shift(value: str, window):
    """The value of the next row, 0 for the last."""
    return F.lead(value, 1, 0).over(window)


def tranche_table(tranches: DataFrame, target_titv: float, keys: list[str]) -> DataFrame:
    """True and false positives per tranche, cumulative and specific to the tranche.

    ``tranches`` holds (keys, truth_sensitivity, num_novel, novel_titv), few rows per key. The
    false-positive rate follows from the distance of the Ti/Tv ratio from its target.
    """
    rate = F.greatest(
        F.least(1 - (F.col("novel_titv") - 0.5) / (target_titv - 0.5), F.lit(1.0)),
        F.lit(MIN_FP_RATE),
    )
    order = Window.partitionBy(*keys).orderBy(F.desc("truth_sensitivity"))
    counted = (
        tranches.withColumn("_good", F.bround((1 - rate) * F.col("num_novel")))
        .withColumn("_bad", F.col("num_novel") - F.col("_good"))
        .withColumn("cum_tps", lead_shift("_good", order))
        .withColumn("cum_fps", lead_shift("_bad", order))
    )
    return counted.select(
        *keys,
        "truth_sensitivity",
        "novel_titv",
        "cum_tps",
        (F.col("_good") - F.col("cum_tps")).alias("tranche_tps"),
        (F.col("_bad") - F.col("cum_fps")).alias("tranche_fps"),
        "cum_fps",
        (F.col("cum_tps") + F.col("cum_fps")).alias("total_novel"),
    )


def pc_variance(eigenvalues: DataFrame, keys: list[str]) -> DataFrame:
    """Share of the variance of each principal component, rounded to three decimals."""
    totals = eigenvalues.groupBy(*keys).agg(F.sum("eigenvalue").alias("_total"))
    return eigenvalues.join(totals, keys).select(
        *keys, "component", F.round(F.col("eigenvalue") / F.col("_total"), 3).alias("share")
    )
