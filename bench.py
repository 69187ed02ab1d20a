"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores,
BENCH_QUERIES a comma-separated subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

from helixframe.catalog import QUERIES
from helixframe.plans.session import local_session

HEADLINE = [
    "coverage_contig",
    "coverage_region",
    "depth_histogram",
    "max_depth",
    "reads_in_regions",
    "merge_regions",
    "mark_duplicates_collapsed",
    "mark_duplicates_paired",
    "duplicate_read_groups",
    "finalize_filter_counts",
    "finalize_histograms",
    "cleanup_records",
    "flagstat",
    "reads_at_sites",
    "consensus",
    "allele_frequencies",
    "msa_reduce",
    "biallelic_sites",
    "percentile_bounds",
    "clade_support",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE

    spark = local_session(cpus, int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    # The first query would otherwise pay for starting up
    QUERIES["flagstat"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    return 0


if __name__ == "__main__":
    sys.exit(main())
