"""Times the marts, silver events and the whole flow; prints one JSON line.

BENCH_SF_DIR names the folder of input tables, BENCH_CPUS the local cores, BENCH_WORK_DIR
or the first argument the folder for files (a new temporary one if neither is given). Each
query is written to Spark's no-op sink once to warm up, then three times; the median
counts. The flow reads raw CSV and JSON files, made from the same tables beforehand, and
writes all layers and exports; marts and checks are timed from these stored tables too.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from subtide.contract.registry import QUERIES
from subtide.plans import medallion
from subtide.plans.marts import mart_tables
from subtide.plans.staging import staging_tables
from subtide.schemas import RAW_FILES
from subtide.session import local_session
from subtide.sources.star_schema import AS_OF, raw_table

HEADLINE = (
    "silver_content_events",
    "mart_trial_conversion",
    "mart_retention",
    "mart_payment_failures",
    "mart_churn_risk",
    "mart_weekly_metrics",
    "dq_checks",
)


def median_seconds(run, times=3):
    run()
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def write_extracts(spark, sf_dir, folder):
    for name, file in RAW_FILES.items():
        writer = raw_table(spark, sf_dir, name).write
        if file.endswith(".json"):
            writer.json(f"{folder}/{file}", ignoreNullFields=False)
        else:
            writer.csv(f"{folder}/{file}", header=True)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = local_session(cpus, "subtide-bench", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {
        name: median_seconds(
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
        for name in HEADLINE
    }
    given = os.environ.get("BENCH_WORK_DIR") or (sys.argv[1] if len(sys.argv) > 1 else None)
    folder = given or tempfile.mkdtemp(prefix="subtide-bench-")
    write_extracts(spark, sf_dir, f"{folder}/raw")
    seconds["whole_flow"] = median_seconds(
        lambda: medallion.build_all(spark, f"{folder}/raw", f"{folder}/lake", AS_OF, exports=f"{folder}/out")
    )
    staged = staging_tables(medallion.silver_layer(spark, f"{folder}/lake"))
    for name, mart in mart_tables(staged, AS_OF).items():
        seconds[f"stored_{name}"] = median_seconds(lambda: mart.write.format("noop").mode("overwrite").save())
    checks = medallion.check_layers(spark, f"{folder}/lake")
    seconds["stored_check_layers"] = median_seconds(lambda: checks.write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "headline queries and whole flow, sum of medians (stored_ ones apart)",
        "value": round(sum(s for name, s in seconds.items() if not name.startswith("stored_")), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
