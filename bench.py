"""Headline benchmark: runs the main registered queries over the tables in
$BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints
one JSON line.

Each query is fully executed through the ``noop`` sink (no collect to the
driver); times include planning and any eager snapshot the query writes.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# query -> main input table (for rows/s)
HEADLINE = {
    "label_from_path": "pages",            # label extraction
    "bronze_binary_rows": "documents",     # bronze/silver rows
    "label_index_join": "events",          # vocabulary + index join
    "hash_split_rows": "embeddings",       # reproducible split
    "minibatches": "orders",               # shard + mini-batch numbering
    "gradient_step0": "embeddings",        # one all-reduce
    "distributed_fit": "embeddings",       # synchronous data-parallel fit
    "parallel_trials": "embeddings",       # fused trials
    "score_table": "embeddings",           # batch scoring
    "image_decode": "embeddings",          # rows -> PNG files -> decode -> pool
    "runs_wide": "lineitem",               # run table pivot (orders + lineitem)
    "search_runs": "lineitem",             # rank runs per parent
    "current_stage": "lineitem",           # registry stages (orders + lineitem)
    "tpe_density_ratio": "part",           # TPE proposal scores
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    names = sys.argv[1:] or list(HEADLINE)

    from flowline.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="flowline-bench", shuffle_partitions=2 * cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "6g")})
    spark.sparkContext.setLogLevel("ERROR")
    from flowline.plans.catalog import QUERIES

    # warm-up (not timed): JVM code paths, Python workers with pandas/Arrow
    for w in ("label_from_path", "label_from_path_pandas"):
        QUERIES[w](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times, errors = {}, {}
    for n in names:
        t0 = time.perf_counter()
        try:
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as e:      # keep going: one JSON line is always printed
            times[n] = None
            errors[n] = repr(e)[:300]
        print(f"# {n}: {times[n]} s", file=sys.stderr, flush=True)
    total = round(sum(v for v in times.values() if v is not None), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count()
             for t in {HEADLINE.get(n) for n in names} if t}
    rps = {n: round(sizes[HEADLINE[n]] / times[n]) for n in names if HEADLINE.get(n) and times[n]}
    out = {"metric": "headline_total", "value": total, "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "rows_per_sec": rps}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
