"""Headline workloads; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

HEADLINE = [
    "g02_userset_expansion", "g05_ancestor_closure", "g08_role_permissions", "g09_binding_grants", "g13_check_bulk",
    "g14_lookup_resources", "g17_effective_access", "w01_touch", "w07_fold_updates", "w10_version_intervals",
    "s03_decode_flat_changes", "c05_current_state", "c06_stream_to_tuples", "c12_hop_latency", "k03_subject_lists",
    "k06_invalidate_transitive", "m07_hosts", "m15_reconcile", "t01_counter_rate", "t04_bucket_quantile",
    "t11_alert_states", "t14_throttle",
]


def run(spark, fn, sf_dir) -> float:
    start = time.time()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.time() - start, 3)


def host_access(spark, sf_dir):
    """Group-level host access for every permission: what is stored before groups are opened."""
    from grantflow.operators.roles import resource_grants
    from grantflow.plans.derived import HOST
    from grantflow.plans.queries_graph import scope_access

    tuples, scopes, _ = scope_access(spark, sf_dir)
    return resource_grants(tuples, scopes, HOST)


def fold_log(spark, sf_dir):
    """Change log to current workspaces to tuples, merged into the graph."""
    from grantflow.operators.relate import cdc_tuples
    from grantflow.operators.writes import touch
    from grantflow.plans.derived import change_log, graph

    return touch(graph(spark, sf_dir), cdc_tuples(change_log(spark, sf_dir)))


def check_100k(spark, sf_dir):
    """100,000 distinct host view checks."""
    from grantflow.operators.evaluate import check_bulk
    from grantflow.plans.derived import graph
    from grantflow.plans.queries_graph import host_model, line_requests

    ask = line_requests(spark, sf_dir).distinct().orderBy("res_id", "sub_id").limit(100_000)
    return check_bulk(ask, graph(spark, sf_dir), host_model(spark)[0])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from grantflow.plans import QUERIES

    work = {name: QUERIES[name] for name in HEADLINE}
    work |= {"host_access": host_access, "fold_change_log": fold_log, "check_100k": check_100k}
    spark.range(1000).agg(F.sum("id")).collect()
    run(spark, QUERIES["g02_userset_expansion"], sf_dir)
    only = sys.argv[1:]
    seconds = {}
    for name, fn in work.items():
        if not only or any(name.startswith(o) for o in only):
            seconds[name] = run(spark, fn, sf_dir)
            print(name, seconds[name], file=sys.stderr, flush=True)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    asks = min(100_000, spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_suppkey").distinct().count())
    extra = {}
    if "check_100k" in seconds:
        extra["checks_per_sec"] = round(asks / seconds["check_100k"], 1)
    if "fold_change_log" in seconds:
        extra["events_folded_per_sec"] = round(events / seconds["fold_change_log"], 1)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")), **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
