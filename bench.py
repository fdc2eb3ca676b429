"""Benchmark the headline attribution queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Untimed warm-up passes over
the two smaller scales run first (JVM start-up, code generation, JIT), then
each query is timed once.
Each query is evaluated completely into Spark's ``noop`` sink, so the time is
the query's, not the transfer of its rows into Python.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from touchline.plans import catalog  # noqa: E402
from touchline.session import local_session  # noqa: E402

HEADLINE = (
    "keyword_revenue",
    "keyword_revenue_timeout",
    "last_touch_time_order",
    "quality_metrics",
    "run_counts",
    "keyword_revenue_ranked",
    "session_last_touch",
)


def _rows(sf_dir: str) -> int:
    import pyarrow.parquet as pq

    return pq.ParquetFile(f"{sf_dir}/events.parquet").metadata.num_rows


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _end_to_end(spark, sf_dir: str) -> None:
    """The whole job: attribute once, write the dated report and the manifest."""
    import time as _t

    from touchline.plans.attribution import attribute
    from touchline.plans.sinks import manifest, write_manifest, write_report
    from touchline.session import scratch_path
    from touchline.sources.events import hits_from_events

    started = _t.monotonic()
    run = attribute(hits_from_events(spark, sf_dir)).materialize()
    out = scratch_path(spark, "bench-out")
    report = write_report(run, out)
    write_manifest(spark, manifest(run, sf_dir, started, results_path=report), out, result=run)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="touchline-bench")
    spark.sparkContext.setLogLevel("ERROR")
    reg = catalog.registry()
    warmups = [os.path.join(os.path.dirname(sf_dir), d) for d in ("sf0.001", "sf0.01")]
    warmups = [w for w in warmups if os.path.isdir(w) and os.path.abspath(w) != os.path.abspath(sf_dir)]
    for warm in warmups:
        for k in HEADLINE:
            _run(reg[k](spark, warm))
        _end_to_end(spark, warm)
    times = {}
    for k in HEADLINE:
        t0 = time.perf_counter()
        _run(reg[k](spark, sf_dir))
        times[k] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    _end_to_end(spark, sf_dir)
    times["end_to_end_job"] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    rows = _rows(sf_dir)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "attribution_headline_wall",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "hits": rows,
        "flagship_hits_per_sec": round(rows / times["keyword_revenue"], 1),
        "end_to_end_hits_per_sec": round(rows / times["end_to_end_job"], 1),
        "cpus": cpus,
        "warmup": [os.path.basename(w) for w in warmups],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
