"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the test data (default /root/testdata/sf0.1), BENCH_CPUS the
local cores (default 8). Every query runs completely into a sink that discards the
rows; the best of BENCH_RUNS (default 3) timings counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tracemill.session import local_session  # noqa: E402
import tracemill as tm  # noqa: E402
from workload.derived import problems  # noqa: E402
from workload.registry import QUERIES, _mix  # noqa: E402

# Sizes of the published recipes; the registered queries take fewer rows, so that the
# smaller test data have rows to leave out.
DIRECT_ROWS, BASELINE_ROWS = 5000, 600
TIMED = QUERIES | {
    "sample_exact": lambda spark, sf: tm.sample_exact(problems(spark, sf), BASELINE_ROWS),
    "baseline_recipe": lambda spark, sf: tm.baseline_recipe(problems(spark, sf), BASELINE_ROWS, keep=("id",)),
    "mixed_recipe": lambda spark, sf: _mix(spark, sf, DIRECT_ROWS).ordered,
    "mix_report": lambda spark, sf: _mix(spark, sf, DIRECT_ROWS).report(),
}

HEADLINE = (
    "eval_summary",
    "clean_traces",
    "clean_report",
    "verify_accepted",
    "verify_summary",
    "exclude_ids",
    "sample_exact",
    "split_train",
    "shuffle_order",
    "text_reasoned",
    "request_rows",
    "chat_turns",
    "chat_conversations",
    "verify_paired",
    "request_files",
    "baseline_recipe",
    "trace_recipe",
    "mixed_recipe",
    "mix_report",
    "load_json_lines",
    "stream_accepted",
)


def timed(run, repeats: int) -> float:
    best = float("inf")
    for _ in range(repeats):
        started = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - started)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    # The first job pays for starting up, which belongs to no query.
    spark.read.parquet(f"{sf_dir}/documents.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        query = TIMED[name]
        seconds[name] = timed(
            lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save(), repeats
        )
        print(f"{name:20s} {seconds[name]:7.3f}s", file=sys.stderr, flush=True)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
