"""Time the headline queries: one JSON line on standard output.

One query runs first to warm up the JVM; short queries are timed twice and the better time counts.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.registry import QUERIES  # noqa: E402
from rankloom.runtime import build_session  # noqa: E402

HEADLINE = [
    "clean_text",
    "redact_pii",
    "extract_skills",
    "experience_years",
    "build_features",
    "parse_job_description",
    "tokenize_ngrams",
    "chunk_words",
    "tfidf_cosine",
    "semantic_top3_mean",
    "rank_candidates",
    "rank_for_jobs",
    "top_n",
    "rank_candidates_by_source",
    "stratified_pool",
    "evaluate_rankings",
]
WARM_UP = "build_features"
SHORT = 15


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(max(int(cpus), 8)),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    run(WARM_UP)
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds[name] = run(name)
        if seconds[name] < SHORT:
            seconds[name] = min(seconds[name], run(name))
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = os.path.basename(os.path.normpath(sf_dir))
    print(
        json.dumps(
            {"metric": "total_wall_clock", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
