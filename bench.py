"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

from checks.queries import QUERIES
from hirelake.session import local_session

# Headline queries: the reference's own steps over whole tables.
HEADLINE = [
    "word_frequency", "word_frequency_semi_join", "word_frequency_repeated_keys",
    "silver_postings", "silver_by_source", "dedup_ignoring_time", "dedup_report",
    "first_per_key", "dense_id", "salary_bounds", "role_keyword_match",
    "quality_report", "high_water_mark", "newer_than", "attach_details",
    "page_links", "page_details", "page_cards", "page_job_details",
    "csv_round_trip", "json_round_trip", "staging_pruned", "load_incremental",
    "stream_ingest", "daily_run_gold", "keyword_trend", "postings_fact",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("high_water_mark"), run("word_frequency")  # start-up of the engine
    seconds = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
