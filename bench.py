"""Time the headline queries: median of warm runs, one JSON line on stdout."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from talkmill.plans import QUERIES  # noqa: E402
from talkmill.session import build_session  # noqa: E402

HEADLINE = [
    "pack_chunks",
    "pack_merge",
    "batch_groups",
    "export_chunks",
    "dedup_last_wins",
    "dedup_first_wins",
    "link_content_upsert",
    "resume_anti_join",
    "work_queue",
    "conv_validity",
    "conv_refusal_filter",
    "conv_sections",
    "token_totals",
    "markdown_clean",
    "page_links",
    "page_articles",
    "mcq_extract",
    "mcq_accuracy",
    "champion_challenger",
    "chat_keyset_page",
    "latest_version",
    "version_diff",
    "cascade_delete",
    "vote_upsert",
    "quota_breach",
    "metric_unpivot",
    "gauge_avg_sum",
    "stream_series",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            begun = time.perf_counter()
            # Every row and column is computed; nothing is written.
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begun)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
