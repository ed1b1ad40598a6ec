"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from snaptrend.session import build_session
from workload.registry import QUERIES

HEADLINE = (
    "latest_per_key", "upsert_newer", "video_momentum", "video_discovery",
    "counter_changes_hot_keys", "topic_daily", "topic_trends", "channel_daily", "dashboard_summary",
    "topics_over_time_dense", "topic_share", "top_videos_by_topic", "sub_topics_over_time",
    "flatten_details", "iso_duration", "normalize_text", "build_documents", "macro_rules",
    "macro_tfidf_fallback", "top_phrases_single_doc", "cluster_top_phrases",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").count().collect()
    names = sys.argv[1:] or HEADLINE
    took = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    spark.stop()
    sf = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
