"""Bench: headline queries at $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS]; prints one JSON line with per-query seconds.

Each query is fully executed (written to the no-op sink) once to warm up
the JVM and the Python workers, then timed on a second run."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rss_article_counts", "clean_url", "entry_dedupe_seen", "insert_ignore", "feed_poll_update",
    "feeds_due", "new_articles", "upsert_articles", "article_counts", "article_counts_incremental",
    "merge_publications", "duplicate_pubs", "unique_categories", "category_alias_lookup",
    "latest_article_per_pub", "pub_category_backfill", "read_wire", "wire_to_article",
    "page_validate", "extract_content", "merge_extracted", "search_pubs", "queue_depth",
    "stream_article_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from newsdesk.session import get_spark
    from newsdesk.plans.registry import QUERIES
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    names = sys.argv[1:] or HEADLINE
    times, failed = {}, []
    for name in names:
        fn = QUERIES[name]
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            spark.catalog.clearCache()  # no cached data carried into the timed run
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the rest
            times[name] = None
            failed.append(name)
            print(f"bench: {name} failed: {str(e)[:300]}", file=sys.stderr)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_sec", "value": round(sum(v for v in times.values() if v is not None), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
