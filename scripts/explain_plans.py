"""Write the physical plans of the key queries (sf0.1) to PLANS.md."""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = {
    "rss_article_counts": "URL cleaning is Column code; the store side of the URL judgement is narrowed by a "
                          "semi join before its per-url aggregate; counts are partial + final aggregates.",
    "new_articles": "Store rows are semi-joined to the batch's urls (broadcast side) before the per-url "
                    "min/max; both sides are one row per url when joined back: no row multiplication.",
    "feed_poll_update": "Latest poll per feed is a grouped min of a struct (partial aggregate); one left "
                        "join back to the feed table.",
    "duplicate_pubs": "Survivor per name from a grouped min; joined back on name (one row per name on "
                      "the right).",
    "latest_article_per_pub": "Grouped max of a struct per pub: partial aggregate, no window; the scan "
                              "reads only the columns used and pushes the origin filter.",
    "category_alias_lookup": "The only explicit broadcast: the fixed 123-row alias table.",
    "wire_to_article": "Newswire read through the XML file source with the mapped schema; parents and "
                       "articles share one persisted parse.",
    "feeds_due": "Top-k: TakeOrderedAndProject (per-partition top 25, one small merge).",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from newsdesk.plans.registry import QUERIES
    from newsdesk.session import get_spark
    spark = get_spark(shuffle_partitions=16)
    out = ["# Physical plans of key queries",
           "",
           f"Generated by `scripts/explain_plans.py` at `{os.path.basename(sf_dir)}`, local[8], 16 shuffle",
           "partitions, AQE on (initial plans; AQE may turn a shuffle join into a broadcast at run time).",
           ""]
    for name, note in NOTES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain()
        plan = re.sub(r"file:/[^\]]*/", "file:.../", buf.getvalue()).rstrip()
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## {name}", "", note, "", "```", plan, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
