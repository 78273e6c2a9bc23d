"""Registered queries: extraction and publication rules (rows-only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import dates
from newsdesk.operators import pubs
from newsdesk.plans.common import _pages_with_rules
from newsdesk.plans.registry import joined, query, ts_str
from newsdesk.sources import driver_tables as dt


@query("xpath_rule_split", """
, r AS (SELECT pub_id, unnest(list_concat(list_concat(coalesce(xpath_body, []), coalesce(xpath_title, [])), coalesce(xpath_date, []))) AS rule FROM d_pub
        WHERE xpath_body IS NOT NULL OR xpath_title IS NOT NULL OR xpath_date IS NOT NULL)
SELECT pub_id,
  coalesce(array_to_string(list_sort(list(substr(rule, 2)) FILTER (WHERE starts_with(rule, '-'))), '|'), '') AS removes,
  coalesce(array_to_string(list_sort(list(split_part(rule, '~~', 1)) FILTER (WHERE NOT starts_with(rule, '-'))), '|'), '') AS searches
FROM r GROUP BY pub_id""")
def q_xpath_rule_split(spark, d):
    from newsdesk.operators.extract import split_rules
    p = dt.pubs(spark, d)
    rules = F.concat(F.coalesce("xpath_body", F.array().cast("array<string>")),
                     F.coalesce("xpath_title", F.array().cast("array<string>")),
                     F.coalesce("xpath_date", F.array().cast("array<string>")))
    s = p.filter(F.size(rules) > 0).select("pub_id", split_rules(rules).alias("r"))
    return s.select("pub_id", joined(F.array_sort("r.removes")).alias("removes"),
                    joined(F.array_sort("r.searches")).alias("searches"))


@query("extract_content")
def q_extract_content(spark, d):
    from newsdesk.operators.extract import extract_content
    e = extract_content(_pages_with_rules(spark, d))
    return e.select("article_id", F.col("content.title").alias("title"),
                    F.octet_length("content.body_text").alias("body_bytes"),
                    F.col("content.body_xpath").alias("body_xpath"),
                    joined("content.authors").alias("authors"),
                    F.col("content.published").alias("published"))


@query("extract_xpath")
def q_extract_xpath(spark, d):
    from newsdesk.operators.extract import extract_content, extract_xpath
    e = extract_content(_pages_with_rules(spark, d).filter(F.col("route") == "xpath"))
    x = extract_xpath(e.withColumn("body_text", F.col("content.body_text")))
    return x.select("article_id", "xp.title", "xp.author", "xp.published",
                    F.octet_length("xp.body").alias("body_bytes"), "xp.error")


@query("merge_extracted")
def q_merge_extracted(spark, d):
    from newsdesk.operators.extract import extract_page, merge_extracted
    base = _pages_with_rules(spark, d).withColumn("published", dates.parse_rfc1123("published"))
    m = merge_extracted(extract_page(base))     # one parse per page
    return m.select("article_id", "title", "author", ts_str("published").alias("published"),
                    F.octet_length("body_text").alias("body_bytes"),
                    (F.col("body_html") == "").alias("body_html_cleared"))
