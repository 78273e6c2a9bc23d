"""Category lists: unique categories and the alias table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsdesk.fixed import CATEGORY_ALIASES
from newsdesk.functions.text import category_key, category_slug


def alias_table(spark: SparkSession) -> DataFrame:
    """The alias table as published: categories stored with spaces removed."""
    rows = [(a, [c.replace(" ", "") for c in cats]) for a, cats in CATEGORY_ALIASES]
    return spark.createDataFrame(rows, "alias string, categories array<string>")


def unique_categories(pubs: DataFrame, store: DataFrame | None, now) -> DataFrame:
    """New unique categories: every category over all pubs, one per slug
    (the bytewise-first spelling), minus slugs already stored. ``added`` is
    the run time. Returns the rows to insert."""
    cats = (pubs.select(F.explode("categories").alias("category"))
            .filter(F.col("category").isNotNull())
            .groupBy(category_slug("category").alias("category_id"))
            .agg(F.min("category").alias("category")))
    if store is not None:
        cats = cats.join(store.select("category_id"), "category_id", "left_anti")
    return cats.withColumn("added", F.lit(now).cast("timestamp"))


def category_alias_lookup(pubs: DataFrame, aliases: DataFrame) -> DataFrame:
    """(pub_id, category, alias) for every pub category whose space-free key
    is listed under an alias. The alias table is a fixed list of 123 rows,
    so broadcasting it is bounded."""
    a = aliases.select("alias", F.explode("categories").alias("key"))
    p = pubs.select("pub_id", F.explode("categories").alias("category"))
    return (p.join(F.broadcast(a), category_key(F.col("category")) == F.col("key"), "inner")
            .select("pub_id", "category", "alias"))
