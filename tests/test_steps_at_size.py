"""What keeps the newswire and count paths in proportion to their input: narrow
exchanges, history skipped by key range, adaptive micro-batches."""

import glob
import os
import uuid

from pyspark.sql import functions as F

from newsdesk.plans import common
from newsdesk.plans.wire import ingest_wire
from newsdesk.session import checkpoint_dir
from newsdesk.sources import driver_tables as dt
from newsdesk.store import KeyIndex, TableStore
from newsdesk.streaming import jobs as streams
from tests.conftest import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark, folder, n=1200):
    spark.range(1, n + 1).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "timestamp'2024-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority"
                                     ).write.parquet(f"{folder}/orders.parquet")
    spark.range(7).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "cast(id % 3 AS int) AS c_nationkey", "'TOOLS' AS c_mktsegment"
                              ).write.parquet(f"{folder}/customer.parquet")
    spark.range(3).selectExpr("cast(id AS int) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{folder}/nation.parquet")
    spark.range(20).selectExpr("id AS event_id", "timestamp'2024-01-02' AS ts", "id AS user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props"
                               ).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_responses_are_landed_compressed_and_whole(spark, tmp_path):
    d = _tables(spark, tmp_path)
    files = glob.glob(os.path.join(common._wire_files(spark, d), "part-*"))
    assert len(files) >= 3 and all(f.endswith(".gz") for f in files)       # pages of at most 500
    got = common._wire(spark, d)
    assert rows(got.select("seq")) == sorted(((k,) for k in range(1, 1201)), key=lambda r: str(r[0]))
    one = got.filter("seq = 10").select("a.*").first()
    assert (one.title, one.source.feed.id, one.source.location.country, one.author.name) == ("Wire 10", 3, "N0", "By By C3")


def test_exchange_of_the_landing_is_narrow(spark, tmp_path):
    d = _tables(spark, tmp_path, 10)
    w = dt.wire_articles_of(dt.wire_orders(spark, d).repartitionByRange("o_orderkey"))
    plan = _plan(w)
    assert plan.index(" AS article#") < plan.index("rangepartitioning")     # articles are made above the exchange


def test_no_exchange_holds_articles(spark, tmp_path):
    d = _tables(spark, tmp_path, 50)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        _p, _f, arts, cached = ingest_wire(common._wire(spark, d, mapped=False), dt.feeds(spark, d), dt.RUN_TS)
        top = _plan(arts).split("InMemoryTableScan")[0]
        assert "BroadcastHashJoin" in top and "SortMergeJoin" not in top and "hashpartitioning" not in top
        assert arts.count() == 50 and arts.filter("feed_id IS NULL").count() == 0
        cached.unpersist()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_history_outside_the_keys_is_skipped(spark):
    index = KeyIndex(TableStore(spark, checkpoint_dir(spark, "tests", uuid.uuid4().hex)), "ids", "k", ["v"])
    of = lambda *ks: spark.createDataFrame([(k, "v" + k) for k in ks], "k string, v string")
    index.add(of("a", "b", "c", "e"), "1")
    found = index.stored(of("b", "c", "d"))
    assert "GreaterThanOrEqual(k,b)" in _plan(found) and "LessThanOrEqual(k,d)" in _plan(found)
    assert rows(found) == [("b", "vb"), ("c", "vc")]                        # the ends of the range are in it
    assert rows(index.stored(of("e"))) == [("e", "ve")] and rows(index.stored(of("f", "g"))) == []
    assert rows(index.stored(spark.createDataFrame([(None, "x")], "k string, v string"))) == []


def test_sinks_run_adaptively(spark):
    seen = []
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", "false")
    batch = other.range(3)
    streams._adaptive(lambda b, n: seen.append((b.sparkSession.conf.get("spark.sql.adaptive.enabled"), n)))(batch, 4)
    assert seen == [("true", 4)] and other.conf.get("spark.sql.adaptive.enabled") == "false"
