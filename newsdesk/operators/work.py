"""Work in flight: queue depth per stage and per topic (the back-pressure checks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsdesk.fixed import QUEUE_THRESHOLD as DEFAULT_THRESHOLD


def queue_depth(work: DataFrame, threshold: int = DEFAULT_THRESHOLD, stages=None) -> DataFrame:
    """(stage, depth, error): depth = rows waiting in a stage; error when a
    listed stage has no rows handling it or depth exceeds the threshold."""
    d = work.groupBy("stage").agg(F.count("*").alias("depth"))
    if stages:
        want = work.sparkSession.createDataFrame([(s,) for s in stages], "stage string")
        d = want.join(d, "stage", "left").withColumn("depth", F.coalesce("depth", F.lit(0)).cast("bigint"))
    err = (F.when(F.col("depth") == 0, F.format_string("stage %s: nothing is waiting", "stage"))
            .when(F.col("depth") > threshold,
                  F.format_string("stage %s: %d rows wait, at most %d may", F.col("stage"), F.col("depth"), F.lit(threshold))))
    return d.withColumn("error", err)


def topic_depth(messages: DataFrame, threshold: int = DEFAULT_THRESHOLD, topics: DataFrame | None = None) -> DataFrame:
    """(topic, channels, undelivered, depth, error) from queued messages
    (``topic``, ``channel``; channel NULL: not handed to a consumer's channel
    yet). The depth of a topic is that of all its channels. An error when no
    channel reads the topic, when messages wait in the topic itself, or when the
    depth is over the threshold. ``topics`` (topic, channel) lists the channels
    that exist, so that an empty one counts; without it, those with messages."""
    d = messages.groupBy("topic").agg(
        F.count("channel").alias("depth"), F.count_if(F.col("channel").isNull()).alias("undelivered"),
        F.count_distinct("channel").alias("channels"))
    if topics is not None:
        known = topics.groupBy("topic").agg(F.count_distinct("channel").alias("known"))
        zero = F.lit(0).cast("bigint")
        d = known.join(d, "topic", "full").select("topic", F.coalesce("known", "channels").alias("channels"),
                                                  F.coalesce("depth", zero).alias("depth"), F.coalesce("undelivered", zero).alias("undelivered"))
    err = (F.when(F.col("channels") == 0, F.format_string("topic %s: no channel reads it", "topic"))
            .when(F.col("undelivered") > 0, F.format_string("topic %s: %d messages are not in a channel", "topic", "undelivered"))
            .when(F.col("depth") > threshold,
                  F.format_string("topic %s: %d messages wait, at most %d may", F.col("topic"), F.col("depth"), F.lit(threshold))))
    return d.select("topic", "channels", "undelivered", "depth", err.alias("error"))


def may_enqueue(depths: DataFrame) -> DataFrame:
    """One row: ok = no stage reported an error."""
    return depths.agg(F.coalesce(F.max(F.col("error").isNotNull().cast("int")), F.lit(0)).alias("_e")) \
        .select((F.col("_e") == 0).alias("ok"))
