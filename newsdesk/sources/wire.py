"""Newswire XML: explicit nested schema, file source, string parser, archive.

Repeated elements sit under a wrapper element (``<tags><tag/>..</tags>``), so
each list is a struct holding one array field, the way the XML source maps
them. Every leaf is a string except the few typed fields of the format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

_S = "STRING"
_PROPS = f"properties: STRUCT<property: ARRAY<STRUCT<name: {_S}, value: {_S}>>>"
_STR = lambda *names: ", ".join(f"{n}: {_S}" for n in names)

WIRE_ARTICLE_DDL = f"""
sequenceId {_S}, id {_S}, language {_S}, title {_S}, subTitle {_S}, content {_S},
contentWithMarkup {_S}, tags STRUCT<tag: ARRAY<{_S}>>, publishedDate {_S},
harvestDate {_S}, embargoDate {_S}, licenseEndDate {_S}, contentLicenseEndDate {_S},
url {_S}, originalUrl {_S}, commentsUrl {_S},
outboundUrls STRUCT<outboundUrl: ARRAY<{_S}>>, wordCount {_S}, dataFormat {_S},
copyright {_S}, loginStatus {_S}, duplicateGroupId {_S}, contentGroupIds {_S},
harvest STRUCT<{_STR('legacyNewsFeedId', 'legacyNewsName', 'harvestingMethods',
  'harvesterServerId', 'processingTime', 'streamReaderName', 'streamReaderStartTime',
  'streamReaderFileName', 'streamReaderSearchTermName')},
  customerTags: STRUCT<customerTag: ARRAY<{_S}>>>,
media STRUCT<audio: ARRAY<STRUCT<{_STR('url', 'mimeType', 'caption', 'duration')}>>,
  image: ARRAY<STRUCT<{_STR('url', 'mimeType', 'caption')}>>,
  video: ARRAY<STRUCT<{_STR('url', 'mimeType', 'caption', 'duration')}>>>,
publishingPlatform STRUCT<{_STR('itemId', 'statusId', 'itemType', 'inReplyToUserId',
  'inReplyToStatusId', 'userMentions', 'totalViews')}>,
adultLanguage {_S},
topics STRUCT<topic: ARRAY<STRUCT<{_STR('name', 'group')}>>>,
companies STRUCT<company: ARRAY<STRUCT<{_STR('name', 'symbol', 'exchange', 'isin', 'cusip')},
  titleCount: INT, contentCount: INT, primary: BOOLEAN>>>,
locations STRUCT<location: ARRAY<STRUCT<{_STR('name', 'type', 'class', 'mentions', 'confidence')},
  country: STRUCT<{_STR('confidence', 'fipsCode', 'isoCode', 'name')}>,
  {_STR('region', 'subregion')}, state: STRUCT<{_STR('confidence', 'fipsCode', 'name')}>,
  {_STR('latitude', 'longitude', 'provider')}>>>,
semantics STRUCT<events: STRUCT<event: ARRAY<STRUCT<{_PROPS}>>>,
  entities: STRUCT<entity: ARRAY<STRUCT<{_PROPS}>>>>,
sentiment STRUCT<score: {_S}, entities: STRUCT<entity: ARRAY<STRUCT<{_STR('type', 'value',
  'mentions', 'score', 'evidence')}, confident: BOOLEAN>>>>,
print STRUCT<{_STR('supplement', 'publicationEdition', 'regionalEdition', 'section',
  'pageNumber', 'pageCount', 'sizeCm', 'sizePercentage', 'originLeft', 'originTop', 'width',
  'height', 'byLine', 'photo')}>,
broadcast STRUCT<{_STR('marketName', 'nationalNetwork', 'title', 'programOrigin',
  'programCategory')}, lines: STRUCT<line: ARRAY<STRUCT<{_STR('date', 'text')}>>>>,
author STRUCT<{_STR('name', 'homeUrl', 'email', 'description', 'dateLastActive')},
  publishingPlatform: STRUCT<{_STR('userName', 'userId', 'statusesCount', 'totalViews',
  'followingCount', 'followersCount', 'kloutScore')}>>,
licenses STRUCT<license: ARRAY<STRUCT<name: {_S}>>>,
linkedArticles STRUCT<linkedArticle: ARRAY<STRUCT<{_STR('type', 'articleId')}>>>,
advertisingValueEquivalency STRUCT<{_STR('value', 'currency')}>,
source STRUCT<{_STR('id', 'syndicatorSourceId', 'name', 'homeUrl', 'publisher',
  'primaryLanguage', 'primaryMediaType', 'category', 'editorialRank', 'publicationId',
  'licensorPublicationId', 'channelCode')},
  location: STRUCT<{_STR('country', 'countryCode', 'region', 'subregion', 'state', 'county',
    'zipArea', 'zipCode')}>,
  metrics: STRUCT<mozscape: STRUCT<{_STR('mozRank', 'pageAuthority', 'domainAuthority',
    'externalLinks', 'links')}>,
    sourceReachMetrics: STRUCT<reach: ARRAY<STRUCT<{_STR('type', 'value', 'frequency')}>>>>,
  feedSource: {_S},
  feed: STRUCT<id: BIGINT, {_STR('name', 'url', 'mediaType', 'publishingPlatform',
    'idFromPublisher', 'generator', 'description')}, tags: STRUCT<tag: ARRAY<{_S}>>,
    {_STR('imageUrl', 'copyright', 'language', 'dataFormat')},
    rank: STRUCT<{_STR('autoRank', 'autoRankOrder', 'inboundLinkCount')}>,
    inWhiteList: {_S}, autoTopics: STRUCT<autoTopic: ARRAY<{_S}>>,
    editorialTopics: STRUCT<editorialTopic: ARRAY<{_S}>>, genre: {_S}>>
"""

# The fields the article mapping, parent resolution and category back-fill
# read. from_xml cannot prune a nested schema by itself, and parse time grows
# with the schema, so those paths parse with this one.
WIRE_MAPPED_DDL = f"""
sequenceId {_S}, id {_S}, title {_S}, content {_S}, contentWithMarkup {_S},
publishedDate {_S}, harvestDate {_S}, embargoDate {_S}, licenseEndDate {_S},
contentLicenseEndDate {_S}, url {_S}, originalUrl {_S},
publishingPlatform STRUCT<itemId: {_S}>,
author STRUCT<{_STR('name', 'homeUrl', 'email')}>,
source STRUCT<location: STRUCT<country: {_S}>,
  feed: STRUCT<id: BIGINT, {_STR('name', 'description')},
    editorialTopics: STRUCT<editorialTopic: ARRAY<{_S}>>, genre: {_S}>>
"""

WIRE_ARTICLE: T.StructType | None = None  # parsed from the DDL on first use
WIRE_MAPPED: T.StructType | None = None
CORRUPT = "_corrupt_record"
RESPONSE_DDL = "status STRING, messageCode STRING, userMessage STRING, developerMessage STRING"


def wire_schema(spark: SparkSession, mapped: bool = False) -> T.StructType:
    """Full newswire article schema, or only the mapped fields."""
    global WIRE_ARTICLE, WIRE_MAPPED
    if mapped:
        if WIRE_MAPPED is None:
            WIRE_MAPPED = spark.createDataFrame([], WIRE_MAPPED_DDL).schema
        return WIRE_MAPPED
    if WIRE_ARTICLE is None:
        WIRE_ARTICLE = spark.createDataFrame([], WIRE_ARTICLE_DDL).schema
    return WIRE_ARTICLE


class WireFailure(RuntimeError):
    """A newswire response says that the request failed."""


def position() -> Column:
    """Place of a row in the documents: file name, start of its split, order in
    the split. Taken at the scan (before any shuffle), where rows come in
    document order; names of files that arrive later sort later."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def read_wire(spark: SparkSession, path: str, with_file: bool = True, mapped: bool = False,
              with_position: bool = False) -> DataFrame:
    """Newswire response files -> one row per ``article`` element, with its
    place ``pos`` in the documents if asked for.

    Malformed articles land in ``_corrupt_record`` (PERMISSIVE mode), so a
    bad record is visible instead of becoming a row of nulls."""
    schema = T.StructType(wire_schema(spark, mapped).fields + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.format("xml").option("rowTag", "article")
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
          .schema(schema).load(path))
    extra = {"source_file": F.col("_metadata.file_path")} if with_file else {}
    if with_position:
        extra["pos"] = position()
    return df.select("*", *[c.alias(n) for n, c in extra.items()])


def read_wire_status(spark: SparkSession, path: str) -> DataFrame:
    """Response envelope per file; ``failed`` when status is FAILURE."""
    return (spark.read.format("xml").option("rowTag", "response").schema(RESPONSE_DDL).load(path)
            .withColumn("source_file", F.col("_metadata.file_path"))
            .withColumn("failed", F.coalesce(F.col("status") == "FAILURE", F.lit(False))))


def check_status(spark: SparkSession, path: str) -> None:
    """Stop on responses with status FAILURE (their messages in the error):
    they hold no articles, and going on would move the cursor past them."""
    failed = read_wire_status(spark, path).filter("failed").select("source_file", "messageCode", "userMessage").limit(10).collect()
    if failed:
        raise WireFailure("; ".join(f"{r.source_file}: {r.messageCode or ''} {r.userMessage or ''}".strip() for r in failed))


def parse_wire(spark: SparkSession, xml: Column, mapped: bool = False) -> Column:
    """One ``<article>`` XML string -> the newswire struct."""
    return F.from_xml(xml, wire_schema(spark, mapped), {"mode": "PERMISSIVE"})


def render_wire(article: Column) -> Column:
    """Struct -> ``<article>`` XML (also how the raw copy is re-serialised)."""
    return F.to_xml(article, {"rowTag": "article"})


def archive_wire(raw: DataFrame, path: str, ts_col: str = "fetched_at", mode: str = "append") -> None:
    """Keep a copy of every raw response, partitioned by fetch date.

    Rows are rebalanced by date before the write: AQE gives a date tasks (and
    files) in proportion to its bytes, by the session's advisory partition size,
    and puts small dates together. A date with half of the data is split.
    A batch that may run again names its own folder and ``mode="overwrite"``,
    so that a replay replaces its rows; ``append`` adds to what is there."""
    (raw.withColumn("fetch_date", F.to_date(ts_col)).hint("rebalance", "fetch_date")
        .write.mode(mode).partitionBy("fetch_date").parquet(path))


def wire_cursor_from_files(spark: SparkSession, path: str) -> DataFrame:
    """Last sequence id in document order of each response file.

    The row-tag reader keeps no position, so each file is read whole and its
    articles exploded with their position. A response holds at most one API
    page (500 articles), so one file per task is a bounded unit."""
    inner = "articles STRUCT<article: ARRAY<STRUCT<sequenceId: STRING>>>"
    files = spark.read.text(path, wholetext=True).withColumn("source_file", F.col("_metadata.file_path"))
    parsed = files.select("source_file", F.from_xml("value", inner, {"rowTag": "response"}).alias("r"))
    arts = parsed.select("source_file", F.posexplode("r.articles.article").alias("pos", "a"))
    return arts.groupBy("source_file").agg(F.max_by("a.sequenceId", "pos").alias("sequence_id"))
