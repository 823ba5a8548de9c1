"""The provided tables read as an item feed in the shape of the silver layer.

orders are stories and jobs, lineitems are comments on them (repeated line numbers are
versions of one comment), pages are stories with a URL, documents are stories with a text.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlake.functions import day_string
from forumlake.schemas import SILVER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _seconds_after(start, seconds):
    return F.timestamp_add("SECOND", seconds, start.cast("timestamp"))


def _silver(df: DataFrame, **columns) -> DataFrame:
    given = df.select(*[c.alias(name) for name, c in columns.items()])
    day = day_string("created_at")
    known = {"ingest_date": day, "ingest_date_str": day}
    return given.select(
        *[
            (F.col(f.name) if f.name in columns else known.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
            for f in SILVER
        ]
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(
        table(spark, sf_dir, "orders"),
        item_id=F.col("o_orderkey"),
        item_type=F.when(F.col("o_orderstatus") == "P", "job").otherwise("story"),
        author=F.when(
            F.col("o_orderpriority") != "4-NOT SPECIFIED", F.concat(F.lit("user"), F.col("o_custkey").cast("string"))
        ),
        created_at=_seconds_after(F.col("o_orderdate"), (F.col("o_orderkey") * 7919) % 86400),
        title=F.concat_ws(" ", "o_orderpriority", "o_orderstatus"),
        score=F.floor("o_totalprice"),
        source_file=F.lit("orders"),
    )


def lineitem_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(
        table(spark, sf_dir, "lineitem"),
        item_id=-(F.col("l_orderkey") * 8 + F.col("l_linenumber")),
        item_type=F.lit("comment"),
        author=F.concat(F.lit("user"), F.col("l_suppkey").cast("string")),
        created_at=_seconds_after(F.col("l_shipdate"), (F.col("l_partkey") * 31 + F.col("l_suppkey")) % 86400),
        parent_id=F.col("l_orderkey"),
        score=F.floor("l_extendedprice"),
        descendants=F.floor("l_quantity"),
        source_file=F.concat(F.lit("lineitem-"), F.col("l_returnflag")),
    )


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(
        table(spark, sf_dir, "pages"),
        item_id=F.col("page_id") + 1_000_000_000_000,
        item_type=F.lit("story"),
        author=F.lit("pagebot"),
        created_at=_seconds_after(F.lit("1996-01-01 00:00:00"), F.col("page_id") * 3600),
        title=F.concat(F.lit("page "), F.col("page_id").cast("string")),
        text_content=F.col("html"),
        url=F.col("url"),
        score=F.length("html"),
        source_file=F.lit("pages"),
    )


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(
        table(spark, sf_dir, "documents"),
        item_id=F.col("doc_id") + 2_000_000_000_000,
        item_type=F.lit("story"),
        author=F.col("source"),
        created_at=_seconds_after(F.lit("1997-01-01 00:00:00"), F.col("doc_id") * 600),
        title=F.col("lang"),
        text_content=F.col("text"),
        score=F.col("n_chars"),
        source_file=F.lit("documents"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four tables as one silver layer."""
    parts = [part(spark, sf_dir) for part in (order_items, lineitem_items, page_items, document_items)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as states of one item per user and event type, delivered over many days."""
    return _silver(
        table(spark, sf_dir, "events"),
        item_id=F.col("user_id") * 100 + F.length("event_type"),
        item_type=F.lit("story"),
        author=F.concat(F.lit("user"), F.col("user_id").cast("string")),
        created_at=F.col("ts").cast("timestamp"),
        score=F.floor("value"),
        descendants=F.get_json_object("props", "$.k").cast("bigint"),
        source_file=F.concat(F.lit("events-"), F.lpad(F.col("event_id").cast("string"), 12, "0")),
    )


def event_discussion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as stories and comments: clicks, views and purchases are versions of a user's three stories, signups and
    errors versions of comments on them. Later versions may move a story to another day and a comment to another story."""
    story = F.col("event_type").isin("click", "view", "purchase")
    kind = F.element_at(F.array(F.lit(4), F.lit(5), F.lit(8)), (F.col("event_id") % 3 + 1).cast("int"))
    return _silver(
        table(spark, sf_dir, "events"),
        item_id=F.when(story, F.col("user_id") * 100 + F.length("event_type")).otherwise(
            1_000_000 + (F.col("event_id") * 7) % 5000
        ),
        item_type=F.when(story, "story").otherwise("comment"),
        author=F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("user"), F.col("user_id").cast("string"))),
        created_at=F.col("ts").cast("timestamp"),
        parent_id=F.when(~story, F.col("user_id") * 100 + kind),
        score=F.floor("value"),
        descendants=F.get_json_object("props", "$.k").cast("bigint"),
        source_file=F.concat(F.lit("events-"), F.lpad(F.col("event_id").cast("string"), 12, "0")),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as raw JSON lines with their ingest day; the props object is a nested field."""
    events = table(spark, sf_dir, "events")
    line = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.lit("story").alias("type"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("by"),
            F.unix_timestamp(F.col("ts").cast("timestamp")).alias("time"),
            F.concat(F.lit("["), F.col("event_type"), F.lit("] § {x}")).alias("title"),
            F.from_json("props", "k BIGINT").alias("text"),
            F.col("value").alias("parent"),
            F.get_json_object("props", "$.k").alias("score"),
            F.floor("value").alias("descendants"),
        )
    )
    return events.select(
        line.alias("value"),
        F.lit("events").alias("source_file"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"),
    )


# The same feed for the comparison database.
SILVER_SQL = """
silver AS (
    SELECT o_orderkey AS item_id,
           CASE WHEN o_orderstatus = 'P' THEN 'job' ELSE 'story' END AS item_type,
           CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'user' || o_custkey END AS author,
           o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS created_at,
           o_orderpriority || ' ' || o_orderstatus AS title,
           CAST(NULL AS VARCHAR) AS text_content, CAST(NULL AS VARCHAR) AS url, CAST(NULL AS BIGINT) AS parent_id,
           CAST(floor(o_totalprice) AS BIGINT) AS score, CAST(NULL AS BIGINT) AS descendants,
           'orders' AS source_file
    FROM orders
    UNION ALL
    SELECT -(l_orderkey * 8 + l_linenumber), 'comment', 'user' || l_suppkey,
           l_shipdate + to_seconds((l_partkey * 31 + l_suppkey) % 86400),
           NULL, NULL, NULL, l_orderkey,
           CAST(floor(l_extendedprice) AS BIGINT), CAST(floor(l_quantity) AS BIGINT), 'lineitem-' || l_returnflag
    FROM lineitem
    UNION ALL
    SELECT page_id + 1000000000000, 'story', 'pagebot', TIMESTAMP '1996-01-01' + to_seconds(page_id * 3600),
           'page ' || page_id, html, url, NULL, length(html), NULL, 'pages'
    FROM pages
    UNION ALL
    SELECT doc_id + 2000000000000, 'story', source, TIMESTAMP '1997-01-01' + to_seconds(doc_id * 600),
           lang, text, NULL, NULL, n_chars, NULL, 'documents'
    FROM documents
)"""

EVENT_SILVER_SQL = """
silver AS (
    SELECT user_id * 100 + length(event_type) AS item_id, 'story' AS item_type, 'user' || user_id AS author,
           ts AS created_at, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS text_content,
           CAST(NULL AS VARCHAR) AS url, CAST(NULL AS BIGINT) AS parent_id, CAST(floor(value) AS BIGINT) AS score,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS descendants,
           'events-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS source_file
    FROM events
)"""

DISCUSSION_SILVER_SQL = """
silver AS (
    SELECT CASE WHEN story THEN user_id * 100 + length(event_type) ELSE 1000000 + (event_id * 7) % 5000 END AS item_id,
           CASE WHEN story THEN 'story' ELSE 'comment' END AS item_type,
           CASE WHEN event_id % 11 <> 0 THEN 'user' || user_id END AS author, ts AS created_at,
           CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS text_content, CAST(NULL AS VARCHAR) AS url,
           CASE WHEN NOT story
                THEN user_id * 100 + CASE event_id % 3 WHEN 0 THEN 4 WHEN 1 THEN 5 ELSE 8 END END AS parent_id,
           CAST(floor(value) AS BIGINT) AS score, CAST(json_extract_string(props, '$.k') AS BIGINT) AS descendants,
           'events-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS source_file
    FROM (SELECT *, event_type IN ('click', 'view', 'purchase') AS story FROM events)
)"""
