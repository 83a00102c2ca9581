"""Single operators over whole tables."""

from pyspark.sql import functions as F

from tidemark import functions as C
from tidemark import operators as O
from tidemark import plans, schemas
from tidemark.registry.base import VIDEOS_SQL, typed_videos
from tidemark.session import work_folder
from tidemark.sources import (
    categories,
    explode_items,
    flatten_categories,
    found_schema,
    item_fields,
    messages,
    parse_documents,
    read_categories,
    read_documents,
    read_transactions,
    read_tweets,
    read_videos,
    table,
    transactions,
    tweets,
    videos,
    write_csv,
)

# ---------------------------------------------------------------- sources


def scan_csv_typed(spark, folder):
    path = work_folder(spark, "transactions")
    write_csv(transactions(spark, folder), path)
    return read_transactions(spark, path)


SCAN_CSV_TYPED_SQL = """
SELECT CAST(o_orderkey % 744 AS INTEGER) AS step, o_orderpriority AS type, o_totalprice AS amount,
       'C' || CAST(o_custkey AS VARCHAR) AS "nameOrig", o_totalprice AS "oldbalanceOrg",
       CAST(0 AS DOUBLE) AS "newbalanceOrig", 'M' || CAST(o_orderkey AS VARCHAR) AS "nameDest",
       CAST(0 AS DOUBLE) AS "oldbalanceDest", o_totalprice AS "newbalanceDest",
       CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS "isFraud",
       CAST(0 AS INTEGER) AS "isFlaggedFraud"
FROM orders"""


def scan_csv_multiline(spark, folder):
    path = work_folder(spark, "tweets")
    write_csv(tweets(spark, folder), path)
    return read_tweets(spark, path).select("tweet_id", "author_id", "inbound", "text")


SCAN_CSV_MULTILINE_SQL = """
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS tweet_id, role AS author_id,
       CASE WHEN role = 'user' THEN 'True' ELSE 'False' END AS inbound, text
FROM conversations"""


def scan_videos_csv(spark, folder):
    path = work_folder(spark, "videos")
    write_csv(videos(spark, folder), path)
    return read_videos(spark, path)


# Customers of a nation that share a document.
DOCUMENT_KEYS = 500


def _category_documents(spark, folder, **more):
    """Customers as items of JSON documents over many lines, one per nation and range of keys, each a file."""
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(F.col("c_name").alias("title")).alias("snippet"),
        *[F.col(column).alias(name) for name, column in more.items()],
    )
    slices = F.expr(f"c_custkey div {DOCUMENT_KEYS}").alias("slice")
    nations = table(spark, folder, "customer").groupBy("c_nationkey", slices).agg(F.collect_list(item).alias("items"))
    path = work_folder(spark, "category-documents")
    text = F.to_json(F.struct(F.col("c_nationkey").alias("nation"), "items"), {"pretty": "true"}).alias("value")
    nations.select(text).write.option("maxRecordsPerFile", 1).text(path)
    return path


def read_category_documents(spark, folder):
    """Documents read with their declared schema."""
    return read_categories(spark, _category_documents(spark, folder))


def read_variant_documents(spark, folder):
    """The same documents without a declared schema; `segment` is in no schema of this library."""
    path = _category_documents(spark, folder, segment="c_mktsegment")
    documents = read_documents(spark, path).withColumn("nation", F.try_variant_get("document", "$.nation", "long"))
    items = explode_items(documents, keep=["nation"])
    fields = {"id": ("$.id", "long"), "title": ("$.snippet.title", "string"), "segment": ("$.segment", "string")}
    return item_fields(items, fields, keep=["nation"])


def find_fields(spark, folder):
    """Fields of JSON texts, found by reading: event properties of the given table beside fields that few rows have."""
    events = table(spark, folder, "events")
    rare = F.when(F.col("event_id") % 1000 == 0, F.col("event_id"))
    text = F.to_json(F.struct("event_id", "event_type", rare.alias("rare"))).alias("value")
    return found_schema(parse_documents(events.select(text)))


def profile_table(spark, folder):
    """Profile of the transactions, taken while they are written."""
    rows = transactions(spark, folder).withColumn("amount", F.when(F.col("step") > 3, F.col("amount")))
    found = plans.write_profiled(rows.select("step", "type", "amount", "nameDest"), work_folder(spark, "profiled"))
    return found.select("column", "type", "n_rows", "n_nulls", "least", "greatest")


PROFILE_TABLE_SQL = """
WITH rows AS (
    SELECT CAST(o_orderkey % 744 AS INTEGER) AS step, o_orderpriority AS type,
           CASE WHEN o_orderkey % 744 > 3 THEN o_totalprice END AS amount,
           'M' || CAST(o_orderkey AS VARCHAR) AS "nameDest"
    FROM orders
)
SELECT 'step' AS "column", 'int' AS type, count(*) AS n_rows, count(*) - count(step) AS n_nulls,
       CAST(min(step) AS VARCHAR) AS least, CAST(max(step) AS VARCHAR) AS greatest FROM rows
UNION ALL SELECT 'type', 'string', count(*), count(*) - count(type), min(type), max(type) FROM rows
UNION ALL SELECT 'amount', 'double', count(*), count(*) - count(amount),
       CAST(min(amount) AS VARCHAR), CAST(max(amount) AS VARCHAR) FROM rows
UNION ALL SELECT 'nameDest', 'string', count(*), count(*) - count("nameDest"), min("nameDest"), max("nameDest") FROM rows"""


def flatten_items(spark, folder):
    """Orders as JSON documents with an array of items, written, read and flattened again."""
    item = F.struct(
        F.col("l_linenumber").cast("string").alias("id"),
        F.struct(F.col("l_partkey").cast("string").alias("title")).alias("snippet"),
    )
    path = work_folder(spark, "documents")
    O.nest(table(spark, folder, "lineitem"), ["l_orderkey"], item, "items").select("items").write.json(path)
    return flatten_categories(spark.read.schema(schemas.CATEGORIES_JSON).json(path))


FLATTEN_ITEMS_SQL = """
SELECT CAST(l_linenumber AS VARCHAR) AS id, CAST(l_partkey AS VARCHAR) AS title FROM lineitem"""


def row_count(spark, folder):
    return plans.row_count(table(spark, folder, "lineitem"))


# ---------------------------------------------------------------- projections and filters


def project_rename(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), "o_totalprice"
    )


def cast_measures(spark, folder):
    raw = videos(spark, folder, "video_id", "views", "likes", "dislikes", "tags")
    return raw.select(
        "video_id",
        C.to_long("views").alias("views"),
        C.to_long("likes").alias("likes"),
        C.to_long("dislikes").alias("dislikes"),
        C.to_long("tags").alias("not_a_number"),
        C.to_long(F.concat(F.lit(" -"), "likes", F.lit(".9 "))).alias("cut_likes"),
        C.to_long(F.concat("views", F.lit("."))).alias("cut_views"),
    )


def struct_fields(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.struct(
            F.col("l_orderkey").alias("id"),
            F.struct(F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag")).alias("line"),
        ).alias("order")
    )
    return rows.alias("o").select(
        F.col("o.order.id").alias("order_id"), F.col("o.order.line.quantity"), F.col("o.order.line.flag")
    )


def derive_delta(spark, folder):
    rows = typed_videos(spark, folder, "video_id", "views")
    return O.cumulative_gain(rows, ["video_id"], "views", "video_id", min_rows=1, gain="views_gained")


def filter_views(spark, folder):
    return typed_videos(spark, folder, "video_id", "views").where(F.col("views") > 100000)


def having_repeat(spark, folder):
    return plans.weekly_gains(typed_videos(spark, folder, "video_id", "trending_date", "views", "category_id"))


# ---------------------------------------------------------------- joins


def join_using_left(spark, folder):
    rows = typed_videos(spark, folder, "video_id", "views", "likes")
    known = rows.where(F.col("video_id").isNotNull()).groupBy("video_id")
    stats = known.agg(F.count("views").alias("n_rows"), F.sum("likes").alias("sum_likes"))
    # Its null-safe keys give both sides an exchange of their own, so Spark can split a hot one.
    return O.null_safe_join(rows, stats, ["video_id"], "left")


def join_dimension(spark, folder):
    rows = typed_videos(spark, folder, "video_id", "category_id", "views")
    return O.with_name(rows, categories(spark, folder), "category_id")


def join_mapping_fanout(spark, folder):
    rows = typed_videos(spark, folder, "video_id", "channel_title", "views")
    mapping = rows.select("video_id", "channel_title").distinct()
    nested = rows.groupBy("video_id").agg(F.max("views").alias("views"))
    nested = nested.select(F.struct(F.col("video_id").alias("id"), "views").alias("video"))
    return (
        nested.alias("v")
        .join(mapping.alias("m"), F.col("v.video.id") == F.col("m.video_id"), "left")
        .select(F.col("v.video.id").alias("video_id"), F.col("v.video.views"), "m.channel_title")
    )


# ---------------------------------------------------------------- aggregations


def count_per_key(spark, folder):
    return table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("o_orderdate").alias("n_orders"))


def sum_per_key(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("sum_quantity"))
    )


def date_span_per_key(spark, folder):
    date = F.col("o_orderdate").cast("date")
    return (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    )


def collect_ids(spark, folder):
    rows = O.nest(table(spark, folder, "lineitem"), ["l_suppkey"], F.col("l_partkey"), "part_ids")
    return rows.select("l_suppkey", F.explode("part_ids").alias("l_partkey"))


def collect_documents(spark, folder):
    line = F.struct("l_partkey", "l_quantity", "l_returnflag")
    rows = O.nest(table(spark, folder, "lineitem"), ["l_suppkey"], line, "lines")
    return rows.select("l_suppkey", F.explode("lines").alias("line")).select("l_suppkey", "line.*")


def distinct_tags(spark, folder):
    return plans.tag_days(typed_videos(spark, folder, "video_id", "trending_date", "tags"))


# ---------------------------------------------------------------- rankings


def latest_per_key(spark, folder):
    order = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    latest = O.first_per_key(table(spark, folder, "orders"), ["o_custkey"], order)
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


def best_per_key(spark, folder):
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    lines = table(spark, folder, "lineitem")
    return O.first_per_key(lines, ["l_suppkey", "l_returnflag"], order).select(
        "l_suppkey", "l_returnflag", "l_extendedprice", "l_orderkey"
    )


def top_n_per_group(spark, folder):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    top = O.top_n_per_group(table(spark, folder, "orders"), ["o_orderpriority"], order, 10, rank="rank")
    return top.select("o_orderpriority", "rank", "o_orderkey", "o_totalprice")


def top_k(spark, folder):
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return O.top_k(table(spark, folder, "lineitem"), order, 20).select("l_orderkey", "l_extendedprice")


# ---------------------------------------------------------------- scalar functions


def parse_trending_date(spark, folder):
    return videos(spark, folder, "video_id", "trending_date", "views").select(
        "video_id",
        C.parse_snapshot_date("trending_date").alias("date"),
        C.parse_snapshot_date("views").alias("not_a_date"),
    )


def week_bounds(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return O.with_week_bounds(rows, "date")


def sliding_periods(spark, folder):
    """Orders per 30-day period; counted per date first, so only dates are spread."""
    dates = table(spark, folder, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date"))
    return (
        O.explode_periods(dates.agg(F.count("*").alias("n")), "date")
        .groupBy("start_date", "end_date")
        .agg(F.sum("n").alias("n_orders"))
    )


def split_tags(spark, folder):
    return O.explode_tags(videos(spark, folder, "video_id", "tags")).select("video_id", "tag")


def array_spread(spark, folder):
    rows = typed_videos(spark, folder, "video_id", "views", "likes", "dislikes")
    return rows.select("video_id", C.spread(F.array("views", "likes", "dislikes")).alias("spread"))


def array_len(spark, folder):
    rows = videos(spark, folder, "video_id", "tags")
    return rows.select("video_id", F.size(C.split_tags("tags")).cast("long").alias("n_tags"))


def like_ratio(spark, folder):
    rows = typed_videos(spark, folder, "video_id", "likes", "dislikes")
    return rows.select("video_id", C.ratio("likes", "dislikes").alias("ratio"))


def minute_key(spark, folder):
    return messages(spark, folder).select(
        "tweet_id", C.minute_text("created_at").alias("minute"), C.minute_key("created_at").alias("minute_key")
    )


QUERIES = {
    "scan_csv_typed": (scan_csv_typed, SCAN_CSV_TYPED_SQL),
    "scan_csv_multiline": (scan_csv_multiline, SCAN_CSV_MULTILINE_SQL),
    "scan_videos_csv": (scan_videos_csv, f"{VIDEOS_SQL} SELECT * FROM raw"),
    "read_category_documents": (
        read_category_documents,
        "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS title FROM customer",
    ),
    "flatten_items": (flatten_items, FLATTEN_ITEMS_SQL),
    "read_variant_documents": (
        read_variant_documents,
        """SELECT CAST(c_nationkey AS BIGINT) AS nation, CAST(c_custkey AS BIGINT) AS id, c_name AS title,
                  c_mktsegment AS segment FROM customer""",
    ),
    "find_fields": (
        find_fields,
        """SELECT count(*) AS n_documents, 'OBJECT<event_id: BIGINT, event_type: STRING, rare: BIGINT>' AS schema FROM events""",
    ),
    "profile_table": (profile_table, PROFILE_TABLE_SQL),
    "row_count": (row_count, "SELECT count(*) AS n_rows FROM lineitem"),
    "project_rename": (
        project_rename,
        "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice FROM orders",
    ),
    "cast_measures": (
        cast_measures,
        f"""{VIDEOS_SQL} SELECT video_id, views, likes, dislikes,
            TRY_CAST(tags AS BIGINT) AS not_a_number, -likes AS cut_likes, views AS cut_views FROM videos""",
    ),
    "struct_fields": (
        struct_fields,
        "SELECT l_orderkey AS order_id, l_quantity AS quantity, l_returnflag AS flag FROM lineitem",
    ),
    "derive_delta": (
        derive_delta,
        f"""{VIDEOS_SQL} SELECT video_id, max(views) - min(views) AS views_gained
            FROM videos GROUP BY video_id""",
    ),
    "filter_views": (filter_views, f"{VIDEOS_SQL} SELECT video_id, views FROM videos WHERE views > 100000"),
    "having_repeat": (
        having_repeat,
        f"""{VIDEOS_SQL} SELECT CAST(CAST(date_trunc('week', date) AS DATE) AS VARCHAR) AS start_date,
            video_id, category_id, max(views) - min(views) AS views_gained
            FROM videos WHERE date IS NOT NULL GROUP BY 1, 2, 3 HAVING count(video_id) >= 2""",
    ),
    "join_using_left": (
        join_using_left,
        f"""{VIDEOS_SQL} SELECT v.video_id, v.views, v.likes, c.n_rows, s.sum_likes FROM videos v
            LEFT JOIN (SELECT video_id, count(views) AS n_rows FROM videos GROUP BY 1) c
                ON v.video_id = c.video_id
            LEFT JOIN (SELECT video_id, CAST(sum(likes) AS BIGINT) AS sum_likes FROM videos GROUP BY 1) s
                ON v.video_id = s.video_id""",
    ),
    "join_dimension": (
        join_dimension,
        f"""{VIDEOS_SQL} SELECT v.video_id, v.category_id, v.views, c.title AS category_name
            FROM videos v LEFT JOIN categories c ON v.category_id = c.id""",
    ),
    "join_mapping_fanout": (
        join_mapping_fanout,
        f"""{VIDEOS_SQL} SELECT v.video_id, v.views, m.channel_title
            FROM (SELECT video_id, max(views) AS views FROM videos GROUP BY 1) v
            LEFT JOIN (SELECT DISTINCT video_id, channel_title FROM videos) m ON v.video_id = m.video_id""",
    ),
    "count_per_key": (
        count_per_key,
        "SELECT o_custkey, count(o_orderdate) AS n_orders FROM orders GROUP BY o_custkey",
    ),
    "sum_per_key": (
        sum_per_key,
        """SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_quantity
           FROM lineitem GROUP BY l_partkey""",
    ),
    "date_span_per_key": (
        date_span_per_key,
        """SELECT o_custkey, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_date,
           CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_date FROM orders GROUP BY o_custkey""",
    ),
    "collect_ids": (collect_ids, "SELECT l_suppkey, l_partkey FROM lineitem"),
    "collect_documents": (
        collect_documents,
        "SELECT l_suppkey, l_partkey, l_quantity, l_returnflag FROM lineitem",
    ),
    "distinct_tags": (
        distinct_tags,
        f"""{VIDEOS_SQL} SELECT DISTINCT video_id, unnest(string_split(replace(tags, '"', ''), '|')) AS tag,
            CAST(date AS VARCHAR) AS date FROM videos""",
    ),
    "latest_per_key": (
        latest_per_key,
        """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
           (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
           WHERE rn = 1""",
    ),
    "best_per_key": (
        best_per_key,
        """SELECT l_suppkey, l_returnflag, l_extendedprice, l_orderkey FROM (SELECT *, row_number() OVER
           (PARTITION BY l_suppkey, l_returnflag
            ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem)
           WHERE rn = 1""",
    ),
    "top_n_per_group": (
        top_n_per_group,
        """SELECT o_orderpriority, rank, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
           (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
           WHERE rank <= 10""",
    ),
    "top_k": (
        top_k,
        """SELECT l_orderkey, l_extendedprice FROM lineitem
           ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 20""",
    ),
    "parse_trending_date": (
        parse_trending_date,
        f"""{VIDEOS_SQL} SELECT video_id,
            CAST(CAST(try_strptime(trending_date, '%y.%d.%m') AS DATE) AS VARCHAR) AS date,
            CAST(CAST(try_strptime(views, '%y.%d.%m') AS DATE) AS VARCHAR) AS not_a_date FROM raw""",
    ),
    "week_bounds": (
        week_bounds,
        """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
           CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS start_date,
           CAST(CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS VARCHAR) AS end_date FROM orders""",
    ),
    "sliding_periods": (
        sliding_periods,
        """SELECT CAST(end_date - 30 AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
           count(*) AS n_orders
           FROM (SELECT CAST(o_orderdate AS DATE) + CAST(r.i AS INTEGER) AS end_date
                 FROM orders, range(0, 30) r(i)) GROUP BY end_date""",
    ),
    "split_tags": (
        split_tags,
        f"""{VIDEOS_SQL} SELECT video_id, unnest(string_split(replace(tags, '"', ''), '|')) AS tag FROM raw""",
    ),
    "array_spread": (
        array_spread,
        f"""{VIDEOS_SQL} SELECT video_id,
            greatest(views, likes, dislikes) - least(views, likes, dislikes) AS spread FROM videos""",
    ),
    "array_len": (
        array_len,
        f"""{VIDEOS_SQL} SELECT video_id,
            CAST(len(string_split(replace(tags, '"', ''), '|')) AS BIGINT) AS n_tags FROM raw""",
    ),
    "like_ratio": (
        like_ratio,
        f"""{VIDEOS_SQL} SELECT video_id,
            CASE WHEN dislikes = 0 THEN NULL ELSE CAST(likes AS DOUBLE) / dislikes END AS ratio FROM videos""",
    ),
    "minute_key": (
        minute_key,
        """SELECT CAST(event_id AS VARCHAR) AS tweet_id, strftime(sent, '%Y-%m-%d %H:%M') AS minute,
           strftime(sent, '%Y_%m_%d_%H_%M') || '_00' AS minute_key
           FROM (SELECT event_id, TIMESTAMP '2024-01-01' + to_seconds(event_id * 90 // 1000) AS sent
                 FROM events)""",
    ),
}
