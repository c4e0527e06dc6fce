"""Filters, counts, joins, dates: queries and their SQL."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from socialtext.catalog.registry import query, table
from socialtext.catalog.texts import GRAM_SQL
from socialtext.functions import dates
from socialtext.operators import counts, filters, joins, merge, reshape, sampling
from socialtext.session import ensure_checkpoint_dir, without_leftovers
from socialtext.sources import categories, incremental, readers

START, END = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20, 12)


@query("range_language_filter", """
    SELECT event_id, user_id, event_type FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'
      AND event_type IN ('click', 'view')""")
def range_language_filter(spark, sf):
    return readers.in_range(table(spark, sf, "events"), START, END, ["click", "view"], time_col="ts",
                            language_col="event_type").select("event_id", "user_id", "event_type")


@query("export_filter", """
    SELECT o_orderkey AS id, o_custkey AS user_id FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-06-30' AND o_orderstatus = 'F'
      AND o_orderpriority <> '5-LOW'""")
def export_filter(spark, sf):
    posts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("created"),
        F.col("o_orderstatus").alias("language"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderkey")).alias("retweet_id"))
    return filters.export_filter(posts, dt.datetime(1997, 1, 1), dt.datetime(1998, 6, 30), "F").select("id", "user_id")


@query("open_ended_filter", """
    SELECT 'before' AS side, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1997-05-01'
    UNION ALL SELECT 'since', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-01'""")
def open_ended_filter(spark, sf):
    orders, edge = table(spark, sf, "orders"), dt.datetime(1997, 5, 1)
    before = filters.created_before(orders, edge, "o_orderdate").agg(F.count(F.lit(1)).alias("n"))
    since = filters.created_since(orders, edge, "o_orderdate").agg(F.count(F.lit(1)).alias("n"))
    return reshape.labelled_union([(before, {"side": "before"}), (since, {"side": "since"})])


@query("any_present_filter", """
    SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL OR l.toxic IS NOT NULL""")
def any_present_filter(spark, sf):
    both = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return both.filter(filters.any_present(["quality", "toxic"])).select("doc_id", "lang")


@query("junk_text_filter", """
    SELECT doc_id, source, n_chars FROM documents
    WHERE text NOT IN ('[deleted]', '[removed]') AND text NOT LIKE '%has been removed%'
      AND text NOT LIKE '%has been overwritten%' AND text NOT LIKE '%performed automatically%'
      AND text NOT LIKE '%bot action performed%' AND text NOT LIKE '%autowikibot%' AND text NOT LIKE '%I am a bot%'
      AND length(text) > 0 AND n_chars >= 200 AND lang IN ('en', 'fr')""")
def junk_text_filter(spark, sf):
    docs = table(spark, sf, "documents")
    kept = filters.comment_filter(docs, ["en", "fr"], None, 200, body="text", group="lang", author="source",
                                  score="n_chars")
    return kept.select("doc_id", "source", "n_chars")


@query("sigma_filter", """
    WITH s AS (SELECT avg(log10(l_quantity + 1)) AS qm, stddev_samp(log10(l_quantity + 1)) AS qs,
                      avg(log10(l_extendedprice + 1)) AS pm, stddev_samp(log10(l_extendedprice + 1)) AS ps FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem, s
    WHERE log10(nullif(l_quantity, 0)) BETWEEN qm - 1.5 * qs AND qm + 1.5 * qs
      AND log10(nullif(l_extendedprice, 0)) BETWEEN pm - 1.5 * ps AND pm + 1.5 * ps""")
def sigma_filter(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return filters.sigma_filter(items, ["l_quantity", "l_extendedprice"], 1.5).select(
        "l_orderkey", "l_linenumber", "l_partkey")


@query("log_statistics", """
    SELECT round(avg(log10(l_quantity + 1)), 6) AS l_quantity_mean,
           round(stddev_samp(log10(l_quantity + 1)), 6) AS l_quantity_std,
           round(avg(log10(l_extendedprice + 1)), 6) AS l_extendedprice_mean,
           round(stddev_samp(log10(l_extendedprice + 1)), 6) AS l_extendedprice_std FROM lineitem""")
def log_statistics(spark, sf):
    stats = counts.log_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


ROOT_N = """
    SELECT * EXCLUDE (rn, n) FROM (
      SELECT event_id, user_id, event_type, value,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
             count(*) OVER (PARTITION BY user_id) AS n
      FROM events WHERE event_type <> 'error') WHERE rn <= ceil(sqrt(n))
    UNION ALL SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'error'"""


def _root_n(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return sampling.root_n_sample(events, F.when(F.col("event_type") != "error", F.col("user_id")), ["event_id"])


@query("root_n_sample", f"SELECT event_id, user_id, event_type FROM ({ROOT_N})")
def root_n_sample(spark, sf):
    return _root_n(spark, sf).select("event_id", "user_id", "event_type")


@query("sampled_semi_intersection", f"""
    WITH r AS ({ROOT_N}),
    s AS (SELECT avg(log10(value + 1)) AS m, stddev_samp(log10(value + 1)) AS d FROM events),
    u AS (SELECT event_id FROM events, s WHERE log10(nullif(value, 0)) BETWEEN m - d AND m + d)
    SELECT event_id, user_id FROM r WHERE event_id IN (SELECT event_id FROM u)""")
def sampled_semi_intersection(spark, sf):
    usual = filters.sigma_filter(table(spark, sf, "events"), ["value"], 1.0)
    return sampling.both_filters(_root_n(spark, sf), usual, ["event_id"]).select("event_id", "user_id")


@query("top_score_per_group", """
    SELECT doc_id, source, n_chars FROM (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn FROM documents)
    WHERE rn <= 10""")
def top_score_per_group(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return sampling.top_per_group(docs, ["source"], [F.desc("n_chars"), F.asc("doc_id")], 10, ["doc_id"])


@query("random_per_group", """
    SELECT doc_id, source FROM (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('24|' || doc_id), doc_id) AS rn FROM documents)
    WHERE rn <= 10""")
def random_per_group(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return sampling.random_per_group(docs, ["source"], 10, ["doc_id"])


@query("balanced_downsample", """
    SELECT doc_id, toxic FROM (
      SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY md5('24|' || doc_id), doc_id) AS rn
      FROM labels WHERE toxic IS NOT NULL)
    WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels WHERE toxic IS NOT NULL GROUP BY toxic))""")
def balanced_downsample(spark, sf):
    return sampling.balanced_downsample(table(spark, sf, "labels"), "toxic", ["doc_id"]).select("doc_id", "toxic")


@query("smallest_class", """
    SELECT min(n) AS smallest FROM (SELECT count(*) AS n FROM documents GROUP BY lang)""")
def smallest_class(spark, sf):
    return counts.smallest_class(table(spark, sf, "documents"), "lang")


@query("shuffled_order", """
    SELECT doc_id, row_number() OVER (ORDER BY md5('24|' || doc_id), doc_id) AS place FROM labels""")
def shuffled_order(spark, sf):
    return sampling.hash_place(table(spark, sf, "labels").select("doc_id"), [], ["doc_id"])


@query("cascade_counts", """
    SELECT user_id AS original, count(*) AS "count" FROM events WHERE event_type <> 'error' GROUP BY user_id""")
def cascade_counts(spark, sf):
    return counts.cascade_counts(table(spark, sf, "events"),
                                 F.when(F.col("event_type") != "error", F.col("user_id")))


@query("duplicate_ledger", """
    SELECT CAST(coalesce(sum(n), 0) - count(*) AS BIGINT) AS duplicates
    FROM (SELECT count(*) AS n FROM documents GROUP BY text)""")
def duplicate_ledger(spark, sf):
    keys = table(spark, sf, "documents").select(merge.text_key(F.col("text")).alias("key"))
    return counts.duplicate_total(counts.id_counts(keys, "key"))


@query("duplicate_ledger_update", """
    SELECT user_id, count(*) AS copies FROM events WHERE user_id IS NOT NULL GROUP BY user_id""")
def duplicate_ledger_update(spark, sf):
    events = table(spark, sf, "events")
    edge = dt.datetime(2024, 1, 10)
    known = counts.id_counts(filters.created_before(events, edge, "ts"), "user_id")
    new = counts.id_counts(filters.created_since(events, edge, "ts"), "user_id")
    return counts.merge_id_counts(known, new, "user_id")


@query("keep_first", """
    SELECT min(doc_id) AS doc_id FROM documents GROUP BY text""")
def keep_first(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", merge.text_key(F.col("text")).alias("key"))
    return merge.keep_first(docs, ["key"], [F.asc("doc_id")]).select("doc_id")


@query("insert_ignore", """
    WITH e AS (SELECT *, hour(ts) AS h FROM events),
    t AS (SELECT DISTINCT user_id, event_type, h FROM e WHERE ts < TIMESTAMP '2024-01-10'),
    b AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, h ORDER BY ts, event_id) AS rn
          FROM e WHERE ts >= TIMESTAMP '2024-01-10')
    SELECT event_id, user_id FROM b WHERE rn = 1 AND NOT EXISTS (
      SELECT 1 FROM t WHERE t.user_id = b.user_id AND t.event_type = b.event_type AND t.h = b.h)""")
def insert_ignore(spark, sf):
    events = table(spark, sf, "events").withColumn("h", F.hour("ts"))
    edge = dt.datetime(2024, 1, 10)
    target, batch = filters.created_before(events, edge, "ts"), filters.created_since(events, edge, "ts")
    return merge.insert_ignore(target, batch, ["user_id", "event_type", "h"], [F.asc("ts"), F.asc("event_id")]).select(
        "event_id", "user_id")


@query("newest_wins", """
    SELECT event_id, user_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC,
                                   CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 0 ELSE 1 END, event_id) AS rn FROM events)
    WHERE rn = 1""")
def newest_wins(spark, sf):
    events, edge = table(spark, sf, "events"), dt.datetime(2024, 1, 10)
    return merge.newest_wins(
        filters.created_before(events, edge, "ts"), filters.created_since(events, edge, "ts"),
        ["user_id", "event_type"], "ts", [F.asc("event_id")]).select("event_id", "user_id", "event_type")


@query("daily_counts", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def daily_counts(spark, sf):
    return counts.daily_counts(table(spark, sf, "events"), "ts")


@query("running_total", """
    SELECT day, n, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS total
    FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)""")
def running_total(spark, sf):
    return counts.running_total(counts.daily_counts(table(spark, sf, "events"), "ts"))


SLICE_FROM, SLICE_TO = dt.datetime(1996, 1, 1), dt.datetime(1999, 12, 31)


@query("time_slice_counts", """
    WITH e AS (SELECT range AS s, TIMESTAMP '1996-01-01' + INTERVAL (range * 1460 / 8 * 86400) SECOND AS a,
                      TIMESTAMP '1996-01-01' + INTERVAL ((range + 1) * 1460 / 8 * 86400) SECOND AS b FROM range(8))
    SELECT s AS slice, count(o_orderkey) AS n FROM e LEFT JOIN orders
      ON o_orderdate >= a AND (o_orderdate < b OR (s = 7 AND o_orderdate = b)) GROUP BY s""")
def time_slice_counts(spark, sf):
    return counts.time_slice_counts(table(spark, sf, "orders"), SLICE_FROM, SLICE_TO, 8, "o_orderdate")


@query("time_slice_counts_inclusive", """
    WITH e AS (SELECT range AS s, TIMESTAMP '1996-01-01' + INTERVAL (range * 1460 / 20) DAY AS a,
                      TIMESTAMP '1996-01-01' + INTERVAL ((range + 1) * 1460 / 20) DAY AS b FROM range(20))
    SELECT s AS slice, count(o_orderkey) AS n FROM e LEFT JOIN orders ON o_orderdate BETWEEN a AND b GROUP BY s""")
def time_slice_counts_inclusive(spark, sf):
    return counts.time_slice_counts(table(spark, sf, "orders"), SLICE_FROM, SLICE_TO, 20, "o_orderdate",
                                    edges="inclusive")


@query("partition_counts", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS tw_year, CAST(month(o_orderdate) AS INTEGER) AS tw_month,
           CAST(day(o_orderdate) AS INTEGER) AS tw_day, count(*) AS n
    FROM orders GROUP BY 1, 2, 3""")
def partition_counts(spark, sf):
    return counts.partition_counts(dates.with_date_parts(table(spark, sf, "orders"), "o_orderdate"))


@query("month_range", """
    SELECT strftime(o_orderdate, '%Y_%m') AS month, count(*) AS n FROM orders
    WHERE strftime(o_orderdate, '%Y_%m') BETWEEN '1996_11' AND '1997_02' GROUP BY 1""")
def month_range(spark, sf):
    orders = table(spark, sf, "orders").withColumn("month", dates.month_name(F.col("o_orderdate")))
    return readers.month_range(orders, "1996_11", "1997_02").groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query("month_arithmetic", """
    SELECT o_orderkey, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 3 AS INTEGER) AS months,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month,
           strftime(o_orderdate, '%Y-%m-%d') AS folder, CAST(CAST(o_orderdate AS DATE) + 7 AS DATE) AS next_week FROM orders""")
def month_arithmetic(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.month_difference(day, F.lit(dt.date(1995, 3, 1))).cast("int").alias("months"),
        dates.shift_months(day.cast("date"), 1).alias("next_month"), dates.day_folder(day, "-").alias("folder"),
        F.date_add(day.cast("date"), 7).alias("next_week"))


@query("date_parts", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS tw_year, CAST(month(o_orderdate) AS INTEGER) AS tw_month,
           CAST(day(o_orderdate) AS INTEGER) AS tw_day FROM orders""")
def date_parts(spark, sf):
    return dates.with_date_parts(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop(
        "o_orderdate")


@query("created_at_parse", """
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS created FROM events""")
def created_at_parse(spark, sf):
    ts = F.col("ts").cast("timestamp")
    text = F.date_format(ts, "EEE MMM dd HH:mm:ss '+0000' yyyy")
    return table(spark, sf, "events").select(
        "event_id", F.date_format(dates.parse_created_at(text), "yyyy-MM-dd HH:mm:ss").alias("created"))


@query("key_join", """
    SELECT n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def key_join(spark, sf):
    posts = table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), "o_totalprice")
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    # Orders per account first: the joins then see one row per account.
    per_user = posts.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    joined = joins.posts_with_users(per_user, users).join(nations, F.col("user_n_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("payload_join", """
    SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def payload_join(spark, sf):
    posts = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    payload = table(spark, sf, "labels").select(F.col("doc_id").alias("tweet_id"), "quality")
    return joins.posts_with_payload(posts, payload).select(F.col("id").alias("doc_id"), "quality")


@query("locate_users", """
    SELECT c_custkey AS user_id, r_name AS address, CAST(n_nationkey * 2 AS DOUBLE) AS longitude,
           CAST(n_nationkey * 3 AS DOUBLE) AS latitude
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def locate_users(spark, sf):
    users = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("  Nation -- "), F.col("c_nationkey").cast("string"), F.lit("! ")).alias("located"))
    gazetteer = (table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
                 .select(F.replace("n_name", F.lit("_"), F.lit(" ")).alias("address_text"), F.col("r_name").alias("address"),
                         (F.col("n_nationkey") * 2).cast("double").alias("longitude"),
                         (F.col("n_nationkey") * 3).cast("double").alias("latitude")))
    return joins.locate(users, gazetteer)


@query("keys_to_do", """
    SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (
      SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def keys_to_do(spark, sf):
    return incremental.keys_to_do(table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id")),
                                  table(spark, sf, "orders").filter("o_totalprice > 400000"), "user_id", "o_custkey")


@query("days_to_do", """
    SELECT DISTINCT strftime(o_orderdate, '%Y_%m_%d') AS folder FROM orders
    EXCEPT SELECT strftime(l_shipdate, '%Y_%m_%d') FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45""")
def days_to_do(spark, sf):
    done = table(spark, sf, "lineitem").filter("l_returnflag = 'R' and l_quantity > 45")
    return incremental.days_to_do(
        table(spark, sf, "orders").select(dates.day_folder(F.col("o_orderdate")).alias("folder")),
        done.select(dates.day_folder(F.col("l_shipdate")).alias("folder")))


@query("distinct_counts", """
    SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT event_type) AS event_type, count(DISTINCT props) AS props
    FROM events""")
def distinct_counts(spark, sf):
    return counts.distinct_counts(table(spark, sf, "events"), ["user_id", "event_type", "props"])


@query("quotes_itself", """
    SELECT l_orderkey AS id FROM lineitem WHERE l_suppkey = l_linenumber""")
def quotes_itself(spark, sf):
    posts = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("quote_id"), F.col("l_linenumber").alias("retweet_id"))
    return filters.quotes_itself(posts).select("id")


@query("point_lookup", """
    SELECT o_orderkey AS id, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 77""")
def point_lookup(spark, sf):
    return filters.by_id(table(spark, sf, "orders").withColumnRenamed("o_orderkey", "id"), 77).select(
        "id", "o_custkey", "o_orderstatus")


@query("set_operations", """
    SELECT s_nationkey AS k FROM supplier UNION SELECT c_nationkey FROM customer
    EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 0""")
def set_operations(spark, sf):
    both = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")).unionByName(
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")))
    return both.subtract(table(spark, sf, "nation").filter("n_regionkey = 0").select(F.col("n_nationkey").alias("k")))


@query("labelled_union", """
    SELECT c_custkey AS key, 'customer' AS chamber, 115 AS congress_num FROM customer
    UNION ALL SELECT s_suppkey, 'supplier', 116 FROM supplier""")
def labelled_union(spark, sf):
    return reshape.labelled_union([
        (table(spark, sf, "customer").select(F.col("c_custkey").alias("key")), {"chamber": "customer", "congress_num": 115}),
        (table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key")), {"chamber": "supplier", "congress_num": 116})])


@query("json_fields", """
    SELECT event_type, CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY event_type""")
def json_fields(spark, sf):
    parsed = F.from_json("props", T.StructType([T.StructField("k", T.LongType())]))
    return table(spark, sf, "events").select("event_type", parsed["k"].alias("k")).groupBy("event_type").agg(
        F.sum("k").alias("total"), F.count(F.lit(1)).alias("n"))


def _paths(spark, sf):
    return table(spark, sf, "documents").select(F.concat(
        F.lit("corpus/"), "lang", F.lit("-"), "source", F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".json.gz")).alias("path"))


@query("path_category", """
    SELECT lang || '-' || source AS category, count(*) AS files FROM documents
    WHERE regexp_matches(lang || '-' || source, '^(en|fr)-') GROUP BY 1""")
def path_category(spark, sf):
    catalog = categories.with_category(_paths(spark, sf), cat_pattern=r"(en|fr|de|es)-[^/]+")
    files = categories.files_of(catalog, "(en|fr)-")
    return catalog.join(files, "path").groupBy("category").agg(F.count(F.lit(1)).alias("files"))


@query("mapped_category", """
    SELECT 'corpus/' || lang || '-' || source || '/doc_' || d.doc_id || '.json.gz' AS path,
           CASE WHEN toxic = 1 THEN 'toxic' ELSE 'fine' END AS category
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def mapped_category(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.concat(
        F.lit("corpus/"), "lang", F.lit("-"), "source", F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".json.gz")).alias("path"))
    mapping = docs.join(table(spark, sf, "labels"), "doc_id").select(
        "path", F.when(F.col("toxic") == 1, "toxic").otherwise("fine").alias("category"))
    return categories.with_category(_paths(spark, sf), cat_map=mapping)


@query("category_list", "SELECT DISTINCT lang || '-' || source AS category FROM documents")
def category_list(spark, sf):
    return categories.categories_of(categories.with_category(_paths(spark, sf), cat_pattern=r"(en|fr|de|es)-[^/]+"))


@query("file_times", """
    SELECT strftime(ts, 'streamed_%d_%m_%Y_%H_%M_%S.json.gz') AS name,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS file_time FROM events WHERE day(ts) % 2 = 1""")
def file_times(spark, sf):
    names = table(spark, sf, "events").select(
        F.date_format("ts", "'streamed_'dd_MM_yyyy_HH_mm_ss'.json.gz'").alias("name"))
    files = categories.with_file_time(categories.name_matches(names, categories.STREAM_NAME))
    return categories.order_files(files, days="odd").select(
        "name", F.date_format("file_time", "yyyy-MM-dd HH:mm:ss").alias("file_time"))


_POST_SQL = """
    WITH c AS (SELECT *, conv_id * 1000 + turn AS id,
                      lag(conv_id * 1000 + turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_id,
                      lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_text FROM conversations)
"""


def _nested_posts(spark, sf):
    """Turns as posts: an answer reposts the turn before it, a later question quotes it."""
    from pyspark.sql import Window
    from socialtext.schemas import post_schema
    turn = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn")).withColumns({
        "prev_id": F.lag("id").over(turn), "prev_text": F.lag("text").over(turn)})
    before = F.when(F.col("prev_id").isNotNull(), F.struct(
        F.col("prev_id").alias("id"), F.col("prev_text").alias("text"),
        F.struct(F.concat(F.lit("long "), "prev_text").alias("full_text")).alias("extended_tweet"),
        F.struct(F.col("conv_id").alias("id")).alias("user")))
    post = F.struct(
        "id", "text", F.struct(F.col("conv_id").alias("id"), F.lit("").alias("location")).alias("user"),
        F.when(F.col("role") == "assistant", before).alias("retweeted_status"),
        F.when(F.col("role") == "user", before).alias("quoted_status"))
    return rows.select(F.from_json(F.to_json(post), post_schema()).alias("p")).select("p.*")


@query("embedded_explode", _POST_SQL + """
    SELECT id, count(*) AS copies FROM (
      SELECT id FROM c UNION ALL SELECT prev_id FROM c WHERE prev_id IS NOT NULL) GROUP BY id""")
def embedded_explode(spark, sf):
    return counts.id_counts(reshape.explode_embedded(_nested_posts(spark, sf)))


@query("post_rows", _POST_SQL + """
    SELECT id, conv_id AS user_id, CASE WHEN role = 'assistant' AND prev_id IS NOT NULL THEN 'long ' || prev_text ELSE text END AS full_text,
           CASE WHEN role = 'assistant' THEN prev_id END AS retweet_id, CASE WHEN role = 'user' THEN prev_id END AS quote_id
    FROM c
    UNION ALL SELECT prev_id, conv_id, 'long ' || prev_text, NULL, NULL FROM c WHERE prev_id IS NOT NULL""")
def post_rows(spark, sf):
    return reshape.post_rows(reshape.explode_embedded(_nested_posts(spark, sf))).select(
        "id", "user_id", "full_text", "retweet_id", "quote_id")


@query("user_rows", "SELECT DISTINCT conv_id AS user_id, CAST(NULL AS VARCHAR) AS located FROM conversations")
def user_rows(spark, sf):
    users = reshape.user_rows(reshape.explode_embedded(_nested_posts(spark, sf)))
    return merge.keep_first(users, ["user_id"], [F.asc("level_order")]).select("user_id", "located")


@query("flatten_nested", r"""
    SELECT doc_id, CAST(count(*) AS BIGINT) AS words, CAST(count(DISTINCT p) AS BIGINT) AS paragraphs FROM (
      SELECT doc_id, p, unnest(string_split(trim(s), ' ')) AS w FROM (
        SELECT doc_id, p, unnest(string_split(par, '.')) AS s FROM (
          SELECT doc_id, generate_subscripts(ps, 1) AS p, unnest(ps) AS par
          FROM (SELECT doc_id, string_split(text, chr(10)) AS ps FROM documents))))
    WHERE w <> '' GROUP BY doc_id""")
def flatten_nested(spark, sf):
    paragraphs = F.transform(F.split("text", "\n"), lambda p: F.transform(
        F.split(p, r"\."), lambda s: F.split(F.trim(s), " ")))
    words = readers.flatten_nested(table(spark, sf, "documents").select("doc_id", paragraphs.alias("paragraphs")))
    return words.filter("word <> ''").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"), F.count_distinct("paragraph").alias("paragraphs"))


@query("sample_comments", """
    WITH c AS (SELECT o_orderkey AS id, o_orderstatus AS subreddit, CAST(floor(o_totalprice) AS INTEGER) AS score,
                      strftime(o_orderdate, '%Y_%m') AS month FROM orders
               WHERE strftime(o_orderdate, '%Y_%m') BETWEEN '1996_03' AND '1996_08' AND floor(o_totalprice) >= 1000
                 AND o_orderstatus IN ('F', 'O'))
    SELECT month, subreddit, id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY month, subreddit ORDER BY score DESC, CAST(id AS VARCHAR)) AS rn FROM c)
    WHERE rn <= 7""")
def sample_comments(spark, sf):
    from socialtext.plans.comments import sample_comments as sample
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("body"),
        F.col("o_orderstatus").alias("subreddit"), F.col("o_custkey").cast("string").alias("author"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("created_utc"), F.lit("l").alias("link_id"),
        F.lit("p").alias("parent_id"), F.floor("o_totalprice").cast("int").alias("score"))
    out = sample(orders, ("1996_03", "1996_08"), ["F", "O"], None, 1000, 7, True)
    return out.select("month", "subreddit", F.col("id").cast("long").alias("id"), "score")


def _event_stream(spark, sf):
    return (spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet")
            .parquet(sf).withColumn("time", F.col("ts").cast("timestamp")))


def _stream_result(spark, rows, mode):
    """Run a stream over the files at hand into a table in the shared checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    writer = rows.writeStream.option("checkpointLocation", f"{base}/ledger").outputMode(mode).trigger(availableNow=True)
    if mode == "append":
        run = writer.format("parquet").start(f"{base}/rows")
    else:
        run = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{base}/rows")).start()
    run.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")


@query("repeated_ids_stream", "SELECT DISTINCT event_id FROM events")
def repeated_ids_stream(spark, sf):
    """Every event twice, as a stream of files; the repeats are dropped."""
    from socialtext.streaming.intake import without_repeats
    twice = _event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = without_repeats(twice, "time", "event_id").select("event_id")
    return _stream_result(spark, rows, "append")


@query("window_counts_stream", """
    SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1""")
def window_counts_stream(spark, sf):
    """Daily counts by a stream in complete mode, so the open last window is given too."""
    from socialtext.streaming.intake import window_counts
    rows = _stream_result(spark, window_counts(_event_stream(spark, sf), "time"), "complete")
    return rows.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "n")


#: Posts in one line of a file, at most.
LINE_POSTS = 5000


def _lines(batches):
    """``part, value`` from ``part, line, p`` with the rows of a line together: JSON arrays of up to ``LINE_POSTS`` texts."""
    key, texts = None, []

    def line():
        return pa.RecordBatch.from_pydict({"part": pa.array([key[0]], pa.string()), "value": pa.array([json.dumps(texts, ensure_ascii=False)], pa.string())})

    for batch in batches:
        for *new, text in zip(*(batch.column(c).to_pylist() for c in ("part", "line", "p"))):
            if texts and (new != key or len(texts) >= LINE_POSTS):
                yield line()
                texts = []
            key = new
            texts.append(text)
    if texts:
        yield line()


def _post_files(spark, sf, folder: str) -> None:
    """Documents as nested posts in files of JSON arrays of JSON texts; ``lang`` and ``source`` are fields that no schema declares."""
    docs = table(spark, sf, "documents")
    entities = F.struct("lang", F.struct(F.col("source").alias("name")).alias("app"))
    post = F.to_json(F.struct(F.col("doc_id").alias("id"), F.lit("Thu Apr 02 10:00:00 +0000 2020").alias("created_at"), "text",
                              F.struct((F.col("doc_id") % 97 + 1).alias("id")).alias("user"), entities.alias("entities")))
    name = F.format_string("streamed_02_04_2020_%02d_00_00", (F.col("doc_id") % 4).cast("int"))
    posts = docs.select(name.alias("part"), (F.col("doc_id") % 16).alias("line"), post.alias("p")).repartition("part", "line").sortWithinPartitions("part", "line")
    with without_leftovers(spark):
        posts.mapInArrow(_lines, "part string, value string").write.partitionBy("part").text(folder)


def _ingested(spark, sf, stream: bool):
    from socialtext.operators.language import fit_profiles
    from socialtext.plans.ingest import ingest_batch, stored
    from socialtext.session import stored as kept
    from socialtext.streaming.intake import post_stream, start_intake
    base = f"{ensure_checkpoint_dir(spark)}/intake-{uuid.uuid4().hex}"
    _post_files(spark, sf, f"{base}/raw")
    profiles = kept(fit_profiles(table(spark, sf, "documents"), "text", "lang"), "profiles")
    tables = ("tweet", "entity")
    for turn in range(2):
        if stream:
            posts = post_stream(spark, f"{base}/raw/*", max_files=2, whole=True)
            start_intake(posts, f"{base}/store", f"{base}/ledger{turn}", tables=tables, profiles=profiles).awaitTermination()
        else:
            ingest_batch(readers.read_nested_json(spark, f"{base}/raw", whole=True), f"{base}/store", tables, profiles)
    tweets, payload = (stored(spark, f"{base}/store/{name}") for name in tables)
    english = filters.export_filter(tweets, dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1), "en")
    return (english.join(payload.select(F.col("tweet_id").alias("id"), "entities"), "id")
            .select("id", "user_id", F.char_length("full_text").cast("long").alias("chars"), F.get_json_object("entities", "$.lang").alias("lang"),
                    F.get_json_object("entities", "$.app.name").alias("source")))


_INGESTED_SQL = GRAM_SQL + """,
    b AS (SELECT doc_id, language FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, language DESC) = 1)
    SELECT d.doc_id AS id, d.doc_id % 97 + 1 AS user_id, length(text) AS chars, lang, source FROM documents d JOIN b USING (doc_id)
    WHERE language = 'en'"""


@query("intake_batch", _INGESTED_SQL)
def intake_batch(spark, sf):
    """The same files ingested twice, with the language of each post; English ones, with undeclared fields of their records."""
    return _ingested(spark, sf, stream=False)


@query("intake_stream", _INGESTED_SQL)
def intake_stream(spark, sf):
    """The same as a stream of files, read twice with two ledgers, as after a lost one."""
    return _ingested(spark, sf, stream=True)


@query("store_newest", """
    WITH b AS (SELECT o_orderkey AS id, o_orderdate AS stamp, o_totalprice AS price FROM orders),
    c AS (SELECT id, stamp + INTERVAL (CASE WHEN id % 4 = 0 THEN -1 ELSE 1 END) DAY AS stamp, price + 1 AS price FROM b WHERE id % 3 = 0)
    SELECT id, CASE WHEN c.stamp > b.stamp THEN c.stamp ELSE b.stamp END AS stamp, round(CASE WHEN c.stamp > b.stamp THEN c.price ELSE b.price END, 2) AS price
    FROM b LEFT JOIN c USING (id)""")
def store_newest(spark, sf):
    """A store of orders, then a batch of later and earlier versions of every third one: only the buckets of the batch are replaced."""
    from socialtext.plans.store import KeyedStore
    store = KeyedStore(f"{ensure_checkpoint_dir(spark)}/orders-{uuid.uuid4().hex}", "id", span=4096)
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("stamp"), F.col("o_totalprice").alias("price"))
    store.append(store.new_rows(rows, [F.col("stamp")]))
    days = F.when(F.col("id") % 4 == 0, -1).otherwise(1)
    later = rows.where("id % 3 = 0").select("id", (F.col("stamp") + F.make_dt_interval(days)).alias("stamp"), (F.col("price") + 1).alias("price"))
    for _ in range(2):
        store.replace_newest(later, "stamp")
    return store.read(spark).select("id", "stamp", F.round("price", 2).alias("price"))
