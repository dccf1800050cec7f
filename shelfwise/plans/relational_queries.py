"""Projections, filters, joins, aggregation, windows and scalar functions over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.scalars import day, flag, number_or, r6
from shelfwise.operators import ids, relational as rel
from shelfwise.plans.registry import TARGET, query
from shelfwise.session import durable
from shelfwise.sources.tables import latest_by_time
from shelfwise.sources.text import as_json, parse_delimited, parse_json

UI = "ui AS (SELECT DISTINCT o_custkey u, l_partkey i FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"


def _ui(t):
    return rel.order_pairs(t.orders, t.lineitem)


@query("project", "SELECT p_partkey, lower(p_brand) AS brand_lower, p_retailprice * 2 AS price2 FROM part")
def project(t):
    return t.part.select("p_partkey", F.lower("p_brand").alias("brand_lower"), (F.col("p_retailprice") * 2).alias("price2"))


@query("filter_eq", "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag = 'R'")
def filter_eq(t):
    return t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")


@query("sort_multi", "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey DESC")
def sort_multi(t):
    return t.orders.select("o_custkey", "o_orderkey").orderBy("o_custkey", F.desc("o_orderkey"))


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk(t):
    return rel.top_k(t.orders.select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query(
    "cast_defaults",
    """
    SELECT event_id, coalesce(try_cast(CASE WHEN event_id % 7 = 0 THEN 'null' WHEN event_id % 11 = 0 THEN 'x'
           ELSE json_extract_string(props, '$.k') END AS double), 0) AS v FROM events
    """,
)
def cast_defaults(t):
    text = (
        F.when(F.col("event_id") % 7 == 0, "null")
        .when(F.col("event_id") % 11 == 0, "x")
        .otherwise(F.get_json_object("props", "$.k"))
    )
    return t.events.select("event_id", number_or(text).alias("v"))


@query(
    "parse_delimited",
    """
    SELECT o_custkey AS user_id, o_orderkey AS item_id, o_totalprice AS rating,
           CAST(epoch(o_orderdate) AS bigint) AS ts FROM orders
    """,
)
def parse_delimited_lines(t):
    lines = t.orders.select(
        F.concat_ws("::", "o_custkey", "o_orderkey", "o_totalprice", F.unix_timestamp("o_orderdate")).alias("value")
    )
    good, _ = parse_delimited(lines, {"user_id": "long", "item_id": "long", "rating": "double", "ts": "long"})
    return good


@query(
    "json_extract",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS int) AS k,
           '{"event_id":' || event_id || ',"k":' || json_extract_string(props, '$.k') || '}' AS row_json FROM events
    """,
)
def json_extract(t):
    parsed = parse_json(t.events, "props", "k int").select("event_id", "parsed.k")
    return parsed.withColumn("row_json", as_json("event_id", "k"))


@query(
    "latest_partition",
    """
    SELECT event_id, strftime(ts, '%Y%m%d') AS etldate FROM events
    WHERE strftime(ts, '%Y%m%d') = (SELECT max(strftime(ts, '%Y%m%d')) FROM events)
    """,
)
def latest_partition(t):
    return latest_by_time(t.events, "ts").select("event_id", day(F.col("ts")).alias("etldate"))


@query("state_flag", "SELECT event_id, CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END::double AS state FROM events")
def state_flag(t):
    return t.events.select("event_id", flag(F.col("event_type") == "error").alias("state"))


@query("join_inner", "SELECT o_orderkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def join_inner(t):
    return t.orders.join(t.lineitem, t.orders["o_orderkey"] == t.lineitem["l_orderkey"]).select("o_orderkey", "l_partkey")


@query(
    "join_using",
    """
    SELECT k, o_custkey, l_partkey FROM (SELECT o_orderkey AS k, o_custkey FROM orders)
    JOIN (SELECT l_orderkey AS k, l_partkey FROM lineitem) USING (k)
    """,
)
def join_using(t):
    left = t.orders.select(F.col("o_orderkey").alias("k"), "o_custkey")
    return left.join(t.lineitem.select(F.col("l_orderkey").alias("k"), "l_partkey"), ["k"])


@query(
    "interactions",
    """
    SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    JOIN part ON p_partkey = l_partkey JOIN customer ON c_custkey = o_custkey
    """,
)
def interactions(t):
    return rel.interactions(t.orders, t.lineitem, t.part, t.customer)


@query("distinct_pairs", f"WITH {UI} SELECT u, i FROM ui")
def distinct_pairs(t):
    return _ui(t)


@query("semi_items", f"WITH {UI} SELECT u, i FROM ui WHERE i IN (SELECT i FROM ui WHERE u = {TARGET})")
def semi_items(t):
    pairs = _ui(t)
    return rel.keep_keys(pairs, rel.items_of(pairs, TARGET), "i")


@query("anti_items", f"WITH {UI} SELECT p_partkey AS i FROM part WHERE p_partkey NOT IN (SELECT i FROM ui WHERE u = {TARGET})")
def anti_items(t):
    items = t.part.select(F.col("p_partkey").alias("i"))
    return rel.drop_keys(items, rel.items_of(_ui(t), TARGET), "i")


@query("group_count", f"WITH {UI} SELECT u, count(*) AS n FROM ui GROUP BY u")
def group_count(t):
    return _ui(t).groupBy("u").agg(F.count(F.lit(1)).alias("n"))


@query(
    "group_stats",
    """
    SELECT o_custkey AS u, round(avg(l_quantity), 6) AS avg_q, max(l_quantity) AS max_q, count(*) AS n
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1
    """,
)
def group_stats(t):
    return rel.purchases(t.orders, t.lineitem).groupBy("u").agg(
        r6(F.avg("q")).alias("avg_q"), F.max("q").alias("max_q"), F.count(F.lit(1)).alias("n")
    )


@query(
    "count_distinct",
    "SELECT count(DISTINCT o_custkey) AS n_users, count(DISTINCT l_partkey) AS n_items FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
)
def count_distinct(t):
    return rel.purchases(t.orders, t.lineitem).agg(
        F.countDistinct("u").alias("n_users"), F.countDistinct("i").alias("n_items")
    )


@query(
    "user_item_sets",
    f"WITH {UI} SELECT u, i // {rel.CHUNK} AS chunk, string_agg(CAST(i AS varchar), ',' ORDER BY i) AS items FROM ui GROUP BY 1, 2",
)
def user_item_sets(t):
    return rel.item_sets(_ui(t)).select("u", "chunk", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query(
    "user_item_lists",
    f"""
    WITH l AS (SELECT o_custkey u, l_partkey i, count(*) n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
    SELECT u, i // {rel.CHUNK} AS chunk, string_agg(i || 'x' || n, ',' ORDER BY i) AS items FROM l GROUP BY 1, 2
    """,
)
def user_item_lists(t):
    entries = F.transform("items", lambda e: F.concat_ws("x", e["i"], e["n"]))
    return rel.item_lists(rel.purchases(t.orders, t.lineitem)).select("u", "chunk", F.array_join(entries, ",").alias("items"))


@query("explode_items", f"WITH {UI} SELECT u, i FROM ui")
def explode_items(t):
    return rel.explode_items(rel.item_sets(_ui(t)))


@query(
    "user_item_pivot",
    """
    SELECT * FROM (PIVOT (SELECT o_custkey AS u, 'size_' || p_size AS c, 1.0::double AS w FROM orders JOIN lineitem ON o_orderkey = l_orderkey
      JOIN part ON p_partkey = l_partkey) ON c USING coalesce(max(w), 0.0) GROUP BY u)
    """,
)
def user_item_pivot(t):
    sizes = t.part.select(F.col("p_partkey").alias("i"), "p_size")
    bought = rel.purchases(t.orders, t.lineitem).select("u", "i").join(sizes, "i")
    return rel.indicator_pivot(bought, "u", "p_size", "size_")


@query(
    "user_item_vector",
    f"""
    WITH {UI}, ix AS (SELECT i, row_number() OVER (ORDER BY i) - 1 AS pos FROM (SELECT DISTINCT i FROM ui))
    SELECT u, pos, 1.0::double AS value FROM ui JOIN ix USING (i)
    """,
)
def user_item_vector(t):
    pairs = durable(_ui(t))
    index = ids.dense_index(pairs, "i", "pos")
    return pairs.join(index, "i").select("u", "pos", F.lit(1.0).alias("value"))


@query("item_vectors", f"WITH {UI} SELECT i, count(*) AS n_users, round(sqrt(count(*)), 6) AS norm FROM ui GROUP BY i")
def item_vectors(t):
    return _ui(t).groupBy("i").agg(F.count(F.lit(1)).alias("n_users"), r6(F.sqrt(F.count(F.lit(1)))).alias("norm"))


@query(
    "topk_per_group",
    """
    WITH r AS (SELECT o_custkey u, l_partkey i, sum(l_quantity) qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
    SELECT * FROM (SELECT u, i, qty, row_number() OVER (PARTITION BY u ORDER BY qty DESC, i) AS rank FROM r) WHERE rank <= 3
    """,
)
def topk_per_group(t):
    totals = rel.ratings(t.orders, t.lineitem).withColumnRenamed("w", "qty")
    return rel.top_k_per_group(totals, "u", 3, F.desc("qty"), F.asc("i"))


@query(
    "two_level_agg",
    """
    WITH m AS (SELECT o_custkey u, l_partkey i, avg(l_quantity) m FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
    SELECT i, round(max(m), 6) AS best_avg FROM m GROUP BY i
    """,
)
def two_level_agg(t):
    return rel.best_average(rel.purchases(t.orders, t.lineitem)).select("i", r6(F.col("best_avg")).alias("best_avg"))


@query(
    "id_mapping",
    f"""
    WITH {UI}, m AS (SELECT u, i, dense_rank() OVER (ORDER BY u) - 1 AS u_ix, dense_rank() OVER (ORDER BY i) - 1 AS i_ix FROM ui)
    SELECT u, i, u_ix, i_ix, u_ix || ':' || i_ix AS label FROM m
    """,
)
def id_mapping(t):
    return ids.index_pairs(_ui(t))
