"""Similarity measures and the recommendation jobs built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import arrays
from shelfwise.functions.scalars import r6
from shelfwise.operators import features as feat
from shelfwise.operators import neighbours, recommend, relational as rel, similarity as sim
from shelfwise.plans.registry import TARGET, query
from shelfwise.plans.relational_queries import UI
from shelfwise.session import durable

RATINGS = "r AS (SELECT o_custkey u, l_partkey i, sum(l_quantity) w FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)"
CORATED = f"""
    {RATINGS}, c AS (
      SELECT a.i AS a, b.i AS b, round(0.5 * sum(a.w * b.w) / sqrt(sum(a.w * a.w) * sum(b.w * b.w)), 12) AS score
      FROM r a JOIN r b ON a.u = b.u AND a.i <> b.i
      WHERE a.i IN (SELECT i FROM r WHERE u = {TARGET}) GROUP BY 1, 2)
"""
FEATURES = """
    s AS (SELECT stddev_samp(p_retailprice) sp, stddev_samp(p_size) ss FROM part),
    bi AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 ix FROM part GROUP BY 1),
    ti AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 ix FROM part GROUP BY 1),
    nb AS (SELECT count(*) n FROM bi), nt AS (SELECT count(*) n FROM ti),
    f AS (
      SELECT p_partkey, 0 AS pos, p_retailprice / sp AS value FROM part, s
      UNION ALL SELECT p_partkey, 1, p_size / ss FROM part, s
      UNION ALL SELECT p_partkey, 2 + g.k, CASE WHEN ix = g.k THEN 1.0 ELSE 0.0 END
        FROM part JOIN bi USING (p_brand), nb, range(0, 1000) g(k) WHERE g.k < nb.n
      UNION ALL SELECT p_partkey, 2 + nb.n + g.k, CASE WHEN ix = g.k THEN 1.0 ELSE 0.0 END
        FROM part JOIN ti USING (p_type), nb, nt, range(0, 1000) g(k) WHERE g.k < nt.n)
"""


def _ui(t):
    return rel.order_pairs(t.orders, t.lineitem)


def _vectors(t):
    return t.embeddings.select("vec_id", arrays.doubles(F.col("embedding")).alias("v"))


def _against(t, measure):
    return sim.against_target(_vectors(t), "vec_id", "v", TARGET, measure).withColumn("score", r6(F.col("score")))


def _vector_sql(expression):
    return f"""
    WITH e AS (SELECT vec_id, CAST(embedding AS double[]) v FROM embeddings)
    SELECT a.vec_id AS a, b.vec_id AS b, round({expression}, 6) AS score
    FROM e a JOIN e b ON a.vec_id = {TARGET} AND b.vec_id <> {TARGET}
    """


@query("cosine_pairs", _vector_sql("list_cosine_similarity(a.v, b.v)"))
def cosine_pairs(t):
    return _against(t, arrays.cosine)


@query("euclid_pairs", _vector_sql("list_distance(a.v, b.v)"))
def euclid_pairs(t):
    return _against(t, arrays.euclidean)


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "pearson",
    " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r FROM lineitem" for x in _NUMERIC for y in _NUMERIC
    ),
)
def pearson(t):
    return sim.pearson(t.lineitem, _NUMERIC).select("x", "y", r6(F.col("r")).alias("r"))


_SHARED = f"""
    WITH {UI}, k AS (SELECT count(*) n FROM ui WHERE u = {TARGET}),
    o AS (SELECT a.u, count(*) n_items, count(b.i) n_shared FROM ui a LEFT JOIN ui b ON a.i = b.i AND b.u = {TARGET} GROUP BY 1)
"""


def _shared(t):
    return sim.shared_with_target(_ui(t), TARGET)


@query("array_setops", f"{_SHARED} SELECT u, n_shared AS n_inter, n_items - n_shared AS n_diff FROM o")
def array_setops(t):
    return _shared(t).select("u", F.col("n_shared").alias("n_inter"), (F.col("n_items") - F.col("n_shared")).alias("n_diff"))


@query("overlap_ratio", f"{_SHARED} SELECT u, round(n_shared / k.n, 6) AS ratio FROM o, k")
def overlap_ratio(t):
    return _shared(t).select("u", r6(F.try_divide("n_shared", "n_target")).alias("ratio"))


@query("jaccard", f"{_SHARED} SELECT u, round(n_shared / (n_items + k.n - n_shared), 6) AS score FROM o, k")
def jaccard(t):
    union = F.col("n_items") + F.col("n_target") - F.col("n_shared")
    return _shared(t).select("u", r6(F.try_divide(F.col("n_shared"), union)).alias("score"))


@query(
    "jaccard_multiset",
    f"""
    WITH l AS (SELECT o_custkey u, l_partkey i, count(*) n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
    k AS (SELECT sum(n) n FROM l WHERE u = {TARGET})
    SELECT a.u, round(coalesce(sum(CASE WHEN b.n IS NOT NULL THEN least(a.n, b.n) END), 0) / (sum(a.n) + max(k.n)), 6) AS score
    FROM l a LEFT JOIN l b ON a.i = b.i AND b.u = {TARGET}, k GROUP BY 1
    """,
)
def jaccard_multiset(t):
    table = sim.multiset_overlap(rel.purchases(t.orders, t.lineitem), TARGET)
    return table.select("u", r6(F.try_divide(F.col("n_shared"), F.col("n_lines") + F.col("n_target"))).alias("score"))


@query(
    "cross_target",
    f"""
    WITH {UI}, n AS (SELECT i, count(*) n FROM ui GROUP BY 1), mine AS (SELECT i FROM ui WHERE u = {TARGET}),
    sh AS (SELECT a.i AS a, b.i AS b, count(*) s FROM ui a JOIN ui b ON a.u = b.u WHERE a.i IN (SELECT i FROM mine) GROUP BY 1, 2)
    SELECT c.i, count(*) AS n_target, round(avg(coalesce(s, 0) / sqrt(nc.n * nm.n)), 6) AS score
    FROM (SELECT DISTINCT i FROM ui WHERE i NOT IN (SELECT i FROM mine)) c CROSS JOIN mine m
    JOIN n nc ON nc.i = c.i JOIN n nm ON nm.i = m.i LEFT JOIN sh ON sh.a = m.i AND sh.b = c.i GROUP BY c.i
    """,
)
def cross_target(t):
    return sim.mean_item_cosine(durable(_ui(t)), TARGET).withColumn("score", r6(F.col("score")))


@query(
    "item_item_cosine",
    f"""
    WITH {UI}, n AS (SELECT i, count(*) n FROM ui GROUP BY 1)
    SELECT a.i AS a, b.i AS b, round(count(*) / sqrt(max(na.n) * max(nb.n)), 6) AS score
    FROM ui a JOIN ui b ON a.u = b.u AND a.i <> b.i JOIN n na ON na.i = a.i JOIN n nb ON nb.i = b.i
    WHERE a.i IN (SELECT i FROM ui WHERE u = {TARGET}) GROUP BY 1, 2
    """,
)
def item_item_cosine(t):
    pairs = durable(_ui(t))
    return sim.item_cosine(pairs, rel.items_of(pairs, TARGET)).withColumn("score", r6(F.col("score")))


@query(
    "item_neighbours",
    f"""
    WITH {UI}, n AS (SELECT i, count(*) n FROM ui GROUP BY 1),
    s AS (SELECT a.i AS item_id, b.i AS neighbour_id, count(*) AS n FROM ui a JOIN ui b ON a.u = b.u AND a.i <> b.i GROUP BY 1, 2),
    c AS (SELECT item_id, neighbour_id, s.n / sqrt(na.n * nb.n) AS score FROM s JOIN n na ON na.i = item_id JOIN n nb ON nb.i = neighbour_id)
    SELECT item_id, rank, neighbour_id, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, neighbour_id) AS rank FROM c) WHERE rank <= 10
    """,
)
def item_neighbours(t):
    """The ten nearest items of every item."""
    found = neighbours.item_neighbours(_ui(t), 10)
    return found.select(F.col("a").alias("item_id"), "rank", F.col("b").alias("neighbour_id"), r6(F.col("score")).alias("score"))


@query("corated_cosine", f"WITH {CORATED} SELECT a, b, round(score, 6) AS score FROM c")
def corated_cosine(t):
    weighted = durable(rel.ratings(t.orders, t.lineitem))
    return sim.corated_cosine(weighted, rel.items_of(weighted, TARGET)).withColumn("score", r6(F.col("score")))


@query(
    "copurchase_top10",
    f"""
    WITH {UI} SELECT a.u AS user_id, count(*) AS n_shared FROM ui a JOIN ui t ON a.i = t.i AND t.u = {TARGET}
    WHERE a.u <> {TARGET} GROUP BY 1 ORDER BY n_shared DESC, user_id LIMIT 10
    """,
)
def copurchase_top10(t):
    return recommend.copurchase_users(_ui(t), TARGET)


@query(
    "similar_users",
    f"""
    {_SHARED}, s AS (SELECT u AS user_id, round(n_shared / sqrt(n_items * k.n), 6) AS score FROM o, k WHERE u <> {TARGET})
    SELECT row_number() OVER (ORDER BY score DESC, user_id) AS rank, user_id, score FROM s ORDER BY rank LIMIT 5
    """,
)
def similar_users(t):
    return recommend.similar_users(_ui(t), TARGET)


@query(
    "rec_neighbourhood",
    f"""
    WITH {CORATED} SELECT b AS item_id, round(avg(score), 6) AS score FROM c
    WHERE b NOT IN (SELECT i FROM r WHERE u = {TARGET}) GROUP BY 1
    """,
)
def rec_neighbourhood(t):
    return recommend.neighbourhood_scores(durable(rel.ratings(t.orders, t.lineitem)), TARGET)


@query(
    "rec_content_top5",
    f"""
    WITH {UI}, {FEATURES}, fn AS (SELECT p_partkey i, sqrt(sum(value * value)) n FROM f GROUP BY 1),
    mine AS (SELECT i FROM ui WHERE u = {TARGET}),
    peers AS (SELECT u FROM (SELECT a.u, count(*) n FROM ui a WHERE a.i IN (SELECT i FROM mine) AND a.u <> {TARGET}
              GROUP BY 1 ORDER BY n DESC, u LIMIT 10)),
    cand AS (SELECT DISTINCT i FROM ui WHERE u IN (SELECT u FROM peers) AND i NOT IN (SELECT i FROM mine)),
    fc AS (SELECT * FROM f WHERE p_partkey IN (SELECT i FROM cand)), fm AS (SELECT * FROM f WHERE p_partkey IN (SELECT i FROM mine)),
    dots AS (SELECT fc.p_partkey c, fm.p_partkey m, sum(fc.value * fm.value) d FROM fc JOIN fm USING (pos) GROUP BY 1, 2),
    sc AS (SELECT c AS item_id, round(avg(d / (nc.n * nm.n)), 6) AS score FROM dots
           JOIN fn nc ON nc.i = c JOIN fn nm ON nm.i = m GROUP BY 1)
    SELECT row_number() OVER (ORDER BY score DESC, item_id) AS rank, item_id, score FROM sc ORDER BY rank LIMIT 5
    """,
)
def rec_content_top5(t):
    rows = feat.product_rows(t.part).withColumnRenamed("p_partkey", "i")
    return recommend.content_top(durable(_ui(t)), rows, TARGET)


@query("vector_ops", "SELECT vec_id, embedding[1]::double AS first, embedding[-1]::double AS last, len(embedding) AS dim FROM embeddings")
def vector_ops(t):
    v = F.col("v")
    return _vectors(t).select(
        "vec_id", F.get(v, 0).alias("first"), F.element_at(v, -1).alias("last"), F.size(v).cast("long").alias("dim")
    )
