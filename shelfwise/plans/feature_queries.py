"""Numeric and categorical features of products and embeddings."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfwise.functions.scalars import r6
from shelfwise.operators import features as feat, relational as rel
from shelfwise.plans.registry import query
from shelfwise.session import durable
from shelfwise.plans.similarity_queries import FEATURES

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
FREQUENCY_INDEX = "SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS ix FROM part GROUP BY 1"


def _rounded(df):
    return df.withColumn("value", r6(F.col("value")))


def _embeddings(t):
    return feat.as_vector(t.embeddings, "embedding", "v")


@query(
    "assemble",
    """
    SELECT p_partkey, CAST(0 AS bigint) AS pos, CAST(p_size AS double) AS value FROM part
    UNION ALL SELECT p_partkey, 1, p_retailprice FROM part
    """,
)
def assemble(t):
    return feat.long_form(feat.assemble(t.part, ["p_size", "p_retailprice"]), "p_partkey", "features")


@query("string_index", f"SELECT p_type, CAST(ix AS double) AS ix FROM ({FREQUENCY_INDEX.format(c='p_type')})")
def string_index(t):
    return feat.index_labels(t.part, "p_type", "ix").select("p_type", "ix").distinct()


@query("index_roundtrip", "SELECT p_partkey, p_type FROM part")
def index_roundtrip(t):
    labels = durable(feat.label_table(t.part, "p_type"))
    indexed = feat.index_labels(t.part, "p_type", "ix", labels).select("p_partkey", "ix")
    return feat.labels_back(indexed, "ix", "p_type", labels).select("p_partkey", "p_type")


@query(
    "one_hot",
    f"""
    WITH b AS ({FREQUENCY_INDEX.format(c='p_brand')})
    SELECT p_partkey, CASE WHEN ix = (SELECT max(ix) FROM b) THEN -1 ELSE ix END AS ix FROM part JOIN b USING (p_brand)
    """,
)
def one_hot(t):
    indexed = feat.index_labels(t.part, "p_brand", "brand_ix")
    encoded = feat.one_hot(indexed, ["brand_ix"], ["hot"])
    place = F.array_position(vector_to_array("hot"), F.lit(1.0)) - 1
    return encoded.select("p_partkey", place.cast("long").alias("ix"))


@query(
    "dummy_columns",
    "SELECT p_partkey, " + ", ".join(f"CASE WHEN p_type = '{v}' THEN 1.0 ELSE 0.0 END::double AS {v}" for v in TYPES) + " FROM part",
)
def dummy_columns(t):
    return feat.dummies(t.part, ["p_partkey"], "p_type", rel.values_of(t.part, "p_type"))


@query(
    "vector_index",
    """
    SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_size) - 1 AS double) AS size_ix, p_retailprice AS price FROM part
    """,
)
def vector_index(t):
    vectors = feat.assemble(t.part, ["p_size", "p_retailprice"])
    indexed = feat.index_categories(vectors, "features", most=60, expected=[0])
    v = F.col("indexed")
    return indexed.select("p_partkey", feat.element(v, 0).alias("size_ix"), feat.element(v, 1).alias("price"))


def _norm_sql(length):
    return f"""
    WITH e AS (SELECT vec_id, CAST(embedding AS double[]) v FROM embeddings),
    n AS (SELECT vec_id, v, {length} AS n FROM e)
    SELECT vec_id, CAST(k AS bigint) AS pos, round(v[k + 1] / n, 6) + 0.0 AS value FROM n, range(0, 64) g(k)
    """


def _normalized(t, p):
    return _rounded(feat.long_form(feat.normalize(_embeddings(t), "v", p), "vec_id", "normalized"))


@query("normalize_l1", _norm_sql("list_sum([abs(x) for x in v])"))
def normalize_l1(t):
    return _normalized(t, 1.0)


@query("normalize_l2", _norm_sql("sqrt(list_sum([x * x for x in v]))"))
def normalize_l2(t):
    return _normalized(t, 2.0)


@query("normalize_linf", _norm_sql("list_max([abs(x) for x in v])"))
def normalize_linf(t):
    return _normalized(t, float("inf"))


@query(
    "dct",
    """
    WITH e AS (SELECT vec_id, CAST(embedding AS double[]) v FROM embeddings),
    x AS (SELECT vec_id, n, v[n + 1] AS x FROM e, range(0, 64) g(n))
    SELECT vec_id, CAST(k AS bigint) AS pos,
           round(CASE WHEN k = 0 THEN sqrt(1 / 64) ELSE sqrt(2 / 64) END * sum(x * cos(pi() * (n + 0.5) * k / 64)), 6) + 0.0 AS value
    FROM x, range(0, 64) h(k) GROUP BY 1, 2, k
    """,
)
def dct(t):
    return _rounded(feat.long_form(feat.cosine_transform(_embeddings(t), "v"), "vec_id", "transformed"))


def _scaled(t, kind):
    scaled = feat.scale(t.part, ["p_retailprice", "p_size"], kind)
    v = F.col("scaled")
    return scaled.select("p_partkey", r6(feat.element(v, 0)).alias("price_s"), r6(feat.element(v, 1)).alias("size_s"))


@query(
    "standard_scale",
    """
    SELECT p_partkey, round(p_retailprice / (SELECT stddev_samp(p_retailprice) FROM part), 6) AS price_s,
           round(p_size / (SELECT stddev_samp(p_size) FROM part), 6) AS size_s FROM part
    """,
)
def standard_scale(t):
    return _scaled(t, "standard")


@query(
    "minmax_scale",
    """
    WITH m AS (SELECT min(p_retailprice) a, max(p_retailprice) b, min(p_size) c, max(p_size) d FROM part)
    SELECT p_partkey, round((p_retailprice - a) / (b - a), 6) AS price_s, round((p_size - c) / (d - c), 6) AS size_s FROM part, m
    """,
)
def minmax_scale(t):
    return _scaled(t, "minmax")


@query(
    "maxabs_scale",
    """
    WITH m AS (SELECT max(abs(p_retailprice)) b, max(abs(p_size)) d FROM part)
    SELECT p_partkey, round(p_retailprice / b, 6) AS price_s, round(p_size / d, 6) AS size_s FROM part, m
    """,
)
def maxabs_scale(t):
    return _scaled(t, "maxabs")


@query(
    "poly_expand",
    """
    WITH x AS (SELECT p_partkey, p_size / 7 AS x, p_retailprice / 700 AS y FROM part),
    l AS (SELECT p_partkey, [x, x * x, x * x * x, y, x * y, x * x * y, y * y, x * y * y, y * y * y] v FROM x)
    SELECT p_partkey, CAST(k AS bigint) AS pos, round(v[k + 1], 6) AS value FROM l, range(0, 9) g(k)
    """,
)
def poly_expand(t):
    scaled = t.part.select("p_partkey", (F.col("p_size") / 7).alias("x"), (F.col("p_retailprice") / 700).alias("y"))
    return _rounded(feat.long_form(feat.expand(feat.assemble(scaled, ["x", "y"]), "features", 3), "p_partkey", "expanded"))


@query(
    "product_features",
    f"WITH {FEATURES} SELECT p_partkey, CAST(pos AS bigint) AS pos, round(value, 6) AS value FROM f",
)
def product_features(t):
    table, _ = feat.product_features(t.part)
    return _rounded(feat.long_form(table, "p_partkey", "features"))


@query(
    "feature_head",
    f"WITH {FEATURES} SELECT "
    + ", ".join(f"round(max(CASE WHEN pos = {k} THEN value END), 6) AS v{k + 1}" for k in range(10))
    + " FROM f WHERE p_partkey = (SELECT min(p_partkey) FROM part)",
)
def feature_head(t):
    table, _ = feat.product_features(t.part)
    head = feat.first_values(table, "p_partkey", "features", 10)
    return head.select(*(r6(F.col(c)).alias(c) for c in head.columns))
