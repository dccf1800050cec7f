"""Small literal inputs with known results."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfwise.functions import arrays
from shelfwise.operators import factor, features as feat, relational as rel, telemetry as tel, text as tx


def vectors(spark, *rows):
    return spark.createDataFrame([(k, Vectors.dense(r)) for k, r in enumerate(rows)], ["id", "features"])


def values(df, column, digits=6):
    return [[round(x, digits) for x in r[0].toArray().tolist()] for r in df.orderBy("id").select(column).collect()]


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def array(*xs):
    return F.array(*(F.lit(float(x)) for x in xs))


def test_vector_measures(spark):
    assert one(spark, arrays.cosine(array(1, 2, 3), array(4, 5, 6))) == pytest.approx(0.974632, abs=1e-6)
    assert one(spark, arrays.euclidean(array(1, 1, 1), array(1, 1, 1))) == 0.0
    assert one(spark, arrays.cosine(array(0, 0), array(1, 2))) is None
    assert one(spark, arrays.unit(array(0, 0))) is None
    a, b = array(1, 2, 3, 8, 9, 10), array(1, 2, 3, 4, 5, 6)
    assert one(spark, arrays.jaccard_multiset(a, b)) == pytest.approx(0.25)
    assert one(spark, arrays.jaccard(a, b)) == pytest.approx(1 / 3)
    assert one(spark, arrays.jaccard_multiset(array(1, 1, 2), array(1, 1, 1, 3))) == pytest.approx(2 / 7)


def test_pivot(spark):
    rows = [("Alice", 2019), ("Bob", 2019), ("Alice", 2020), ("Bob", 2020), ("Bob", 2023), ("Lkx", 0)]
    wide = rel.indicator_pivot(spark.createDataFrame(rows, ["who", "year"]), "who", "year", "y")
    got = {r["who"]: [r["y0"], r["y2019"], r["y2020"], r["y2023"]] for r in wide.collect()}
    assert got == {"Alice": [0, 1, 1, 0], "Bob": [0, 1, 1, 1], "Lkx": [1, 0, 0, 0]}


def test_pearson_literal(spark):
    from shelfwise.operators.similarity import pearson

    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (2.0, 3.0, 4.0, 5.0)], ["a", "b", "c", "d"])
    cells = pearson(df, ["a", "b", "c", "d"]).collect()
    assert len(cells) == 16 and all(r["r"] == pytest.approx(1.0) for r in cells)


def test_tokenizers(spark):
    df = spark.createDataFrame([(0, "Logistic,regression,models,are,neat")], ["id", "text"])
    assert tx.tokenize(df).first()["tokens"] == ["logistic,regression,models,are,neat"]
    assert tx.tokenize_regex(df).first()["tokens"] == ["logistic", "regression", "models", "are", "neat"]
    assert tx.token_count(tx.tokenize_regex(df)).first()["n"] == 5


def test_stop_words_and_ngrams(spark):
    df = spark.createDataFrame([(0, ["我", "喜欢", "这个", "电影"]), (1, ["这本", "书", "非常", "有趣"])], ["id", "tokens"])
    kept = [r["kept"] for r in tx.remove_words(df, ["我", "这个"]).orderBy("id").collect()]
    assert kept == [["喜欢", "电影"], ["这本", "书", "非常", "有趣"]]
    words = spark.createDataFrame([(0, ["Hi", "I", "heard", "about", "Spark"])], ["id", "tokens"])
    assert tx.ngrams(words).first()["grams"] == ["Hi I", "I heard", "heard about", "about Spark"]


def test_count_vectorizer(spark):
    df = spark.createDataFrame([(0, list("abc")), (1, list("abbcafga"))], ["id", "tokens"])
    model = tx.fit_counts(df, 3, 2)
    assert model.vocabulary == ["a", "b", "c"]
    assert values(model.transform(df), "counts") == [[1, 1, 1], [3, 2, 1]]
    counted = tx.count_terms(tx.document_terms(df, "id"), "id", 2).select("id", "term", "n").collect()
    assert {tuple(r) for r in counted} == {(0, "a", 1), (0, "b", 1), (0, "c", 1), (1, "a", 3), (1, "b", 2), (1, "c", 1)}


def test_tfidf_forms_agree(spark):
    df = spark.createDataFrame([(0, list("aab")), (1, list("ac")), (2, list("d"))], ["id", "tokens"])
    model = tx.fit_counts(df)
    weighted = tx.weigh(model.transform(df), "counts", "w")
    dense = {
        (k, model.vocabulary[j]): v for k, row in enumerate(values(weighted, "w", 9)) for j, v in enumerate(row) if v
    }
    long = {(r["id"], r["term"]): round(r["w"], 9) for r in tx.tfidf(tx.document_terms(df, "id"), df, "id").collect()}
    assert long == pytest.approx(dense)


def test_feature_hasher(spark):
    rows = [(2.2, True, "1", "张三"), (3.3, False, "2", "李四"), (4.4, False, "3", "张明"), (5.5, False, "4", "张三")]
    df = spark.createDataFrame(rows, ["real", "bool", "stringNum", "string"])
    hashed = tx.hash_columns(df, df.columns, 300)
    assert sorted(sorted(r["hashed"].indices.tolist()) for r in hashed.collect()) == sorted(
        [[126, 150, 249, 291], [64, 169, 200, 291], [64, 130, 172, 291], [64, 231, 249, 291]]
    )
    entries = feat.nonzero_form(hashed.withColumn("id", F.col("real")), "id", "hashed").where(F.col("id") == 2.2).collect()
    assert sorted((r["pos"], r["value"]) for r in entries)[-1] == (291, 2.2) and len(entries) == 4


def test_string_indexer(spark):
    df = spark.createDataFrame([(k, s) for k, s in enumerate("男男女男女女")], ["id", "sex"])
    indexed = feat.index_labels(df, "sex", "ix")
    assert {r["sex"]: r["ix"] for r in indexed.collect()} == {"女": 0.0, "男": 1.0}
    colours = spark.createDataFrame([(k, s) for k, s in enumerate("红黄蓝蓝蓝红")], ["id", "c"])
    indexed = feat.index_labels(colours, "c", "ix")
    assert {r["c"]: r["ix"] for r in indexed.collect()} == {"蓝": 0.0, "红": 1.0, "黄": 2.0}
    back = feat.labels_back(indexed, "ix", "name", feat.label_table(colours, "c"))
    assert all(r["c"] == r["name"] for r in back.collect()) and back.count() == 6
    other = spark.createDataFrame([("x", 0.0), ("y", 1.0), ("z", 2.0)], ["name", "_ix"])
    assert feat.labels_back(indexed, "ix", "other", other).where("c = '黄'").first()["other"] == "z"


def test_unseen_labels(spark):
    labels = feat.label_table(spark.createDataFrame([("a",), ("b",), ("b",), (None,)], ["c"]), "c")
    assert {r["c"]: r["_ix"] for r in labels.collect()} == {"b": 0.0, "a": 1.0}
    rows = spark.createDataFrame([("new",), ("a",), (None,)], "c string")
    assert {r["c"]: r["ix"] for r in feat.index_labels(rows, "c", "ix", labels, invalid="keep").collect()} == {"new": 2.0, "a": 1.0, None: 2.0}
    assert [tuple(r) for r in feat.index_labels(rows, "c", "ix", labels, invalid="skip").collect()] == [("a", 1.0)]
    with pytest.raises(Exception, match="without a label"):
        feat.index_labels(rows, "c", "ix", labels).collect()


def test_a_million_labels_stay_in_tables(spark):
    wide = spark.range(1_000_000).selectExpr("concat('label', id % 900000) AS c")
    plan = feat.index_labels(wide, "c", "ix")._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "SinglePartition" not in plan
    assert feat.index_labels(wide, "c", "ix").agg({"ix": "max"}).first()[0] == 899_999.0


def test_one_hot(spark):
    rows = [(0.0, 1.0), (1.0, 0.0), (2.0, 1.0), (0.0, 2.0), (0.0, 1.0), (2.0, 0.0)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], ["id", "a", "b"])
    hot = feat.one_hot(df, ["a", "b"], ["x", "y"])
    assert values(hot, "x")[:3] == [[1, 0], [0, 1], [0, 0]]
    assert values(hot, "y")[:3] == [[0, 1], [1, 0], [0, 1]]


def test_vector_indexer(spark):
    df = vectors(spark, (1, 2, 3, 4), (0, 2, 0, 4), (4, 5, 2, 4), (2, 2, 1, 3))
    assert values(feat.index_categories(df, "features", 2), "indexed") == [[1, 0, 3, 1], [0, 0, 0, 1], [4, 1, 2, 1], [2, 0, 1, 0]]


def test_normalizer(spark):
    df = vectors(spark, (1, 0.5, -1), (2, 1, 1), (4, 10, 2))
    assert values(feat.normalize(df, "features", 1.0), "normalized") == [[0.4, 0.2, -0.4], [0.5, 0.25, 0.25], [0.25, 0.625, 0.125]]
    assert values(feat.normalize(df, "features", float("inf")), "normalized") == [[1, 0.5, -1], [1, 0.5, 0.5], [0.4, 1, 0.2]]


def test_scalers(spark):
    df = spark.createDataFrame([(0, 2.0, 3.0), (1, -1.0, 5.0), (2, 4.0, 7.0), (3, 6.0, 9.0), (4, 8.0, 11.0)], ["id", "a", "b"])
    first = values(feat.scale(df, ["a", "b"], "standard"), "scaled")[0]
    assert first == [round(2 / 3.492850, 6), round(3 / 3.162278, 6)]
    df = spark.createDataFrame([(0, 2.0, 1.1, 1.0), (1, 1.0, 0.1, -1.0), (2, 3.0, 10.1, 3.0)], ["id", "a", "b", "c"])
    assert values(feat.scale(df, ["a", "b", "c"], "minmax"), "scaled") == [[0.5, 0.1, 0.5], [0, 0, 0], [1, 1, 1]]
    assert values(feat.scale(df, ["a", "b", "c"], "maxabs"), "scaled", 4) == [
        [0.6667, 0.1089, 0.3333], [0.3333, 0.0099, -0.3333], [1, 1, 1]
    ]


def test_constant_column_scales(spark):
    df = spark.createDataFrame([(0, 5.0), (1, 5.0)], ["id", "a"])
    assert values(feat.scale(df, ["a"], "standard"), "scaled") == [[0.0], [0.0]]
    assert values(feat.scale(df, ["a"], "minmax"), "scaled") == [[0.5], [0.5]]


def test_polynomial(spark):
    df = vectors(spark, (2, 1), (3, -1), (0, 0))
    assert values(feat.expand(df, "features"), "expanded") == [[2, 4, 8, 1, 2, 4, 1, 2, 1], [3, 9, 27, -1, -3, -9, 1, 3, -1], [0] * 9]


def test_dct_round_trip(spark):
    df = vectors(spark, (0, 1, -2, 3), (-1, 2, 4, -7))
    there = feat.cosine_transform(df, "features")
    assert values(there, "transformed")[0] == [1.0, -1.14805, 2.0, -2.771639]
    back = feat.cosine_transform(there, "transformed", inverse=True, out="back")
    assert values(back, "back", 9) == values(df, "features", 9)


def test_assemble(spark):
    df = spark.createDataFrame([(0, 18, 1.0, Vectors.dense(0, 10, 0.5))], ["id", "hour", "mobile", "v"])
    assert values(feat.assemble(df, ["hour", "mobile", "v"]), "features") == [[18, 1, 0, 10, 0.5]]


def test_dummies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "c")], ["id", "kind"])
    assert [tuple(r) for r in feat.dummies(df, ["id"], "kind", ["a", "b"]).orderBy("id").collect()] == [(1, 1.0, 0.0), (2, 0.0, 0.0)]


ROWS_3X5 = [(0, 1, 0, 7, 0), (2, 0, 3, 4, 5), (4, 0, 0, 6, 7)]


def test_pca(spark):
    _, shares = factor.pca(vectors(spark, *ROWS_3X5), "id", "features", 3)
    assert [round(float(x), 4) for x in shares] == [0.7944, 0.2056, 0.0]


@pytest.mark.parametrize(
    "rows, expected",
    [
        (ROWS_3X5, [13.029276, 5.368578, 2.533050]),
        (
            [(1, 1, 0, 1, 1), (1, 0, 0, 0, 1), (0, 0, 0, 1, 1), (1, 1, 1, 1, 0), (0, 1, 1, 0, 0), (1, 1, 1, 0, 0), (1, 1, 0, 0, 0)],
            [3.513134, 1.979615, 1.279873, 0.814405, 0.661578],
        ),
    ],
)
def test_svd_values(spark, rows, expected):
    found = factor.vector_svd(vectors(spark, *rows), "id", "features", 5)
    assert found.s.tolist() == pytest.approx(expected, abs=1e-6)


XML = '<col ColName="主轴转速">12.5</col><col ColName="主轴倍率">null</col><col ColName="PMC程序号"></col><col ColName="主轴转速">7</col>'


def test_telemetry_rules(spark):
    rows = [(1, 1, "报警", XML), (2, 1, "运行", '<col ColName="a">1</co'), (3, 2, None, None), (4, 2, "x", '<col ColName="主轴负载"> 3.5 </col>')]
    machine = spark.createDataFrame(rows, "record_id int, machine_id int, state string, data string").withColumn(
        "date", F.lit("2024-02-03 04:05:06").cast("timestamp")
    )
    facts = {r["machine_record_id"]: r for r in tel.fact_rows(machine, "2024-02-04 00:00:00", "user1").collect()}
    assert facts[1]["machine_record_mainshaft_speed"] == 7.0 and facts[1]["machine_record_state"] == 1.0
    assert all(facts[2][c] == 0.0 for c in tel.measure_columns()) and facts[2]["machine_record_state"] == 0.0
    assert sorted(facts) == [1, 2, 4]  # a record without payload gives no fact
    assert facts[1]["machine_record_mainshaft_multiplerate"] == facts[1]["machine_record_pmc_code"] == 0.0
    assert facts[4]["machine_record_mainshaft_load"] == 3.5
    assert facts[1]["machine_record_date"] == "2024-02-03 04:05:06" and facts[1]["etldate"] == "20240203"
    assert (facts[1]["dwd_insert_user"], facts[1]["dwd_insert_time"]) == ("user1", "2024-02-04 00:00:00")
    assert len(tel.measure_columns()) == 14
    assert tel.keep_filled(machine, "data").count() == 3


def test_hashing_tf(spark):
    df = spark.createDataFrame([(0, "Hi I heard about Spark")], ["id", "text"])
    vector = tx.hash_terms(tx.tokenize(df), 20).first()["tf"]
    assert vector.size == 20 and sum(vector.values) == 5.0
