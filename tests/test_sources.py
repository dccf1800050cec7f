"""Readers and writers."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfwise.sources import jdbc, tables, text


def test_csv_in_gbk(spark, tmp_path):
    path = tmp_path / "orders.csv"
    with pytest.raises(ValueError, match="javaCharsets"):
        text.read_csv(spark, str(path), "a int", charset="gbk")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    path.write_bytes("用户id,商品id,价格\n1,2,3.5\n4,5,\n".encode("gbk"))
    df = text.read_csv(spark, str(path), "`用户id` int, `商品id` int, `价格` double", charset="gbk")
    assert [tuple(r) for r in df.orderBy("用户id").collect()] == [(1, 2, 3.5), (4, 5, None)]
    names = tmp_path / "names.csv"
    names.write_bytes("名\n张三\n".encode("gbk"))
    assert text.read_csv(spark, str(names), "n string", charset="gbk").first()["n"] == "张三"


def test_csv_utf8(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,é\n", encoding="utf-8")
    assert tuple(text.read_csv(spark, str(tmp_path / "a.csv"), "a int, b string").first()) == (1, "é")


def test_libsvm_round_trip(spark, tmp_path):
    path = str(tmp_path / "points")
    rows = [(1.0, Vectors.sparse(5, [0, 3], [1.5, 2.0])), (0.0, Vectors.sparse(5, [4], [7.0]))]
    spark.createDataFrame(rows, ["label", "features"]).coalesce(1).write.format("libsvm").save(path)
    back = text.read_libsvm(spark, path, 5)
    assert {(r["label"], r["features"]) for r in back.collect()} == set(rows)


def test_word_list(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\n a \n\nthe\n")
    assert {r["term"] for r in text.read_words(spark, str(tmp_path / "stop.txt")).collect()} == {"the", "a"}


def test_delimited_lines(spark):
    lines = spark.createDataFrame(
        [("1::2::3.5::978300760",), ("1::2::3.5",), ("x::2::3::4",), ("1::2::3::4::5",), ("",), (None,)], "value string"
    )
    good, bad = text.parse_delimited(lines, {"user": "int", "item": "int", "rating": "float", "ts": "long"})
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3.5, 978300760)]
    assert good.dtypes == [("user", "int"), ("item", "int"), ("rating", "float"), ("ts", "bigint")]
    assert bad.count() == 5


def test_json_text(spark):
    df = spark.createDataFrame([('{"k": 3, "s": "x"}',), ("broken",)], "props string")
    parsed = text.parse_json(df, "props", "k int, s string").select("parsed.*").collect()
    assert [tuple(r) for r in parsed] == [(3, "x"), (None, None)]
    assert df.limit(1).select(text.as_json(F.lit(1).alias("a"), F.lit("b").alias("c")).alias("j")).first()["j"] == '{"a":1,"c":"b"}'


def test_catalog_table(spark):
    df = spark.range(3)
    tables.save_table(df, "shelf_numbers")
    tables.save_table(df.limit(2), "shelf_numbers")
    assert tables.load_table(spark, "shelf_numbers").count() == 2
    spark.sql("DROP TABLE shelf_numbers")


def test_daily_partitions(spark, tmp_path):
    path = str(tmp_path / "daily")
    tables.write_daily(spark.range(2), path, "20240101")
    tables.write_daily(spark.range(5), path, "20240102")
    tables.write_daily(spark.range(3), path, "20240102")
    back = spark.read.parquet(path)
    assert back.groupBy("etldate").count().orderBy("etldate").collect()[0]["count"] == 2
    newest = tables.read_latest(spark, path)
    assert newest.count() == 3
    scan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(etldate" in scan


def test_jdbc_options():
    db = jdbc.Database("jdbc:any:db", {"user": "me", "password": "pw"})
    assert "numPartitions" not in jdbc.read_options(db, "orders")
    options = jdbc.read_options(db, "orders", "id", (0, 100), 8)
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "0", "100", "8")
    assert options["user"] == "me" and options["dbtable"] == "orders"
    with pytest.raises(ValueError):
        jdbc.read_options(db, "orders", "id")


def test_jdbc_write_mode(spark):
    with pytest.raises(ValueError):
        jdbc.write_table(spark.range(1), jdbc.Database("jdbc:any:db"), "t", mode="replace")
