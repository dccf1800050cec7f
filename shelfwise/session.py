"""Session construction and lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "shelfwise", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or one inside the warehouse where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


_written: dict[str, SparkSession] = {}


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet below the shared folder and continue from the files.

    Later steps then see one fixed set of rows, whatever executor is lost, and read only the columns
    they need. ``release`` deletes the files; what is left goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/shelfwise-{uuid.uuid4().hex}"
    _written[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of durable tables that nothing reads any more; without arguments, of all of them."""
    for path in [t.scratch_path for t in tables] if tables else list(_written):
        spark = _written.pop(path, None)
        if spark is not None:
            with contextlib.suppress(Exception):  # the JVM may have ended first
                jvm = spark._jvm
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget(spark: SparkSession) -> None:
    """Let the driver's JVM collect, so that Spark removes the shuffle files of finished steps, which nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


atexit.register(release)
