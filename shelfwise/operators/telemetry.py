"""Machine telemetry: XML fragments to a daily fact table, and the alarm model on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalars import day, flag, number_or, stamp

# Element names in the machine's XML and the fact columns they fill.
MEASURES = {
    "主轴转速": "mainshaft_speed",
    "主轴倍率": "mainshaft_multiplerate",
    "主轴负载": "mainshaft_load",
    "进给速度": "feed_speed",
    "进给倍率": "feed_multiplerate",
    "PMC程序号": "pmc_code",
    "循环时间": "circle_time",
    "运行时间": "run_time",
    "有效轴数": "effective_shaft",
    "总加工个数": "amount_process",
    "已使用内存": "use_memory",
    "未使用内存": "free_memory",
    "可用程序量": "amount_use_code",
    "注册程序量": "amount_free_code",
}
ALARM = "报警"
FIELDS = "col array<struct<_ColName:string,_VALUE:string>>"


def fields(fragment: Column) -> Column:
    """Named values of a ``<col ColName="..">value</col>`` fragment; null when it is malformed."""
    return F.from_xml(F.concat(F.lit("<x>"), fragment, F.lit("</x>")), FIELDS).getField("col")


def pick(parsed: Column, name: str) -> Column:
    """Last value given for a name as double; absent, blank or non-numeric values become 0."""
    named = F.filter(parsed, lambda f: f["_ColName"] == name)
    return number_or(F.try_element_at(named, F.lit(-1)).getField("_VALUE"))


def keep_filled(df: DataFrame, column: str) -> DataFrame:
    """Rows that carry a payload."""
    return df.where(F.col(column).isNotNull())


def fact_rows(machine: DataFrame, loaded_at: str, user: str = "", alarm: str = ALARM) -> DataFrame:
    """One fact row per record ``(record_id, machine_id, state, data, date)`` that carries a payload.

    The fragment is parsed once per row and every measure is picked by name. ``loaded_at`` fills
    the audit columns, so a rerun of the same load writes the same rows.
    """
    parsed = keep_filled(machine, "data").withColumn("_fields", fields(F.col("data")))
    return parsed.select(
        F.col("record_id").alias("machine_record_id"),
        "machine_id",
        flag(F.col("state") == alarm).alias("machine_record_state"),
        *(pick(F.col("_fields"), name).alias(f"machine_record_{column}") for name, column in MEASURES.items()),
        stamp(F.col("date")).alias("machine_record_date"),
        F.lit(user).alias("dwd_insert_user"),
        F.lit(loaded_at).alias("dwd_insert_time"),
        F.lit(user).alias("dwd_modify_user"),
        F.lit(loaded_at).alias("dwd_modify_time"),
        day(F.col("date")).alias("etldate"),
    )


def measure_columns() -> list[str]:
    """The fourteen model inputs; the state is the label and is not among them."""
    return [f"machine_record_{column}" for column in MEASURES.values()]
