"""Telemetry facts built from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import telemetry as tel
from shelfwise.plans.registry import query

LOADED_AT = "2024-01-01 00:00:00"
ALARM_LOAD = 60


def machine_records(t):
    """Events in the shape of machine records, with the payload as an XML fragment. An event
    without properties gives a record without one.

    Purchases carry their speed twice (the last one counts), views carry the text ``null`` and
    signups an empty load, so every rule for odd values is met. An alarm raises the load by ``ALARM_LOAD``, so the state
    leaves a trace that a classifier can find.
    """
    kind = F.col("event_type")
    speed = F.when(kind == "view", "null").otherwise(F.col("value").cast("string"))
    k = F.get_json_object("props", "$.k")
    load = F.when(kind == "signup", "").when(kind == "error", (k.cast("int") + ALARM_LOAD).cast("string")).otherwise(k)

    def tag(name, value):
        return F.concat(F.lit(f'<col ColName="{name}">'), value, F.lit("</col>"))

    first = F.when(kind == "purchase", F.lit('<col ColName="主轴转速">-1</col>')).otherwise("")
    return t.events.select(
        F.col("event_id").alias("record_id"),
        F.col("user_id").alias("machine_id"),
        F.when(kind == "error", tel.ALARM).otherwise("运行").alias("state"),
        F.concat(first, tag("主轴转速", speed), tag("主轴负载", load)).alias("data"),
        F.col("ts").alias("date"),
    )


def facts(t):
    return tel.fact_rows(machine_records(t), LOADED_AT)


_ABSENT = [c for c in tel.measure_columns() if not c.endswith(("mainshaft_speed", "mainshaft_load"))]


@query(
    "telemetry_parse",
    f"""
    SELECT event_id AS machine_record_id, user_id AS machine_id,
      CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END::double AS machine_record_state,
      CASE WHEN event_type = 'view' THEN 0.0 ELSE value END::double AS machine_record_mainshaft_speed,
      CASE WHEN event_type = 'signup' THEN 0.0 ELSE CAST(json_extract_string(props, '$.k') AS double) END
        + CASE WHEN event_type = 'error' THEN {ALARM_LOAD} ELSE 0 END AS machine_record_mainshaft_load,
      {", ".join(f"0.0::double AS {c}" for c in _ABSENT)},
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS machine_record_date, '' AS dwd_insert_user, '{LOADED_AT}' AS dwd_insert_time,
      '' AS dwd_modify_user, '{LOADED_AT}' AS dwd_modify_time, strftime(ts, '%Y%m%d') AS etldate
    FROM events WHERE event_type = 'signup' OR json_extract_string(props, '$.k') IS NOT NULL
    """,
)
def telemetry_parse(t):
    return facts(t)
