"""URL filters over dated lists: validity intervals and an as-of join, in DataFrame functions alone.

A list's log holds dated additions and removals of entries: a host, a domain with all below it, or a host with a path
prefix. Changes of one entry on one day form one row with the state that earlier days left, valid until the entry's
next day with changes; a day's row holds the day's intervals, sorted. A window sees an entry's days, never its
changes, so it is bounded by the calendar. Rows are repeated for each month of their validity, and a capture meets
those of its entry and month: at most a month's days, of which one is valid. Captures are evaluated once for each
distinct URL and time; a host with a third of all captures is split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.names import fresh

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?(/[^?#]*)?"


def host(url: Column) -> Column:
    """The host in lower case without user and port; empty where there is none."""
    return F.lower(F.regexp_extract(url, _URL, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def path_depth(url_path: Column) -> Column:
    return F.size(F.filter(F.split(url_path, "/"), lambda part: part != ""))


def entry_keys(url: Column, deepest: Column) -> Column:
    """All entries that could cover a URL: its host, its domains, and its path prefixes up to ``deepest`` parts."""
    labels = F.split(host(url), r"\.")
    parts = F.filter(F.split(path(url), "/"), lambda part: part != "")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, k, F.size(labels)), ".")),
    )
    depth = F.least(F.size(parts), deepest)
    prefixes = F.when(depth > 0, F.transform(
        F.sequence(F.lit(1), depth),
        lambda k: F.concat(F.lit("prefix:"), host(url), F.lit("/"), F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")),
    )).otherwise(F.array().cast("array<string>"))
    return F.when(host(url) != "", F.concat(F.array(F.concat(F.lit("host:"), host(url))), domains, prefixes))


def validity(log: DataFrame, until: Column) -> DataFrame:
    """``(entry, month, day, next_day, before, changes)`` from a log ``(entry, ts, active)``.

    ``before`` is the change that earlier days left last, ``changes`` the day's ``(ts, active)`` by time. Of changes of an entry
    at one time a removal counts. Changes without entry, time or state are no changes. ``until`` ends the last months.
    """
    clean = log.where(F.col("entry").isNotNull() & F.col("ts").isNotNull() & F.col("active").isNotNull())
    moments = clean.groupBy("entry", "ts").agg(F.min("active").alias("active"))
    days = moments.groupBy("entry", F.to_date("ts").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("ts", "active"))).alias("changes")
    )
    order = Window.partitionBy("entry").orderBy("day")
    dated = days.select(
        "entry", "day", F.lead("day").over(order).alias("next_day"), F.lag(F.element_at("changes", -1)).over(order).alias("before"), "changes"
    )
    final = F.greatest(F.coalesce(F.date_sub("next_day", 1), F.to_date(until), F.col("day")), F.col("day"))
    months = F.sequence(F.trunc("day", "month"), F.trunc(final, "month"), F.expr("interval 1 month"))
    return dated.select("*", F.explode(months).alias("month"))


def evaluate(captures: DataFrame, log: DataFrame) -> DataFrame:
    """``captures`` ``(url, ts, ...)`` with ``n_active``, ``entry`` and ``since``: the entries active at each fetch time.

    ``entry`` is the longest active entry (the first by name among equals), ``since`` the time of its latest change. A capture
    without URL, host or time has ``n_active`` 0. All rows and columns of ``captures`` stay; result columns replace columns
    of these names. An empty log, or one whose changes all come later, filters nothing.
    """
    seen = captures.select(F.col("url").alias("_url"), F.col("ts").alias("_ts")).where("_url is not null and _ts is not null").distinct()
    is_prefix = F.col("entry").startswith("prefix:")
    limits = log.agg(F.coalesce(F.max(F.when(is_prefix, F.size(F.split("entry", "/")) - 2)), F.lit(0)).alias("_deepest"))
    until = seen.agg(F.max("_ts").alias("_until"))
    deepest, latest = limits.first()[0], until.first()[0]
    rows = seen.withColumn("_entry", F.explode(entry_keys(F.col("_url"), F.lit(deepest)))).withColumn("_month", F.trunc(F.to_date("_ts"), "month"))
    valid = validity(log, F.lit(latest).cast("timestamp")).select(*(F.col(c).alias(f"_{c}") for c in ("day", "next_day", "before", "changes")),
                                                F.col("entry").alias("_entry"), F.col("month").alias("_month"))
    day = F.to_date("_ts")
    met = rows.join(valid, ["_entry", "_month"]).where((day >= F.col("_day")) & (F.col("_next_day").isNull() | (day < F.col("_next_day"))))
    past = F.filter("_changes", lambda c: c["ts"] <= F.col("_ts"))
    now = met.withColumn("_state", F.coalesce(F.get(past, F.size(past) - 1), F.col("_before")))
    on = now.where("_state.active").select("_url", "_ts", "_entry", F.col("_state.ts").alias("_since"))
    best = F.min(F.struct((-F.length("_entry")).alias("n"), F.col("_entry").alias("entry"), F.col("_since").alias("since")))
    active = on.groupBy("_url", "_ts").agg(F.count(F.lit(1)).alias("_n"), best.alias("_best"))
    own_url, own_ts, number, best_one = fresh(captures, "url", "ts", "n", "best")
    active = active.toDF(own_url, own_ts, number, best_one)
    same = (F.col("url") == F.col(own_url)) & (F.col("ts") == F.col(own_ts))
    kept = [c for c in captures.columns if c not in ("n_active", "entry", "since")]
    return captures.select(*kept).join(active, same, "left").select(
        *kept, F.coalesce(number, F.lit(0).cast("long")).alias("n_active"), F.col(f"{best_one}.entry").alias("entry"), F.col(f"{best_one}.since").alias("since")
    )
