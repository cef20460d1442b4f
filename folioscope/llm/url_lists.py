"""Temporal list join: captures are judged by the list entries in force when they were fetched.

Dated changes of list entries become validity intervals. An interval and a capture meet on the entry and on a period of
time, so that a host with very many captures is spread over periods, and intervals of other times are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PERIOD_SECONDS = 14 * 86_400


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute address, null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def entries_of(host: Column) -> Column:
    """The host and its parent domains down to two labels: the entries that can name it."""
    labels = F.split(host, r"\.")
    return F.when(F.size(labels) < 2, F.array(host)).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )


def validity_intervals(changes: DataFrame) -> DataFrame:
    """``list, entry, since, until`` from ``list, entry, action, at``; ``until`` is exclusive, null while in force.

    Changes that repeat the present state have no effect, changes of one entry at one instant count as a removal if one of
    them is. Rows with a null list, entry or time, or with an action other than add and remove, are left out. An entry's
    history is one group; it grows with the list's age, not with the captures.
    """
    known = changes.where(F.col("action").isin("add", "remove")).dropna(subset=["list", "entry", "at"])
    states = known.groupBy("list", "entry", "at").agg(F.every(F.col("action") == "add").alias("listed"))
    history = Window.partitionBy("list", "entry").orderBy("at")
    turns = states.withColumn("before", F.lag("listed").over(history)).where("listed <> coalesce(before, false)")
    spans = turns.select("list", "entry", "listed", F.col("at").alias("since"), F.lead("at").over(history).alias("until"))
    return spans.where("listed").drop("listed")


def _period(at: Column) -> Column:
    return F.floor(F.unix_timestamp(at.cast("timestamp")) / PERIOD_SECONDS)


def judge_captures(captures: DataFrame, intervals: DataFrame, key: str, url: str, fetched: str) -> DataFrame:
    """``key, host, fetched, blocked, lists, since`` of every capture: the lists (sorted) with an entry for its host or
    a parent domain in force at the time of the fetch, and the earliest beginning of those entries.

    Captures without a host or a time are on no list. Repeated captures are judged each, null keys stay null, empty
    tables give no rows or no hits. Only the first and last time of the captures reach the driver.
    """
    rows = captures.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), host_of(F.col(url)).alias("host"), F.col(fetched).alias("fetched")
    )
    ends = captures.agg(F.min(_period(F.col(fetched))).alias("first"), F.max(_period(F.col(fetched))).alias("last")).first()
    first, last = F.lit(ends["first"] or 0), F.lit(ends["last"] or 0)
    begin = F.greatest(_period(F.col("since")), first)
    end = F.least(F.coalesce(_period(F.col("until")), last), last)
    placed = intervals.where(begin <= end).select("list", F.col("entry").alias("named"), "since", "until", F.explode(F.sequence(begin, end)).alias("period"))
    asked = rows.withColumn("period", _period(F.col("fetched"))).withColumn("named", F.explode_outer(entries_of(F.col("host"))))
    in_force = (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    met = asked.join(placed.withColumnsRenamed({"named": "i_named", "period": "i_period"}), (F.col("named") == F.col("i_named")) & (F.col("period") == F.col("i_period")) & in_force, "left")
    judged = met.groupBy("row").agg(
        F.first("key").alias(key), F.first("host").alias("host"), F.first("fetched").alias("fetched"),
        (F.count("list") > 0).alias("blocked"), F.sort_array(F.collect_set("list")).alias("lists"), F.min("since").alias("since"),
    )
    return judged.drop("row")


def listed_changes(pages: DataFrame, start: str = "2024-01-01") -> DataFrame:
    """Dated changes drawn from the hosts of ``pages`` themselves: some hosts are listed, taken off and listed again, some
    domains are listed once. Numbers come from digests of the names, so that SQL can follow."""

    def number(tag: str) -> Column:
        return F.conv(F.substring(F.md5(F.concat(F.lit(tag), "entry")), 1, 6), 16, 10).cast("int")

    def change(frame: DataFrame, name: str, action: str, days: Column) -> DataFrame:
        return frame.select(F.lit(name).alias("list"), "entry", F.lit(action).alias("action"), F.date_add(F.lit(start).cast("date"), days).alias("at"))

    hosts = pages.select(host_of(F.col("url")).alias("entry")).where("entry is not null").distinct()
    listed = hosts.where(number("pick") % 3 == 0)
    added, taken_off = number("add") % 240, number("add") % 240 + 20 + number("remove") % 90
    domains = hosts.select(F.regexp_extract("entry", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("entry")).where("entry <> ''").distinct()
    parts = [
        change(listed, "hosts", "add", added),
        change(listed, "hosts", "remove", taken_off),
        change(listed.where(number("again") % 2 == 0), "hosts", "add", taken_off + 15),
        change(domains.where(number("domain") % 4 == 0), "domains", "add", number("since") % 360),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
