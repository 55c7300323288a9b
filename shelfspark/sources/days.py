"""Tables stored by day: incremental refresh that rewrites only touched days.

A day table is a Parquet folder partitioned by ``event_date``. ``merge_days``
brings a batch into a table that keeps one row per key; ``replace_days``
rewrites given days by dynamic partition overwrite, and removes days left
without rows. Spark writes such rows beside the table and moves them in when the
last task has ended, so they may be made from the table's own days and are
written once; a repeated merge changes nothing: a run that was broken off is
simply run again. A table has one writer at a time
(``streaming.ingest`` has the form for several).

Sparse feeds can be stored by a longer ``grain`` ("week", "month"), so partitions
keep a size worth a file; ``event_date`` is then the period's first day, and what
is said of days holds for periods.

``merge_days`` works on batches of days of about BATCH_ROWS rows, so what is shuffled
and kept twice at a time does not grow with the table (a single day is not divided).

Each day is dealt by ``rebalance``: small days share a task, a day that holds a
third of all rows is split over several, and files are bounded by days plus
splits. Lists of days and of their files pass the driver, never rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.session import scratch_path, written

EVENT_DATE = "event_date"
# Rows of the days that are rewritten at a time, and the codec of stored tables.
BATCH_ROWS = 10_000_000
STORED = "zstd"


def _folder(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _folder(spark, path)
    return store.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    store, at = _folder(spark, path)
    store.delete(at, True)


def period(time: Column, grain: str = "day") -> Column:
    """The first day of the period that ``time`` lies in."""
    return F.to_date(time) if grain == "day" else F.trunc(F.to_date(time), grain)


def with_day(df: DataFrame, time: str = "EventTime", grain: str = "day") -> DataFrame:
    return df.withColumn(EVENT_DATE, period(F.col(time), grain))


def read_days(spark: SparkSession, path: str, days: Iterable[dt.date] | None = None) -> DataFrame | None:
    """The table with its ``event_date`` column, or some days of it; None if there is none yet."""
    if not exists(spark, path):
        return None
    table = spark.read.parquet(path)
    if EVENT_DATE not in table.columns:
        return None
    table = table.withColumn(EVENT_DATE, F.col(EVENT_DATE).cast("date"))
    return table if days is None else table.where(F.col(EVENT_DATE).isin(list(days)))


def days_of(df: DataFrame) -> list[dt.date]:
    return sorted(r[0] for r in df.select(EVENT_DATE).distinct().collect())


def counts_of(df: DataFrame) -> dict[dt.date, int]:
    """The rows of each day."""
    return {r[0]: r[1] for r in df.groupBy(EVENT_DATE).count().collect()}


def batches(counts: dict[dt.date, int]) -> list[list[dt.date]]:
    """Days in order, in batches of BATCH_ROWS rows (one day at least)."""
    out, n = [], 0
    for day in sorted(counts):
        if not out or n + counts[day] > BATCH_ROWS:
            out, n = [*out, []], 0
        out[-1].append(day)
        n += counts[day]
    return out


def _files(spark: SparkSession, path: str, days: Iterable[dt.date]) -> dict[dt.date, set[str]]:
    """The names of each day's files; each write has names of its own."""
    found = {}
    for day in days:
        store, at = _folder(spark, f"{path}/{EVENT_DATE}={day}")
        if store.exists(at):
            found[day] = {f.getPath().getName() for f in store.listStatus(at)}
    return found


def replace_days(rows: DataFrame, path: str, days: Iterable[dt.date]) -> None:
    """Rewrite ``days`` of the table to hold ``rows`` (with ``event_date``), which
    has no other days and may read the table itself; days without rows go."""
    spark = rows.sparkSession
    before = _files(spark, path, days)
    (rows.hint("rebalance", EVENT_DATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(EVENT_DATE).parquet(path, compression=STORED))
    for day, names in _files(spark, path, before).items():
        if names & before[day]:  # no row of this day was written
            remove(spark, f"{path}/{EVENT_DATE}={day}")


def merge_days(batch: DataFrame, path: str, keys: list[str], latest: Callable[[DataFrame], DataFrame],
               time: str = "EventTime", before: Callable[[list[dt.date]], None] | None = None,
               grain: str = "day") -> list[dt.date]:
    """Merge ``batch`` (read several times: a written table, or one with a few more
    columns) into the table at ``path``; ``latest`` keeps one row per ``keys`` by a total order. Returns the rewritten days: those of the batch,
    and those that held another version of one of its keys. ``before`` gets them
    first, for those who must not forget them if the merge breaks off."""
    spark = batch.sparkSession
    new = with_day(batch, time, grain)
    counts = counts_of(new)
    old = read_days(spark, path)
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    if old is not None and counts:
        stored = counts_of(old)
        touched = days_of(old.alias("o").join(new.select(*keys).distinct().alias("b"), same("o", "b"), "left_semi"))
        counts = {d: counts.get(d, 0) + stored.get(d, 0) for d in {*counts, *touched}}
    if not counts:
        return []
    if before is not None:
        before(sorted(counts))

    def rows(days: list[dt.date]) -> DataFrame:
        """What the batch and the table have of some days, as they are now."""
        mine, stored = new.where(F.col(EVENT_DATE).isin(days)), read_days(spark, path, days)
        return mine if stored is None else mine.unionByName(stored.select(*mine.columns))

    def resolved(some: DataFrame) -> DataFrame:
        return with_day(latest(some.drop(EVENT_DATE)), time, grain)

    parts = batches(counts)
    if len(parts) == 1:
        replace_days(resolved(rows(parts[0])), path, parts[0])
        return sorted(counts)
    # keys whose versions lie in several days are resolved first and together; the rest within each batch
    every, scratch = rows(sorted(counts)), [scratch_path(spark, x) for x in ("moved-keys", "moved-rows")]
    moved = written(every.groupBy(*keys).agg(F.min(EVENT_DATE).alias("_a"), F.max(EVENT_DATE).alias("_b"))
                    .where(F.col("_a") < F.col("_b")).select(*keys), "moved-keys", scratch[0])
    winners = written(resolved(every.alias("e").join(moved.alias("m"), same("e", "m"), "left_semi")), "moved-rows", scratch[1])
    for days in parts:
        own = rows(days).alias("e").join(moved.alias("m"), same("e", "m"), "left_anti")
        replace_days(resolved(own).unionByName(winners.where(F.col(EVENT_DATE).isin(days))), path, days)
    for each in scratch:
        remove(spark, each)
    return sorted(counts)
