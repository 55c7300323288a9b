"""The medallion runner (SNK3): every table equals the lazy plan over all files, a
refresh rewrites only the days it must, trending reads only its window (FLT5),
rejected rows are kept apart (STR5)."""

import glob
import os

from pyspark.sql import functions as F

from shelfspark.functions.columns import as_of_timestamp
from shelfspark.functions.frames import latest_by
from shelfspark.operators import clean
from shelfspark.plans import medallion
from shelfspark.plans.layers import Layers
from shelfspark.schemas import BRONZE_SALES, SALES_COLUMNS
from shelfspark.session import scratch_path
from shelfspark.sources import days
from shelfspark.sources import fixtures as fx
from shelfspark.sources.csv import write_feed

from conftest import SF_SMALL

AS_OF = "2001-11-05"


def rows(df, columns=None):
    """Sorted rows; doubles at ten digits (sums of another order)."""
    columns = sorted(columns or df.columns)
    show = lambda v: f"{v * 1.00000000000037:.10g}" if isinstance(v, float) else str(sorted(v, key=str) if isinstance(v, list) else v)
    return sorted(tuple(show(r[c]) for c in columns) for r in df.select(*columns).collect())


def lazy(spark, sales):
    ing = as_of_timestamp(AS_OF)
    return Layers(clean.clean_customers(fx.raw_customers(spark, SF_SMALL), ing),
                  clean.clean_products(fx.raw_products(spark, SF_SMALL), ing), clean.clean_sales(sales, ing), as_of=AS_OF)


def recent_sales(spark):
    """The sales of some months (and rows without a readable time)."""
    sales = fx.raw_sales(spark, SF_SMALL)
    return sales.where(F.col("Timestamp").between("2001-09-20", "2001-11-30") | (F.col("Timestamp") == "junk"))


def feeds(spark, sales):
    root = scratch_path(spark, "t-medallion")
    paths = [os.path.join(root, "feeds", k) for k in ("customers", "products", "sales")]
    write_feed(fx.raw_customers(spark, SF_SMALL), paths[0])
    write_feed(fx.raw_products(spark, SF_SMALL), paths[1])
    write_feed(sales, paths[2])
    return paths, os.path.join(root, "tables")


def files_by_day(out, table):
    return {d.rsplit("=", 1)[1]: sorted(os.listdir(d)) for d in glob.glob(f"{out.removeprefix('file:')}/{table}/event_date=*")}


def test_every_table_equals_the_lazy_plan(spark):
    sales = fx.raw_sales(spark, SF_SMALL)
    paths, out = feeds(spark, sales)
    t = medallion.run(spark, *paths, out, as_of=AS_OF, grain="month")
    want = lazy(spark, sales).materialize("silver_sales", *medallion.GOLD_TABLES, *medallion.SERVING_TABLES)
    for layer, name in {**medallion.GOLD_TABLES, **medallion.SERVING_TABLES}.items():
        frame = getattr(want, layer)
        assert t.read(name).columns == frame.columns, name
        assert rows(t.read(name)) == rows(frame), name
    # a run without new files changes nothing
    before = files_by_day(out, "gold_sales_enriched")
    again = medallion.run(spark, *paths, out, as_of=AS_OF, only=["gold_trending_products_30d"], grain="month")
    assert files_by_day(out, "gold_sales_enriched") == before
    assert rows(again.read("gold_trending_products_30d")) == rows(want.trending)


def test_refresh_rewrites_only_touched_days(spark):
    sales = recent_sales(spark)
    valid = clean.clean_sales(sales, as_of_timestamp(AS_OF))
    late_day = str(valid.agg(F.max(F.to_date("EventTime"))).first()[0])
    late = F.coalesce(F.to_date(F.try_to_timestamp(F.col("Timestamp"))) == F.lit(late_day).cast("date"), F.lit(False))
    paths, out = feeds(spark, sales.where(~late))
    only = ["gold_trending_products_30d", "gold_user_price_profile"]
    medallion.run(spark, *paths, out, as_of=AS_OF, only=only)
    before = {k: files_by_day(out, k) for k in ("silver_sales", "gold_sales_enriched")}
    # the new file: the last day, and a new version of one item of an older day
    old = valid.where(F.to_date("EventTime") < F.lit(late_day).cast("date")).orderBy("OrderID", "ProductID").first()
    moved = (sales.where((F.col("OrderID") == old.OrderID) & (F.col("ProductID") == str(old.ProductID)))
                  .withColumn("Timestamp", F.lit(f"{late_day} 12:00:00")).dropDuplicates())
    write_feed(sales.where(late).unionByName(moved), paths[2], mode="append")
    t = medallion.run(spark, *paths, out, as_of=AS_OF, only=only)
    touched = {late_day, str(old.EventTime.date())}
    for table, was in before.items():
        now = files_by_day(out, table)
        assert {d for d in set(now) | set(was) if now.get(d) != was.get(d)} <= touched, table
        assert now[late_day] != was.get(late_day)
    want = lazy(spark, sales.unionByName(moved))
    assert rows(t.read("gold_sales_enriched")) == rows(want.enriched)
    assert rows(t.read("gold_user_price_profile")) == rows(want.price_profile)


def test_changed_dimension_rewrites_its_days(spark):
    sales = recent_sales(spark)
    paths, out = feeds(spark, sales)
    medallion.run(spark, *paths, out, as_of=AS_OF, only=["gold_user_price_profile"])
    before = files_by_day(out, "gold_sales_enriched")
    one = clean.clean_sales(sales, as_of_timestamp(AS_OF)).where("CustomerID IS NOT NULL").orderBy("CustomerID").first().CustomerID
    changed = fx.raw_customers(spark, SF_SMALL).withColumn(
        "Gender", F.when(F.col("CustomerID") == str(one), F.lit("Other")).otherwise(F.col("Gender")))
    write_feed(changed, paths[0])
    t = medallion.run(spark, *paths, out, as_of=AS_OF, only=["gold_user_price_profile"])
    fact = t.read("gold_sales_enriched")
    assert {r[0] for r in fact.where(F.col("CustomerID") == one).select("Gender").distinct().collect()} == {"Other"}
    days = {str(r[0]) for r in fact.where(F.col("CustomerID") == one).select(F.to_date("EventTime")).distinct().collect()}
    now = files_by_day(out, "gold_sales_enriched")
    assert {d for d in now if now[d] != before[d]} == days


def test_runner_reads_only_the_days_of_the_window(spark):
    sales = recent_sales(spark)
    paths, out = feeds(spark, sales)
    t = medallion.run(spark, *paths, out, as_of=AS_OF, only=["gold_trending_products_30d"])
    graph = medallion.layers(spark, out, AS_OF)
    plan = graph.trending._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert rows(t.read("gold_trending_products_30d")) == rows(lazy(spark, sales).trending)
    # files stay in proportion to days, and the stored day is not published
    days = files_by_day(out, "gold_sales_enriched")
    parts = sum(f.endswith(".parquet") for names in days.values() for f in names)
    assert parts <= len(days) + spark.sparkContext.defaultParallelism
    # FLT4: types are stored in lower case too, so the filter reaches the scan
    plan = graph.interactions._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(type_key,purchase)" in plan and "lower(" not in plan
    assert "event_date" not in t.read("gold_sales_enriched").columns and len(t.read("gold_sales_enriched").columns) == 24


def test_rejected_rows_are_kept_apart(spark):
    sales = recent_sales(spark)
    paths, out = feeds(spark, sales)
    t = medallion.run(spark, *paths, out, as_of=AS_OF, only=["gold_user_price_profile"])
    bad = t.read("bronze_customers_rejects")
    raw = fx.raw_customers(spark, SF_SMALL)
    assert {r.error for r in bad.select("error").collect()} <= {"missing_key"}
    assert bad.count() == raw.where("CustomerID IS NULL").count()
    assert t.read("bronze_customers").count() + bad.count() == raw.count()
    good = medallion.bronze_sales(spark, out)
    from shelfspark.streaming.ingest import appended_rows, reject_schema
    rejected = appended_rows(spark, t.path("bronze_sales_rejects"), reject_schema(BRONZE_SALES))
    assert good.columns == SALES_COLUMNS
    assert good.count() + rejected.count() == sales.count() and rejected.where("error IS NULL").count() == 0


def test_day_table_is_written_once_and_may_be_read_by_its_own_rows(spark):
    """A merge writes the table's days alone: no second copy of them, of the batch neither."""
    import datetime as dt
    path = scratch_path(spark, "t-days")
    at = lambda day, hour: dt.datetime(2001, 5, day, hour)
    frame = lambda some: spark.createDataFrame(some, "k long, EventTime timestamp_ntz, v string")
    latest = lambda df: latest_by(df, "k", [F.col("EventTime").desc(), F.col("v")])
    folders = lambda: set(os.listdir(os.path.dirname(path.removeprefix("file:"))))
    days.merge_days(frame([(1, at(1, 0), "a"), (2, at(2, 0), "a"), (3, at(3, 0), "a"), (None, at(3, 1), "a")]), path, ["k"], latest)
    was = folders()
    # the only row of the first day moves to the second one; a day that is left alone keeps its file
    third = os.listdir(f"{path.removeprefix('file:')}/event_date=2001-05-03")
    touched = days.merge_days(frame([(1, at(2, 5), "b"), (4, at(4, 0), "b")]), path, ["k"], latest)
    assert [d.day for d in touched] == [1, 2, 4] and folders() == was
    got = {(r.k, r.v, r.event_date.day) for r in days.read_days(spark, path).collect()}
    assert got == {(1, "b", 2), (2, "a", 2), (3, "a", 3), (None, "a", 3), (4, "b", 4)}
    assert not days.exists(spark, f"{path}/event_date=2001-05-01")
    assert os.listdir(f"{path.removeprefix('file:')}/event_date=2001-05-03") == third


def test_feed_of_compressed_files(spark):
    """The stream reads compressed files as it reads plain ones."""
    from shelfspark.sources.csv import read_feed
    path, plain = scratch_path(spark, "t-gzip"), scratch_path(spark, "t-plain")
    write_feed(recent_sales(spark), path, compression="gzip")
    write_feed(recent_sales(spark), plain)
    assert rows(read_feed(spark, path, BRONZE_SALES)) == rows(read_feed(spark, plain, BRONZE_SALES))
    size = lambda p: sum(os.path.getsize(f) for f in glob.glob(p.removeprefix("file:") + "/*.csv*"))
    assert size(path) < 0.5 * size(plain)


def test_days_are_merged_in_bounded_batches_and_leave_nothing(spark, tmp_path, monkeypatch):
    """Few rows at a time, versions of an item (NULL keys too) that move between batches of
    days, a merge that broke off: the rows are those of one resolution of everything."""
    schema = "k string, n int, v int, EventTime timestamp_ntz"
    at = lambda day: f"2001-01-{day:02d} 10:00:00"
    frame = lambda data: spark.createDataFrame([(k, n, v, at(d)) for k, n, v, d in data], "k string, n int, v int, t string").select(
        "k", "n", "v", F.col("t").cast("timestamp_ntz").alias("EventTime"))
    latest = lambda df: latest_by(df, ["k", "n"], [F.col("v").desc(), F.col("EventTime").desc()])
    first = [(f"a{i}", i % 3, 1, 1 + i % 9) for i in range(60)] + [(None, 1, 1, 2), ("a0", 0, 0, 9)]
    second = [(f"a{i}", i % 3, i % 3, 1 + (i * 4) % 9) for i in range(0, 60, 2)] + [(None, 1, 2, 8), ("new", 0, 1, 12)]
    seen = []
    replace = days.replace_days

    def counted(rows, path, some):
        seen.append(len(some))
        replace(rows, path, some)
        if len(seen) == 3:
            raise RuntimeError("broken off")

    monkeypatch.setattr(days, "BATCH_ROWS", 20)
    monkeypatch.setattr(days, "replace_days", counted)
    path = str(tmp_path / "table")
    for data in (first, second):
        for _ in range(2):  # a broken merge is run again
            try:
                days.merge_days(frame(data), path, ["k", "n"], latest)
                break
            except RuntimeError:
                pass
    assert len(seen) > 4 and max(seen) <= 4, seen
    got = days.read_days(spark, path).drop("event_date")
    assert rows(got) == rows(latest(frame(first + second)))


def test_working_copies_and_shuffles_go_during_a_run(spark):
    """After a run no staging of feeds or batches is left, and its jobs drop their shuffles."""
    from shelfspark.session import SHUFFLES_DROPPED, ensure_checkpoint_dir
    import urllib.parse
    root = urllib.parse.urlparse(ensure_checkpoint_dir(spark)).path + "/shelfspark"
    left = lambda: {x for x in os.listdir(root) if x.startswith(("checked-", "new-", "changed-", "moved-"))}
    paths, out = feeds(spark, recent_sales(spark))
    before = left()
    medallion.run(spark, *paths, out, as_of=AS_OF, only=["gold_trending_products_30d"], grain="month")
    assert left() == before
    assert spark.conf.get(SHUFFLES_DROPPED) == "false"
