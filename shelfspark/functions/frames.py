"""Generic DataFrame helpers used by every layer.

* ``latest_by`` / ``top_n``: ``row_number`` over a key with ``rn <= n``.
  Catalyst plans this as a WindowGroupLimit on *both* sides of the
  shuffle, so a hot key ships at most ``n`` rows per map task.
* ``top_k``: ``orderBy().limit()`` -> TakeOrderedAndProject (per-task
  top-k, then a k-row merge); no full sort.
* ``histogram``: equal-width bins in one pass over the input: partial counts of
  narrow cells with their least and greatest value, merged into bins; only the
  values in the few cells that a bin's edge crosses are told apart one by one.
* ``assign_ids``: consecutive ids after ``max(existing)`` from a
  distributed sort plus per-partition offsets (a table with one row per
  partition), never a single-partition window over the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def top_n(df: DataFrame, keys, order, n: int, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per ``keys`` under ``order`` (a total order
    gives a deterministic result). ``rank_col`` keeps the 1-based rank."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def latest_by(df: DataFrame, keys, order) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (pass descending columns)."""
    return top_n(df, keys, order, 1)


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    """Global top-k under ``order``; add a unique tiebreak for determinism."""
    return df.orderBy(*_cols(order)).limit(k)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, frames)


# A cell of ``histogram`` holds the doubles that agree in this many binary digits.
CELL_DIGITS = 12


def _cell(x: Column) -> Column:
    """The cell of a double: its leading binary digits, scaled to its exponent.
    Any cutting is right, as each cell keeps its least and greatest value."""
    digits = F.greatest(F.floor(F.log2(F.abs(x))) - CELL_DIGITS, F.lit(-1000))  # the scale of tiny values stays above 0
    scale = F.pow(F.lit(2.0), digits)
    return F.when(x == 0, 0.0).otherwise(F.floor(x / scale) * scale)


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram of a numeric column.

    Bins span [min, max]; the last bin is closed on the right; NULLs are
    ignored; only non-empty bins are returned. Columns: bin (0-based),
    bin_start, bin_end, n.

    The input is worked out once: its values go to a narrow written table (no
    shuffle). Cells merge to (least, greatest, count) by partial aggregation, a
    small table whatever the input; an edge crosses one cell at most, and only the
    values of the crossed cells are looked at one by one.
    """
    from shelfspark.session import written

    x = F.col(col).cast("double")
    vals = written(df.select(x.alias("_x")).where(F.col("_x").isNotNull()).withColumn("_cell", _cell(F.col("_x"))), "histogram")
    cells = written(vals.groupBy("_cell").agg(F.min("_x").alias("_least"), F.max("_x").alias("_greatest"),
                                              F.count(F.lit(1)).alias("_n")), "histogram-cells")
    s = cells.agg(F.struct(F.min("_least").alias("lo"), F.max("_greatest").alias("hi"))).scalar()
    lo, hi = s.getField("lo"), s.getField("hi")
    width = (hi - lo) / F.lit(float(bins))

    def bin_of(v: str) -> Column:
        return F.when(hi == lo, F.lit(0)).otherwise(
            F.least(F.floor((F.col(v) - lo) / width).cast("int"), F.lit(bins - 1)))

    ends = cells.select("_cell", "_n", bin_of("_least").alias("bin"), bin_of("_greatest").alias("_last"))
    whole = ends.where(F.col("bin") == F.col("_last")).select("bin", "_n")
    # an edge crosses one cell, so there are at most ``bins`` of them: a proven, tiny broadcast
    crossed = F.broadcast(ends.where(F.col("bin") < F.col("_last")).select("_cell"))
    parted = vals.join(crossed, "_cell", "left_semi").select(bin_of("_x").alias("bin"), F.lit(1).cast("long").alias("_n"))
    counts = whole.unionByName(parted).groupBy("bin").agg(F.sum("_n").cast("long").alias("n"))
    return counts.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        "n",
    )


def assign_ids(new: DataFrame, existing: DataFrame, existing_id: str,
               order, id_col: str = "NewID") -> DataFrame:
    """Give each row of ``new`` a consecutive id after ``max(existing_id)``,
    in ``order`` (a total order for a deterministic numbering).

    Distributed: a range-partitioned sort is written once, each row with its
    partition and its place in it; row counts per partition, a running sum over
    them (one row per partition) and the ids all come from that one table, so
    both sides mean the same partitions whatever the planner does. ``order``
    columns must be ascending column names.
    """
    from shelfspark.session import written

    order_cols = _cols(order)
    base = existing.agg(F.coalesce(F.max(existing_id), F.lit(0)).cast("long")).scalar()
    ordered = written(new.repartitionByRange(*order_cols)
                      .sortWithinPartitions(*order_cols)
                      .withColumn("_pid", F.spark_partition_id())
                      .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "assigned-ids")
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    # offsets has one row per partition: a proven, tiny broadcast.
    out = ordered.join(F.broadcast(offsets), "_pid")
    return (out.withColumn(id_col, base + F.col("_off") + F.col("_pos") + F.lit(1))
               .drop("_pid", "_pos", "_off"))
