"""Ordered computations that do not put one key's whole history into one task.

A plain window over ``keys`` sorts all rows of a key in one task.  When a single key may hold a
third of the table that task is the job.  These helpers take a ``chunk`` column (a day number, a
block of sequence numbers) that is monotone in the order.  Rows are windowed inside ``(keys, chunk)``,
each chunk is summarised to one row, the small summary is windowed per key, and the carried value
is joined back.  The answers equal the plain window's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.session import cut_lineage


def with_previous(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str],
                  value: Column, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` on an earlier row of the same key."""
    tmp = df.withColumn("__v", value)
    inside = (Window.partitionBy(*keys, chunk).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = tmp.withColumn("__near", F.last("__v", ignorenulls=True).over(inside))
    tails = (tmp.where(F.col("__v").isNotNull())
             .groupBy(*keys, chunk)
             .agg(F.max_by(F.struct(F.col("__v").alias("v")), F.struct(*order)).alias("__tail")))
    return _carry(tmp, rows, tails, keys, chunk, name, forward=True)


def with_next(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str],
              value: Column, name: str) -> DataFrame:
    """Add ``name``: the first non-null ``value`` on a later row of the same key."""
    tmp = df.withColumn("__v", value)
    inside = (Window.partitionBy(*keys, chunk).orderBy(*order)
              .rowsBetween(1, Window.unboundedFollowing))
    rows = tmp.withColumn("__near", F.first("__v", ignorenulls=True).over(inside))
    heads = (tmp.where(F.col("__v").isNotNull())
             .groupBy(*keys, chunk)
             .agg(F.min_by(F.struct(F.col("__v").alias("v")), F.struct(*order)).alias("__tail")))
    return _carry(tmp, rows, heads, keys, chunk, name, forward=False)


def _carry(tmp: DataFrame, rows: DataFrame, tails: DataFrame, keys: Sequence[str], chunk: str,
           name: str, forward: bool) -> DataFrame:
    chunks = tmp.select(*keys, chunk).distinct()
    left = chunks.alias("c").join(tails.alias("t"), [*keys, chunk], "left")
    if forward:
        frame = (Window.partitionBy(*keys).orderBy(chunk)
                 .rowsBetween(Window.unboundedPreceding, -1))
        carried = F.last("__tail", ignorenulls=True).over(frame)
    else:
        frame = (Window.partitionBy(*keys).orderBy(chunk)
                 .rowsBetween(1, Window.unboundedFollowing))
        carried = F.first("__tail", ignorenulls=True).over(frame)
    carry = left.select(*keys, chunk, carried.alias("__carry"))
    return (rows.join(carry, [*keys, chunk], "left")
            .withColumn(name, F.coalesce("__near", "__carry.v"))
            .drop("__v", "__near", "__carry"))


def running_sum(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str],
                value: Column, name: str) -> DataFrame:
    """Add ``name``: the inclusive running total of ``value`` in order."""
    tmp = df.withColumn("__v", value)
    inside = (Window.partitionBy(*keys, chunk).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    rows = tmp.withColumn("__near", F.sum("__v").over(inside))
    totals = tmp.groupBy(*keys, chunk).agg(F.sum("__v").alias("__total"))
    frame = (Window.partitionBy(*keys).orderBy(chunk)
             .rowsBetween(Window.unboundedPreceding, -1))
    carry = totals.select(*keys, chunk, F.sum("__total").over(frame).alias("__carry"))
    return (rows.join(carry, [*keys, chunk], "left")
            .withColumn(name, F.coalesce("__near", F.lit(0)) + F.coalesce("__carry", F.lit(0)))
            .drop("__v", "__near", "__carry"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  cols: Sequence[str]) -> DataFrame:
    """One row per key: ``cols`` of the row that sorts first.

    Written as an aggregate, so each input task reduces a hot key to one row before the shuffle.
    """
    best = F.min_by(F.struct(*cols), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 cols: Sequence[str]) -> DataFrame:
    """One row per key: ``cols`` of the row that sorts last."""
    best = F.max_by(F.struct(*cols), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*")


def ranked_rows(df: DataFrame, order: Sequence[Column], name: str,
                partitions: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of every row in one global order.

    A window without ``partitionBy`` would move the table into one task.  Here the rows are range
    partitioned, the partition number is written down with the rows, and each row's position is its
    rank inside its range plus the sizes of the ranges before it.  Only the list of range sizes,
    one row per partition, is windowed as a whole.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(parts, *order)
              .withColumn("__range", F.spark_partition_id()))
    ranged = cut_lineage(ranged)
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range",
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    local = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    # one row per range partition, so the broadcast is bounded by the partition count
    return (ranged.withColumn("__local", local)
            .join(F.broadcast(starts), "__range")
            .withColumn(name, F.col("__start") + F.col("__local"))
            .drop("__range", "__local", "__start"))


def ranked_value(df: DataFrame, keys: Sequence[str], value: str, width: float,
                 ranks: dict[str, Column]) -> DataFrame:
    """Exact order statistics per key without holding a key's values in one place.

    Values are counted first (a map-side combine), grouped into bins of ``width``, and only the
    bins that hold a wanted rank are opened.  ``ranks`` maps an output name to a 0-based rank
    expression over ``n``, the number of rows of the key.
    """
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, F.col(value).alias("__x")).agg(F.count(F.lit(1)).alias("__c"))
              .withColumn("__bin", F.floor(F.col("__x") / F.lit(width))))
    bins = counts.groupBy(*keys, "__bin").agg(F.sum("__c").alias("__bc"))
    by_bin = Window.partitionBy(*keys).orderBy("__bin")
    bins = (bins
            .withColumn("__from", F.coalesce(
                F.sum("__bc").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("n", F.sum("__bc").over(Window.partitionBy(*keys))))
    wanted = F.array(*[F.struct(F.lit(name).alias("stat"), expr.cast("long").alias("rank"))
                       for name, expr in ranks.items()])
    asked = (bins.withColumn("__w", F.explode(wanted))
             .where((F.col("__w.rank") >= F.col("__from"))
                    & (F.col("__w.rank") < F.col("__from") + F.col("__bc")))
             .select(*keys, "__bin", "__from", F.col("__w.stat").alias("__stat"),
                     F.col("__w.rank").alias("__rank")))
    opened = counts.join(asked, [*keys, "__bin"])
    within = (Window.partitionBy(*keys, "__bin", "__stat").orderBy("__x")
              .rowsBetween(Window.unboundedPreceding, 0))
    hit = (opened.withColumn("__upto", F.col("__from") + F.sum("__c").over(within))
           .where((F.col("__rank") < F.col("__upto"))
                  & (F.col("__rank") >= F.col("__upto") - F.col("__c"))))
    return hit.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__stat") == name, F.col("__x"))).alias(name) for name in ranks])


def exact_median(df: DataFrame, keys: Sequence[str], value: str, width: float,
                 name: str) -> DataFrame:
    """Per-key median; an even count averages the middle two."""
    n = F.col("n")
    got = ranked_value(df, keys, value, width, {
        "__lo": F.floor((n - 1) / 2), "__hi": F.floor(n / 2)})
    return got.select(*keys, ((F.col("__lo") + F.col("__hi")) / 2.0).alias(name))
