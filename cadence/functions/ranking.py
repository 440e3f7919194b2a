"""Global ranks without a single-partition window.

Rows are range-partitioned and sorted once, and that placement is written to the shared
checkpoint folder before anything else reads it. A row's rank is the number of rows in
earlier partitions plus its position in its own. Both the rows and the partition sizes are
read from the written placement, so there is one set of range boundaries, ever.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.session import checkpoint_dir


def global_rank(df: DataFrame, order: list[str], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (ascending, nulls first); ties get
    consecutive ranks in an unspecified order, fixed for the returned frame.

    A running row id is the last range key, so rows with equal keys (also fully equal rows)
    spread over as many partitions as their number asks for.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.withColumn("__tie", F.monotonically_increasing_id())
              .repartitionByRange(n, *order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie")
              # Documented contract of this id: partition number in the upper 31 bits,
              # record number within the partition in the lower 33.
              .withColumn("__at", F.monotonically_increasing_id()).checkpoint())
    part, pos = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__pid")).agg(F.count(F.lit(1)).alias("__cnt"))
    offsets = sizes.withColumn("__off", F.coalesce(F.sum("__cnt").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__pid", "__off")
    # offsets has one row per partition: a proven bound for the broadcast.
    return (placed.withColumn("__pid", part).join(F.broadcast(offsets), "__pid")
            .withColumn(out, F.col("__off") + pos).drop("__pid", "__at", "__off"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL (group keys may be NULL)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def running_totals(df: DataFrame, groups: list[str], order: list[str], value: str,
                   before: str = "__before", total: str = "__total", partitions: int | None = None,
                   wanted=None) -> DataFrame:
    """``df`` with the sum of ``value`` over a group's rows that come earlier in ``order``, and over
    all of them. Rows are range-partitioned by (groups, order, a running row id) and written once,
    so neither a large group nor many equal rows end up in one task; a table of one row per
    partition and group holds the offsets.

    ``wanted(first, size, total)`` says whether a group's part of a partition, which covers the
    running sums from ``first`` to ``first + size``, is of interest; the rows of all other parts
    are left out before they are sorted."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.withColumn("__tie", F.monotonically_increasing_id())
              .repartitionByRange(n, *groups, *order, "__tie")
              .withColumn("__part", F.spark_partition_id()).checkpoint())
    keys = [*groups, "__part"]
    by_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = by_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    sums = (placed.groupBy(*keys).agg(F.sum(value).alias("__s"))
            .withColumn(total, F.sum("__s").over(by_group))
            .withColumn("__off", F.sum("__s").over(earlier) - F.col("__s")))
    if wanted is not None:
        sums = sums.where(wanted(F.col("__off"), F.col("__s"), F.col(total)))
    rows = join_null_safe(placed, sums.drop("__s"), keys, "left" if wanted is None else "inner")
    mine = Window.partitionBy(*keys).orderBy(*order, "__tie").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn(before, F.col("__off") + F.sum(value).over(mine) - F.col(value))
            .drop("__tie", "__part", "__off"))
