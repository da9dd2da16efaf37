"""Row numbers within groups.

The default is a plain window: right for groups that one task can hold, such as
the relationships of one account.  For groups that may hold a large part of the
rows, ``spread=True`` range-partitions on the full sort key ``(group, order)``,
so that a hot group covers consecutive partitions:

1. each row is numbered within its (partition, group) piece;
2. the counts of the pieces (at most groups x partitions rows) give every piece
   the number of rows of its group in earlier partitions;
3. row number = local number + that offset.

The result equals the window for a total order.  Groups with NULL keys are
groups like any other on both paths.  Range bounds are sampled, so the assigned rows
are checkpointed once, in the shared checkpoint folder, and read by both sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_number_by(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "row_number",
                  spread: bool = False, partitions: int | None = None) -> DataFrame:
    if not spread:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("int"))
    from ..session import ensure_checkpoint_dir
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    r = df.repartitionByRange(n, *group, *order).withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    local = r.withColumn("__local", F.row_number().over(Window.partitionBy("__pid", *group).orderBy(*order)))
    counts = r.groupBy(*group, "__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"__g_{c}") for c in group], F.col("__pid").alias("__p"),
                            F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in group],
                  F.col("__pid") == F.col("__p"))
    return local.join(offsets, same).withColumn(out, (F.col("__local") + F.col("__off")).cast("int")) \
        .drop("__pid", "__p", "__local", "__off", *[f"__g_{c}" for c in group])
