"""MERGE-update of a DataFrame from another (left join + coalesce)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_update(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str], condition: str | None = None,
                 null_overwrites: bool = False, check_unique: bool = True) -> DataFrame:
    """Update ``update_cols`` of ``target`` from ``source`` matched on ``keys``.

    * matched rows take ``coalesce(source, target)`` (a NULL source keeps the
      old value) or, with ``null_overwrites``, the source value as is;
    * ``condition`` (SQL text over ``a.`` target and ``b.`` source columns)
      limits which matched rows are updated;
    * unmatched target rows are kept unchanged, so the row count never grows.

    The source must be unique on ``keys``.  With ``check_unique`` it is
    collapsed per key (partial aggregation, no extra job) and a key seen more
    than once fails the query through ``raise_error`` when it executes.
    """
    keys = list(keys)
    upd = [c for c in update_cols if c in target.columns]
    if condition is not None:
        # the condition may read any source column
        src_cols = [c for c in source.columns if c not in keys]
    else:
        src_cols = [c for c in upd if c in source.columns]
    src = source.select(*keys, *src_cols)
    if check_unique:
        src = (src.groupBy(*keys)
               .agg(*[F.first(c).alias(c) for c in src_cols], F.count(F.lit(1)).alias("__n"))
               .withColumn("__ok", F.when(F.col("__n") > 1, F.raise_error(
                   F.lit("merge_update: source has duplicate keys"))).otherwise(F.lit(True))))
    else:
        src = src.withColumn("__ok", F.lit(True))
    a, b = target.alias("a"), src.alias("b")
    cond = None
    for k in keys:
        e = F.col(f"a.{k}") == F.col(f"b.{k}")
        cond = e if cond is None else cond & e
    joined = a.join(b, cond, "left")
    hit = F.col("b.__ok").isNotNull()
    if condition is not None:
        hit = hit & F.expr(condition)
    out = []
    for c in target.columns:
        if c in upd and c in src_cols:
            new = F.col(f"b.{c}") if null_overwrites else F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}"))
            out.append(F.when(hit, new).otherwise(F.col(f"a.{c}")).alias(c))
        else:
            out.append(F.col(f"a.{c}").alias(c))
    return joined.select(out)
