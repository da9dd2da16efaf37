"""Effective-dated rate lookup, run-date rates and tax split.

Rates live in a parameter table ``(fee_type, branch_id, begin_date,
end_date, para_value)`` whose ``branch_id`` is a text list of OA branches,
matched by substring containment.  The containment is resolved once, against the
OA branch dimension (both are parameter tables), into one row per OA branch
and period.

``rate_segments`` then cuts time at every begin and end of a branch's periods into
disjoint segments, each with the rates of all fee types that hold in it.  A job
joins its facts once, on the OA branch with the segment as residual condition,
however many fee types it asks for.  It holds for any date and fee type; two
periods that overlap fan a row out, and a rate row with a NULL value is a
match, as in the containment join.

No broadcast hints: Spark broadcasts the rate side below its own threshold.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def expand_rates(rates: DataFrame, oa_ids: DataFrame, match: str = "substring") -> DataFrame:
    """Resolve the branch text list of each rate row to OA branch ids.

    ``match='substring'`` keeps containment semantics (``O1`` also matches a
    list holding ``O12``); ``match='member'`` is exact list membership.
    An empty OA id never matches.
    """
    ids = oa_ids.select(F.col(oa_ids.columns[0]).alias("oa_branch_id")).distinct() \
        .filter(F.col("oa_branch_id").isNotNull() & (F.col("oa_branch_id") != ""))
    r = rates.alias("r")
    if match == "member":
        cond = F.array_contains(F.split(F.col("r.branch_id"), ","), F.col("i.oa_branch_id"))
    else:
        cond = F.instr(F.col("r.branch_id"), F.col("i.oa_branch_id")) > 0
    # both sides are small parameter tables; this is the only non-equi join
    return (r.join(ids.alias("i"), cond, "inner")
            .select("i.oa_branch_id", "r.fee_type", "r.begin_date", "r.end_date",
                    "r.para_value"))


def rate_dim(spark, match: str = "substring") -> DataFrame:
    """Expanded rate dimension from the registered ``rate_param`` and OA map."""
    oa = spark.table("branch_oa_rela").select("oa_branch_id")
    return expand_rates(spark.table("rate_param"), oa, match)


def resolved_rates(spark) -> DataFrame:
    """Segments of the registered rates: the parameter table ``rate_segment`` staged with the warehouse."""
    return spark.table("rate_segment")


def rate_segments(rdim: DataFrame) -> DataFrame:
    """``oa_branch_id, seg_from, seg_to, rates``: disjoint segments of time and the rates that hold in them.

    A date ``d`` lies in a segment when ``seg_from <= d < seg_to`` as text.  A period
    begins at its begin date and ends behind its end date, written ``end~``: behind that date, before the next.
    ``rates`` maps a fee type to the values that hold, one for each period.
    """
    spans = rdim.filter("begin_date <= end_date").select(
        "oa_branch_id", "fee_type", "begin_date", F.concat("end_date", F.lit("~")).alias("behind"), "para_value")
    cuts = spans.select("oa_branch_id", F.explode(F.array("begin_date", "behind")).alias("seg_from")).distinct()
    w = Window.partitionBy("oa_branch_id").orderBy("seg_from")
    cuts = cuts.select(F.col("oa_branch_id").alias("oa"), "seg_from", F.lead("seg_from").over(w).alias("seg_to")) \
        .filter(F.col("seg_to").isNotNull())
    held = spans.join(cuts, (F.col("oa_branch_id") == F.col("oa")) & (F.col("begin_date") <= F.col("seg_from"))
                      & (F.col("seg_from") < F.col("behind")))
    # a struct keeps a NULL value as a member of the list
    by_fee = held.groupBy("oa_branch_id", "seg_from", "seg_to", "fee_type") \
        .agg(F.transform(F.collect_list(F.struct("para_value")), lambda x: x["para_value"]).alias("held"))
    return by_fee.groupBy("oa_branch_id", "seg_from", "seg_to") \
        .agg(F.map_from_entries(F.collect_list(F.struct("fee_type", "held"))).alias("rates"))


def lookup_rates(facts: DataFrame, segments: DataFrame, oa_col: str, date_col: str,
                 fee_types: Mapping[str, str], how: str = "left") -> DataFrame:
    """Attach the rates valid at ``date_col`` (``yyyymmdd``) of several fee types by one join.

    ``fee_types``: output column -> fee type; ``segments`` as of ``rate_segments``.  ``how='left'`` keeps facts
    without a rate (value NULL); ``'inner'`` drops them.
    """
    r = segments
    for out, ft in fee_types.items():  # a generator a fee type, over the parameter table
        explode = F.explode_outer if how == "left" else F.explode
        r = r.select("*", explode(F.try_element_at("rates", F.lit(ft))).alias(out))
    r = r.select(F.col("oa_branch_id").alias("__oa"), F.col("seg_from").alias("__from"), F.col("seg_to").alias("__to"), *fee_types)
    d = F.col(date_col)
    return facts.join(r, (F.col(oa_col) == F.col("__oa")) & (d >= F.col("__from")) & (d < F.col("__to")), how) \
        .drop("__oa", "__from", "__to")


def run_date_rates(facts: DataFrame, rates: DataFrame, run_date: str, fee_types: Mapping[str, str],
                   oa_col: str | None = None) -> DataFrame:
    """Attach the rates valid at the run date, inner: without a rate there are no rows.

    By default a rate holds for every row, whatever its branch, and two valid
    rates of a fee type give two rows.  With ``oa_col`` a rate's branch list
    must contain the row's OA branch.
    """
    valid = rates.filter((F.col("begin_date") <= run_date) & (F.col("end_date") >= run_date))
    for out, ft in fee_types.items():
        r = valid.filter(F.col("fee_type") == ft).select(
            F.col("fee_type").alias(f"__ft_{out}"), F.col("para_value").alias(out),
            *([F.col("branch_id").alias(f"__list_{out}")] if oa_col else []))
        x = facts.withColumn("__ft", F.lit(ft))
        cond = F.col("__ft") == F.col(f"__ft_{out}")
        if oa_col:
            cond = cond & (F.instr(F.col(f"__list_{out}"), F.nullif(F.col(oa_col), F.lit(""))) > 0)
        facts = x.join(r, cond).drop("__ft", f"__ft_{out}", f"__list_{out}")
    return facts


def tax_split(amount: Column, vat: Column, surtax: Column | None = None,
              risk: Column | None = None) -> list[Column]:
    """Amount -> [amount/(1+vat), amount*surtax, amount*risk]; missing rate = 0."""
    out = [amount / (F.lit(1) + F.coalesce(vat, F.lit(0)))]
    if surtax is not None:
        out.append(amount * F.coalesce(surtax, F.lit(0)))
    if risk is not None:
        out.append(amount * F.coalesce(risk, F.lit(0)))
    return out


def with_oa_branch(facts: DataFrame, spark, branch_col: str, how: str = "inner") -> DataFrame:
    """Map a CTP branch column to its OA branch (``oa_branch_id``)."""
    m = spark.table("branch_oa_rela").select(
        F.col("ctp_branch_id").alias("__ctp"), "oa_branch_id", "oa_branch_name")
    return facts.join(m, F.col(branch_col) == F.col("__ctp"), how).drop("__ctp")
