"""Code dictionaries: the ``dictionary`` table (``grp, code, label``), and a group of it as one map.

A group is folded into a ``map`` by a scalar subquery over the table, so a lookup is a map access inside
whole-stage codegen without a join of the rows, and a change of the table needs no change of code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The groups the fixtures use, code -> label.
GROUPS: dict[str, dict[str, str]] = {
    "report.rpt_risk_grade": {"0": "低风险", "1": "中风险", "2": "高风险", "3": "黑名单"},
    "report.wh_risk_level": {"0": "C1", "1": "C2", "2": "C3", "3": "C4", "4": "C5", "5": "专业投资者"},
}


def code_map(dictionary: DataFrame, group: str) -> Column:
    """``code -> label`` of one group as a scalar subquery; a group without rows is an empty map.

    A code that stands twice in a group is an error of the table and fails the query.  Spark takes no subquery
    inside a lambda: add the map as a column first, then look codes up in that column.
    """
    rows = dictionary.where(F.col("grp") == group)
    return rows.agg(F.map_from_entries(F.collect_list(F.struct("code", "label"))).alias("labels")).scalar()


def dictionary_sql() -> str:
    rows = ",\n  ".join(f"('{g}', '{k}', '{v}')" for g, m in GROUPS.items() for k, v in m.items())
    return f"SELECT grp, code, label FROM (VALUES\n  {rows}\n) AS t(grp, code, label)"
