"""Scalar column functions (all built-in Spark expressions, no Python UDFs)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def compact_date(x) -> Column:
    """``yyyy-mm-dd`` -> ``yyyymmdd``."""
    return F.regexp_replace(_c(x), "-", "")


def dash_date(x) -> Column:
    """``yyyymmdd`` -> ``yyyy-mm-dd``."""
    c = _c(x)
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


def to_date_ymd(x) -> Column:
    return F.to_date(_c(x), "yyyyMMdd")


def money(x, digits: int = 2, scale: int = 10) -> Column:
    """HALF_UP rounding through DECIMAL(38,10), so float noise never decides a tie.

    A smaller ``scale`` fits single amounts of a fact, which have at most that many
    digits: a decimal of 18 digits is a plain long, much cheaper per row.
    """
    return F.round(_c(x).cast(f"decimal({38 if scale > 9 else 18},{scale})"), digits).cast("double")


def safe_divide(x, d) -> Column:
    """``x / d`` with a zero or NULL divisor treated as 1."""
    d = _c(d)
    return _c(x) / F.when(d.isNull() | (d == 0), F.lit(1)).otherwise(d)


def case_max(a, b) -> Column:
    """``CASE WHEN a > b THEN a ELSE b END``.

    Unlike ``greatest``: a NULL ``a`` picks ``b``, a NULL ``b`` stays NULL.
    """
    a, b = _c(a), _c(b)
    return F.when(a > b, a).otherwise(b)


def decode(x, mapping: Mapping[str, str], default=None) -> Column:
    """CASE chain ``code -> label`` with an ``else`` value."""
    x = _c(x)
    out = None
    for k, v in mapping.items():
        out = F.when(x == k, F.lit(v)) if out is None else out.when(x == k, F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


# Relation-type labels (fixed values: codes 301, 001, 002, 003 of the broker
# relation table and their labels; anything else decodes to '-').
RELATION_LABELS = {
    "301": "居间关系",
    "001": "开发关系",
    "002": "服务关系",
    "003": "维护关系",
}


def relation_label(x) -> Column:
    return decode(x, RELATION_LABELS, "-")


def multi_code_label(codes, labels) -> Column:
    """Comma list of codes -> comma list of labels; unknown codes and empty labels dropped.

    ``labels`` is a ``map<string,string>`` column (a dictionary group folded
    into a map).  NULL in gives NULL out.
    """
    found = _c(labels)
    looked_up = F.transform(F.split(_c(codes), ","), lambda k: found[k])
    return F.array_join(F.filter(looked_up, lambda v: v.isNotNull() & (v != "")), ",")


def nullif_empty(x) -> Column:
    x = _c(x)
    return F.when(x == "", F.lit(None)).otherwise(x)
