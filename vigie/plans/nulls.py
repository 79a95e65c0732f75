"""SQL's null-aware NOT IN as joins of any size.

Spark plans ``NOT IN`` as a broadcast of the whole list. Here the two facts that make it null-aware (is the list empty,
does it hold a NULL) are scalar subqueries, and the rest is a plain ``left_anti`` join that Spark may shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, column: str, right: DataFrame, right_column: str) -> DataFrame:
    """Rows of ``left`` for which ``column NOT IN (right.right_column)`` is true."""
    values = right.select(F.col(right_column).alias("_v"))
    nothing = values.agg(F.count(F.lit(1)) == 0).scalar()
    has_null = values.agg(F.coalesce(F.max(F.col("_v").isNull()), F.lit(False))).scalar()
    rows = left.where(nothing | (~has_null & F.col(column).isNotNull()))
    return rows.join(values.distinct(), F.col(column) == F.col("_v"), "left_anti")
