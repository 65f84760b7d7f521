"""Ranks and running sums inside groups of any size, without a window over a whole group.

Rows are range-partitioned by (group, order), sorted and written, so a hot group spreads over as many files as it needs.
What lies before a row is what the earlier files hold of its group (one small row per file and group) plus what lies
before it in its own file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlab.llm.tables import written

AT = "_at"


def running(df: DataFrame, group: list[str], order: list[str], sums: tuple[str, ...] = (), name: str = "ordered") -> DataFrame:
    """``df`` with its place in its group: ``_rank`` (from 0), ``_rows`` (rows of the group), for each column ``x`` of
    ``sums`` the sum of it over the rows before, ``_before_x``, and ``_at``, a number unique to the row that ascends in the order.

    ``group`` columns must not be null.  Rows that tie in ``order`` get an arbitrary order among themselves, so give
    ``order`` all columns that the result is read by.  A group column named by ``order`` too is sorted only once.
    """
    keys = group + [o for o in order if o not in group]
    tie = F.monotonically_increasing_id()
    placed, _ = written(df.withColumn("_tie", tie).repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie")
                        .drop("_tie").withColumn(AT, F.monotonically_increasing_id()), name)
    part = F.shiftright(AT, 33).alias("_part")
    totals = [F.sum(c).alias(f"_sum_{c}") for c in sums]
    parts = placed.groupBy(part, *group).agg(F.count(F.lit(1)).alias("_n"), F.min(AT).alias("_first"), *totals)
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", *group, "_first", F.sum("_n").over(whole).alias("_rows"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rank0"),
                         *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_base_{c}") for c in sums])
    inside = Window.partitionBy("_part", *group).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("_part", part).join(parts, ["_part", *group])
    for c in sums:
        out = out.withColumn(f"_before_{c}", F.col(f"_base_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return (out.withColumn("_rank", F.col(AT) - F.col("_first") + F.col("_rank0"))
            .drop("_part", "_first", "_rank0", *[f"_base_{c}" for c in sums]))
