"""Global positions and running totals without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_running(
    df: DataFrame,
    order: Sequence[Column],
    totals: dict[str, str] | None = None,
    position: str = "position",
) -> DataFrame:
    """Add a 1-based ``position`` in ``order`` and running sums (new name -> column).

    Rows are range-partitioned and sorted, numbered inside their partition, and
    shifted by what the partitions before hold. Only one row per partition
    meets in a single task. ``order`` should be unique, so that the ranges are
    even and the result is fixed.
    """
    totals = totals or {}
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("_part", F.shiftright("_slot", _LOCAL_BITS))

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(c).alias(f"_sum_{new}") for new, c in totals.items()],
    )
    offsets = offsets.select(  # at most n rows
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_sum_{t}").over(before), F.lit(0)).alias(f"_before_{t}") for t in totals],
    )
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    out = placed
    for new, c in totals.items():
        out = out.withColumn(f"_in_{new}", F.sum(c).over(inside))
    out = out.join(F.broadcast(offsets), "_part")
    local = F.col("_slot").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    out = out.withColumn(position, local + F.col("_rows_before") + 1)
    for new in totals:
        out = out.withColumn(new, F.coalesce(F.col(f"_in_{new}"), F.lit(0)) + F.col(f"_before_{new}"))
    return out.select(*df.columns, position, *totals)
