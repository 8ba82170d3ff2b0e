"""Running sums over one global order without sorting everything in one task."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitf.session import materialise


def join_groups(left: DataFrame, right: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Inner join on the group columns, NULL groups included: a struct compares its NULL fields as equal."""
    key = F.struct(*groups)
    right = right.withColumn("_group_key", key).drop(*groups)
    return left.withColumn("_group_key", key).join(right, "_group_key").drop("_group_key")


def running_totals(df: DataFrame, order: Sequence[tuple[str, bool]], measures: dict[str, Column],
                   groups: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sum and group total of every measure.

    ``order`` lists (column, ascending). For measure ``m`` the result adds
    ``m``, ``m_cum`` and ``m_total``. The order columns must be unique within a
    group (collapse equal keys first, or end with an id): equal keys cannot be
    split over tasks.

    Rows are range-partitioned into slices and written once, so a slice number
    never changes when a task is retried. Slice totals (one row per slice and
    group) give the offsets; the running sum itself works inside each slice, so
    a group holding most of the rows is still spread over many tasks.
    """
    groups = list(groups)
    keys = [F.col(g).asc() for g in groups] + [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        df.withColumns(measures).repartitionByRange(slices, *keys).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )

    # A struct compares its NULL fields as equal, so rows of a NULL group find their offset.
    # Join and window then use the same keys and share one shuffle.
    place = ["_slice"]
    if groups:
        placed = placed.withColumn("_group", F.struct(*groups))
        place = ["_group", "_slice"]
    earlier = Window.partitionBy(*place[:-1]).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*place[:-1])
    slice_sums = placed.groupBy(*place).agg(*[F.sum(m).alias(m) for m in measures])
    offsets = slice_sums.select(
        *place,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_{m}_before") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = (Window.partitionBy(*place)
              .orderBy(*keys[len(groups):])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = placed.join(offsets, place).withColumns(
        {f"{m}_cum": F.sum(m).over(inside) + F.col(f"_{m}_before") for m in measures}
    )
    return out.drop(*place, *[f"_{m}_before" for m in measures])
