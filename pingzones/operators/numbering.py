"""Consecutive ids for new rows, continuing after the highest id in use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingzones.operators.shared_folder import new_folder
from pingzones.operators.skew import row_spread

# monotonically_increasing_id keeps the position within a partition in its low bits.
_POSITION_BITS = 33


def max_id(df: DataFrame, column: str = "id") -> DataFrame:
    """One row: the highest id, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("max_id"))


def with_row_index(rows: DataFrame, out: str, order_by: list[str] | None = None) -> DataFrame:
    """Number the rows 0, 1, 2, ... without sending them through one task.

    Each partition numbers its own rows; adding the sizes of the partitions
    before it makes the numbers consecutive.  The rows are first written with
    their place to the shared folder, so that a lost executor cannot renumber
    some of them; counting then reads the place column only.

    With ``order_by`` the numbers follow that order.  The range shuffle also
    splits on a hash of the row and its input partition, so a run of equal keys,
    or of copies, does not end up in one partition.
    """
    spark = rows.sparkSession
    if order_by:
        keys: list[str | Column] = [*order_by, "_tie"]
        rows = (
            rows.withColumn("_tie", row_spread(rows, F.lit(1 << 30)))
            .repartitionByRange(*keys)
            .sortWithinPartitions(*keys)
            .drop("_tie")
        )
    folder = new_folder(spark, "numbering")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    rows.withColumns({"_part": F.spark_partition_id(), "_pos": position}).write.parquet(folder)
    placed = spark.read.parquet(folder)
    # One row per partition of the input, so this ungrouped window stays small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )


def with_next_ids(
    rows: DataFrame, existing: DataFrame, column: str = "id", order_by: list[str] | None = None
) -> DataFrame:
    """``rows`` with ids that follow the highest one of ``existing``.

    Too many rows for the id type raise an overflow error under ANSI mode.
    """
    kind = existing.schema[column].dataType
    first = max_id(existing, column).first()["max_id"] + 1
    numbered = with_row_index(rows, "_index", order_by)
    return numbered.withColumn(column, (F.col("_index") + first).cast(kind)).drop("_index")
