"""Helpers of this package: written intermediate tables, row identity, fixed randomness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pingzones.operators.shared_folder import new_folder


def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again.

    It cuts the lineage: an executor lost later cannot change what earlier
    steps decided, and nothing before is computed twice.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.partitionBy(*(partition_by or [])).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame, *also) -> Column:
    """64 bits from all columns that can be hashed; equal rows have equal hashes."""
    names = sorted(f.name for f in df.schema if _hashable(f.dataType))
    return F.xxhash64(*[named(n) for n in names], *also)


def identity(df: DataFrame) -> dict[str, Column]:
    """128 bits that tell rows apart, as two columns; ``_unit`` is ``row_hash``."""
    return {"_unit": row_hash(df), "_check": row_hash(df, F.lit("check"))}


IDENTITY = ["_unit", "_check"]


def named(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def placed(df: DataFrame, **added: Column) -> DataFrame:
    """Columns by their place (c0, c1, ...) and ``added`` ones, so that no name of theirs clashes or has a dot."""
    here = [named(c).alias(f"c{i}") for i, c in enumerate(df.columns)]
    return df.select(*here, *[v.alias(k) for k, v in added.items()])


def named_again(placed_: DataFrame, df: DataFrame) -> DataFrame:
    """The columns of ``df`` from a table made of ``placed(df)``."""
    return placed_.select(*[f"c{i}" for i in range(len(df.columns))]).toDF(*df.columns)


def uniform(*parts) -> Column:
    """A number in [0, 1) that only depends on ``parts``, so reruns agree."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def words(text: Column | str) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def prefix_of_partitions(placed: DataFrame, part: str, sums: list[str]) -> DataFrame:
    """For each partition number: what the partitions before it sum up to.

    One row per partition reaches the ungrouped window, not the rows themselves.
    Returns ``part``, ``before_<sum>`` and ``all_<sum>`` for each of ``sums``.
    """
    per_part = placed.groupBy(part).agg(*[F.sum(c).alias(c) for c in sums])
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per_part.select(
        part,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in sums],
        *[F.sum(c).over(everything).alias(f"all_{c}") for c in sums],
    )
