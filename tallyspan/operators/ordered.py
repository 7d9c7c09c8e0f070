"""Ordered work inside groups that may be far too large for one task.

``row_number().over(partitionBy(key))`` puts a whole group into one task. The
functions here give the same numbers while a group of any size stays spread:

* ``first_n``          keep the first n rows of each group, cut map-side first
* ``number_rows``      position in the group and sums before each row, any order
* ``running_sums``     sums before each row where the order is a dense integer
* ``next_value``       the following row's value, same precondition
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.storage import settle

# Rows of one (key, block) that may meet in one task.
BLOCK_ROWS = 4096
# Spark inserts its map-side group limit up to this many rows per group.
GROUP_LIMIT_DEFAULT = 1000


def _cols(columns: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of every group, as ``_rank`` 1..n.

    Up to the session's group-limit threshold Spark cuts each group to n rows
    per map task before the shuffle; above it the rows are numbered in blocks. Rows that tie
    in ``order`` follow a hash of their columns, so both ways choose the same ones.
    """
    order = [*order, F.xxhash64(*[
        name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind
    ])]
    limit = int(
        df.sparkSession.conf.get(
            "spark.sql.optimizer.windowGroupLimitThreshold", str(GROUP_LIMIT_DEFAULT)
        )
    )
    if n <= limit:
        spec = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_rank", F.row_number().over(spec)).filter(F.col("_rank") <= n)
    return number_rows(df, keys, order, position="_rank").filter(F.col("_rank") <= n)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    position: str = "position",
    running: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add each row's 1-based ``position`` in its group, and sums over the rows before it.

    The rows are range-partitioned by (keys, order), so a hot group covers many
    partitions, and written once so that the block ids stay fixed. One total per
    (group, block) is then accumulated over the blocks - at most one row per
    partition and group - and added back. ``order`` must be unique in a group.
    """
    sums = dict(running or {})
    marked = df.withColumns({f"_term_{name}": term for name, term in sums.items()})
    placed = (
        marked.repartitionByRange(*_cols(keys), *order)
        .sortWithinPartitions(*_cols(keys), *order)
        .withColumn("_seq", F.monotonically_increasing_id())
        .withColumn("_block", F.shiftright("_seq", 33))
    )
    placed = settle(placed, "numbered")

    in_block = [*keys, "_block"]
    totals = placed.groupBy(*in_block).agg(
        F.count("*").alias("_n"),
        F.min("_seq").alias("_first"),
        *[F.sum(f"_term_{name}").alias(f"_sum_{name}") for name in sums],
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        if keys
        else Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *in_block,
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_base_{name}")
            for name in sums
        ],
    )
    # Null group keys are groups of their own, hence the null-safe join.
    left, right = placed.alias("l"), offsets.alias("r")
    on = F.col("l._block") == F.col("r._block")
    for key in keys:
        on = on & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    joined = left.join(right, on).select(
        "l.*", "r._first", "r._before", *[f"r._base_{name}" for name in sums]
    )
    result = joined.withColumn(
        position, (F.col("_before") + F.col("_seq") - F.col("_first") + 1).cast("long")
    )
    if sums:
        inside = (
            Window.partitionBy(*in_block)
            .orderBy("_seq")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        result = result.withColumns(
            {
                name: F.col(f"_base_{name}")
                + F.coalesce(F.sum(f"_term_{name}").over(inside), F.lit(0))
                for name in sums
            }
        )
    return result.drop(
        "_seq", "_block", "_first", "_before",
        *[f"_term_{name}" for name in sums], *[f"_base_{name}" for name in sums],
    )


def _with_block(df: DataFrame, order: str, size: int) -> DataFrame:
    return df.withColumn("_block", F.floor(F.col(order) / F.lit(size)).cast("long"))


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Mapping[str, Column],
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """Sums over the rows before each row, for an ``order`` that is a whole number >= 0.

    ``order`` is unique within a group, so a block of ``size`` order values holds
    at most ``size`` rows whatever the group's total is. Only groups reaching
    beyond their first block need an offset; for all others that table is empty.
    """
    blocked = _with_block(df, order, size).withColumns(
        {f"_term_{name}": term for name, term in sums.items()}
    )
    in_block = [*keys, "_block"]
    # The test is on the column itself, so the scan skips row groups without long groups.
    long_groups = df.filter(F.col(order) >= size).select(*keys).distinct()
    totals = (
        blocked.join(long_groups, list(keys), "left_semi")
        .groupBy(*in_block)
        .agg(*[F.sum(f"_term_{name}").alias(f"_sum_{name}") for name in sums])
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *in_block,
        *[F.sum(f"_sum_{name}").over(earlier).alias(f"_base_{name}") for name in sums],
    ).filter(F.col("_block") > 0)
    inside = (
        Window.partitionBy(*in_block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0)
    return (
        blocked.join(offsets, in_block, "left")
        .withColumns(
            {
                name: F.coalesce(F.col(f"_base_{name}"), zero)
                + F.coalesce(F.sum(f"_term_{name}").over(inside), zero)
                for name in sums
            }
        )
        .drop("_block", *[f"_term_{n}" for n in sums], *[f"_base_{n}" for n in sums])
    )


def next_value(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    name: str,
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """``lead(value)`` in ``order``, same precondition as ``running_sums``.

    The last row of a block takes the first value of the group's next block,
    which is looked up only for groups that have one.
    """
    blocked = _with_block(df, order, size).withColumn("_value", value)
    in_block = [*keys, "_block"]
    heads = (
        blocked.filter(F.col(order) >= size)
        .groupBy(*in_block)
        .agg(F.min_by("_value", order).alias("_edge"))
    )
    # Between two neighbouring heads no block but the earlier one holds rows; before
    # the first head only block 0 can.
    previous = F.lag("_block").over(Window.partitionBy(*keys).orderBy("_block"))
    edges = heads.select(*keys, F.coalesce(previous, F.lit(0)).alias("_block"), "_edge")
    inside = Window.partitionBy(*in_block).orderBy(order)
    return (
        blocked.join(edges, in_block, "left")
        .withColumn(name, F.coalesce(F.lead("_value").over(inside), F.col("_edge")))
        .drop("_block", "_value", "_edge")
    )
